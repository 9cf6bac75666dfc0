import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm.bpe import BpeCodec, decode, encode, round_trip

from .cases import SCHEMA, frame, rows, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    return BpeCodec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_ids_and_text_as_the_library(codec, library):
    r = random.Random(2)
    odd = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|>", " lead", "trail ", "two  spaces", "a\n\nb", "a \nb", "a\n b\r\n", "it's we'll 'd", "x y z\x1cq\x85w", "x" * 500 + " " + "ab" * 300, "日本語 текст עברית", "🙂👩‍👩‍👧 é", "12 345 ½ ①"]
    alphabet = "aabbcdeehiinorstt  \n.,'éß漢0"
    many = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 200))) for _ in range(800)]
    syllables = ["ther", "ing", "tion", "ou", "le", "in", "eaux", "sch", "über", "ia", "re", "s", "t"]
    many += [" ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 5))) for _ in range(100)) for _ in range(100)]
    all_texts = [t or "" for t in texts()] + odd + many
    got = codec.encode(all_texts)
    for text, ids in zip(all_texts, got, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)
    assert codec.encode(all_texts) == got  # from the cache


def test_compatible_pairs_are_those_that_stay(codec):
    import numpy as np

    r = random.Random(5)
    own = list(codec.proposable.values())
    a, b = (np.array([r.choice(own) for _ in range(3000)] + [1, 1, 64, 64]) for _ in range(2))
    want = [codec.merge(codec.bytes_of[x] + codec.bytes_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert codec.compatible(a, b).tolist() == want
    assert 0 < sum(want) < len(want)


def test_repeated_letters_merge_from_the_left(codec, library):
    for text in ("aaaaaaa", "-----", "=" * 77, "hahahahaha", "\t\t\t\t\t"):
        assert codec._merge_long([codec.single[b] for b in text.encode()]) == codec.merge(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_frames(spark, library):
    docs = frame(spark)
    tokens = encode(docs, PATH)
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows())
    assert Counter((r.id, tuple(r.ids)) for r in tokens.collect()) == want
    assert Counter((r.id, r.text) for r in decode(tokens, PATH).collect()) == Counter((i, t or "") for i, t, *_ in rows())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = Counter((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, PATH).collect())
    assert got == Counter((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(list(ids), skip_special_tokens=False))) for (i, ids), n in want.items() for _ in range(n))


def test_empty(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA), PATH).count() == 0
