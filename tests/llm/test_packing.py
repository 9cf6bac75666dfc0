import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm.packing import Plan, WordEncoder, pack, place

from .cases import SCHEMA, frame, rows, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def test_word_cache_equals_the_library():
    odd = ["<|endoftext|> a<|startoftext|>b", "é ́x İΣ Σ", "it's 's ''s don't x\x1cy\x85z", "12 3.4%", "a\r\nb\tc", "ΑΣ ΣΑΣ", "ﬁ ½ ①"]
    library = Tokenizer.from_file(PATH)
    own = WordEncoder(PATH)
    for text in [t or "" for t in texts()] + odd:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("limits", [{}, {"capacity": 64}, {"capacity": 64, "max_documents": 3, "max_cost": 4096}])
def test_every_piece_is_packed_once_under_every_limit(spark, limits):
    capacity, most = limits.get("capacity", 2048), limits.get("max_documents", 1 << 30)
    got = pack(frame(spark), PATH, with_ids=True, **limits).collect()
    want = Counter()
    for i, text, *_ in rows():
        ids = ids_of(text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            want[(i, k, at, len(part) // 4, zlib.crc32(part), part)] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.crc, bytes(r.ids)) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity and len(inside) <= most
        assert sum(n * n for _, n in inside) <= limits.get("max_cost", 1 << 60)
    if not limits:
        assert len(bins) == -(-sum(r.length for r in got) // capacity)


def test_plan_is_close_to_the_lower_bound():
    r = random.Random(3)
    lengths = Counter(min(2048, int(r.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    need = -(-sum(n * c for n, c in lengths.items()) // 2048)
    for rule in ("norm", "dot"):
        plan = Plan(place(lengths, (2048, 2048, 2048 * 2048), (1, 0.01, 0.01), rule))
        assert plan.sequences <= need * 1.01
        assert len(plan.length) < 20_000


def test_empty(spark):
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
