import hashlib
import random
import re
from collections import Counter

import pytest

from quire.llm.repeats import anchors, covered, intervals, merged, remove_repeats

from .cases import SCHEMA, frame, rows


def brute(found, length):
    count = Counter()
    raw = [(t or "").encode() for _, t, *_ in found]
    for data in raw:
        count.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for (i, *_), data in zip(found, raw, strict=True):
        runs = merged([(k, k + length) for k in range(len(data) - length + 1) if count[data[k : k + length]] > 1])
        gone = set()
        for a, b in runs:
            gone.update(range(a, b))
        left = bytes(c for k, c in enumerate(data) if k not in gone)
        out.append((i, len(data), len(gone), len(runs), hashlib.sha256(left).hexdigest()))
    return Counter(out)


def digests(df):
    return Counter((r.doc_id, r.repeats.n_bytes, r.repeats.n_removed, r.repeats.n_spans, r.repeats.kept_sha256) for r in df.collect())


def passages(seed):
    """Texts that share stretches of lengths around the limit, at their ends, in the middle and within themselves."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    pool = [prose(40)[:n] for n in (99, 100, 101, 130, 180)] + [prose(200)]
    out = []
    for i in range(50):
        parts = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(pool)
            a = r.randint(0, len(p) // 2) if r.random() < 0.5 else 0
            parts += [prose(r.randint(0, 30)), p[a:]]
        out.append((i, "".join(parts), "r", "o", i, i))
    out += [(100, "ab" * 400, "r", "o", 0, 0), (101, "z" * 350, "r", "o", 0, 0), (102, prose(300) + "ab" * 60, "r", "o", 0, 0)]
    return out


@pytest.mark.parametrize("crowd", [1000, 1])
def test_matches_brute_force(spark, crowd):
    for seed in (1, 2):
        found = passages(seed)
        got = digests(remove_repeats(spark.createDataFrame(found, SCHEMA), length=100, gram=16, crowd=crowd))
        assert got == brute(found, 100)
        assert any(0 < x[2] < x[1] for x in got)


def test_edge_cases_and_columns(spark):
    out = remove_repeats(frame(spark))
    assert digests(out) == brute(rows(), 400)
    assert out.columns == ["doc_id", "text", "row", "id", "th", "n", "repeats"]
    assert Counter((r.doc_id, r.text, r.row, r.id, r.th, r.n) for r in out.collect()) == Counter(rows())


def test_cut_characters_leave_the_text_valid(spark):
    shared = "é" * 300
    found = [(1, "x" + shared, "r", "o", 0, 0), (2, "ñ" + shared[:-1] + "à", "r", "o", 0, 0)]
    out = {r.doc_id: r.repeats for r in remove_repeats(spark.createDataFrame(found, SCHEMA)).collect()}
    assert out[2].text.strip("ñà") == "" and out[1].text == "x"


def test_interval_tree_has_every_node_once():
    words = sorted(["banana", "bandana", "band", "bar", "can", "canal", "canals", "zoo"])
    lcp = [len([1 for k in range(min(len(a), len(b))) if a[: k + 1] == b[: k + 1]]) for a, b in zip(words, words[1:])]
    want = set()
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            h = min(lcp[i:j])
            if (i == 0 or lcp[i - 1] < h) and (j == len(words) - 1 or lcp[j] < h):
                want.add((h, i, j))
    assert sorted(intervals(lcp)) == sorted(want)


def test_all_members_of_a_repeat_are_covered_not_just_neighbours():
    core = bytes(range(65, 91)) * 4
    contexts = [(bytes([k]) * 3 + core + bytes([255 - k]) * 3, 3 + 50) for k in range(20)]
    assert covered(contexts, 100) == [[(3, 107)]] * 20


def test_anchors_cover_all_windows_of_a_long_text():
    r = random.Random(0)
    text = bytes(r.randrange(256) for _ in range(5000))
    found = anchors(text, 400, 32)
    assert sum(w for _, w, _ in found) == 5000 - 399
    assert len(found) < 60


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_words(found, length):
    """The words of each row that a repeated run of ``length`` words covers, and the text without those runs."""
    count, split = Counter(), [[(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t, *_ in found]
    raw = [(t or "").encode() for _, t, *_ in found]
    words = [[data[a:b] for a, b in places] for data, places in zip(raw, split, strict=True)]
    for w in words:
        count.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = []
    for (i, *_), data, w, places in zip(found, raw, words, split, strict=True):
        runs = merged([(k, k + length) for k in range(len(w) - length + 1) if count[tuple(w[k : k + length])] > 1])
        at, kept = 0, b""
        for a, b in runs:
            kept, at = kept + data[at : places[a][0]], places[b - 1][1]
        out.append((i, sum(b - a for a, b in runs), (kept + data[at:]).decode()))
    return Counter(out)


@pytest.mark.parametrize("crowd", [1000, 1])
def test_passages_match_brute_force(spark, crowd):
    found = passages(3) + [(200, "a b " * 40, "r", "o", 0, 0), (201, "\n".join("ab" * 5), "r", "o", 0, 0), (202, None, "r", "o", 0, 0)]
    out = remove_repeats(spark.createDataFrame(found, SCHEMA), length=10**6, words=12, word_gram=4, crowd=crowd)
    got = Counter((r.doc_id, r.repeats.n_passage_words, r.repeats.text) for r in out.collect())
    assert got == brute_words(found, 12)
    assert any(0 < n < len(t.split()) for _, n, t in got) and any(n == 0 for _, n, _ in got)


def test_passages_of_few_bytes_go_and_leave_the_other_figures(spark):
    r = random.Random(5)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    long, short = prose(51), prose(50)
    found = [(k, f"{prose(30)} {p.replace(' ', gap)} {prose(30)}", "r", "o", 0, 0) for k, (p, gap) in enumerate([(long, " "), (long, "\n"), (short, " "), (short, " ")])]
    df = spark.createDataFrame(found, SCHEMA)
    out = {x.doc_id: x.repeats for x in remove_repeats(df, words=51).collect()}
    assert [out[k].n_passage_words for k in range(4)] == [51, 51, 0, 0]
    assert long not in out[0].text and len(out[1].text.split()) == 60 and short in out[2].text
    assert digests(remove_repeats(df, words=51)) == digests(remove_repeats(df)) == brute(found, 400)
