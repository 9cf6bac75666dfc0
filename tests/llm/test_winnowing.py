import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quire.llm.repeats import gram_hashes
from quire.llm.winnowing import compare_with_next, fingerprints, likeness, winnow

from .cases import SCHEMA, frame, rows

BLANK = b" \t\n\x0b\x0c\r"


def plain(text, gram, window):
    """Marks one window at a time."""
    kept = [k for k, b in enumerate(text) if b not in BLANK]
    data = bytes(text[k] for k in kept).lower()
    if len(data) < gram:
        return kept[:1]
    h = [int(x) & ~((1 << 23) - 1) for x in gram_hashes(np.frombuffer(data, np.uint8), gram)]
    out = []
    for i in range(max(1, len(h) - window + 1)):
        part = h[i : i + window]
        best = max(k for k, x in enumerate(part) if x == min(part)) + i
        if not out or out[-1] != best:
            out.append(best)
    return [kept[k] for k in out]


def test_marks_equal_the_definition():
    r = random.Random(1)
    for _ in range(60):
        text = bytes(r.choice(b"abAB  \n") for _ in range(r.randint(0, 150)))
        for gram, window in ((4, 8), (8, 5), (16, 32)):
            assert winnow(text, gram, window)[0].tolist() == plain(text, gram, window)


def test_match_guarantee_and_noise_floor():
    r = random.Random(2)
    letters = lambda n: bytes(r.choice(b"abcdefghij") for _ in range(n))
    for _ in range(40):
        shared = letters(16 + 32 - 1)
        a, b = letters(r.randint(0, 90)) + shared + letters(40), letters(r.randint(0, 90)) + shared.upper() + letters(5)
        assert set(winnow(a)[1].tolist()) & set(winnow(b)[1].tolist())
    assert likeness(winnow(letters(500))[1], winnow(letters(500))[1]) == 0
    assert len(winnow(letters(33_000))[1]) < 33_000 * 2 / 33 * 1.1


def brute(found):
    ordered = sorted(found, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        where, a = winnow(text.encode())
        b, c = (winnow(t.encode())[1] for t in (edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{x:08x}" for x in a), "".join(f"{x:08x}" for x in b), likeness(a, b), likeness(a, c), tuple(where.tolist())))
    return Counter(out)


@pytest.mark.parametrize("width", [1, 4, 30])
def test_next_documents(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        assert Counter((*r[:7], tuple(r.positions)) for r in compare_with_next(frame(spark)).collect()) == brute(rows())
        same = [(7, t, "r", "o", 0, 0) for t in ("b", "a", "a")] + [(None, "c", "r", "o", 0, 0)]
        assert Counter((*r[:7], tuple(r.positions)) for r in compare_with_next(spark.createDataFrame(same, SCHEMA)).collect()) == brute(same)
        assert compare_with_next(spark.createDataFrame(same[:1], SCHEMA)).count() == 1
        assert compare_with_next(spark.createDataFrame([], SCHEMA)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_positions_are_kept(spark):
    for r in fingerprints(frame(spark)).collect():
        assert [m.position for m in r.marks] == sorted(m.position for m in r.marks)
