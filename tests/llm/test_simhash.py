import random
from collections import Counter

import pytest
import xxhash

from quire.llm.components import components
from quire.llm.simhash import near_duplicates, simhash

from .cases import SCHEMA, frame, rows

FOLD = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = (text or "").translate(FOLD).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(found):
    fps = [plain(t) for _, t, *_ in found]
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    groups = {}
    for i, (d, *_) in enumerate(found):
        groups.setdefault(root(i), []).append(d)
    least = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return Counter((found[i][0], fps[i], least[root(i)]) for i in range(len(fps)))


def unsigned(rows_):
    return Counter((r.id, r.fp % (1 << 64), r.component_id) for r in rows_)


def test_components_match_brute_force(spark):
    for bucket in (32, 0):  # 0: every posting list counts as crowded
        assert unsigned(near_duplicates(frame(spark), bucket=bucket).collect()) == brute(rows())


def test_chain_of_flipped_bits(spark, monkeypatch):
    import quire.llm.simhash as module

    base = 0x8123456789ABCDEF
    chain = [base]
    for k in range(0, 64, 2):
        chain.append(chain[-1] ^ (1 << k) ^ (1 << (k * 7 + 33) % 64))
    far = [base ^ 0x7 << k for k in (3, 40)]
    table = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(chain + far)], "id long, fp long")
    monkeypatch.setattr(module, "fingerprints", lambda docs, **_: table)
    for bucket in (32, 0):
        got = {r.id: r.component_id for r in near_duplicates(table, bucket=bucket).collect()}
        want = {}
        fps = chain + far
        for i in range(len(fps)):
            seen, todo = {i}, [i]
            while todo:
                x = todo.pop()
                for j in range(len(fps)):
                    if j not in seen and (fps[x] ^ fps[j]).bit_count() <= 2:
                        seen.add(j)
                        todo.append(j)
            want[i] = min(seen)
        assert got == want


def test_single_fingerprint_of_known_cases():
    for _, t, *_ in rows():
        assert simhash((t or "").encode()) == plain(t)


def test_components_of_a_hub_and_a_path(spark):
    edges = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(300)) and all(got[1000 + i] == 1000 for i in range(61)) and len(got) == 361


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("few", [0, 10_000])
def test_components_by_rounds_and_in_one_task(spark, few):
    r = random.Random(5)
    links = [(r.randrange(-300, 300), r.randrange(-300, 300)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1060)] + [(7, 7), (1 << 62, -(1 << 62))]
    root = {}

    def find(i):
        while root.get(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        if x != y:
            root[y] = x
    want = {(n, find(n)) for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a long, b long"), few).collect()
    assert {(n, x) for n, x in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long"), few).count() == 0
