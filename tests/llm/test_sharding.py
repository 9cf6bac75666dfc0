import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from quire.llm.sharding import hilbert_index, hilbert_shards

from .cases import SCHEMA, frame, rows


def test_curve_visits_every_cell_once_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(got, found, shards):
    assert Counter((r.id, r.size, r.crc) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in found)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    along = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in along] == sorted(r.curve for r in got)


def test_counts_slots_and_order(spark):
    for shards in (1, 7, 24, 100):
        check(hilbert_shards(frame(spark), dimensions=("id", "row", "n"), shards=shards).collect(), rows(), shards)


def test_shards_prune_on_every_dimension(spark):
    r = random.Random(3)
    found = [(i, "x", f"s{r.randrange(64):02}", "abcdefgh"[r.randrange(8)], r.randrange(1000), r.randrange(10**6)) for i in range(4000)]
    docs = spark.createDataFrame(found, SCHEMA)
    got = {x.id: x.shard for x in hilbert_shards(docs, dimensions=("row", "id", "n"), shards=24).collect()}
    for pick in (2, 3, 5):
        values, spans = sorted({f[pick] for f in found}), defaultdict(set)
        rank = {v: k / len(values) for k, v in enumerate(values)}
        for f in found:
            spans[got[f[0]]].add(rank[f[pick]])
        assert np.mean([max(s) - min(s) for s in spans.values()]) < 0.75


def test_empty_and_one_row(spark):
    assert hilbert_shards(spark.createDataFrame([], SCHEMA), dimensions=("n",)).count() == 0
    check(hilbert_shards(spark.createDataFrame([(1, None, None, None, None, None)], SCHEMA), dimensions=("n", "row")).collect(), [(1, None)], 24)
