"""Connected components of a large edge table, without collecting links or components anywhere.

Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).  Each round is two aggregations and two joins; hub nodes are met by a size-bounded
broadcast (``common.split_hot``), so that no task gets all edges of a hub.  Every half round is
checkpointed, which cuts the lineage and survives lost executors; a round's shuffles are given back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.engine import cut, release
from quire.llm.common import split_hot


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round over rows (a, b) with a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("degree"))
    total = edges.count() * (2 if large else 1)
    linked = split_hot(both, least, ["u"], "degree", total)
    if large:  # neighbours above u go to the least of the neighbourhood
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # u and its neighbours below go to the least of them
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return cut(out.where(F.col("a") != F.col("b")).distinct())


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, root) of one task's edges: roots are hooked onto lesser ones and paths halved until nothing changes."""
    read = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if not read:
        return
    nodes, place = np.unique(np.concatenate([np.concatenate(c) for c in zip(*read, strict=True)]), return_inverse=True)
    a, b = place.reshape(2, -1)
    root, before = np.arange(len(nodes)), None
    while before is None or (root != before).any():
        before = root.copy()
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "root"])


def components(edges: DataFrame, few: int = 500_000) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b); root is the component's least node.

    Up to ``few`` edges (8 MB) are united in one task; more go by rounds, with the same result.

    Nodes are non-null longs; loops and repeated edges are ignored; no edges give no rows.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct())

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).head()
        return tuple(row)

    before, after = None, mark(now)
    if after[0] <= few:
        return now.coalesce(1).mapInArrow(_united, "node long, root long")
    while after[0] and after != before:
        now = _star(_star(now, large=True), large=False)
        before, after = after, mark(now)
        release(edges.sparkSession)  # a round's shuffles have many small files
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
