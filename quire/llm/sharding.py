"""Sharding (operator 4): Hilbert-curve ordering.

Each metadata dimension is cut at quantiles into 2^bits cells (frequent values take several, so that
few distinct values spread over the whole axis too), the cells of a row give its index on
a Hilbert curve, and rows sorted by index are cut into runs of equal counts.  Rows near on the curve
are near in every dimension, so a shard spans a small range of each and readers can skip most
shards on a predicate over any of them.

Quantiles are mergeable sketches of fixed size.  Only (id, size, checksum, index) rows are sorted:
a range partitioning with ties broken by id, so that a value held by a third of the rows spreads
over many tasks.  A row's rank is its place in its partition plus the partitions' counts before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.engine import cut, shuffle_width
from quire.llm.common import arrow_map


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the curve of each row of ``cells`` (n, dimensions), 0 <= cell < 2**bits.

    John Skilling's transformation ("Programming the Hilbert curve", 2004), on columns.
    """
    x = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            index = index << 1 | ((c ^ flip) >> level) & 1
    return index


def _ordered_number(column: Column, kind: T.DataType) -> Column:
    """A long in the column's order; of strings the first seven bytes."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return column.cast("long")


def hilbert_shards(
    docs: DataFrame,
    *,
    dimensions: tuple[str, ...] = ("source", "lang", "n_chars"),
    shards: int = 24,
    bits: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (id, size, crc, curve, shard int, slot long) for each input row.

    ``size`` is the text's UTF-8 bytes plus 8 and ``crc`` its CRC-32 (null: no bytes).  Shards are
    runs along the curve whose counts differ by one at most; ``slot`` counts from 0 within a shard.
    Null metadata counts as least; ties on the curve go by id (nulls first), then checksum and size;
    repeated rows are rows of their own.  Fewer rows than shards leave shards empty; an empty table
    gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = {f.name: f.dataType for f in docs.schema}
    numbers = [_ordered_number(F.col(f"`{c}`"), kinds[c]).alias(f"d{k}") for k, c in enumerate(dimensions)]
    shares = [k / 2**bits for k in range(1, 2**bits)]
    sketch = docs.select(*numbers).agg(*[F.percentile_approx(f"d{k}", shares, 10_000).alias(f"q{k}") for k in range(len(dimensions))]).head()
    quantiles = [np.array(sketch[k] or [], dtype=np.int64) for k in range(len(dimensions))]

    def place(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            columns = [np.array([np.iinfo(np.int64).min if v is None else v for v in batch[f"d{k}"]], dtype=np.int64) for k in range(len(dimensions))]
            cells = np.stack([np.searchsorted(q, c, side="left") for q, c in zip(quantiles, columns, strict=True)], axis=1)
            yield {k: batch[k] for k in ("id", "size", "crc")} | {"curve": hilbert_index(cells, bits)}

    read = docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"), *numbers)
    placed = cut(arrow_map(read, place, "id long, size long, crc long, curve long"))

    def number(batches: Iterator[dict]) -> Iterator[dict]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch["id"])
            yield batch | {"part": [part] * n, "ordinal": np.arange(done, done + n)}
            done += n

    order = ["curve", "id", "crc", "size"]
    sorted_ = placed.repartitionByRange(shuffle_width(docs.sparkSession), *order).sortWithinPartitions(*order)
    numbered = cut(arrow_map(sorted_, number, "id long, size long, crc long, curve long, part int, ordinal long"))
    counts = sorted((r.part, r.n) for r in numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    total = sum(n for _, n in counts)
    starts = np.cumsum([0, *(n for _, n in counts)]).tolist()
    spark = docs.sparkSession
    bases = spark.createDataFrame([(p, s) for (p, _), s in zip(counts, starts, strict=False)], "part int, base long")
    rank = F.col("base") + F.col("ordinal")
    shard = F.expr(f"(base + ordinal) * {shards} DIV {max(total, 1)}").cast("int")
    ranked = numbered.join(F.broadcast(bases), "part").select("id", "size", "crc", "curve", shard.alias("shard"), rank.alias("rank"))
    return ranked.select("id", "size", "crc", "curve", "shard", (F.col("rank") - F.expr(f"(CAST(shard AS LONG) * {total} + {shards - 1}) DIV {shards}")).alias("slot"))
