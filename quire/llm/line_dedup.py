"""Line dedup (operator 10): levelled sorted runs of line hashes, native throughout.

Documents come in batches of descending id.  A *run* is a table of line hashes, hash-partitioned
and sorted by hash, with the number of documents that hold each line and its *keeper*, the largest
such id.  A new batch is grouped by hash and merge-anti-joined with the runs: lines that no run
knows are new, and since later batches hold smaller ids only, the batch's largest id is their keeper
for good.  Lines that a run knows add to its count.  Both go into a new run of level 0; ``fanout``
runs of a level are compacted into one of the next.  At the end the runs fold into one index, and
lines whose count reaches ``min_docs`` go from every document but the keeper.

Hashes are 128 bits (two chained XXH64), so that lines of a very large corpus don't collide.
Only (id, text hash, position, line hash) rows take part; the texts move once, at the end, to meet
the positions to drop.  Lines with a large share of all rows meet the index by a broadcast whose
size is bounded (see ``common.split_hot``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.engine import cut
from quire.llm.common import BLANK, LOWER, UPPER, packed, split_hot, unpacked

HASH = ["h1", "h2"]


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z and no other letter; pure ASCII texts take the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


class LineRuns:
    """The levels of sorted runs: rows (h1, h2, n, keeper), several runs a level."""

    def __init__(self, fanout: int = 4) -> None:
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    @staticmethod
    def merge(runs: list[DataFrame]) -> DataFrame:
        """One run out of several: counts add up, the one known keeper stays."""
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy(*HASH).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def add(self, holders: DataFrame) -> None:
        """Add a batch of distinct (h1, h2, id) rows; its ids are below those of all batches before."""
        batch = holders.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        if known := self.runs():
            seen = known[0].select(*HASH)
            for run in known[1:]:
                seen = seen.unionByName(run.select(*HASH))
            fresh = batch.join(seen, HASH, "left_anti").select(*HASH, "n", F.col("top").alias("keeper"))
            again = batch.join(seen, HASH, "left_semi").select(*HASH, "n", F.lit(None).cast("long").alias("keeper"))
            rows = fresh.unionByName(again)
        else:
            rows = batch.select(*HASH, "n", F.col("top").alias("keeper"))
        self.levels[0].append(cut(rows.sortWithinPartitions(*HASH)))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(cut(self.merge(self.levels[level]).sortWithinPartitions(*HASH)))
            self.levels[level] = []
            level += 1

    def index(self, min_docs: int) -> DataFrame:
        return self.merge(self.runs()).where(F.col("n") >= min_docs)


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "line_dedup",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    r"""Add ``out``: struct(n_lines long, n_dropped long, text string).

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased.  Keys
    of at least ``min_chars`` code points held by at least ``min_docs`` distinct ids lose all their
    lines except those in documents with the largest id.  The other lines stay, joined by ``\n``.

    A null or empty text is one empty line and stays ''.  Rows that share an id count as one holder
    and are treated alike.  Null ids count as one holder that is never the largest.  Lines may be of
    any length and number; an empty table gives an empty result.
    """
    base = packed(docs, id_col, text_col, out).withColumn("th", F.xxhash64("text"))
    keys = F.transform(F.split(fold_ascii(F.col("text")), "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)))
    entries = F.filter(F.transform(keys, lambda key, pos: F.struct(pos.alias("pos"), key.alias("key"))), lambda e: F.char_length(e["key"]) >= min_chars)
    hashed = F.transform(entries, lambda e: F.struct(e["pos"].alias("pos"), F.xxhash64(e["key"]).alias("h1"), F.xxhash64(F.lit(1), e["key"]).alias("h2")))
    lines = cut(base.select("id", "th", F.inline(hashed)))
    total = lines.count()

    cuts = lines.select(F.percentile_approx("id", [k / batches for k in range(1, batches)], 1000)).head()[0] or [] if batches > 1 else []
    runs = LineRuns(fanout)
    bounds = [None, *sorted(set(cuts), reverse=True), None]
    for above, below in zip(bounds, bounds[1:], strict=False):  # ids in (below, above], the largest first
        part = lines if above is None else lines.where((F.col("id") <= above) | F.col("id").isNull() if below is None else F.col("id") <= above)
        part = part if below is None else part.where(F.col("id") > below)
        runs.add(part.select(*HASH, "id").distinct())

    drops = split_hot(lines, cut(runs.index(min_docs)), HASH, "n", total).where(~F.col("id").eqNullSafe(F.col("keeper")))
    dropped = drops.groupBy("id", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone")).withColumnsRenamed({"id": "gone_id", "th": "gone_th"})

    # The dropped positions as a string of marks, one for each line: linear however many lines go.
    gone = F.col("gone")
    marks = F.array_join(F.transform(gone, lambda p, i: F.concat(F.repeat(F.lit("0"), p - F.when(i == 0, F.lit(0)).otherwise(F.get(gone, i - 1) + 1)), F.lit("1"))), "")
    met = base.join(dropped, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left").withColumn("marks", F.split(marks, ""))
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: F.coalesce(F.get(F.col("marks"), i), F.lit("0")) != "1")
    text = F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    result = F.struct(n_lines.cast("long").alias("n_lines"), F.when(gone.isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias("n_dropped"), text.alias("text"))
    return unpacked(met, result, out)
