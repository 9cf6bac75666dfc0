"""SimHash near-dedup (operator 5) by multi-index hashing.

A 64-bit fingerprint is cut into two 32-bit segments.  Two fingerprints at distance 2 or less agree
in the high segment, or differ by at most one bit in the low one (if the low one differs by two bits,
the high one doesn't differ).  So each *distinct* fingerprint is posted under both segment values;
it probes the high table with its own value and the low table with the Hamming ball of radius 1
(only bits that it sets, so that each pair meets once); matches are verified on all 64 bits.

A posting list longer than ``bucket`` would make a quadratic number of pairs.  All fingerprints that
touch such a list take another exact way: each is listed at the 65 points of its own radius-1 ball
over 64 bits.  Two fingerprints are within distance 2 exactly if their balls share a point, so
linking each member of a point to the point's least member yields the same components with linear
work, and a point has 65 members at most.

Copies collapse into their fingerprint before any of this, and only (id, fingerprint) rows move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.engine import cut
from quire.llm.common import LOWER, UPPER, arrow_map, split_hot
from quire.llm.components import components

FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
LOW = 0xFFFFFFFF


def simhash(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of UTF-8 text: bit set in over half of the shingles' XXH64 (seed 42)."""
    words = text.translate(FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, 42)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), dtype="<u8", count=len(starts))
    counts = np.zeros(64, dtype=np.int64)
    for block in range(0, len(hashes), 1 << 16):  # very long texts: bounded memory
        bits = np.unpackbits(hashes[block : block + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Rows (id, fp): the signed 64-bit fingerprint of every row; null and blank texts get 0."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"id": batch["id"], "fp": [(f ^ (1 << 63)) - (1 << 63) for f in (simhash(t or b"", shingle) for t in batch["text"])]}

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")), rows, "id long, fp long")


def _key(segment: int, value: Column) -> Column:
    return value.bitwiseOR(F.lit(segment << 32))


def fingerprint_links(nodes: DataFrame, bucket: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all those within distance 2."""
    fp = F.col("fp")
    low, high = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 32)
    postings = nodes.select("fp", F.explode(F.array(_key(0, low), _key(1, high))).alias("key"))
    ball = F.filter(F.array(*[F.when(low.bitwiseAND(F.lit(1 << i)) == 0, _key(0, low.bitwiseOR(F.lit(1 << i)))) for i in range(32)]), lambda k: k.isNotNull())
    probes = nodes.select("fp", F.explode(F.concat(F.array(_key(0, low), _key(1, high)), ball)).alias("key"))

    crowded = cut(postings.groupBy("key").count().where(F.col("count") > bucket).select("key"))
    few_postings, few_probes, edges = postings, probes, None
    if not crowded.isEmpty():
        few_postings, few_probes = (t.join(crowded, "key", "left_anti") for t in (postings, probes))
        touched = postings.join(crowded, "key", "left_semi").select("fp").unionByName(probes.join(crowded, "key", "left_semi").select("fp")).distinct()
        points = touched.select("fp", F.explode(F.array(fp, *[fp.bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(64)])).alias("point"))
        centres = points.groupBy("point").agg(F.min("fp").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
        edges = points.join(centres, "point").where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = (
        few_probes.select("key", F.col("fp").alias("a"))
        .join(few_postings.select("key", F.col("fp").alias("b")), "key")
        .where("a <> b AND bit_count(a ^ b) <= 2")
        .select("a", "b")
    )
    return pairs if edges is None else pairs.unionByName(edges)


def _components(fps: DataFrame, bucket: int) -> DataFrame:
    """Rows (id, fp, component_id) from materialised rows (id, fp)."""
    nodes = cut(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")))
    roots = components(fingerprint_links(nodes.select("fp"), bucket))
    member = cut(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root")))
    groups = member.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = split_hot(member, groups, ["root"], "n", member.count()).select("fp", "copies", "component_id")
    return split_hot(fps, named, ["fp"], "copies", fps.count()).select("id", "fp", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bucket: int = 32) -> DataFrame:
    """One row (id, fp, component_id) for each input row.

    Fingerprints link at 2 or fewer differing bits; ``component_id`` is the smallest id reachable
    over links, the row's own included.  Texts without words have fingerprint 0 and link like any
    other.  Texts of fewer than ``shingle`` words are one shingle.  Repeated rows yield repeated
    results; null ids are never a component's smallest (a component of null ids only has a null
    ``component_id``).  Other columns of the input are not read.
    """
    return _components(cut(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle)), bucket)
