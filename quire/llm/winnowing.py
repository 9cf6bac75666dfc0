"""Document fingerprints (operator 3): winnowing.

A text's bytes without ASCII white space, A-Z lower-cased, are cut into all ``gram``-byte grams; in
every window of ``window`` consecutive grams the least hash is marked, the rightmost of equal ones,
once however many windows pick it.  Any two texts that share ``gram + window - 1`` such bytes in a
row therefore share a mark, and no match shorter than ``gram`` bytes is ever seen.  Marks keep the
position of their gram in the original text, so that a shared mark locates the match.

``compare_with_next`` needs each document's successor by descending id.  Ids alone are read first to
cut them into ranges of about equal counts; texts then move once, to their range, together with a
copy of each range's first row, which is the successor of the last row of the range before.  So each
task streams over its sorted rows with one row of look-ahead, and no task sees more than its ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.engine import shuffle_width
from quire.llm.common import LOWER, UPPER, arrow_map
from quire.llm.repeats import gram_hashes, sliding_min

FOLD = np.frombuffer(bytes.maketrans(UPPER.encode(), LOWER.encode()), dtype=np.uint8)
SOLID = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
_BLOCK = 1 << 22
_LOW = np.uint64((1 << 23) - 1)


def winnow(text: bytes, gram: int = 16, window: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 32-bit hashes) of the marks in order.

    A text shorter than a gram is one mark if it has any byte but white space, else none; a text
    with fewer grams than a window has one window.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    where = np.flatnonzero(SOLID[raw])
    data = FOLD[raw[where]]
    if not len(data):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint32)
    if len(data) < gram:
        return where[:1].astype(np.int64), np.frombuffer(hashlib.sha256(data.tobytes()).digest()[:4], dtype="<u4")
    n_grams = len(data) - gram + 1
    span = min(window, n_grams)
    marks, hashes = [], []
    for at in range(0, n_grams - span + 1, _BLOCK):  # blocks of windows, so that hash and place share 64 bits
        h = gram_hashes(data[at : at + _BLOCK + span + gram - 2], gram)
        least = sliding_min((h & ~_LOW) | np.arange(len(h), 0, -1, dtype=np.uint64), span)
        picked = len(h) - (least & _LOW).astype(np.int64)
        picked = picked[np.concatenate([[True], picked[1:] != picked[:-1]])]
        if marks and picked[0] + at == marks[-1][-1]:
            picked = picked[1:]
        if len(picked):
            marks.append(picked + at)
            hashes.append((h[picked] >> np.uint64(32)).astype(np.uint32))
    return where[np.concatenate(marks)], np.concatenate(hashes)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two mark sets; 1 for two empty ones."""
    x, y = set(a.tolist()), set(b.tolist())
    return len(x & y) / len(x | y) if x or y else 1.0


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", gram: int = 16, window: int = 32) -> DataFrame:
    """Rows (id, marks array<struct<position: long, hash: long>>), byte positions; null texts have none."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [winnow(t or b"", gram, window) for t in batch["text"]]
            yield {"id": batch["id"], "marks": [[{"position": p, "hash": h} for p, h in zip(ps.tolist(), hs.tolist(), strict=True)] for ps, hs in found]}

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return arrow_map(read, rows, "id long, marks array<struct<position: long, hash: long>>")


def _with_successors(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows (part, late, id, text): parts of the descending id order; late rows are the next part's first."""
    ids = docs.select("id")
    cuts = ids.select(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 10_000)).head()[0] or []
    bounds = sorted(set(cuts))
    part = F.when(F.col("id").isNull(), F.lit(len(bounds) + 1)).otherwise(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("id"))) if bounds else F.lit(0))
    firsts = ids.groupBy(part.alias("part")).agg(F.max("id").alias("first")).orderBy("part").collect()  # one row a range
    before = [(r.first, firsts[k - 1].part) for k, r in enumerate(firsts)]  # (first id of a part, the part that ends before it)
    known = F.broadcast(docs.sparkSession.createDataFrame(before, "first long, into int"))
    rows = docs.join(known, F.col("id").eqNullSafe(F.col("first")), "left")
    late = F.when(F.col("into").isNotNull(), F.struct(F.col("into").alias("part"), F.lit(True).alias("late")))
    places = F.array_compact(F.array(F.struct(part.cast("int").alias("part"), F.lit(False).alias("late")), late))
    spread = rows.select("id", "text", F.explode(places).alias("place")).select("place.part", "place.late", "id", "text")
    return spread.repartition("part").sortWithinPartitions("part", "late", F.desc_nulls_last("id"), "text")


def compare_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", gram: int = 16, window: int = 32) -> DataFrame:
    """One row (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, positions).

    The edited text has its last third (floor of the code points) replaced by as many first code
    points of the next document, or all it has.  Next is the order of descending ids, null ids last,
    equal ids by text; after the last comes the first.  Fingerprints are the marks' hashes in order,
    eight hex digits each, ``positions`` their byte offsets in the text in the same order; likeness is
    the marks' Jaccard similarity.  Null texts count as empty
    (and an empty text's fingerprint is empty); repeated rows follow one another; a single row is
    its own next; other columns are not read; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions")

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        seen = None  # (part, id, text, marks, positions) of the row that waits for its next
        for batch in batches:
            out = {k: [] for k in names}
            for part, late, i, text in zip(batch["part"], batch["late"], batch["id"], batch["text"], strict=True):
                if late and (seen is None or seen[0] != part):
                    continue  # a further copy of the same first id
                where, marks = winnow(text.encode(), gram, window)
                if seen is not None:
                    _, own, old, mine, at = seen
                    k = len(old) // 3
                    edited = (old[: len(old) - k] + text[:k]).encode()
                    changed = winnow(edited, gram, window)[1]
                    values = (own, len(old), hashlib.sha256(edited).hexdigest(), mine.astype(">u4").tobytes().hex(), changed.astype(">u4").tobytes().hex(), likeness(mine, changed), likeness(mine, marks), at)
                    for key, value in zip(names, values, strict=True):
                        out[key].append(value)
                seen = None if late else (part, i, text, marks, where)
            yield out

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<long>"
    return arrow_map(_with_successors(base, 2 * shuffle_width(docs.sparkSession)), rows, schema)
