r"""Quality rules (operator 1): cross-document line frequency on top of a few base counts.

One pass over the texts makes the base counts and the hashes of the normalised lines (words with
A-Z lower-cased, one space between).  For each host and line the *distinct texts* that hold it are
counted, so that a text copied many times isn't boilerplate by itself.  Lines in more than
``max_texts`` texts of a host are removed there, except from the smallest id that holds them, which
lets one document of a family of near copies survive.  Documents are rejected that fail the base
rule, or that are depleted: fewer than ``min_left`` percent of their words are left.

Only hashes are shuffled; lines that hold a large share of all rows meet their verdict through a
size-bounded broadcast.  Texts move only if the caller wants them back without the removed lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.engine import cut, stored
from quire.llm.common import LOWER, UPPER, arrow_map, split_hot

FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)], dtype=np.uint64)


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words inside windows of ``width`` words that the text holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        rolled += hashes[k : k + n] * _POWERS[k]
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    windows: dict[tuple, list[int]] = {}
    for at in np.flatnonzero(np.isin(rolled, twice)).tolist():  # equal hashes are compared word by word
        windows.setdefault(tuple(words[at : at + width]), []).append(at)
    covered = np.zeros(len(words), dtype=bool)
    for places in windows.values():
        if len(places) > 1:
            for at in places:
                covered[at : at + width] = True
    return int(covered.sum())


def line_hashes(line: bytes) -> tuple[int, int, int] | None:
    """(h1, h2, words) of a normalised line; None if it has no word."""
    words = line.split()
    if not words:
        return None
    key = b" ".join(words)
    return tuple(np.array([xxhash.xxh64_intdigest(key, seed) for seed in (42, 43)], dtype=np.uint64).view(np.int64).tolist()) + (len(words),)


LINE = "struct<h1: long, h2: long, words: long>"
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def _facts(docs: DataFrame, id_col: str, text_col: str, host_col: str, min_words: int, max_repeat: int) -> DataFrame:
    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lines")}
            for text in batch["text"]:
                data = text.encode()
                words, lines = data.split(), data.split(b"\n")
                seen, dup = set(), 0
                for line in lines:
                    if line in seen:
                        dup += 1
                    elif not line.isspace() and line:
                        seen.add(line)
                repeat = repeated_words(words)
                keyed: dict[tuple, int] = {}
                for line in data.translate(FOLD).split(b"\n"):
                    if found := line_hashes(line):
                        keyed[found[:2]] = keyed.get(found[:2], 0) + found[2]
                n = len(words)
                values = (n, len(text) - (len(data) - len(data.translate(None, BLANKS))), len(data) - len(data.translate(None, SYMBOLS)), dup, repeat, n < min_words or 100 * repeat > max_repeat * n, [{"h1": a, "h2": b, "words": w} for (a, b), w in keyed.items()])
                for key, value in zip(out, values, strict=True):
                    out[key].append(value)
            yield {k: batch[k] for k in ("id", "th", "host")} | out

    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    return arrow_map(read, rows, f"id long, th long, host string, {BASE}, lines array<{LINE}>")


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_texts: int = 10,
    min_left: int = 10,
    min_words: int = 20,
    max_repeat: int = 30,
) -> DataFrame:
    """One row (id, th, host, the base counts, base_failed, n_left long, kept boolean, removed) a document.

    ``removed`` lists the hashes of the lines to remove (``without_lines`` applies it), ``n_left``
    counts the words outside them.  Words are runs of anything but ASCII white space.  A null text
    counts as empty, has no words and fails the base rule; null hosts are one host; rows that repeat
    id and text are judged alike and count once; null ids are never a line's smallest id unless all
    its ids are null.  Other columns are not read; an empty table gives no rows.
    """
    facts, _ = stored(_facts(docs, id_col, text_col, host_col, min_words, max_repeat), "quality")
    key = ["id", "th", "host"]
    lines = facts.select(*key, F.inline("lines"))
    line = ["host", "h1", "h2"]
    texts = lines.groupBy(*line, "th").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    common = cut(texts.groupBy(*line).agg(F.count(F.lit(1)).alias("texts"), F.min("id").alias("keeper"), F.sum("n").alias("n")).where(F.col("texts") > max_texts))
    total = lines.count()
    plain = F.coalesce(F.concat(F.lit("h"), F.col("host")), F.lit("")).alias("host_key")  # a null host joins like any other
    matched = split_hot(lines.select(*key, "h1", "h2", "words", plain), common.select("h1", "h2", "keeper", "n", plain), ["host_key", "h1", "h2"], "n", total)
    gone = matched.where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy(*key).agg(F.collect_set(F.struct("h1", "h2", "words")).alias("removed"))
    gone = gone.withColumnsRenamed({k: f"g_{k}" for k in key})
    same = F.lit(True)
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"g_{k}"))
    left = F.col("n_words") - F.coalesce(F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["words"]), F.lit(0))
    judged = facts.drop("lines").join(gone, same, "left").drop(*gone.columns[:3]).withColumn("n_left", left)
    return judged.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_left") >= min_left * F.col("n_words"))).select(*key, *(f.name for f in T._parse_datatype_string(BASE)), "n_left", "kept", "removed")


def without_lines(docs: DataFrame, judged: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` that ``judged`` keeps, with the removed lines gone from their texts; same columns."""
    keys = judged.where("kept").groupBy("id", "th", "host").agg(F.first("removed").alias("removed")).withColumnsRenamed({"id": "j_id", "th": "j_th", "host": "j_host"})
    rest = [c for c in docs.columns if c != text_col]
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(host_col).cast("string").alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    same = F.col("id").eqNullSafe(F.col("j_id")) & (F.xxhash64("text") == F.col("j_th")) & F.col("host").eqNullSafe(F.col("j_host"))
    met = base.join(keys, same).select("row", "text", "removed")

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            texts = []
            for text, removed in zip(batch["text"], batch["removed"], strict=True):
                if removed:
                    bad = {(r["h1"], r["h2"]) for r in removed}
                    lines = text.encode().split(b"\n")
                    text = b"\n".join(x for x in lines if (line_hashes(x.translate(FOLD)) or (None, None))[:2] not in bad).decode()
                texts.append(text)
            yield {"row": batch["row"], "text": texts}

    kind = T.StructType([T.StructField("row", base.schema["row"].dataType), T.StructField("text", T.StringType())])
    done = arrow_map(met, rows, kind)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
