"""Suffix-array dedup (operator 6): remove every byte inside a long repeated string.

A suffix array of a whole corpus doesn't fit a task, but a sparse one falls apart into independent
parts.  Of all ``gram``-byte grams inside a window of ``length`` bytes the one with the least hash
(rightmost on ties) is the window's *anchor*; equal windows have equal anchors at equal places.  An
anchor leads a run of consecutive windows; the bytes they span are its *context*.  Windows can only
repeat within contexts of equal anchor grams, and those form one part:

* contexts that are equal as a whole are covered as a whole: counting is enough;
* the distinct contexts of a part are sorted from the anchor on (the suffix array), neighbours'
  common prefixes are found, and a stack scan builds the tree of common-prefix intervals.  For each
  interval the members' left extensions are compared: where they diverge ends a maximal repeat, and
  prefix plus left extension of ``length`` bytes or more is covered in *every* member that has it;
* a part with more than ``crowd`` distinct contexts (a passage in very many surroundings) isn't
  gathered in a task.  Its windows are hashed and counted instead, which is as exact and spreads.

Only hashes and places are shuffled for all documents; context bytes move for contexts that share an
anchor but differ, one representative each.  The texts are shuffled twice, by id: to cut the contexts
out and to remove the spans.  Between the phases finished shuffles are given back.

Passages are found the same way, in words: a text is then the string of its words' 64-bit hashes, and
windows, anchors and spans count words (``unit`` is 8 bytes; common prefixes are cut to whole words).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.engine import cut, delete_path, release, stored
from quire.llm.common import arrow_map, split_hot

_BYTE_HASH = np.random.default_rng(20).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Positions per block of the sliding minimum, so that hash and position share 64 bits.
_BLOCK = 1 << 22


#: Bytes of a word's hash; which bytes are part of a word.
_WORD = 8
_IN_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def word_hashes(text: bytes) -> bytes:
    """The hashes of the words ``[^\\x20\\x09-\\x0D]+``, one after the other."""
    return b"".join(map(xxhash.xxh64_digest, text.split()))


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after it."""
    inside = np.concatenate([[False], _IN_WORD[np.frombuffer(text, dtype=np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def signed(x: int) -> int:
    return (x ^ (1 << 63)) - (1 << 63)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A well-mixed hash of every ``gram`` consecutive bytes or word hashes; ``gram`` is a power of two."""
    h, width = _BYTE_HASH[data] if data.dtype == np.uint8 else data, 1
    while width < gram:
        h = (h[:-width] * _ODD) ^ (h[width:] + (h[:-width] >> np.uint64(29)))
        width *= 2
    return (h ^ (h >> np.uint64(31))) * _ODD


def sliding_min(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every ``window`` consecutive values."""
    out, width = values, 1
    while width * 2 <= window:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = window - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(text: bytes, length: int, gram: int, unit: int = 1) -> list[tuple[int, int, int]]:
    """(first window, windows, anchor position) for each anchor of ``text``, in order, in units."""
    n_windows = len(text) // unit - length + 1
    if n_windows < 1:
        return []
    data, span, found = np.frombuffer(text, dtype=np.uint8 if unit == 1 else "<u8"), length - gram + 1, []
    for at in range(0, n_windows, _BLOCK):
        block = data[at : at + _BLOCK + length - 1]
        h = gram_hashes(block, gram)
        place = np.arange(len(h), 0, -1, dtype=np.uint64)  # rightmost wins ties
        least = sliding_min((h & ~np.uint64((1 << 23) - 1)) | place, span)
        where = len(h) - (least & np.uint64((1 << 23) - 1)).astype(np.int64) + at
        cuts = np.flatnonzero(np.diff(where)) + 1
        begins, ends = np.concatenate([[0], cuts]), np.append(cuts, len(where))
        found += zip((begins + at).tolist(), (ends - begins).tolist(), where[begins].tolist(), strict=True)
    return found


def _common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = 0, n  # x[:low] == y[:low], x[:high] != y[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of each inner node of the common-prefix interval tree.

    ``prefixes[i]`` is the common prefix of sorted suffixes i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*prefixes, -1]):
        first = i
        while stack and stack[-1][0] > value:
            height, first = stack.pop()
            yield height, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def covered(contexts: list[tuple[bytes, int]], length: int, unit: int = 1) -> list[list[tuple[int, int]]]:
    """Spans of each distinct context (bytes, anchor offset) that lie in a repeat of ``length`` or more, in units."""
    spans: list[list[tuple[int, int]]] = [[] for _ in contexts]
    right = [text[at * unit :] for text, at in contexts]
    left = [text[: at * unit][::-1] for text, at in contexts]
    order = sorted(range(len(contexts)), key=right.__getitem__)
    prefixes = [_common(right[a], right[b]) for a, b in zip(order, order[1:], strict=False)]
    for height, first, last in intervals(prefixes):
        members = sorted(order[first : last + 1], key=left.__getitem__)
        shared = [_common(left[a], left[b]) // unit for a, b in zip(members, members[1:], strict=False)]
        height //= unit
        if height + max(shared) < length:
            continue
        for k, m in enumerate(members):  # the longest left extension that some other member has too
            reach = max(shared[k - 1] if k else 0, shared[k] if k < len(shared) else 0)
            if reach + height >= length:
                at = contexts[m][1]
                spans[m].append((at - reach, at + height))
    return [merged(s) for s in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint and not touching."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _occurrences(base: DataFrame, length: int, gram: int, unit: int) -> DataFrame:
    """Every anchor of every text: rows (id, th, a, c, at, windows, offset)."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out = {k: [] for k in ("id", "th", "a", "c", "at", "windows", "offset")}
            for i, th, text in zip(batch["id"], batch["th"], batch["text"], strict=True):
                data = text if unit == 1 else word_hashes(text)
                for at, windows, anchor in anchors(data, length, gram, unit):
                    a, c = digest(data[anchor * unit : (anchor + gram) * unit]), digest(data[at * unit : (at + windows - 1 + length) * unit], anchor - at)
                    for key, value in zip(out, (i, th, signed(a), signed(c), at, windows, anchor - at), strict=True):
                        out[key].append(value)
            yield out

    texts = base.select("id", "th", F.col("text").cast("binary").alias("text"))
    return arrow_map(texts, rows, "id long, th long, a long, c long, at long, windows int, offset int", at_once=32)


def _fetch(base: DataFrame, wanted: DataFrame, length: int, unit: int) -> DataFrame:
    """Context bytes of representatives: the columns of ``wanted`` and bytes."""
    fields = [c for c in wanted.columns if c not in ("id", "th")]
    lists = wanted.groupBy(F.col("id").alias("w_id"), F.col("th").alias("w_th")).agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    met = base.select("id", "th", F.col("text").cast("binary").alias("text")).join(lists, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th")))

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out = {k: [] for k in ("id", "th", *fields, "bytes")}
            for i, th, text, wants in zip(batch["id"], batch["th"], batch["text"], batch["wanted"], strict=True):
                data = text if unit == 1 else word_hashes(text)
                for w in wants:
                    for key, v in zip(out, (i, th, *w.values(), data[w["at"] * unit : (w["at"] + w["windows"] - 1 + length) * unit]), strict=True):
                        out[key].append(v)
            yield out

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.select("id", "th", *fields).schema)
    return arrow_map(met.select("id", "th", "text", "wanted"), rows, f"{kinds}, bytes binary", at_once=4)


PLACED = "id long, th long, at long, spans array<struct<lo: long, hi: long>>"


def _sorted_spans(contexts: DataFrame, length: int, unit: int) -> DataFrame:
    """The suffix-array way, a part at a time: rows (id, th, at, spans) of the contexts that occur once."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        part, places, now = [], [], None

        def flush() -> dict:
            found = [(p, s) for p, s in zip(places, covered(part, length, unit), strict=True) if s and p]
            spans = [[{"lo": a, "hi": b} for a, b in s] for _, s in found]
            return {key: [p[k] for p, _ in found] for k, key in enumerate(("id", "th", "at"))} | {"spans": spans}

        for batch in batches:
            for a, n, i, th, at, offset, data in zip(*(batch[k] for k in ("a", "n", "id", "th", "at", "offset", "bytes")), strict=True):
                if a != now:
                    if len(part) > 1:
                        yield flush()
                    part, places, now = [], [], a
                part.append((data, offset))
                places.append((i, th, at) if n == 1 else None)
        if len(part) > 1:
            yield flush()

    columns = contexts.select("a", "n", "id", "th", "at", "offset", "bytes")
    return arrow_map(columns.repartition("a").sortWithinPartitions("a"), rows, PLACED)


def _strips(data: bytes, offset: int, length: int, size: int, within: tuple[int, int] | None, unit: int) -> Iterator[tuple]:
    """Strips of ``size`` windows of a context: (first, windows here, core hash, union hash or None).

    Strips are aligned at the anchor, so that equal windows of two contexts fall in the same strip.
    The core is what all windows of the strip share, the union what any of them has; the union is
    None if the context ends within the strip.  ``within`` limits the windows, (first, last + 1).
    """
    n_windows = len(data) // unit - length + 1
    first, end = within or (0, n_windows)
    for strip in range((first - offset) // size, (end - 1 - offset) // size + 1):
        low = strip * size + offset
        core = xxhash.xxh64_intdigest(data[(low + size - 1) * unit : (low + length) * unit], 2 * (strip & 0xFFFF))
        whole = low >= 0 and low + size <= n_windows
        union = xxhash.xxh64_intdigest(data[low * unit : (low + size - 1 + length) * unit], 2 * (strip & 0xFFFF) + 1) if whole else 0
        a, b = max(low, first), min(low + size, end)
        yield a, b - a, signed(core), signed(union) if whole else None


def _counted_spans(contexts: DataFrame, length: int, unit: int) -> DataFrame:
    """The counting way for crowded parts: rows (id, th, at, spans), at 0.

    Windows are counted by strips, and strips that are neither repeated nor new as a whole are cut
    into eight, down to single windows; so a long passage costs a few rows for each occurrence.
    """
    place = ["id", "th", "ctx"]
    contexts = contexts.select("a", "id", "th", F.col("at").alias("ctx"), "offset", "bytes")
    sizes = [8**k for k in range(6) if 8**k < length][::-1]
    found, open_ = None, None
    for size in sizes:

        def rows(batches: Iterator[dict], size: int = size) -> Iterator[dict]:
            for batch in batches:
                out = {k: [] for k in ("a", "id", "th", "ctx", "w", "windows", "core", "whole")}
                limits = batch.get("limits") or [None] * len(batch["a"])
                for a, i, th, ctx, offset, data, within in zip(*(batch[k] for k in ("a", "id", "th", "ctx", "offset", "bytes")), limits, strict=True):
                    for limit in within or [None]:
                        for strip in _strips(data, offset, length, size, limit and (limit["w"], limit["w"] + limit["windows"]), unit):
                            for key, value in zip(out, (a, i, th, ctx, *strip), strict=True):
                                out[key].append(value)
                yield out

        todo = contexts
        if open_ is not None:
            lists = open_.groupBy(*place).agg(F.collect_list(F.struct("w", "windows")).alias("limits"))
            todo = contexts.join(lists, place)
        strips = cut(arrow_map(todo, rows, "a long, id long, th long, ctx long, w int, windows int, core long, whole long"))
        total = strips.count()
        cores = strips.groupBy("a", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        one = F.min(F.struct("id", "th", "ctx", "w", "windows", "core")).alias("one")
        wholes = cut(strips.where("whole IS NOT NULL").groupBy("a", "whole").agg(F.count(F.lit(1)).alias("copies"), one).where("copies > 1"))
        live = split_hot(strips, cores, ["a", "core"], "n", total).drop("n")
        judged = cut(split_hot(live.where("whole IS NOT NULL"), wholes.drop("one"), ["a", "whole"], "copies", total, "left").unionByName(live.where("whole IS NULL"), allowMissingColumns=True))
        done = F.col("copies").isNotNull()
        lo = F.col("ctx") + F.col("w")
        spans = judged.where(done).select("id", "th", F.lit(0).cast("long").alias("at"), F.array(F.struct(lo.alias("lo"), (lo + F.col("windows") - 1 + length).alias("hi"))).alias("spans"))
        found = spans if found is None else found.unionByName(spans)
        open_ = judged.where(~done).select("a", "core", *place, "w", "windows")
        # One of each group that is done goes on where others share its core: they may repeat a part of it.
        others = wholes.select("a", F.col("one.core").alias("core"), "one").join(open_.select("a", "core").distinct(), ["a", "core"])
        open_ = open_.unionByName(others.select("a", "core", *(f"one.{c}" for c in (*place, "w", "windows"))))
    return found


def repeat_spans(base: DataFrame, *, length: int = 400, gram: int = 32, crowd: int = 1000, by_words: bool = False) -> DataFrame:
    """Occurrences of repeats: rows (id, th, spans array<struct<lo: long, hi: long>>), byte offsets.

    With ``by_words``, ``length``, ``gram`` and the offsets count words.

    ``base`` has columns id, th (a hash of the text) and text.  Spans of a text may overlap.  The work
    is done in phases, each of which leaves a small table and gives its shuffle files back.
    """
    spark, unit = base.sparkSession, _WORD if by_words else 1
    occurrences, path = stored(_occurrences(base, length, gram, unit), "occurrences")
    grams = occurrences.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1")
    mixed = (F.col("c0") != F.col("c1")).alias("mixed")
    repeated = cut(split_hot(occurrences, grams.select("a", "n", mixed), ["a"], "n", occurrences.count()).drop("n"))
    delete_path(spark, path)

    first = F.min(F.struct("id", "th", "at", "windows", "offset")).alias("first")
    kinds = cut(repeated.where("mixed").groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), first))
    parts = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("kinds")).withColumn("crowded", F.col("kinds") > crowd)
    wanted = cut(split_hot(kinds, parts, ["a"], "kinds", kinds.count()).select("a", "c", "n", "first.*", "crowded"))
    del occurrences, grams, kinds, parts
    release(spark)

    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("windows") - 1 + length).cast("long").alias("hi"))).alias("spans")
    copies = wanted.where("n > 1").select("a", "c", "n")
    in_copies = split_hot(repeated.where("mixed"), copies, ["a", "c"], "n", repeated.count())
    found = repeated.where("NOT mixed").select("id", "th", "at", whole).unionByName(in_copies.select("id", "th", "at", whole))
    if not wanted.isEmpty():
        contexts, path = stored(_fetch(base, wanted.drop("c"), length, unit), "contexts")
        release(spark)
        found = found.unionByName(_sorted_spans(contexts.where("NOT crowded"), length, unit))
        if not wanted.where("crowded").isEmpty():
            found = found.unionByName(_counted_spans(contexts.where("crowded"), length, unit))
    moved = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("at")).alias("lo"), (s["hi"] + F.col("at")).alias("hi")))
    spans = cut(found.groupBy("id", "th").agg(F.flatten(F.collect_list(moved)).alias("spans")))
    if not wanted.isEmpty():
        delete_path(spark, path)
    del repeated, in_copies, found, copies, wanted
    release(spark)
    return spans


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "repeats",
    length: int = 400,
    gram: int = 32,
    crowd: int = 1000,
    words: int | None = None,
    word_gram: int = 8,
    with_text: bool = True,
) -> DataFrame:
    """Add ``out``: struct(n_bytes, n_removed, n_spans long, kept_sha256 string[, n_passage_words long][, text string]).

    Every byte of the UTF-8 text is removed that a ``length``-byte string covers which also starts
    anywhere else, in any text of the table or further on in the same; strings are judged on the
    input, overlapping occurrences count, and matches never cross texts.  ``n_spans`` counts maximal
    removed runs; ``kept_sha256`` digests the remaining bytes.  ``text`` is the remaining bytes as
    text; pieces of characters that a span's edge cuts off are left out of it.

    With ``words``, passages are looked for as well: ``n_passage_words`` counts the words (parted by
    ASCII white space) that a run of ``words`` words covers which also starts anywhere else, however
    few bytes it has.  They don't change the other figures, but ``text`` loses them too, from the
    first byte of a maximal run to its last.

    A null text counts as empty; texts shorter than ``length`` stay whole; a repeated row makes the
    text repeat, so that it goes from both; rows with equal ids and different texts are told apart
    by the text; null ids are ordinary; an empty table gives an empty result.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (out, text_col)]
    base = docs.select(
        F.struct(*keep).alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(text_col).isNull().alias("is_null")
    ).withColumn("th", F.xxhash64("text"))
    spans = repeat_spans(base, length=length, gram=gram, crowd=crowd)
    if words:
        passages = repeat_spans(base, length=words, gram=word_gram, crowd=crowd, by_words=True).withColumnRenamed("spans", "passages")
        both = spans.unionByName(passages, allowMissingColumns=True).groupBy("id", "th")
        spans = both.agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("spans", "passages")))
    else:
        spans = spans.withColumn("passages", F.lit(None).cast(spans.schema["spans"].dataType))
    spans = spans.withColumnsRenamed({"id": "s_id", "th": "s_th"})
    met = base.join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("th") == F.col("s_th")), "left").select(*base.columns, "spans", "passages")
    kind = base.schema["row"].dataType

    def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
        at, kept = 0, []
        for a, b in runs:
            kept.append(data[at:a])
            at = b
        return b"".join([*kept, data[at:]])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = []
            for text, marks, more in zip(batch["text"], batch["spans"], batch["passages"], strict=True):
                data = text.encode()
                runs = merged([(m["lo"], m["hi"]) for m in marks or ()])
                left = without(data, runs)
                one = {"n_bytes": len(data), "n_removed": len(data) - len(left), "n_spans": len(runs), "kept_sha256": hashlib.sha256(left).hexdigest()}
                if words:
                    passages = merged([(m["lo"], m["hi"]) for m in more or ()])
                    one["n_passage_words"] = sum(b - a for a, b in passages)
                    if with_text and passages:
                        starts, ends = word_places(data)
                        left = without(data, merged([*runs, *((int(starts[a]), int(ends[b - 1])) for a, b in passages)]))
                found.append(one | ({"text": left.decode("utf-8", "ignore")} if with_text else {}))
            yield {"row": batch["row"], "was": [None if n else t for n, t in zip(batch["is_null"], batch["text"], strict=True)] if with_text else [None] * len(found), "out": found}

    from pyspark.sql import types as T

    result = T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", n_passage_words long" * bool(words) + ", text string" * with_text)
    done = arrow_map(met, rows, T.StructType([T.StructField("row", kind), T.StructField("was", T.StringType()), T.StructField("out", result)]), at_once=32)
    order = [F.col("was").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c != out and (with_text or c != text_col)]
    return done.select(*order, F.col("out").alias(out))
