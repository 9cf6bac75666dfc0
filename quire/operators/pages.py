"""Pages: quality, routing, retry decisions, outline look-up and per-book summaries.

All of it is declarative: one scan of the pages, a shuffle by book where a summary needs one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.engine import cut, shuffle_width
from quire.functions import text as tx

#: Gates that keep a page from the native route, in order (fixed values).
GATES = ["router_disabled", "native_extraction_error", "native_text_empty", "native_render_not_structured", "native_text_quality_gate_failed", "needs_visual_parser"]
FINAL = ["complete", "partial"]
CHUNKABLE = ["complete", "native_text_fallback"]


def number_pages(docs: DataFrame, book: str, order: str) -> DataFrame:
    """Add ``book`` and a gapless 1-based ``page`` in the order of ``order``, which is unique and not null.

    Keys alone are range-partitioned by book and order, so a large book spreads over tasks; a page is
    its row's place in the partition plus what the book has in the partitions before.  The other
    columns meet their page by ``order``.
    """
    keys = docs.select(F.col(book).alias("_book"), F.col(order).alias("_order"))
    ranged = keys.repartitionByRange(shuffle_width(docs.sparkSession), "_book", "_order").sortWithinPartitions("_book", "_order")
    placed = cut(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy(F.col("_book").alias("_own"), F.col("_part").alias("_in")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_own").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
    numbered = placed.join(bases, F.col("_book").eqNullSafe(F.col("_own")) & (F.col("_part") == F.col("_in"))).select("_order", (F.col("_at") + F.col("_base")).cast("int").alias("page"))
    return docs.join(numbered, F.col(order) == F.col("_order")).drop("_order").withColumn("book", F.col(book))


#: Python's white space apart from line feed and carriage return (fixed value).
BLANKS = "\t\x0b\x0c\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def text_counts(text: Column) -> dict[str, Column]:
    """Raw counts behind the quality codes.  What single characters decide is counted by removing them,
    which is several times faster than matching."""
    without = lambda characters: F.length(text) - F.length(F.translate(text, characters, ""))
    return {
        "characters": F.length(text),
        "nonspace": F.length(F.translate(text, BLANKS + "\r\n", "")),
        "alnum": tx.count_matches(text, r"[\p{L}\p{N}]"),
        "spaces": without(BLANKS),
        "newlines": F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))),
        "replaced": F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit(""))),
    }


def quality_codes(counts: dict[str, Column]) -> Column:
    """Reasons why a page's native text can't serve as a reference, in a fixed order; none: usable."""
    length, solid = F.greatest(F.lit(1), counts["characters"]), F.greatest(F.lit(1), counts["nonspace"])
    return F.array_compact(
        F.array(
            F.when(counts["nonspace"] == 0, "native_text_empty"),
            F.when(counts["replaced"] / length > 0.03, "native_text_invalid_characters"),
            F.when((counts["nonspace"] > 0) & (counts["alnum"] / solid < 0.3), "native_text_low_alphanumeric_ratio"),
            F.when(counts["spaces"] / length > 0.7, "native_text_excessive_spaces"),
            F.when(counts["newlines"] / length > 0.6, "native_text_excessive_newlines"),
        )
    )


def text_quality(pages: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts, ``reason_codes`` and ``usable_as_reference``."""
    counts = text_counts(F.col(text))
    named = {k: F.col(k) for k in counts}
    counted = pages.withColumn("counts", F.struct(*[c.alias(k) for k, c in counts.items()])).select(*[F.col(f"`{c}`") for c in pages.columns], "counts.*")
    return counted.withColumn("reason_codes", quality_codes(named)).withColumn("usable_as_reference", F.size("reason_codes") == 0)


def route(pages: DataFrame, enabled: Column) -> DataFrame:
    """Add ``failed_gates``, ``eligible_if_enabled`` and ``route_native``.

    Reads extraction_error, native_text, render_mode, usable_as_reference and needs_visual_parser.
    """
    failed = [
        ~enabled,
        F.col("extraction_error").isNotNull(),
        F.coalesce(tx.strip(F.col("native_text")), F.lit("")) == "",
        F.coalesce(F.col("render_mode"), F.lit("")) != "structured",
        ~F.coalesce(F.col("usable_as_reference"), F.lit(False)),
        F.coalesce(F.col("needs_visual_parser"), F.lit(True)),
    ]
    gates = F.array_compact(F.array(*[F.when(test, gate) for test, gate in zip(failed, GATES, strict=True)]))
    return (
        pages.withColumn("failed_gates", gates)
        .withColumn("eligible_if_enabled", F.size(F.array_remove("failed_gates", "router_disabled")) == 0)
        .withColumn("route_native", F.size("failed_gates") == 0)
    )


def router_summary(routed: DataFrame, book: str = "book") -> DataFrame:
    """Pages, eligible, natively routed and converted pages of each book."""
    return routed.groupBy(book).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if("eligible_if_enabled").alias("eligible"),
        F.count_if("route_native").alias("routed"),
        F.count_if(~F.col("route_native")).alias("llm"),
    )


def histogram(rows: DataFrame, values: str, name: str, book: str = "book", ignore: tuple[str, ...] = ()) -> DataFrame:
    """Counts of the elements of an array column for each book."""
    shown = F.col(name).isNotNull() & ~F.col(name).isin(*ignore) if ignore else F.col(name).isNotNull()
    # explode_outer: plain explode makes Spark evaluate the array a second time in a filter
    return rows.select(book, F.explode_outer(values).alias(name)).where(shown).groupBy(book, name).agg(F.count(F.lit(1)).alias("n"))


def as_map(counts: DataFrame, key: str, book: str = "book") -> DataFrame:
    """A histogram as one key-sorted map a book."""
    entries = F.array_sort(F.collect_list(F.struct(key, "n")))
    return counts.groupBy(book).agg(F.map_from_entries(entries).alias("counts"))


def page_lists(pages: DataFrame, book: str = "book") -> DataFrame:
    """Sorted page numbers by outcome and the book's status: partial if any page failed or fell back."""
    listed = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("page"))))
    failed, fallback = F.col("status") == "failed", F.col("status") == "native_text_fallback"
    return pages.groupBy(book).agg(
        listed(failed).alias("failed_pages"),
        listed(fallback).alias("fallback_pages"),
        listed(F.col("conversion_route") == "native_structured").alias("native_routed_pages"),
        listed(F.col("needs_visual_parser")).alias("visual_review_pages"),
        F.when(F.bool_or(failed | fallback), "partial").otherwise("complete").alias("status"),
    )


def retry_actions(pages: DataFrame, states: DataFrame, requested: DataFrame | None, include_fallback: bool) -> DataFrame:
    """What to do with each page: process, skip, keep_fallback or leave_failed.

    ``states`` has (book, page, status) of pages already materialised, ``requested`` (book, page) of
    an explicit retry; None is a plain resume, which processes whatever isn't there or failed.
    """
    joined = pages.join(states.select("book", "page", F.col("status").alias("was")), ["book", "page"], "left")
    if requested is None:
        chosen = F.lit(True)
    else:
        joined = joined.join(requested.select("book", "page", F.lit(True).alias("chosen")), ["book", "page"], "left")
        chosen = F.coalesce("chosen", F.lit(False))
    again = chosen & F.lit(include_fallback)
    action = (
        F.when(F.col("was") == "complete", "skip")
        .when(F.col("was") == "native_text_fallback", F.when(again, "process").otherwise("keep_fallback"))
        .when(F.col("was").isNotNull() & ~chosen, "leave_failed")
        .otherwise("process")
    )
    return joined.withColumn("action", action).drop("chosen")


def outline_paths(pages: DataFrame, outline: DataFrame) -> DataFrame:
    """As-of join: each page's outline path is that of the latest entry at or before it.

    ``outline`` has (book, idx, level, page, path).  Among entries on one page the later index and
    then the deeper level wins.  One union and one running window by book, no range join.
    """
    entries = outline.where(F.col("page") > 0).groupBy("book", "page").agg(F.max_by("path", F.struct("idx", "level")).alias("path"))
    both = entries.select("book", "page", F.lit(0).alias("side"), "path", F.lit(None).alias("row")).unionByName(
        pages.select("book", "page", F.lit(1).alias("side"), F.lit(None).cast("array<string>").alias("path"), F.struct("*").alias("row"))
    )
    window = Window.partitionBy("book").orderBy("page", "side").rowsBetween(Window.unboundedPreceding, 0)
    latest = both.withColumn("latest", F.last("path", ignorenulls=True).over(window))
    return latest.where("side = 1").select("row.*", F.col("latest").alias("outline_path"), F.element_at("latest", -1).alias("outline_section"))


def outline_tree(outline: DataFrame) -> DataFrame:
    """Materialised paths from (book, idx, level, title): ancestors are the last shallower entries.

    For each level the last title is carried forward and dropped once a shallower entry follows.
    """
    deepest = outline.agg(F.max("level")).head()[0] or 0
    window = Window.partitionBy("book").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    at = [F.max(F.when(F.col("level") == k, F.struct("idx", "title"))).over(window).alias(f"at{k}") for k in range(1, deepest + 1)]
    cut = [F.max(F.when(F.col("level") < k, F.col("idx"))).over(window).alias(f"cut{k}") for k in range(1, deepest + 1)]
    carried = outline.select("*", *at, *cut)
    parts = [F.when((F.lit(k) <= F.col("level")) & (F.col(f"at{k}.idx") > F.coalesce(f"cut{k}", F.lit(-1))), F.col(f"at{k}.title")) for k in range(1, deepest + 1)]
    return carried.select(*outline.columns, F.array_compact(F.array(*parts)).alias("path"))


def islands(pages: DataFrame, book: str = "book") -> DataFrame:
    """Runs of consecutive pages: (book, island, first_page, last_page, n)."""
    window = Window.partitionBy(book).orderBy("page")
    broken = (F.col("page") > F.lag("page").over(window) + 1).cast("int")
    numbered = pages.select(book, "page", F.coalesce(broken, F.lit(0)).alias("broken")).withColumn("island", F.sum("broken").over(window))
    return numbered.groupBy(book, "island").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count(F.lit(1)).alias("n"))


def failure_runs(pages: DataFrame, limit: int = 5, book: str = "book") -> DataFrame:
    """Circuit breaker: books with ``limit`` consecutive failures, and the page that trips it.

    Success and fallback reset the count; skipped pages (null status) don't take part.
    """
    window = Window.partitionBy(book).orderBy("page")
    done = pages.where(F.col("status").isNotNull()).withColumn("resets", F.sum((F.col("status") != "failed").cast("int")).over(window))
    run = done.where("status = 'failed'").withColumn("run", F.row_number().over(Window.partitionBy(book, "resets").orderBy("page")))
    return run.where(F.col("run") == limit).groupBy(book).agg(F.min("page").alias("stopped_at"))


def carry_section(segments: DataFrame, title: Column, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``section``: the last heading so far, '' before the first."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return segments.withColumn("section", F.coalesce(F.last(title, ignorenulls=True).over(window), F.lit("")))
