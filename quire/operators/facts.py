"""Document facts from decoded pages: metadata, permissions, font profile and marginalia."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as tx

#: Permission bits of a PDF (fixed values).
PERMISSIONS = {"print": 4, "modify": 8, "copy": 16, "annotate": 32, "form": 256, "accessibility": 512, "assemble": 1024, "print_high_quality": 2048}


def clean_metadata_map(metadata: Column) -> Column:
    return F.transform_values(metadata, lambda _, v: tx.clean_metadata(v))


def permissions(raw: Column) -> Column:
    """Struct of the eight permission flags."""
    return F.struct(*[(raw.bitwiseAND(F.lit(bit)) != 0).alias(name) for name, bit in PERMISSIONS.items()])


def spans_of(blocks: DataFrame) -> DataFrame:
    """One row a span from (book, page, text_blocks), with its place in reading order."""
    block = blocks.select("book", "page", F.posexplode("text_blocks").alias("b", "block"))
    line = block.select("book", "page", "b", F.posexplode("block.lines").alias("l", "line"))
    return line.select("book", "page", "b", "l", F.posexplode("line.spans").alias("s", "span")).select("book", "page", "b", "l", "s", "span.*")


def font_histogram(spans: DataFrame) -> DataFrame:
    """Characters (one at least for each span) by rounded size: (book, size, n, first)."""
    place = F.struct("page", "b", "l", "s")
    sized = spans.where(tx.strip(F.col("text")) != "").select("book", F.round("size", 1).alias("size"), F.greatest(F.lit(1), F.length(tx.strip(F.col("text")))).alias("w"), place.alias("place"))
    return sized.groupBy("book", "size").agg(F.sum("w").alias("n"), F.min("place").alias("first"))


def font_profile(histogram: DataFrame, headings: int = 6) -> DataFrame:
    """(book, body_size, heading_sizes): the most common size, the first seen on ties, and what is over 1.08 of it."""
    order = Window.partitionBy("book").orderBy(F.desc("n"), "first")
    body = histogram.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("book", F.col("size").alias("body_size"))
    joined = histogram.join(body, "book")
    sizes = F.slice(F.sort_array(F.collect_set(F.when(F.col("size") > F.col("body_size") * 1.08, F.col("size"))), asc=False), 1, headings)
    return joined.groupBy("book").agg(F.first("body_size").alias("body_size"), sizes.alias("heading_sizes"))


def repeated_marginalia(lines: DataFrame, pages: DataFrame, share: float = 0.2, least: int = 3) -> DataFrame:
    """Edge lines that recur: (book, key, n) where n reaches ``least`` and ``share`` of the book's pages.

    ``lines`` has (book, text) of blocks near the edges, ``pages`` one row a page.  Occurrences count,
    not distinct pages.
    """
    keyed = lines.select("book", tx.edge_key(F.col("text")).alias("key")).where("key <> ''")
    total = pages.groupBy("book").agg(F.count(F.lit(1)).alias("pages"))
    counts = keyed.groupBy("book", "key").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(total, "book").where(F.col("n") >= F.greatest(F.lit(least), F.ceil(F.col("pages") * share))).select("book", "key", "n")


def without_marginalia(blocks: DataFrame, repeated: DataFrame) -> DataFrame:
    """Flag blocks whose key is a repeated one: adds ``ignored`` and ``ignore_reason``."""
    keys = repeated.select("book", "key", F.lit(True).alias("again"))
    keyed = blocks.withColumn("key", tx.edge_key(F.col("text"))).join(keys, ["book", "key"], "left")
    again = F.coalesce("again", F.lit(False)) & F.col("edge")
    number = F.col("edge") & F.col("text").rlike(rf"(?i)\A[{tx.WS}]*(?:\d+|[ivxlcdm]+)[{tx.WS}]*\z")
    reason = F.when(again, "repeated_running_header_or_footer").when(number, "isolated_printed_page_number")
    return keyed.withColumn("ignored", again | number).withColumn("ignore_reason", reason).drop("again", "key")


def token_coverage(pairs: DataFrame, expected: str, observed: str, key: str, missing: int = 30) -> DataFrame:
    """Bag containment of ``expected`` tokens in ``observed``: (key, total, matched, coverage, unmatched).

    Both sides are exploded and counted by (key, token); no row holds more than one text's tokens.
    (explode_outer, because plain explode makes Spark split every text a second time in a filter.)
    """
    split = lambda c: F.filter(F.split(F.lower(c), rf"[^{tx.WORD}]+"), lambda t: t != "")
    want = pairs.select(key, F.posexplode_outer(split(expected)).alias("pos", "token")).where("token IS NOT NULL").groupBy(key, "token").agg(F.count(F.lit(1)).alias("want"), F.min("pos").alias("pos"))
    have = pairs.select(key, F.explode_outer(split(observed)).alias("token")).where("token IS NOT NULL").groupBy(key, "token").agg(F.count(F.lit(1)).alias("have"))
    joined = want.join(have, [key, "token"], "left").withColumn("have", F.coalesce("have", F.lit(0)))
    lacks = F.sort_array(F.collect_list(F.when(F.col("want") > F.col("have"), F.struct("pos", F.array_repeat("token", (F.col("want") - F.col("have")).cast("int")).alias("tokens")))))
    found = joined.groupBy(key).agg(F.sum("want").alias("total"), F.sum(F.least("want", "have")).alias("matched"), F.slice(F.flatten(F.transform(lacks, lambda x: x["tokens"])), 1, missing).alias("unmatched"))
    every = pairs.select(key).join(found, key, "left").na.fill(0, ["total", "matched"])
    return every.withColumn("coverage", F.when(F.col("total") > 0, F.col("matched") / F.col("total")).otherwise(1.0))


def containment(blocks: DataFrame, tables: DataFrame, ratio: float = 0.95) -> DataFrame:
    """Blocks inside a table of their page: (book, page, block, table), equi-join by page and a box predicate."""
    t = tables.select("book", "page", "table", *[F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")])
    width = F.greatest(F.lit(0.0), F.least("x1", "t_x1") - F.greatest("x0", "t_x0"))
    height = F.greatest(F.lit(0.0), F.least("y1", "t_y1") - F.greatest("y0", "t_y0"))
    area = F.greatest(F.lit(1.0), (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    return blocks.join(t, ["book", "page"]).where(width * height / area >= ratio)


def accounted_tables(contained: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables whose own words cover those of the blocks inside: (book, page, table, accounted)."""
    words = lambda df, text: df.select("book", "page", "table", F.explode_outer(F.filter(F.split(F.lower(text), rf"[^{tx.WORD}]+"), lambda w: w != "")).alias("token")).where("token IS NOT NULL").groupBy("book", "page", "table", "token").count()
    inside, own = words(contained, "text").withColumnRenamed("count", "need"), words(tables, "text").withColumnRenamed("count", "have")
    met = inside.join(own, ["book", "page", "table", "token"], "left").groupBy("book", "page", "table").agg(F.bool_and(F.coalesce("have", F.lit(0)) >= F.col("need")).alias("accounted"))
    return tables.select("book", "page", "table").join(met, ["book", "page", "table"], "left").withColumn("accounted", F.coalesce("accounted", F.lit(True)))


def captions(blocks: DataFrame, figures: DataFrame, page_height: float, overlap: float = 0.4, gap: float = 0.04) -> DataFrame:
    """Blocks right below a figure: (book, page, block, figure), the first figure in order wins."""
    f = figures.select("book", "page", "figure", *[F.col(c).alias(f"f_{c}") for c in ("x0", "y0", "x1", "y1")])
    shared = F.greatest(F.lit(0.0), F.least("x1", "f_x1") - F.greatest("x0", "f_x0"))
    narrower = F.greatest(F.lit(1.0), F.least(F.col("x1") - F.col("x0"), F.col("f_x1") - F.col("f_x0")))
    below = F.col("y0") - F.col("f_y1")
    near = blocks.join(f, ["book", "page"]).where((shared / narrower >= overlap) & (below >= 0) & (below <= page_height * gap))
    return near.groupBy("book", "page", "block").agg(F.min("figure").alias("figure"))


def vector_signals(drawings: DataFrame, pages: DataFrame) -> DataFrame:
    """(book, page, drawing_count, decorative_rule_count, vector_density) from drawing boxes.

    A rule is two points thick at most and a fifth of the page long; rules don't count as content.
    ``pages`` has (book, page, width, height).
    """
    met = drawings.join(pages, ["book", "page"])
    wide, tall = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    rule = ((tall <= 2) & (wide >= 0.2 * F.col("width"))) | ((wide <= 2) & (tall >= 0.2 * F.col("height")))
    covered = F.sum(F.when(~rule, F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), tall)))
    found = met.groupBy("book", "page").agg(
        F.count_if(~rule).alias("drawing_count"), F.count_if(rule).alias("decorative_rule_count"), (F.coalesce(covered, F.lit(0.0)) / F.first(F.greatest(F.lit(1.0), F.col("width") * F.col("height")))).alias("vector_density")
    )
    every = pages.select("book", "page").join(found, ["book", "page"], "left").na.fill(0, ["drawing_count", "decorative_rule_count", "vector_density"])
    return every.withColumn("vector_density", F.least(F.lit(1.0), "vector_density"))


def span_density(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """(book, page, text_density, invisible_ocr_spans): span boxes of four numbers over the page's area."""
    b = F.col("bbox")
    box = F.when(F.size(b) == 4, F.greatest(F.lit(0.0), F.get(b, F.lit(2)) - F.get(b, F.lit(0))) * F.greatest(F.lit(0.0), F.get(b, F.lit(3)) - F.get(b, F.lit(1))))
    sums = spans.groupBy("book", "page").agg(F.sum(box).alias("area"), F.count_if(F.col("alpha") == 0).alias("invisible_ocr_spans"))
    size = F.greatest(F.lit(1.0), F.col("width") * F.col("height"))
    return pages.join(sums, ["book", "page"], "left").select("book", "page", (F.coalesce("area", F.lit(0.0)) / size).alias("text_density"), F.coalesce("invisible_ocr_spans", F.lit(0)).alias("invisible_ocr_spans"))
