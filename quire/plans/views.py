"""Views of the synthetic tables as corpus records: what the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.engine import table
from quire.functions import hashing
from quire.functions import text as tx
from quire.operators import pages as pg
from quire.operators import preflight


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages: the source is the book, the rank by id the page, labels give the outcome."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    status = F.when(F.col("quality") == 0, "failed").when(F.col("toxic") == 1, "native_text_fallback").otherwise("complete")
    rows = pg.number_pages(docs.select("doc_id", "text", "lang", "source").join(labels, "doc_id", "left"), "source", "doc_id")
    return rows.select("book", "page", "doc_id", "lang", "text", status.alias("status"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with quality and the route decision; every seventh page renders flat, some German ones need a look."""
    scored = pg.text_quality(pages(spark, sf_dir))
    view = scored.select(
        "book", "page", "doc_id", "status", F.lit(None).cast("string").alias("extraction_error"), F.col("text").alias("native_text"),
        F.when(F.col("page") % 7 == 0, "flat_safety_fallback").otherwise("structured").alias("render_mode"), "usable_as_reference",
        ((F.col("lang") == "de") & (F.col("page") % 3 == 0)).alias("needs_visual_parser"), (F.col("page") % 11 != 0).alias("enabled"),
    )
    return pg.route(view, F.col("enabled"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of chunkable pages as prose blocks; the packer splits long ones."""
    lines = pages(spark, sf_dir).where(F.col("status") != "failed").select("book", "page", "status", F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    kept = lines.where(tx.strip(F.col("text")) != "")
    return kept.withColumn("section", F.lit("")).withColumn("structural_block_type", F.lit(None).cast("string"))


def markdown_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as Markdown: the first heading, then the paragraphs, some with a table or a fence behind."""
    raw = table(spark, sf_dir, "pages")
    plain = lambda c: F.regexp_replace(c, "<[^>]*>", " ")
    title = F.concat(F.lit("# "), tx.squeeze(plain(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1))))
    paragraphs = F.transform(F.expr("regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)"), lambda p: tx.squeeze(plain(p)))
    table_text = F.when(F.col("page_id") % 5 == 0, "| a | b |\n| --- | --- |\n| 1 | 2 |")
    fence = F.when(F.col("page_id") % 7 == 0, "```text\ncode\n\nmore\n```")
    return raw.select(F.lit("web").alias("book"), F.col("page_id").cast("int").alias("page"), F.concat_ws("\n\n", title, paragraphs, table_text, fence).alias("markdown"))


def outline(pages_: DataFrame, every: int = 5) -> DataFrame:
    """An outline entry on every fifth page, of levels 1 to 3."""
    rows = pages_.where(F.col("page") % every == 0).select("book", F.col("page").alias("idx"), (F.col("page") % 3 + 1).cast("int").alias("level"), F.concat(F.lit("T"), F.col("page")).alias("title"), "page")
    return rows


def faulty_corpus(spark: SparkSession, sf_dir: str) -> preflight.Corpus:
    """A corpus of one chunk a page with faults of every rule injected by book number and document id."""
    p = pages(spark, sf_dir).select(F.col("book").alias("book_id"), "page", "doc_id", "text", F.regexp_extract("book", r"\d+", 0).cast("int").alias("number"))
    d, n = F.col("doc_id"), F.col("number")
    title = F.concat(F.lit("Book "), F.col("book_id"))
    null = F.lit(None).cast("string")
    bib = lambda t: F.struct(t.alias("title"), F.lit("filename").alias("title_source"), F.array(F.lit("A")).alias("authors"), null.alias("authors_source"), null.alias("edition"), null.alias("publication_year"), F.lit("en").alias("language"))
    none = F.array().cast("array<int>")
    books = p.groupBy("book_id", "number").agg(F.count(F.lit(1)).cast("int").alias("pages")).select(
        "book_id", F.lit("{}").alias("json"), F.when(n % 10 == 4, null).when(n % 10 == 3, "processing").otherwise("complete").alias("status"), F.when(n % 10 == 5, "stolen").otherwise("owned").alias("license_status"),
        bib(title).alias("bibliography"), bib(F.when(n % 10 == 9, "Other").otherwise(title)).alias("resolved_bibliography"), F.when(n % 10 == 6, F.array(F.lit(1))).otherwise(none).alias("failed_pages"),
        F.when(n % 10 == 7, F.array(F.lit(2))).otherwise(none).alias("fallback_pages"), (F.col("pages") + F.when(n % 10 == 8, 1).otherwise(0)).alias("page_count"),
    )
    good = "{" + ",".join(f'"{f}":' + ("{}" if f in ("native_text_quality", "page_complexity") else "null") for f in preflight.PAGE_FIELDS) + "}"
    records = p.select(
        "book_id", "page", "doc_id", F.when(d % 89 == 7, '{"a":1}').when(d % 73 == 3, good.replace('"page_complexity":{}', '"page_complexity":1')).otherwise(good).alias("json"), F.when(d % 97 == 5, 2).otherwise(3).alias("schema_version"),
        F.concat(F.lit("ir/"), "page").alias("native_ir_path"), F.concat(F.lit("dg/"), "page").alias("native_diagnostics_path"), F.when(d % 79 == 2, "no hash").otherwise(F.sha2(F.lit("c"), 256)).alias("native_processor_config_sha256"),
        F.when(d % 71 == 4, "bad").when(d % 67 == 5, "native_structured").otherwise("visual_llm").alias("conversion_route"), F.lit(True).alias("llm_called"), F.lit(False).alias("needs_visual_parser"), F.lit("stub").alias("parser_backend"),
        F.when((n % 20 == 11) & (F.col("page") == 1), "failed").otherwise("complete").alias("status"),
    )
    sha = hashing.chunk_content_sha256(F.col("book_id"), F.col("page"), F.col("page"), F.lit(""), F.col("text"))
    whole = "{" + ",".join(f'"{f}":null' for f in preflight.CHUNK_FIELDS) + "}"
    kinds = F.when(d % 23 == 9, F.array(F.lit("bad"))).otherwise(F.array().cast("array<string>"))
    once = p.where("number % 20 <> 12").withColumn("position", F.col("page"))
    twice = once.unionByName(once.where(d % 47 == 3).withColumn("position", F.col("page") + 100_000))
    chunks = twice.withColumn("sha", sha).select(
        "book_id", "position", "doc_id", F.when(d % 53 == 2, "{}").otherwise(whole).alias("json"), F.when(d % 59 == 1, 4).otherwise(5).alias("schema_version"), hashing.chunk_id(F.col("book_id"), F.col("sha")).alias("chunk_id"),
        F.when(d % 43 == 4, "x").otherwise(F.col("book_id")).alias("own_book_id"), F.when(d % 41 == 5, "x").otherwise(title).alias("book_title"), F.lit("filename").alias("title_source"), F.array(F.lit("A")).alias("authors"),
        null.alias("authors_source"), null.alias("edition"), null.alias("publication_year"), F.lit("en").alias("language"), F.col("page").alias("page_start"), F.col("page").alias("page_end"), F.lit("").alias("section"),
        F.when(d % 37 == 6, " ").otherwise(F.col("text")).alias("body"), F.when(d % 31 == 7, "x").otherwise(F.col("sha")).alias("content_sha256"), F.when(d % 29 == 8, "x").when(n % 10 == 5, "stolen").otherwise("owned").alias("license_status"),
        kinds.alias("structural_block_types"), F.when(d % 23 == 9, "bad").alias("structural_block_type"), (d % 19 == 10).alias("oversized"), null.alias("oversized_reason"), F.concat(F.lit("c"), F.col("page"), F.lit(".md")).alias("path"),
    )
    there = F.array_compact(
        F.array(
            F.when(d % 83 != 1, F.concat(F.lit("ir/"), "page")), F.concat(F.lit("dg/"), "page"), F.when(d % 61 != 6, F.format_string("pages/page-%04d.md", "page")), F.when(d % 17 != 11, F.concat(F.lit("chunks/c"), F.col("page"), F.lit(".md")))
        )
    )
    return preflight.Corpus(books, records, chunks, p.select("book_id", F.explode(there).alias("path")))
