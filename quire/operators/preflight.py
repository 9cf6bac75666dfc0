"""Preflight: each table is read once for all rules that look at one record; a few rules are joins.

The report has rows (book_id, rule, detail).

Rules marked as stopping hide a book's later rules, and row-level gates hide later rules of the same
page or chunk, as a reader who stops at the first unusable record would see it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.engine import cut
from quire.functions import hashing
from quire.functions import text as tx
from quire.operators import books as bk
from quire.operators.retrieval import embedding_text

PAGE_SCHEMA, CHUNK_SCHEMA, TOKEN_LIMIT = 3, 5, 8192
#: Fields that every page and chunk record must have (fixed values).
PAGE_FIELDS = "printed_page_label outline_path outline_section needs_visual_parser reason_codes native_ir_path native_diagnostics_path native_processor_config_sha256 native_text_quality page_complexity parser_backend parser_model conversion_route llm_called".split()
CHUNK_FIELDS = "chunk_id book_id source_file book_title title_source authors authors_source edition publication_year language page_start page_end printed_page_start printed_page_end citation body content_sha256 source_quality included_pages outline_section markdown_section outline_path visual_review_pages native_structured_pages has_native_structured reason_codes structural_block_type structural_block_types oversized oversized_reason".split()
ROUTES = ["native_structured", "visual_llm", "native_fallback_after_llm", "visual_llm_failed", "visual_render_failed_before_llm"]
STRUCTURES = ["fenced_block", "html_table", "markdown_table"]
#: Order of the book-level stages: a failed stopping rule hides all rules of later stages.
STOPPING = {"V1": 1, "V2": 2, "V3": 3, "V4": 4, "V5": 5, "V7": 7, "V8": 8, "V16": 16}
WARNINGS = ["V2", "V6"]


@dataclass
class Corpus:
    """What is checked.  Records come with their raw JSON in ``json``, because a present null is legal.

    books: book_id, json, status, license_status, bibliography, resolved_bibliography, failed_pages,
    fallback_pages, page_count.  pages: book_id, page, json, and the fields that rules read.
    chunks: book_id (of the file), position, json and the record's fields, its own book_id as
    ``own_book_id``.  files: (book_id, path) of all artefacts that exist.
    """

    books: DataFrame
    pages: DataFrame
    chunks: DataFrame
    files: DataFrame


def _missing(json: str, fields: list[str]) -> Column:
    return F.array_except(F.array(*map(F.lit, fields)), F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")))


Rule = tuple[str, Column, Column | None]


def _rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Violations of one table, all rules in one pass: a rule is (name, test, detail)."""
    broken = [F.when(test, F.struct(F.lit(name).alias("rule"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))) for name, test, detail in rules]
    return df.select("book_id", F.explode_outer(F.array_compact(F.array(*broken))).alias("v")).where("v IS NOT NULL").select("book_id", "v.*")


def _absent(df: DataFrame, paths: Column, files: DataFrame, name: str) -> DataFrame:
    wanted = df.select("book_id", F.explode_outer(paths).alias("path")).where("path IS NOT NULL")
    return wanted.join(files, ["book_id", "path"], "left_anti").select("book_id", F.lit(name).alias("rule"), F.col("path").alias("detail"))


def book_rules(c: Corpus, include_unspecified: bool) -> list[DataFrame]:
    pages = c.pages.groupBy("book_id").agg(F.count(F.lit(1)).alias("page_records"), F.sort_array(F.collect_list(F.when(F.col("status") == "failed", F.col("page")))).alias("failed_records"))
    chunks = c.chunks.groupBy("book_id").agg(F.count(F.lit(1)).alias("chunk_records"))
    failed = F.coalesce("failed_records", F.array().cast("array<int>"))
    rules: list[Rule] = [
        ("V1", F.col("status").isNull(), None),
        ("V2", ~F.col("status").isin("complete", "partial"), F.col("status")),
        ("V3", ~F.col("bibliography").eqNullSafe(F.col("resolved_bibliography")), None),
        ("V4", ~bk.packable(F.col("license_status"), include_unspecified), F.col("license_status")),
        ("V5", F.size("failed_pages") > 0, F.array_join("failed_pages", ",")),
        ("V6", F.size("fallback_pages") > 0, F.array_join("fallback_pages", ",")),
        ("V7", F.col("chunk_records").isNull(), None),
        ("V8", ~F.col("page_records").eqNullSafe(F.col("page_count").cast("long")), F.col("page_records")),
        ("V16", F.size(failed) > 0, F.array_join(failed, ",")),
    ]
    return [_rules(c.books.join(pages, "book_id", "left").join(chunks, "book_id", "left"), rules)]


def page_rules(c: Corpus) -> list[DataFrame]:
    p = c.pages.withColumn("missing", _missing("json", PAGE_FIELDS)).withColumn("known", F.col("schema_version").eqNullSafe(F.lit(PAGE_SCHEMA)))
    p = p.withColumn("fine", F.col("known") & (F.size("missing") == 0))
    is_object = lambda f: F.coalesce(F.get_json_object("json", f"$.{f}").startswith("{"), F.lit(False))
    fine, native = F.col("fine"), F.col("conversion_route") == "native_structured"
    rules: list[Rule] = [
        ("V9", ~F.col("known"), F.col("page")),
        ("V10", F.col("known") & (F.size("missing") > 0), F.array_join("missing", ",")),
        ("V12", fine & ~F.coalesce(F.col("native_processor_config_sha256").rlike(r"\A[0-9a-f]{64}\z"), F.lit(False)), F.col("page")),
        ("V13", fine & (~is_object("native_text_quality") | ~is_object("page_complexity")), F.col("page")),
        ("V14", fine & ~F.coalesce(F.col("conversion_route").isin(ROUTES), F.lit(False)), F.col("conversion_route")),
        ("V15", fine & native & (F.col("llm_called") | F.col("needs_visual_parser") | ~F.col("parser_backend").eqNullSafe(F.lit("native"))), F.col("page")),
    ]
    every = c.books.where("page_count > 0").select("book_id", F.transform(F.sequence(F.lit(1), "page_count"), lambda k: F.format_string("pages/page-%04d.md", k)).alias("paths"))
    return [_rules(p, rules), _absent(p.where("fine"), F.array("native_ir_path", "native_diagnostics_path"), c.files, "V11"), _absent(every, F.col("paths"), c.files, "V17")]


def chunk_rules(c: Corpus) -> list[DataFrame]:
    k = c.chunks.withColumn("missing", _missing("json", CHUNK_FIELDS)).withColumn("whole", F.size("missing") == 0)
    # Records that lack a field take no part in the order of equal ids, nor in what is read after it.
    order = Window.partitionBy(F.when(F.col("whole"), F.col("chunk_id")), F.when(~F.col("whole"), F.struct("book_id", "position"))).orderBy("book_id", "position")
    manifest = c.books.select("book_id", F.col("bibliography").alias("m_bibliography"), F.col("license_status").alias("m_license"), F.lit(True).alias("in_manifest"))
    read = k.withColumn("nth", F.row_number().over(order)).join(manifest, "book_id", "left")
    own = F.struct(F.col("book_title").alias("title"), "title_source", "authors", "authors_source", "edition", "publication_year", "language")
    sha = hashing.chunk_content_sha256(F.col("book_id"), F.col("page_start"), F.col("page_end"), F.col("section"), F.col("body"))
    joined = F.col("whole") & F.coalesce("in_manifest", F.lit(False))
    read = read.withColumns({"joined": joined, "empty": F.regexp_replace("body", r"\s+", "") == ""}).withColumn("full", F.col("joined") & ~F.col("empty"))
    read = read.withColumn("sha", F.when(F.col("full"), sha))
    kinds = F.coalesce("structural_block_types", F.array().cast("array<string>"))
    kind = F.when(F.size(kinds) == 0, F.lit(None)).when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).otherwise("mixed")
    has_reason = F.coalesce("oversized_reason", F.lit("")) != ""
    embedded = embedding_text(*[F.col(x) for x in ("book_title", "authors", "edition", "publication_year", "language", "section", "body")])
    joined, full, chunk = F.col("joined"), F.col("full"), F.col("chunk_id")
    rules: list[Rule] = [
        ("V18", ~F.col("schema_version").eqNullSafe(F.lit(CHUNK_SCHEMA)), chunk),
        ("V18", ~F.col("whole"), F.array_join("missing", ",")),
        ("V19", F.col("whole") & (F.col("nth") > 1), chunk),
        ("V20", joined & ~F.col("own_book_id").eqNullSafe(F.col("book_id")), chunk),
        ("V21", joined & ~own.eqNullSafe(F.col("m_bibliography")), chunk),
        ("V22", joined & F.col("empty"), chunk),
        ("V23", full & (~F.col("content_sha256").eqNullSafe(F.col("sha")) | ~chunk.eqNullSafe(hashing.chunk_id(F.col("book_id"), F.col("sha")))), chunk),
        ("V24", full & ~F.col("license_status").eqNullSafe(F.col("m_license")), chunk),
        ("V25", full & ((F.size(F.array_except(kinds, F.array(*map(F.lit, STRUCTURES)))) > 0) | ~F.col("structural_block_type").eqNullSafe(kind)), chunk),
        ("V26", full & (F.col("oversized") != has_reason), chunk),
        ("V27", full & (tx.conservative_tokens(embedded) > TOKEN_LIMIT), chunk),
    ]
    return [_rules(read, rules), _absent(read.where("full"), F.array(F.concat(F.lit("chunks/"), F.col("path"))), c.files, "V28")]


def preflight(c: Corpus, *, requested: DataFrame | None = None, include_unspecified: bool = False) -> DataFrame:
    """All violations (book_id, rule, detail, severity) in the order in which a book is read.

    ``requested`` limits the books by id; ids that don't exist are violations themselves (V29).
    """
    if requested is not None:
        c = Corpus(*(df.join(requested.select("book_id").distinct(), "book_id", "left_semi") for df in (c.books, c.pages, c.chunks, c.files)))
    found = None
    for rule in book_rules(c, include_unspecified) + page_rules(c) + chunk_rules(c):
        found = rule if found is None else found.unionByName(rule)
    found = cut(found)  # violations only, read twice below
    number = F.regexp_extract("rule", r"\d+", 0).cast("int")
    stops = F.create_map(*[F.lit(x) for pair in STOPPING.items() for x in pair])
    first = found.where(F.col("rule").isin(*STOPPING)).groupBy("book_id").agg(F.min(stops[F.col("rule")]).alias("stop"))
    # V9 to V15 are read before the failed pages of V16 stop the book, V17 on are read after.
    shown = found.join(first, "book_id", "left").where(F.col("stop").isNull() | (number <= F.col("stop"))).select("book_id", "rule", "detail")
    if requested is not None:
        unknown = requested.select("book_id").distinct().join(c.books, "book_id", "left_anti").select("book_id", F.lit("V29").alias("rule"), F.lit("unknown book").alias("detail"))
        shown = shown.unionByName(unknown)
    return shown.withColumn("severity", F.when(F.col("rule").isin(*WARNINGS), "warning").otherwise("error"))


def valid_books(c: Corpus, violations: DataFrame) -> DataFrame:
    """Final books without an error."""
    bad = violations.where("severity = 'error' OR rule = 'V2'").select("book_id").distinct()
    return c.books.join(bad, "book_id", "left_anti")
