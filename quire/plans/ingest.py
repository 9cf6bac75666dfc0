"""The life of a book: ingest, rebuild and pack, as tables partitioned by book.

``ingest`` decodes new files, renders and routes their pages, converts what isn't native, and stores
page and book tables; pages done before are kept.  ``rebuild`` derives chunks anew from stored pages,
without any service.  ``pack`` checks the corpus, embeds what the cache lacks and writes the export.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import Settings
from quire.engine import cut
from quire.operators import books as bk
from quire.operators import chunks as ck
from quire.operators import facts as fx
from quire.operators import pages as pg
from quire.operators import preflight as pf
from quire.operators import retrieval as rt
from quire.operators.layout import CONFIG_SHA256, render_pages
from quire.plans import converters as cv
from quire.sources import files as src
from quire.sources import sinks
from quire.streaming.inbox import _exists

BIB_JSON = "struct<title: string, author: string, authors: array<string>, edition: string, publication_year: string, year: string, language: string>"
SIDECAR = f"status string, title string, author string, authors array<string>, edition string, publication_year string, year string, language string, bibliography {BIB_JSON}"


def _table(spark: SparkSession, settings: Settings, name: str) -> DataFrame | None:
    path = settings.path(name)
    return spark.read.parquet(path) if _exists(spark, path) else None


def with_profile(decoded: DataFrame) -> DataFrame:
    """Add each book's font profile and running headers as ``profile``."""
    block = "array<struct<bbox: array<double>, lines: array<struct<spans: array<struct<text: string, size: double, flags: int>>>>>>"
    typed = decoded.where("page > 0").select(F.col("book_id").alias("book"), "page", "height", F.from_json("blocks", block).alias("text_blocks"))
    fonts = fx.font_profile(fx.font_histogram(fx.spans_of(typed)))
    one = typed.select("book", "page", "height", F.explode("text_blocks").alias("b"))
    text = F.array_join(F.transform("b.lines", lambda line: F.array_join(F.transform(line["spans"], lambda s: s["text"]), "")), "\n")
    edge = one.where((F.get("b.bbox", F.lit(3)) <= 0.1 * F.col("height")) | (F.get("b.bbox", F.lit(1)) >= 0.87 * F.col("height"))).select("book", text.alias("text"))
    repeated = fx.repeated_marginalia(edge, typed).groupBy("book").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    both = fonts.join(repeated, "book", "full_outer").select(
        F.col("book").alias("book_id"),
        F.struct(F.col("body_size").alias("body_font_size"), F.col("heading_sizes").alias("heading_font_sizes"), F.col("keys").alias("repeated_marginalia")).alias("profile"),
    )
    return decoded.join(both, "book_id", "left")


def process_pages(decoded: DataFrame, enabled: bool, make_converter: Callable[[], cv.PageConverter]) -> DataFrame:
    """Page records from decoded pages: quality, layout, route, conversion."""
    scored = pg.text_quality(with_profile(decoded.where("page > 0")), "native_text")
    raw = scored.withColumns({c: F.parse_json(c) for c in ("blocks", "tables", "images")}).withColumn("quality_codes", F.col("reason_codes"))
    rendered = render_pages(raw.drop("reason_codes")).withColumns(
        {"render_mode": F.col("rendered.render_mode"), "needs_visual_parser": F.col("rendered.needs_visual_parser"), "reason_codes": F.col("rendered.reason_codes")}
    )
    routed = cut(pg.route(rendered.drop("blocks", "tables", "images"), F.lit(enabled)))
    outcome = cv.native_outcome(routed.where("route_native")).unionByName(cv.convert(routed.where("NOT route_native"), make_converter))
    facts = routed.select(
        "book_id", "page", "page_count", "native_text", "printed_page_label", "outline_path", F.try_element_at("outline_path", F.lit(-1)).alias("outline_section"), "needs_visual_parser", "reason_codes", "failed_gates",
        "eligible_if_enabled", "route_native", F.struct("usable_as_reference", F.col("quality_codes").alias("reason_codes")).alias("native_text_quality"),
        F.struct(F.col("rendered.table_candidates").alias("table_candidates"), F.col("rendered.image_density").alias("image_density")).alias("page_complexity"),
    )
    joined = facts.join(outcome, ["book_id", "page"])
    return joined.withColumns({"schema_version": F.lit(pf.PAGE_SCHEMA), "native_processor_config_sha256": F.lit(CONFIG_SHA256), "markdown_sha256": F.sha2("markdown", 256)})


def with_bibliography(files: DataFrame, old: DataFrame | None) -> DataFrame:
    """Add licence, bibliography and status of (book_id, source_file, license_json); earlier results are kept by rank."""
    named = files.withColumn("license", F.from_json("license_json", SIDECAR))
    empty = F.lit(None).cast(f"struct<{bk.BIBLIOGRAPHY.replace(' ', ': ').replace(',:', ',')}>")
    if old is not None:
        named = named.join(old.select("book_id", F.col("bibliography").alias("existing")), "book_id", "left")
    else:
        named = named.withColumn("existing", empty)
    named = named.withColumn("pdf_metadata", F.struct(F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("author")))
    return bk.resolve_bibliography(named).withColumn("license_status", bk.normalize_license(F.col("license.status"))).drop("license", "existing", "pdf_metadata", "license_json")


def ingest(
    spark: SparkSession,
    settings: Settings,
    make_decoder: Callable[[], cv.DocumentDecoder],
    make_converter: Callable[[], cv.PageConverter],
    *,
    now: datetime,
    pattern: str = "*.pdf",
    retry_pages: set[int] | None = None,
    retry_fallback: bool = False,
) -> DataFrame:
    """Process the stable files of the inbox; returns their book rows.

    Files are known by their content's hash, so a renamed file is the same book.  Pages that are
    complete stay as they are; ``retry_pages`` limits and, with ``retry_fallback``, widens the retry.
    """
    settings.validate_for_ingestion()
    files = src.stable(src.scan_inbox(spark, settings.path("inbox"), pattern), now, settings.stable_seconds)
    known = _table(spark, settings, "books")
    hashed = src.identify(files)
    if known is not None:
        hashed = bk.find_existing(hashed, known.select("source_sha256", "book_id")).withColumn("book_id", F.coalesce("existing_book_id", "book_id")).drop("existing_book_id")
    first = hashed.groupBy("source_sha256").agg(F.min_by(F.struct("path", "source_file", "book_id"), "path").alias("f")).select("source_sha256", "f.*")
    first = bk.attach_sidecars(first, src.read_sidecars(spark, settings.path("inbox")))
    content = files.select("path", "content").join(first.select("path", "book_id"), "path")
    decoded = cut(cv.decode(content, make_decoder))
    unreadable = decoded.where("page = 0").select("book_id", F.col("extraction_error").alias("error"))

    stored = _table(spark, settings, "pages")
    todo = decoded.where("page > 0")
    if retry_pages and (most := decoded.agg(F.max("page_count")).head()[0] or 0) < max(retry_pages):
        raise ValueError(f"page {max(retry_pages)} was asked for, but there are {most}")
    if stored is not None:
        requested = None
        if retry_pages is not None:
            requested = todo.where(F.col("page").isin(*retry_pages)).select("book_id", "page")
        renamed = lambda df: df.withColumnRenamed("book_id", "book")
        actions = pg.retry_actions(renamed(todo.select("book_id", "page")), renamed(stored.select("book_id", "page", "status")), renamed(requested) if requested is not None else None, retry_fallback)
        todo = todo.join(actions.where("action = 'process'").select(F.col("book").alias("book_id"), "page"), ["book_id", "page"], "left_semi")
    fresh = cut(process_pages(todo, settings.native_router_enabled, make_converter))
    if stored is not None:
        kept = stored.join(fresh.select("book_id", "page"), ["book_id", "page"], "left_anti").join(fresh.select("book_id").distinct(), "book_id", "left_semi")
        fresh = cut(fresh.unionByName(kept.select(*fresh.columns)))
    sinks.write_by_book(fresh, settings.path("pages"))

    lists = pg.page_lists(fresh, "book_id").withColumn("page_status", F.col("status")).drop("status")
    counts = fresh.groupBy("book_id").agg(F.max("page_count").alias("page_count"), F.count_if("llm_called").alias("llm_pages"))
    books = with_bibliography(first, known).join(counts, "book_id", "left").join(lists, "book_id", "left").join(unreadable, "book_id", "left")
    changed = fresh.select("book_id").distinct().withColumn("touched", F.lit(True))
    books = books.join(changed, "book_id", "left").where("touched OR error IS NOT NULL").drop("touched", "path")
    books = cut(books.withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("page_status"))).drop("page_status"))
    sinks.write_by_book(books, settings.path("books"))
    ends = books.join(hashed.select("source_sha256", "path"), "source_sha256").select("path", (F.col("error").isNotNull()).alias("bad"), (F.col("status") == "complete").alias("done")).collect()  # one row a new file
    sinks.move_files(spark, [r.path for r in ends if r.bad], settings.path("failed"))
    sinks.move_files(spark, [r.path for r in ends if r.done and not r.bad], settings.path("processed"))
    rebuild(spark, settings, books.where("error IS NULL").select("book_id"))
    return books


def rebuild(spark: SparkSession, settings: Settings, book_ids: list[str] | DataFrame | None = None, sidecars: DataFrame | None = None) -> None:
    """Chunks of the named books, or all, from the stored pages; ``sidecars`` (book_id, license_json) renew bibliographies."""
    books, pages = _table(spark, settings, "books"), _table(spark, settings, "pages")
    if books is None or pages is None:
        raise ValueError("nothing has been ingested yet")
    if isinstance(book_ids, DataFrame):
        books, pages = (t.join(book_ids, "book_id", "left_semi").select(*t.columns) for t in (books, pages))
    elif book_ids is not None:
        books, pages = (t.where(F.col("book_id").isin(book_ids)) for t in (books, pages))
    books = books.where(F.col("status").isin(pg.FINAL))
    if sidecars is not None:
        renewed = with_bibliography(books.join(sidecars, "book_id").select("book_id", "source_file", "source_sha256", "license_json"), None)
        rest = books.drop("bibliography", "license_status").join(renewed.select("book_id", "bibliography", "license_status"), "book_id")
        books = cut(rest.select(*books.columns))
        sinks.write_by_book(books, settings.path("books"))
    manifest = books.select(F.col("book_id").alias("book"), "source_file", "license_status", "bibliography")
    records = ck.build_chunks(pages.withColumnRenamed("book_id", "book"), manifest, target=settings.chunk_target_tokens, most=settings.chunk_max_tokens, overlap=settings.chunk_overlap_tokens)
    sinks.write_by_book(cut(ck.chunk_markdown(records)), settings.path("chunks"))


def corpus(spark: SparkSession, settings: Settings) -> pf.Corpus:
    """The stored tables as preflight reads them; every artefact is a row, so no file can be missing."""
    books, pages, chunks = (_table(spark, settings, n) for n in ("books", "pages", "chunks"))
    if books is None or pages is None or chunks is None:
        raise ValueError("nothing has been built yet")
    p = pages.withColumns({"native_ir_path": F.format_string("ir/page-%04d.json", "page"), "native_diagnostics_path": F.format_string("ir/page-%04d.diagnostics.json", "page")})
    p = p.withColumn("json", F.to_json(F.struct(*[F.col(c) for c in p.columns]), {"ignoreNullFields": "false"}))
    k = chunks.withColumn("own_book_id", F.col("book_id")).withColumn("position", F.col("chunk_index"))
    k = k.withColumn("json", F.to_json(F.struct(*[F.col(c) for c in chunks.columns]), {"ignoreNullFields": "false"}))
    b = books.withColumns({"json": F.lit("{}"), "resolved_bibliography": F.col("bibliography")})
    files = p.select("book_id", F.explode(F.array("native_ir_path", "native_diagnostics_path", F.format_string("pages/page-%04d.md", "page"))).alias("path"))
    return pf.Corpus(b, p, k, files.unionByName(k.select("book_id", F.concat(F.lit("chunks/"), "path").alias("path"))))


def pack(spark: SparkSession, settings: Settings, make_embedder: Callable[[], rt.FakeEmbedder], *, allow_fake: bool = False, sqlite: str | None = None) -> dict[str, str]:
    """Check, embed and export the corpus: Parquet vectors and postings, and one SQLite file if asked; returns its facts."""
    whole = corpus(spark, settings)
    violations = cut(pf.preflight(whole))
    errors = violations.where("severity = 'error'").limit(20).collect()
    if errors:
        raise ValueError("preflight failed: " + "; ".join(f"{e.book_id} {e.rule} {e.detail}" for e in errors))
    embedder = make_embedder()
    if not embedder.semantic_vectors and not allow_fake:
        raise ValueError("vectors without meaning need allow_fake")
    books = pf.valid_books(whole, violations)
    if books.isEmpty():
        raise ValueError("no book to pack")
    chunks = ck.vector_order(whole.chunks.join(books.select("book_id"), "book_id", "left_semi"), ["book_id", "chunk_index"])
    cache_path = settings.path("embeddings")
    cache = src.read_cache(spark, cache_path, embedder.dimensions) if _exists(spark, cache_path) else spark.createDataFrame([], "cache_key string, embedding array<float>")
    vectors, new = rt.with_cache(rt.embedding_inputs(chunks), cache, make_embedder)
    new = cut(new)
    made = new.count()
    sinks.write_cache(new, cache_path)
    vectors = rt.with_cache(rt.embedding_inputs(chunks), src.read_cache(spark, cache_path, embedder.dimensions), make_embedder)[0]
    export = cut(vectors.join(chunks.select("chunk_id", "vector_index"), "chunk_id"))
    export.write.mode("overwrite").parquet(settings.path("exports/vectors"))
    rt.postings(chunks, "chunk_id", "body", "section").write.mode("overwrite").parquet(settings.path("exports/postings"))
    addressed = rt.embedding_inputs(chunks).join(chunks.select("chunk_id", "content_sha256", "vector_index"), "chunk_id").orderBy("vector_index")
    digest = sinks.corpus_digest(addressed.select("chunk_id", "content_sha256", "embedding_input_sha256").toLocalIterator())
    semantic = embedder.semantic_vectors
    facts = {"schema_version": str(pf.CHUNK_SCHEMA), "corpus_sha256": digest, "artifact_mode": "semantic" if semantic else "fake", "production_ready": str(semantic).lower(), "fts_tokenizer": "unicode61 remove_diacritics 2"}
    facts |= {"embedding_model": embedder.model, "embedding_task_type": embedder.task_type, "semantic_vectors": str(embedder.semantic_vectors).lower(), "cache_misses": str(made), "cache_hits": str(export.count() - made)}
    if sqlite:
        labelled = whole.pages.select("book_id", "page", F.col("printed_page_label").alias("printed_label"), "status", F.lit(None).cast("string").alias("citation"))
        titled = books.select("book_id", F.col("bibliography.title").alias("title"), "source_sha256", "page_count", "license_status")
        facts |= sinks.write_sqlite(sqlite, titled, labelled.join(books.select("book_id"), "book_id", "left_semi"), chunks, export, facts)
    return facts
