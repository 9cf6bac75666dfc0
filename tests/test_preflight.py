"""One corpus that passes, and one fault a time for every rule."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quire.config import Settings
from quire.operators import preflight as pf
from quire.plans import converters, ingest

NOW = datetime(2100, 1, 1, tzinfo=UTC).replace(tzinfo=None)


@pytest.fixture(scope="module")
def good(spark, tmp_path_factory):
    import json

    root = tmp_path_factory.mktemp("corpus")
    settings = Settings(root=root, embedding_dimensions=8, stable_seconds=0)
    settings.ensure_directories()
    (root / "inbox" / "a.pdf").write_text(json.dumps({"pages": [{"text": f"page {i} has some words"} for i in range(3)]}))
    ingest.ingest(spark, settings, converters.JsonDecoder, converters.TextConverter, now=NOW)
    c = ingest.corpus(spark, settings)
    local = lambda df: spark.createDataFrame(df.collect(), df.schema)
    return pf.Corpus(*map(local, (c.books, c.pages, c.chunks, c.files)))


def rules(corpus, **more):
    return sorted({r.rule for r in pf.preflight(corpus, **more).collect()})


def changed(corpus, table, **columns):
    parts = {k: getattr(corpus, k) for k in ("books", "pages", "chunks", "files")}
    parts[table] = parts[table].withColumns(columns)
    return pf.Corpus(**parts)


def test_a_sound_corpus_passes(good):
    assert rules(good) == []
    assert pf.valid_books(good, pf.preflight(good)).count() == 1


FAULTS = [
    ("V1", "books", "status", "CAST(NULL AS STRING)"), ("V2", "books", "status", "'processing'"), ("V4", "books", "license_status", "'stolen'"), ("V5", "books", "failed_pages", "array(2)"),
    ("V6", "books", "fallback_pages", "array(2)"), ("V8", "books", "page_count", "2"), ("V9", "pages", "schema_version", "2"), ("V10", "pages", "json", "'{}'"), ("V11", "pages", "native_ir_path", "'x'"),
    ("V12", "pages", "native_processor_config_sha256", "'x'"), ("V13", "pages", "json", r"""regexp_replace(json, '"page_complexity":.[^}]*.', '"page_complexity":1')"""), ("V14", "pages", "conversion_route", "'x'"),
    ("V15", "pages", "conversion_route", "'native_structured'"), ("V16", "pages", "status", "'failed'"), ("V18", "chunks", "schema_version", "4"), ("V20", "chunks", "own_book_id", "'x'"), ("V21", "chunks", "book_title", "'x'"),
    ("V22", "chunks", "body", "'  '"), ("V23", "chunks", "content_sha256", "'x'"), ("V24", "chunks", "license_status", "'x'"), ("V25", "chunks", "structural_block_type", "'html_table'"), ("V26", "chunks", "oversized", "true"),
    ("V28", "chunks", "path", "'x'"),
]


@pytest.mark.parametrize("rule, table, column, value", FAULTS, ids=[f[0] for f in FAULTS])
def test_each_fault_is_found(good, rule, table, column, value):
    found = rules(changed(good, table, **{column: F.expr(value)}))
    assert rule in found
    if rule in ("V1", "V2", "V4", "V5", "V8", "V16"):
        assert all(int(r[1:]) <= int(rule[1:]) for r in found)


def test_other_faults(spark, good):
    b = F.struct(F.lit("x").alias("title"), *[F.col(f"bibliography.{f}") for f in ("title_source", "authors", "authors_source", "edition", "publication_year", "language")])
    assert "V3" in rules(changed(good, "books", resolved_bibliography=b))
    assert rules(pf.Corpus(good.books, good.pages, good.chunks.where("false"), good.files)) == ["V7"]
    assert "V17" in rules(pf.Corpus(good.books, good.pages, good.chunks, good.files.where("path NOT LIKE 'pages/%'")))
    assert rules(pf.Corpus(good.books, good.pages, good.chunks.unionByName(good.chunks), good.files)) == ["V19"]
    long = good.chunks.withColumn("body", F.repeat(F.lit("word "), 9000))
    assert "V27" in rules(pf.Corpus(good.books, good.pages, long, good.files))
    assert rules(good, requested=spark.createDataFrame([("nobody",)], "book_id string")) == ["V29"]
    assert rules(changed(good, "chunks", json=F.lit("{}"))) == ["V18"]
