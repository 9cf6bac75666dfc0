import json
import sqlite3
from datetime import UTC, datetime

import pytest

from quire import cli
from quire.config import Settings, parse_env
from quire.operators.retrieval import FakeEmbedder
from quire.plans import converters, ingest
from quire.sources import files as src
from quire.sources import sinks
from quire.streaming.inbox import drain

NOW = datetime(2100, 1, 1, tzinfo=UTC).replace(tzinfo=None)


def block(text, y, size=10.0):
    return {"bbox": [50, y, 500, y + 15], "lines": [{"spans": [{"text": text, "size": size, "flags": 0}]}]}


def document(*texts):
    return json.dumps({"pages": [{"text": t, "blocks": [block(t, 300)] if t else [], "label": f"l{i}", "outline_path": ["Part"]} for i, t in enumerate(texts)]})


@pytest.fixture
def settings(tmp_path):
    s = Settings(root=tmp_path, native_router_enabled=True, embedding_dimensions=16, stable_seconds=0)
    s.ensure_directories()
    return s


def table(spark, settings, name):
    return {(r.book_id, r.page): r for r in spark.read.parquet(settings.path(name)).collect()}


def test_router_fallback_retry_rename_and_pack(spark, settings):
    inbox = settings.root / "inbox"
    text = document("first page with enough words to be rendered", "", "third page REFUSED by the service")
    (inbox / "book.pdf").write_text(text)
    (inbox / "broken.pdf").write_text("no json")
    (inbox / "locked.pdf").write_text('{"encrypted": true}')
    (inbox / "book.license.json").write_text('{"status": "owned", "title": "A Title", "authors": ["X"], "year": 1999}')
    refuse = lambda: converters.TextConverter({"REFUSED": "RECITATION"})
    raw = json.loads(text)
    raw["pages"][2]["images"] = [[50, 400, 500, 700]]  # a figure: not for the native route
    (inbox / "book.pdf").write_text(json.dumps(raw))
    books = {r.source_file: r for r in ingest.ingest(spark, settings, converters.JsonDecoder, refuse, now=NOW).collect()}
    assert books["broken.pdf"].status == books["locked.pdf"].status == "failed" and "password" in books["locked.pdf"].error
    book = books["book.pdf"]
    assert (book.status, book.failed_pages, book.fallback_pages, book.native_routed_pages, book.llm_pages) == ("partial", [2], [3], [1], 2)
    assert book.bibliography.title == "A Title" and book.license_status == "owned"
    pages = table(spark, settings, "pages")
    assert pages[book.book_id, 1].llm_called is False and pages[book.book_id, 3].status == "native_text_fallback"

    (inbox / "book.pdf").rename(inbox / "renamed.pdf")  # the same content: the same book
    again = {r.source_file: r for r in ingest.ingest(spark, settings, converters.JsonDecoder, converters.TextConverter, now=NOW, retry_pages={3}, retry_fallback=True).collect()}
    assert again["renamed.pdf"].book_id == book.book_id and again["renamed.pdf"].fallback_pages == [] and again["renamed.pdf"].failed_pages == [2]
    chunk = spark.read.parquet(settings.path("chunks")).where(f"book_id = '{book.book_id}'").collect()
    assert [c.included_pages for c in chunk] == [[1], [3]] and chunk[0].section == "Part" and chunk[0].printed_page_start == "l0"

    with pytest.raises(ValueError, match="V5"):
        ingest.pack(spark, settings, lambda: FakeEmbedder(16), allow_fake=True)


def test_pack_writes_one_file_and_uses_the_cache(spark, settings):
    (settings.root / "inbox" / "b.pdf").write_text(document("alpha beta gamma words on the page", "delta epsilon words on the second page"))
    ingest.ingest(spark, settings, converters.JsonDecoder, converters.TextConverter, now=NOW)
    make = lambda: FakeEmbedder(16)
    with pytest.raises(ValueError, match="allow_fake"):
        ingest.pack(spark, settings, make)
    path = str(settings.root / "corpus.sqlite")
    facts = ingest.pack(spark, settings, make, allow_fake=True, sqlite=path)
    assert facts["cache_misses"] == facts["chunks_count"] if "chunks_count" in facts else facts["chunk_count"] == facts["cache_misses"]
    db = sqlite3.connect(path)
    rows, dimensions, blob = db.execute("SELECT row_count, dimensions, data FROM embedding_matrix").fetchone()
    assert len(blob) == rows * dimensions * 4 and dimensions == 16
    assert db.execute("SELECT count(*) FROM chunks_fts WHERE chunks_fts MATCH '\"alpha\"'").fetchone() == (1,)
    assert ingest.pack(spark, settings, make, allow_fake=True)["cache_misses"] == "0"
    ids = [r[0] for r in db.execute("SELECT chunk_id FROM chunks ORDER BY book_id, chunk_index")]
    assert dict(db.execute("SELECT * FROM meta"))["ordered_chunk_ids_sha256"] == sinks.ordered_digest(iter(ids))


def test_rebuild_with_a_new_title_keeps_the_ids(spark, settings):
    (settings.root / "inbox" / "c.pdf").write_text(document("some words that stay the same"))
    ingest.ingest(spark, settings, converters.JsonDecoder, converters.TextConverter, now=NOW)
    (before,) = spark.read.parquet(settings.path("chunks")).collect()
    sidecar = spark.createDataFrame([(before.book_id, '{"status": "owned", "title": "New"}')], "book_id string, license_json string")
    ingest.rebuild(spark, settings, sidecars=sidecar)
    (after,) = spark.read.parquet(settings.path("chunks")).collect()
    assert after.chunk_id == before.chunk_id and after.book_title == "New" and "New" in after.citation and before.book_title == "c"


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n  \n{"a": 2}\n')
    assert [r.a for r in src.require_clean(src.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int")).orderBy("a").collect()] == [1, 2]
    (tmp_path / "y.jsonl").write_text('{"a": 1}\n[1]\n{"a":\n')
    bad = src.read_jsonl(spark, str(tmp_path / "y.jsonl"), "a int")
    assert sorted(r.corrupt for r in bad.where("corrupt IS NOT NULL").collect()) == ["[1]", '{"a":']
    with pytest.raises(ValueError):
        src.require_clean(bad)


def test_page_files(spark, tmp_path):
    (tmp_path / "pages" / "b").mkdir(parents=True)
    (tmp_path / "pages" / "b" / "page-0001.md").write_text("---\nx: 1\n---\nbody")
    assert [tuple(r) for r in src.read_page_files(spark, str(tmp_path)).collect()] == [("b", 1, "body")]
    assert [r.length for r in src.list_files(spark, str(tmp_path)).collect()] == [17]


def test_manifests(spark, tmp_path):
    for name, text in (("a", '{"book_id": "a", "status": "complete"}'), ("b", "{broken")):
        (tmp_path / "metadata" / name).mkdir(parents=True)
        (tmp_path / "metadata" / name / "manifest.json").write_text(text)
    got = src.read_manifests(spark, str(tmp_path), "book_id string, status string").orderBy("path").collect()
    assert [(r.book_id, r.status) for r in got] == [("a", "complete"), (None, None)]


def test_stream_ingests_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name, text in (("b.pdf", "two"), ("a.pdf", "one"), ("c.pdf", "one"), ("d.pdf.uploading", "three")):
        (inbox / name).write_text(text)
    run = lambda: drain(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "state"), per_trigger=2)
    run()
    (inbox / "d.pdf.uploading").rename(inbox / "d.pdf")
    (inbox / "e.pdf").write_text("two")
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 3 and len({r.source_sha256 for r in got}) == 3


def test_settings(tmp_path):
    assert parse_env("# c\nexport A='x y'\nB=\"1\"\n\nbad") == {"A": "x y", "B": "1"}
    (tmp_path / ".env").write_text("QUIRE_CHUNK_TARGET_TOKENS=100\nQUIRE_CHUNK_OVERLAP_TOKENS=10\nQUIRE_NATIVE_ROUTER_ENABLED=yes\n")
    s = Settings.load(tmp_path, {"QUIRE_CHUNK_TARGET_TOKENS": "5", "QUIRE_MAX_RETRIES": "2"})
    assert (s.chunk_target_tokens, s.native_router_enabled, s.max_retries) == (100, True, 2)
    for bad in ("QUIRE_CHUNK_TARGET_TOKENS=1000", "QUIRE_MAX_RETRIES=x", "QUIRE_MAX_RETRIES=-1", "QUIRE_KEEP_PAGE_IMAGES=perhaps"):
        (tmp_path / ".env").write_text(bad)
        with pytest.raises(ValueError):
            Settings.load(tmp_path, {})


def test_command_line(tmp_path, capsys):
    assert cli.build_parser().parse_args(["retry", "--pages", "4,7-9"]).pages == {4, 7, 8, 9}
    assert cli.main(["--root", str(tmp_path), "doctor"]) == 0 and "ok" in capsys.readouterr().out
    (tmp_path / ".env").write_text("QUIRE_CHUNK_TARGET_TOKENS=1000")
    assert cli.main(["--root", str(tmp_path), "doctor"]) == 2 and "overlap < target <= max" in capsys.readouterr().err


def test_atomic_write(tmp_path):
    path = str(tmp_path / "x")
    sinks.write_atomic(path, "one")
    sinks.write_atomic(path, b"two")
    assert (tmp_path / "x").read_text() == "two" and len(list(tmp_path.iterdir())) == 1


def test_chunks_of_all_changed_books_whatever_their_number(spark, settings, monkeypatch):
    """Any cap on the rebuilt books is lowered to one here."""
    for k in range(3):
        (settings.root / "inbox" / f"b{k}.pdf").write_text(document(f"words of book number {k} on its page"))
    kind = type(spark.range(1))
    limit = kind.limit
    monkeypatch.setattr(kind, "limit", lambda self, n: limit(self, min(n, 1)))
    books = ingest.ingest(spark, settings, converters.JsonDecoder, converters.TextConverter, now=NOW)
    ids = {r.book_id for r in books.collect()}
    assert len(ids) == 3 and {r.book_id for r in spark.read.parquet(settings.path("chunks")).select("book_id").collect()} == ids


def test_pack_refuses_rows_that_refer_to_nothing(spark, tmp_path):
    from quire.sources.sinks import write_sqlite

    books = spark.createDataFrame([("b", "T", "x", 1, "owned")], "book_id string, title string, source_sha256 string, page_count int, license_status string")
    pages = spark.createDataFrame([("other", 1, None, "complete", "c")], "book_id string, page int, printed_label string, status string, citation string")
    chunks = spark.createDataFrame([], "chunk_id string, book_id string, chunk_index int, page_start int, page_end int, section string, body string, citation string")
    vectors = spark.createDataFrame([], "vector_index long, chunk_id string, cache_key string, embedding array<float>")
    path = tmp_path / "corpus.sqlite"
    with pytest.raises(ValueError, match="refers to no row"):
        write_sqlite(str(path), books, pages, chunks, vectors, {})
    assert not path.exists()
