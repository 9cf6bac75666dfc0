"""Sinks: Parquet tables by book, JSON lines, per-page files, the SQLite pack and the embedding cache."""

from __future__ import annotations

import json
import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as tx


def write_atomic(path: str, data: bytes | str) -> None:
    """A file that is there as a whole or not at all (driver side)."""
    raw = data.encode() if isinstance(data, str) else data
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".", prefix=".tmp-")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(raw)
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def write_by_book(df: DataFrame, path: str, book: str = "book_id") -> None:
    """Replace only the partitions of the books in ``df``: chunks and pages of other books stay."""
    df.repartition(book).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(book).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def page_front_matter(fields: dict[str, Column]) -> Column:
    """``---`` block of JSON-quoted fields."""
    lines = [F.concat(F.lit(f"{name}: "), F.coalesce(tx.json_quoted(value.cast("string")), F.lit("null"))) for name, value in fields.items()]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"))


def page_markdown(pages: DataFrame) -> DataFrame:
    """Add ``file_markdown``: front matter and the page's body, or a visible warning for other outcomes."""
    names = ["source_file", "book_id", "page", "page_count", "citation", "status", "parser_backend", "conversion_route", "llm_called"]
    fallback = F.concat(F.lit("> [!warning] Native text fallback: layout, tables and figures may be missing.\n\n"), F.coalesce("markdown", F.lit("")))
    failed = F.concat(F.lit("> [!failure] Page "), F.col("page"), F.lit(" could not be converted.\n"))
    body = F.when(F.col("status") == "complete", F.col("markdown")).when(F.col("status") == "native_text_fallback", fallback).otherwise(failed)
    return pages.withColumn("file_markdown", F.concat(page_front_matter({n: F.col(n) for n in names}), F.lit("\n\n"), body, F.lit("\n")))


def combined_books(pages: DataFrame, book: str = "book_id") -> DataFrame:
    """(book, text): page entries in order, each under its marker and source line."""
    entry = F.concat(F.lit("<!-- PAGE_START "), F.col("page"), F.lit(" -->\n[Source: "), F.col("citation"), F.lit("]\n\n"), F.col("markdown"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("page"), entry.alias("text"))))
    return pages.groupBy(book).agg(F.array_join(F.transform(ordered, lambda e: e["text"]), "\n\n").alias("text"))


def refresh_citations(pages: DataFrame, changed: DataFrame) -> DataFrame:
    """Replace the old citation by the new one in texts: ``changed`` has (book_id, page, old, new)."""
    joined = pages.join(changed, ["book_id", "page"], "left")
    text = F.when(F.col("old").isNotNull(), F.replace("markdown", F.col("old"), F.col("new"))).otherwise(F.col("markdown"))
    return joined.withColumn("markdown", text).withColumn("citation", F.coalesce("new", "citation")).drop("old", "new")


def write_cache(new: DataFrame, path: str) -> None:
    new.withColumn("embedding_sha256", F.sha2(F.array_join("embedding", ","), 256)).write.mode("append").parquet(path)


META = """
CREATE TABLE meta (key TEXT PRIMARY KEY, value TEXT NOT NULL);
CREATE TABLE books (book_id TEXT PRIMARY KEY, title TEXT NOT NULL, source_sha256 TEXT, page_count INTEGER, license_status TEXT);
CREATE TABLE pages (book_id TEXT NOT NULL REFERENCES books, page INTEGER NOT NULL, printed_label TEXT, status TEXT, citation TEXT, PRIMARY KEY (book_id, page));
CREATE TABLE chunks (rowid INTEGER PRIMARY KEY, chunk_id TEXT UNIQUE NOT NULL, book_id TEXT NOT NULL REFERENCES books, chunk_index INTEGER, page_start INTEGER, page_end INTEGER, section TEXT, body TEXT NOT NULL, citation TEXT);
CREATE INDEX chunks_by_page ON chunks (book_id, page_start, page_end);
CREATE VIRTUAL TABLE chunks_fts USING fts5 (body, section, content='chunks', content_rowid='rowid', tokenize='unicode61 remove_diacritics 2');
CREATE TABLE embedding_rows (vector_index INTEGER PRIMARY KEY, chunk_id TEXT UNIQUE NOT NULL REFERENCES chunks (chunk_id), cache_key TEXT);
CREATE TABLE embedding_matrix (id INTEGER PRIMARY KEY CHECK (id = 1), dimensions INTEGER, row_count INTEGER, data BLOB NOT NULL);
"""


def ordered_digest(ids: Iterator[str]) -> str:
    """SHA-256 of ids, each followed by a line feed."""
    digest = sha256()
    for i in ids:
        digest.update(i.encode() + b"\n")
    return digest.hexdigest()


def corpus_digest(rows: Iterator[Row]) -> str:
    """SHA-256 over the JSON list of {chunk_id, content_sha256, embedding_input_sha256}, streamed in order."""
    digest = sha256(b"[")
    for k, row in enumerate(rows):
        one = {"chunk_id": row.chunk_id, "content_sha256": row.content_sha256, "embedding_input_sha256": row.embedding_input_sha256}
        digest.update((("," if k else "") + json.dumps(one, sort_keys=True, separators=(",", ":"))).encode())
    digest.update(b"]")
    return digest.hexdigest()


def move_files(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move finished or broken files out of the inbox, through the file system that holds them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        source = hadoop.Path(path)
        system = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(hadoop.Path(folder))
        system.rename(source, hadoop.Path(folder, source.getName()))


def write_sqlite(path: str, books: DataFrame, pages: DataFrame, chunks: DataFrame, vectors: DataFrame, meta: dict[str, str]) -> dict[str, str]:
    """One corpus file for a single reader: tables, full-text index and vector matrix; returns its meta.

    This sink is for corpora that fit one file; rows stream through the driver a partition at a time
    and nothing is collected.  The file appears only when it is whole and passes its own checks.
    """
    temporary = f"{path}.tmp"
    if os.path.exists(temporary):
        os.unlink(temporary)
    db = sqlite3.connect(temporary)
    try:
        db.executescript(META)
        add = lambda name, df, columns: db.executemany(f"INSERT INTO {name} ({', '.join(columns)}) VALUES ({', '.join('?' * len(columns))})", (tuple(r) for r in df.select(*columns).toLocalIterator()))
        add("books", books.orderBy("book_id"), ["book_id", "title", "source_sha256", "page_count", "license_status"])
        add("pages", pages.orderBy("book_id", "page"), ["book_id", "page", "printed_label", "status", "citation"])
        add("chunks", chunks.orderBy("book_id", "chunk_index"), ["chunk_id", "book_id", "chunk_index", "page_start", "page_end", "section", "body", "citation"])
        blob, count, dimensions = bytearray(), 0, 0
        row: Row
        for row in vectors.orderBy("vector_index").toLocalIterator():
            dimensions = len(row.embedding)
            blob += struct.pack(f"<{dimensions}f", *row.embedding)
            db.execute("INSERT INTO embedding_rows VALUES (?, ?, ?)", (row.vector_index, row.chunk_id, row.cache_key))
            count += 1
        if len(blob) != count * dimensions * 4:
            raise ValueError("the vector matrix has a wrong size")
        db.execute("INSERT INTO embedding_matrix VALUES (1, ?, ?, ?)", (dimensions, count, bytes(blob)))
        db.execute("INSERT INTO chunks_fts (chunks_fts) VALUES ('rebuild')")
        ids = (r[0] for r in db.execute("SELECT chunk_id FROM chunks ORDER BY book_id, chunk_index"))
        counted = {f"{t[:-1]}_count": str(db.execute(f"SELECT count(*) FROM {t}").fetchone()[0]) for t in ("books", "pages", "chunks")}
        found = meta | counted | {"ordered_chunk_ids_sha256": ordered_digest(ids), "vector_blob_sha256": sha256(bytes(blob)).hexdigest(), "embedding_dimensions": str(dimensions), "fts_columns": "body,section", "fts_bm25_weights": "10.0,3.0"}
        db.executemany("INSERT INTO meta VALUES (?, ?)", found.items())
        db.commit()
        if db.execute("PRAGMA integrity_check").fetchone()[0] != "ok":
            raise ValueError("the packed file fails its integrity check")
        if orphan := db.execute("PRAGMA foreign_key_check").fetchone():
            raise ValueError(f"the packed file has a row of {orphan[0]} that refers to no row of {orphan[2]}")
        words = db.execute("SELECT body FROM chunks ORDER BY rowid LIMIT 1").fetchone()
        from quire.functions.plain import match_query

        if words and (query := match_query(words[0], 1)) and not db.execute("SELECT 1 FROM chunks_fts WHERE chunks_fts MATCH ? LIMIT 1", (query,)).fetchone():
            raise ValueError("the packed file's text index finds nothing")
    except BaseException:
        db.close()
        os.unlink(temporary)
        raise
    db.close()
    os.replace(temporary, path)
    return found
