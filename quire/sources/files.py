"""Sources: inbox, sidecars, manifests, JSON lines, page files and the embedding cache."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as tx
from quire.operators import books


def scan_inbox(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, modificationTime, length, content) of the folder's files; columns that aren't used aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def stable(files: DataFrame, now: datetime, seconds: int = 8) -> DataFrame:
    """Files that aren't empty and have rested for ``seconds``."""
    return files.where((F.col("length") > 0) & (F.col("modificationTime") <= F.lit(now) - F.make_dt_interval(secs=F.lit(seconds))))


def identify(files: DataFrame) -> DataFrame:
    """(path, source_file, source_sha256, book_id) of PDF files."""
    named = files.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), F.sha2("content", 256).alias("source_sha256"))
    from quire.functions import hashing

    return named.withColumn("book_id", hashing.book_id(tx.slug(books.file_stem(F.col("source_file"))), F.col("source_sha256")))


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of licence sidecars."""
    return spark.read.option("pathGlobFilter", "*.license.json").text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines and ``corrupt``, the line that is no object; blank lines are skipped.

    Bad lines are kept as rows, so that the caller can report them all with their text.
    """
    lines = spark.read.text(path).where(tx.strip(F.col("value")) != "")
    kind = T.StructType(T._parse_datatype_string(schema).fields + [T.StructField("corrupt", T.StringType())])
    parsed = lines.select(F.from_json("value", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}).alias("r"), "value")
    bad = ~F.coalesce(F.ltrim("value").startswith("{"), F.lit(False)) | F.col("r.corrupt").isNotNull()
    return parsed.select("r.*", "value", bad.alias("bad")).withColumn("corrupt", F.when(F.col("bad"), F.col("value"))).drop("bad", "value")


def require_clean(records: DataFrame) -> DataFrame:
    """The records, or an error that names a corrupt line."""
    if bad := records.where("corrupt IS NOT NULL").select("corrupt").head():
        raise ValueError(f"corrupt JSON line: {bad.corrupt[:200]}")
    return records.drop("corrupt")


def read_manifests(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """One row a manifest ``metadata/*/manifest.json``; unreadable ones have a null ``book_id`` and their path."""
    raw = spark.read.text(f"{root}/metadata/*/manifest.json", wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select("path", F.from_json("value", schema).alias("m"), F.col("value").alias("json")).select("path", "json", "m.*")


def read_page_files(spark: SparkSession, root: str) -> DataFrame:
    """(book_id, page, markdown) of the per-page Markdown files, front matter removed."""
    raw = spark.read.option("pathGlobFilter", "page-*.md").option("recursiveFileLookup", True).text(f"{root}/pages", wholetext=True)
    name = r"/pages/([^/]+)/page-(\d+)\.md\z"
    path = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(path, name, 1).alias("book_id"), F.regexp_extract(path, name, 2).cast("int").alias("page"), tx.without_front_matter(F.col("value")).alias("markdown"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files below ``root``, without reading them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return found.withColumn("path", F.regexp_replace("path", r"\Afile:/+", "/"))


def read_cache(spark: SparkSession, path: str, dimensions: int) -> DataFrame:
    """(cache_key, embedding) of intact entries: right length and a matching checksum."""
    packed = spark.read.schema("cache_key string, embedding array<float>, embedding_sha256 string").parquet(path)
    return packed.where((F.size("embedding") == dimensions) & (F.col("embedding_sha256") == F.sha2(F.array_join("embedding", ","), 256))).select("cache_key", "embedding")
