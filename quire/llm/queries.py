"""The thin queries opN_<name>: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.engine import table
from quire.llm.bpe import round_trip
from quire.llm.licence_scan import scan_licences
from quire.llm.licences import PHRASES, TEMPLATES
from quire.llm.line_dedup import dedup_lines
from quire.llm.packing import pack
from quire.llm.quality import quality_rules
from quire.llm.repeats import remove_repeats
from quire.llm.sharding import hilbert_shards
from quire.llm.simhash import near_duplicates
from quire.llm.url_filter import judge_urls
from quire.llm.winnowing import compare_with_next

#: The production rules of op9: (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("line_dedup.text", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), words=51, with_text=False)
    return out.select("doc_id", *(f"repeats.{c}" for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("th", "host", "removed")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"), TEMPLATES, PHRASES).withColumnRenamed("id", "doc_id").drop("spans")


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hilbert_shards(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
