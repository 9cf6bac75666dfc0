"""The training-data pipeline: its stages in order, each over the whole of what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a table with the columns of ``documents``; the last
returns packed pieces.  ``run`` writes each stage's result to shared storage and reads it again, so
a lost executor costs at most the stage that it ran.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.engine import delete_path, scratch_path, table
from quire.llm.line_dedup import dedup_lines
from quire.llm.near_copies import keep_one_of_each
from quire.llm.packing import pack
from quire.llm.quality import quality_rules, without_lines
from quire.llm.repeats import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """Back to the columns of ``documents``, with ``text`` as the text and its length."""
    return df.withColumn("text", F.col(text)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rejected documents go, boilerplate lines go from the others."""
    docs = docs.select(*COLUMNS)
    return as_documents(without_lines(docs, quality_rules(docs)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: repeated lines stay in one document only."""
    return as_documents(dedup_lines(docs.select(*COLUMNS)), "line_dedup.text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays."""
    return as_documents(keep_one_of_each(docs.select(*COLUMNS)))


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: repeats of 400 bytes go from the texts, and passages of over 50 words however few bytes they have."""
    return as_documents(remove_repeats(docs.select(*COLUMNS), words=51), "repeats.text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token pieces with their places in sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("repeat_dedup", repeat_dedup), ("packing", packing)]

#: Hashing, linking, byte-wise cutting and tokenising are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
