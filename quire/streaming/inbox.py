"""Streaming inbox: files that are renamed into a folder become rows of a table, once each.

The file source marks a file as seen when it lists it, so a filter on a file's age would lose the
file for good.  Copies therefore go to another name first and are renamed in; the pattern doesn't
match the other name.  Re-submitted content is dropped against what is stored already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, length long, source_sha256 string"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def ingest_batch(files: DataFrame, out: str) -> None:
    """Append a batch's new contents to ``out``: one row for each distinct content, the first path by name.

    A batch that runs again after a failure finds its own rows and adds nothing.
    """
    spark = files.sparkSession
    rows = files.select("path", "length", F.sha2("content", 256).alias("source_sha256"))
    first = rows.groupBy("source_sha256").agg(F.min_by(F.struct("path", "length"), "path").alias("first")).select("first.*", "source_sha256")
    if _exists(spark, out):
        first = first.join(spark.read.schema(SCHEMA).parquet(out).select("source_sha256"), "source_sha256", "left_anti")
    first.select("path", "length", "source_sha256").orderBy("path").write.mode("append").parquet(out)


def stream(spark: SparkSession, inbox: str, pattern: str = "*.pdf", per_trigger: int = 1) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return files.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger).load(inbox)


def drain(spark: SparkSession, inbox: str, out: str, checkpoint: str, pattern: str = "*.pdf", per_trigger: int = 1) -> None:
    """Ingest what is in the inbox now, and stop."""
    run = stream(spark, inbox, pattern, per_trigger).writeStream.foreachBatch(lambda df, _: ingest_batch(df, out))
    run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def watch(spark: SparkSession, inbox: str, out: str, checkpoint: str, seconds: float = 5, pattern: str = "*.pdf"):  # noqa: ANN201
    """Poll for ever; returns the running query."""
    run = stream(spark, inbox, pattern).writeStream.foreachBatch(lambda df, _: ingest_batch(df, out))
    return run.option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
