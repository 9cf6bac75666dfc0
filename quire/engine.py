"""Session factory and the few helpers that every operator shares.

``cut`` and ``shared_dir`` keep to one rule: anything that outlives a job goes to the folder the
cluster names in ``spark.checkpoint.dir``, which the driver and all executors can reach.  A folder
of our own is chosen only where that setting is absent (a local test session).
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "quire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join splitting on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, set on the context too so that ``checkpoint()`` works; a cluster must name one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quire-"))
    return folder or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage: later reads survive lost executors and redo no work."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for a table that is written once and read again."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as compressed Parquet below the shared folder; the caller deletes the path when it is done."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases now, not when the driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast only when a count proves ``df`` has at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
