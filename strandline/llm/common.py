"""Shared plumbing of the training-data operators: tables, the shared folder and written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (any file system Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only in a local session (tests, one process) without that setting and without a checkpoint folder a temporary folder is
    made and set; on a cluster its lack is an error, as executors could not see such a folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="strandline-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back.

    This cuts the lineage, gives later plans real sizes, and survives the loss of executors. ``discard`` deletes it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Deletes the files of stashed frames; for intermediates all of whose readers have been written themselves."""
    for df in frames:
        path = getattr(df, "_stashed", None)
        if path:
            jvm = df.sparkSession._jvm.org.apache.hadoop.fs
            at = jvm.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Arrow batches of at most ``limit`` bytes in this session, unless it asks for smaller ones already.

    Texts are long and an executor runs several Python workers, each of which holds a batch and its copies.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).rstrip("b"))
    if not 0 < now <= limit:
        spark.conf.set(key, limit)


def rows_of(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small literal frame."""
    return spark.createDataFrame(rows, schema)


def null_safe(a, b):
    return a.eqNullSafe(b)


def ascii_lower(c):
    """A-Z only, unlike ``lower``."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def others(columns: list[str], names: tuple[str, ...]) -> list[str]:
    """The columns that have none of the names, whatever the case, as Spark compares names."""
    taken = {x.lower() for x in names}
    return [c for c in columns if c.lower() not in taken]
