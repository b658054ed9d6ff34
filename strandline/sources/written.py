"""Written intermediates: tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a temporary folder, elsewhere its lack is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="strandline-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later plans have real sizes, and a lost executor costs only a read."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def forget(*frames: DataFrame | None) -> None:
    """Deletes the files of written tables that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_written", None):
            jvm = df.sparkSession._jvm.org.apache.hadoop.fs
            jvm.Path(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm.Path(path), True)
