"""Files as a table, and what is found by their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FASTQ = r"(?i)\.(fastq|fq)(\.gz)?$"


def mate(number: int) -> str:
    """Pattern of a file name with R1 or 1 (R2 or 2) as a word of its own."""
    return rf"(?i)(^|[._-])R?{number}([._-]|$)"


def list_files(spark: SparkSession, root: str, names: str | None = None) -> DataFrame:
    """path, folder, name, length, modified of all files below a folder (names that begin with _ or . are left out, as Spark does); ``names`` is a glob.

    Spark lists the folders, many of them in a job; no content is read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = (reader.option("pathGlobFilter", names) if names else reader).load(root)
    return with_names(found.select("path", "length", F.col("modificationTime").alias("modified")))


def with_names(files: DataFrame) -> DataFrame:
    """Adds folder and name of a path."""
    return files.withColumns({"folder": F.regexp_extract("path", "^(.*)/[^/]*$", 1), "name": F.regexp_extract("path", "[^/]*$", 0)})


def fastq_pairs(files: DataFrame) -> DataFrame:
    """folder, n_r1, n_r2, r1, r2, found: the two FASTQ files of each folder of files (path, folder, name).

    ``found`` is Paired where there is exactly one of each, Multiple where there are several of one, else Missing; r1 and r2 are null unless Paired.
    A name that could be both is R1. Folders whose files are none of them are Missing.
    """
    fastq = F.col("name").rlike(FASTQ)
    first = fastq & F.col("name").rlike(mate(1))
    second = fastq & ~F.col("name").rlike(mate(1)) & F.col("name").rlike(mate(2))
    sides = {"1": first, "2": second}
    aggs = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"n_r{i}") for i, c in sides.items()] + [F.min(F.when(c, F.col("path"))).alias(f"r{i}") for i, c in sides.items()]
    out = files.groupBy("folder").agg(*aggs)
    paired = (F.col("n_r1") == 1) & (F.col("n_r2") == 1)
    state = F.when(paired, "Paired").when((F.col("n_r1") > 1) | (F.col("n_r2") > 1), "Multiple").otherwise("Missing")
    return out.withColumns({"found": state, "r1": F.when(paired, F.col("r1")), "r2": F.when(paired, F.col("r2"))})
