"""Result tables by status, written in one pass with their counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PASS, FAILED, ALL = "Pass", "Failed", "All"
PART = "_table"


def table_names(main: str) -> dict[str, str]:
    """Names of the tables beside the main one (which holds what passed): all clusters, failed clusters, supporting reads."""
    stem = next((main.removesuffix(end) for end in (".clusters.tsv", ".tsv") if main.endswith(end)), main)
    return {PASS: main} | {kind: f"{stem}.{name}.tsv" for kind, name in ((ALL, "all_clusters"), (FAILED, "failed_clusters"), ("Members", "supporting_reads"))}


def write_tee(rows: DataFrame, folder: str, status: str = "status", counters: dict[str, Column] | None = None) -> dict[str, int]:
    """Writes rows once, in a part for each of Pass and Failed (every other status, null too), and returns their counters.

    The table of all rows is both parts read together, so nothing is computed or written twice. Counters (aggregates by name) are observed on the
    rows as they are written, in the tasks that write them; All, Pass and Failed are always among them.
    """
    if PART in [c.lower() for c in rows.columns]:
        raise ValueError(f"{PART} is a column of the rows")
    fine = F.coalesce(F.col(status) == PASS, F.lit(False))
    seen = Observation()
    wanted = {ALL: F.count(F.lit(1)), PASS: F.count_if(fine), FAILED: F.count_if(~fine)} | (counters or {})
    rows.observe(seen, *[v.alias(k) for k, v in wanted.items()]).withColumn(PART, F.when(fine, PASS).otherwise(FAILED)).write.partitionBy(PART).parquet(folder)
    return dict(seen.get)


def read_tee(spark: SparkSession, folder: str, schema: StructType, which: str = ALL) -> DataFrame:
    """One of the tables; a part that nothing was written to has no rows, and one that is not asked for is not read."""
    if which not in (ALL, PASS, FAILED):
        raise ValueError(which)
    found = spark.read.schema(StructType([*schema.fields]).add(PART, "string")).parquet(folder)
    return (found if which == ALL else found.filter(F.col(PART) == which)).drop(PART)
