"""Tables by status in one pass, listing of files and FASTQ pairs."""

import pytest
from pyspark.sql import functions as F

from strandline.sources import listing, tee


def test_names_beside_the_main_table():
    assert tee.table_names("a/x.clusters.tsv") == {"Pass": "a/x.clusters.tsv", "All": "a/x.all_clusters.tsv", "Failed": "a/x.failed_clusters.tsv", "Members": "a/x.supporting_reads.tsv"}
    assert tee.table_names("x.tsv")["All"] == "x.all_clusters.tsv" and tee.table_names("x")["Failed"] == "x.failed_clusters.tsv"


def test_tee_writes_once_and_counts(spark, tmp_path):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "Pass").otherwise("LowSupport").alias("status"))
    folder = str(tmp_path / "t")
    counts = tee.write_tee(rows, folder, counters={"total": F.sum("id")})
    n = len([i for i in range(1000) if i % 10 and i % 3 == 0])
    assert counts == {"All": 1000, "Pass": n, "Failed": 1000 - n, "total": 499500}
    read = lambda which: sorted(map(tuple, tee.read_tee(spark, folder, rows.schema, which).collect()))
    assert read("All") == sorted(map(tuple, rows.collect()))
    assert read("Pass") == [(i, "Pass") for i in range(1000) if i % 10 and i % 3 == 0] and len(read("Failed")) == 1000 - n
    files = tee.read_tee(spark, folder, rows.schema, "Pass").inputFiles()
    plan = tee.read_tee(spark, folder, rows.schema, "Pass")._jdf.queryExecution().executedPlan().toString()
    assert files and "PartitionFilters: [isnotnull(_table" in plan
    with pytest.raises(ValueError):
        tee.read_tee(spark, folder, rows.schema, "Some")
    with pytest.raises(ValueError):
        tee.write_tee(rows.withColumn("_Table", F.lit(1)), str(tmp_path / "u"))


def test_tee_of_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([], "id long, status string")
    assert tee.write_tee(rows, str(tmp_path / "e")) == {"All": 0, "Pass": 0, "Failed": 0}
    assert tee.read_tee(spark, str(tmp_path / "e"), rows.schema, "Failed").count() == 0


def test_fastq_pairs_of_listed_files(spark, tmp_path):
    names = ["A/a_R1.fastq.gz", "A/a_R2.fastq.gz", "A/notes.txt", "B/b.1.fq", "B/c-1.FQ", "B/b.2.fq", "C/R1.fastq", "D/readme_1.md", "E/deep/x_r1_y.fastq", "E/deep/x_2.fastq", "F/S12.fastq", "F/1_2.fastq"]
    for x in names:
        (tmp_path / x).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / x).write_text("@")
    files = listing.list_files(spark, str(tmp_path))
    assert "content" not in files.columns and files.count() == len(names) and files.agg(F.sum("length")).first()[0] == len(names)
    got = {r["folder"].split(str(tmp_path))[1]: r for r in listing.fastq_pairs(files).collect()}
    assert {k: (r["found"], r["n_r1"], r["n_r2"]) for k, r in got.items()} == {"/A": ("Paired", 1, 1), "/B": ("Multiple", 2, 1), "/C": ("Missing", 1, 0), "/D": ("Missing", 0, 0), "/E/deep": ("Paired", 1, 1), "/F": ("Missing", 1, 0)}
    assert got["/A"]["r1"].endswith("a_R1.fastq.gz") and got["/B"]["r1"] is None
    assert listing.list_files(spark, str(tmp_path), "*.fq").count() == 2
