"""Exact quantiles, the tables of merged and annotated candidates, and exact decimal text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions.genome import fixed_exact
from strandline.operators import candidates
from strandline.operators.quantiles import decoded, exact_quantiles, ordered_code

SPLIT = "id string, sample string, chrom string, start long, end long, status string, gene string"
DEPTH = "sample string, chrom string, start2 long, end2 long, svtype string, depth_id string, line long"
PAIRS = "did string, sample string, chrom string, start2 long, end2 long, status string, discordant_reads string, median_insert string"


def test_fixed_exact_is_c_rounding(spark):
    rng = random.Random(3)
    xs = [a / b for b in (1, 3, 16, 32, 160, 200, 640, 2000, 3200) for a in range(0, b + 1, max(1, b // 40))] + [rng.random() for _ in range(500)] + [0.00005, 0.12345, 12.00015, 7.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", *[fixed_exact(F.col("x"), d).alias(f"d{d}") for d in (1, 3, 4)])
    for r in df.collect():
        assert [r["d1"], r["d3"], r["d4"]] == ["%.1f" % r["x"], "%.3f" % r["x"], "%.4f" % r["x"]]


def test_codes_keep_order_and_values(spark):
    rng = random.Random(5)
    xs = [0.0, 5e-324, 1e-310, 2.0**-1022, 2.2250738585072011e-308, 1.0, 1.7976931348623157e308, float("inf"), 0.1, 1 / 3]
    xs += [2.0**k for k in range(-1074, 1024, 7)] + [float(np.nextafter(2.0**k, 0)) for k in range(-1000, 1024, 11)] + [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)]
    xs = sorted(set(xs) | {-x for x in xs})
    df = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("code", ordered_code(F.col("x"), "double"))
    got = df.withColumn("back", decoded(F.col("code"), "double")).orderBy("code").collect()
    assert [r["x"] for r in got] == xs == [r["back"] for r in got]
    assert len({r["code"] for r in got}) == len(xs)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "double"])
def test_quantiles_equal_percentile(spark, kind):
    rng = random.Random(7)
    big = {"tinyint": 100, "smallint": 30000, "int": 2**31 - 1, "bigint": 2**50}.get(kind, 1e6)
    number = (lambda: rng.uniform(-big, big)) if kind in ("float", "double") else (lambda: rng.randint(-int(big), int(big)))
    rows = [("a", number()) for _ in range(400)] + [(None, number()) for _ in range(7)] + [("one", number()), ("none", None), ("b", None)]
    rows += [("b", rng.choice([number(), 5, 5, 5])) for _ in range(301)]
    df = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in rows], "k string, v double").withColumn("v", F.col("v").cast(kind))
    wanted = {"lowest": 0.0, "q1": 0.25, "mid": 0.5, "p995": 0.995, "highest": 1.0}
    plain = df.filter("v is not null").groupBy("k").agg(F.count("*").alias("n"), *[F.percentile("v", F.lit(f)).alias(n) for n, f in wanted.items()])
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert key(exact_quantiles(df, ["k"], "v", wanted)) == key(plain)
    assert exact_quantiles(df.filter("false"), ["k"], "v", wanted).count() == 0
    assert exact_quantiles(df, [], "v", {"mid": 0.5}).collect()[0]["mid"] == df.agg(F.median("v")).first()[0]


def test_quantiles_keep_no_map_of_values(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 200_000 / 3).alias("v"))
    q = exact_quantiles(df, ["k"], "v", {"mid": 0.5})
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "median" not in plan
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, df.groupBy("k").agg(F.count("*").alias("n"), F.median("v")).collect()))
    with pytest.raises(ValueError):
        exact_quantiles(df, ["k"], "v", {"x": 1.5})
    with pytest.raises(ValueError):
        exact_quantiles(df.select("k", F.lit("a").alias("v")), ["k"], "v", {"x": 0.5})


def test_merged_table_of_full_and_thin_support(spark):
    split = spark.createDataFrame([("x", "S", "chr18", 34241309, 34232240, "PASS", "D"), ("y", "S", "chr1", 237566146, 237566204, None, "NA"), ("y", "S", "chr1", 237566146, 237566204, "NA", "R"), ("z", "S", "chr1", 5, 9, "Failed", "R"), ("n", None, None, 10, 19, None, None)], SPLIT)
    depth = spark.createDataFrame([("S", "18", 34234329, 34241312, "DEL", "NA", 7), ("S", "chr18", 34232240, 34234323, "DEL", "W1", 8), ("S", "1", 237566170, 237566204, None, "W2", 9), ("S", "1", 237566146, 237566204, "DUP", "W3", 10), (None, None, 10, 18, None, None, None)], DEPTH)
    pairs = spark.createDataFrame([("D1", "S", "chr18", 34232199, 34241334, "Pass", "12", "9383.00"), ("D1", "S", "chr18", 34232199, 34241335, None, "12", "9383.00"), ("D2", "S", "chr18", 34232199, 34241334, "LowSupport", "5", "1.0"), ("D3", "S", "18", 34232198, 34241334, "NA", "many", "NA")], PAIRS)
    rows = candidates.merged_table(split, depth, pairs).collect()
    assert len(rows) == 4 and len(rows[0]) == 32
    got = {(r["Cluster_ID"], r["Gene"]): r.asDict() for r in rows}
    x = got["x", "D"]
    assert (x["Split_Start"], x["Split_Size"], x["Depth_Covered_Bases"], x["Depth_Coverage_Fraction"], x["Evidence_Level"]) == (34232240, 9070, 9065, "0.9994", "High")
    assert x["Depth_Range"] == "chr18:34232240-34234323,18:34234329-34241312" and x["Discordant_Record_Count"] == 3
    assert (x["Discordant_Cluster_IDs"], x["Discordant_Reads"], x["Median_Insert_Size"]) == ("D3,D1", 12.0, "9383.00")
    assert x["Source_Records"].split(",")[:3] == ["Split:x:chr18:34232240-34241309", "Depth:W1:chr18:34232240-34234323", "Depth:Depth_7:18:34234329-34241312"]
    y = got["y", None]
    assert (y["Depth_Covered_Bases"], y["Depth_Coverage_Fraction"], y["Evidence_Level"], y["Depth_Record_Count"], y["Discordant_Range"], y["Discordant_Reads"]) == (35, "0.5932", "Low", 1, None, None)
    assert {k: v for k, v in got["y", "R"].items() if k != "Gene"} == {k: v for k, v in y.items() if k != "Gene"}
    n = got["n", None]
    assert (n["Depth_Covered_Bases"], n["Depth_Coverage_Fraction"], n["Evidence_Level"], n["Source_Records"]) == (9, "0.9000", "Moderate", "Split:n:NA:10-19,Depth:Depth:NA:10-18")
    few = candidates.merged_table(split.drop("status", "gene"), depth.drop("svtype", "depth_id", "line"), pairs.drop("status", "discordant_reads", "median_insert"))
    assert few.count() == 5 and len(few.columns) == 32
    for i in range(3):
        tables = [t.filter("false") if i == k else t for k, t in enumerate((split, depth, pairs))]
        assert candidates.merged_table(*tables).count() == (0 if i == 0 else 4)


def test_annotated_table_infers_support_from_older_columns(spark):
    exons = spark.createDataFrame([("A", "NM_1", 1, "chr1", 100, 199), ("A", "NM_1", 2, "chr1", 300, 399), ("B", "NM_2", 1, "1", 300, 399)], "gene string, transcript string, exon long, chrom string, start2 long, end2 long")
    rows = spark.createDataFrame(
        [("S", "1", "NA", "NA", "380", "120", None, "4", "Split, depth", "0"), ("S", "chr1", "200", "210", "1", "2", "C1", "0", None, "3"), ("S", "chrX", "1", "5", "NA", "NA", None, "NA", None, None)],
        "SampleID string, Chrom string, Best_Start string, Best_End string, Core_Start string, Core_End string, Cluster_ID string, Support_Reads string, Evidence_Types string, Discordant_Reads string",
    )
    got = {r["Start"]: r for r in candidates.annotated_table(rows, exons).collect()}
    a, b, c = got[120], got[200], got[1]
    assert a.__fields__ == candidates.ANNOTATED and len(a) == 43
    assert (a["End"], a["Coordinate_Source"], a["Candidate_Region"], a["Split_Read_Support"], a["Depth_Support"], a["Discordant_Read_Support"]) == (380, "Core", "1:120-380", "Yes", "Yes", "No")
    assert (a["Annotated_Gene"], a["Annotated_Transcript"], a["Affected_Exons"], a["Overlap_Exon_Count"], a["Fully_Covered_Exons"]) == ("A", "NM_1", "A|NM_1|EX1,A|NM_1|EX2,B|NM_2|EX1", 3, None)
    assert (b["Coordinate_Source"], b["Split_Read_Support"], b["Depth_Support"], b["Discordant_Read_Support"], b["Exon_Overlap_Detail"]) == ("Best", "Yes", "No", "Yes", "No exon overlapped")
    assert (c["Split_Read_Support"], c["Annotation_Status"], c["Exon_Overlap_Detail"]) == ("No", "Not_annotated", "No exon annotation on chromosome chrX")
