import os
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import genome as G
from strandline.operators import depth as D
from strandline.operators import evidence, intervals, reads, regions
from strandline.plans.queries import QUERIES, SQL
from strandline.plans.views import view
from strandline.sources import tables
from tests.oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    same(spark, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_cigar(spark):
    df = spark.createDataFrame([("10S50M5D20M2I30=",), ("*",), ("",)], "c string")
    assert [r[0] for r in df.select(G.cigar_ref_length(F.col("c"))).collect()] == [105, 0, 0]


def test_window_laws(spark):
    genes = spark.createDataFrame([("a", 1, 1206), ("b", 1, 16330), ("c", 1, 150)], "gene string, start long, end long")
    n = {r["gene"]: r["count"] for r in D.sliding_windows(genes, 500, 200, 200).groupBy("gene").count().collect()}
    assert n == {"a": 6, "b": 81}


def test_union_coverage_and_levels(spark):
    split = spark.createDataFrame([("x", "S", "18", 34232240, 34241309), ("y", "S", "1", 237566146, 237566204)], "id string, sample string, chrom string, start long, end long")
    depth = spark.createDataFrame([("S", "18", 34232240, 34234323), ("S", "18", 34234329, 34241312), ("S", "1", 237566170, 237566204)], "sample string, chrom string, start2 long, end2 long")
    disc = spark.createDataFrame([("D1", "S", "18", 34232199, 34241334)], "did string, sample string, chrom string, start2 long, end2 long")
    got = {r["id"]: r for r in evidence.merge_evidence(split, depth, disc).collect()}
    assert (got["x"]["depth_bases"], round(got["x"]["depth_fraction"], 4), got["x"]["evidence_level"]) == (9065, 0.9994, "High")
    assert (got["y"]["depth_bases"], round(got["y"]["depth_fraction"], 4), got["y"]["evidence_level"]) == (35, 0.5932, "Low")


def test_binned_join_equals_plain_join(spark):
    rng = random.Random(4)
    a = spark.createDataFrame([("c", s, s + rng.randint(0, 300)) for s in (rng.randint(1, 5000) for _ in range(200))], "chrom string, start long, end long")
    b = spark.createDataFrame([("c", s, s + rng.randint(0, 300)) for s in (rng.randint(1, 5000) for _ in range(200))], "chrom string, start2 long, end2 long")
    key = lambda df: sorted(map(tuple, df.select("start", "end", "start2", "end2").collect()))
    assert key(intervals.interval_join(a, b)) == key(intervals.interval_join(a, b, bin_size=128))


def test_adjacent_intervals_merge_and_class_rank(spark):
    iv = spark.createDataFrame([("c", 1, 10), ("c", 11, 20), ("c", 22, 30)], "chrom string, start long, end long")
    assert sorted(map(tuple, intervals.merge_intervals(iv, ["chrom"]).collect())) == [("c", 1, 20), ("c", 22, 30)]
    core = spark.createDataFrame([("A", "Limited", 1), ("A", "Strong", 2), ("B", "NA", 3)], "gene string, class string, line long")
    assert {r["gene"]: r["class"] for r in regions.best_class(core).collect()} == {"A": "Strong", "B": "NA"}


def test_robust_threshold(spark):
    rows = spark.createDataFrame([("S", t) for t in [231, 231, 271, 311, 311]], "sample string, tlen long")
    r = reads.tlen_stats(rows).first()
    assert (r["median"], r["mad"], round(r["threshold"], 3)) == (271, 40, 448.912)


def test_tsv_round_trip_and_header_only(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", None, 1), ("c", "x", 2)], "p string, q string, n long")
    tables.write_tsv(df, str(tmp_path / "t"))
    assert [tuple(r) for r in tables.read_tsv(spark, str(tmp_path / "t"), required=["p"]).orderBy("n").collect()] == [("a b", None, "1"), ("c", "x", "2")]
    tables.write_tsv(df.filter("n > 5"), str(tmp_path / "e"))
    text = "".join((tmp_path / "e" / f).read_text() for f in os.listdir(tmp_path / "e") if f.startswith("part"))
    assert text == "p\tq\tn\n"


def test_settings_and_samples():
    assert tables.parse_settings("A=1\n# no\nB = 'x y' # note\nA=2\nnonsense") == {"A": "2", "B": "x y"}
    with pytest.raises(ValueError):
        tables.parse_samples("a\tp\na\tq")


def test_views_read_whole_tables(spark):
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("lineitem", "part")}
    got = {v: view(spark, SF, v).count() for v in ("v_depth_iv", "v_disc_iv", "v_gtf", "v_mane")}
    assert got == {"v_depth_iv": n["lineitem"], "v_disc_iv": n["lineitem"], "v_gtf": n["lineitem"], "v_mane": n["part"]}
    assert 0 < QUERIES["unmatched"](spark, SF).count() < n["part"]


def test_merge_drops_failed_evidence_turns_intervals_and_normalises_names(spark):
    split = spark.createDataFrame([("a", "S", "chr1", 200, 100, "PASS"), ("b", "S", "1", 100, 200, "Low_support"), ("c", "S", "MT", 100, 200, None), ("d", "S", "2", 100, 200, "NA")], "id string, sample string, chrom string, start long, end long, status string")
    depth = spark.createDataFrame([("S", "1", 210, 90, "DEL"), ("S", "chrM", 90, 210, "DUP"), ("S", "chr2", 90, 210, None)], "sample string, chrom string, start2 long, end2 long, svtype string")
    disc = spark.createDataFrame([("D1", "S", "1", 90, 210, "Low_support"), ("D2", "S", "chrM", 90, 210, "Pass"), ("D3", "S", "chr2", 210, 90, "NA")], "did string, sample string, chrom string, start2 long, end2 long, status string")
    got = {r["id"]: (r["start"], r["end"], r["evidence_types"]) for r in evidence.merge_evidence(split, depth, disc).collect()}
    assert got == {"a": (100, 200, "Split,Depth"), "c": (100, 200, "Split,Discordant"), "d": (100, 200, "Split,Depth,Discordant")}
    exons = spark.createDataFrame([("G", "T", 1, "1", 110, 150)], "gene string, transcript string, exon long, chrom string, start2 long, end2 long")
    assert [r["gene"] for r in evidence.annotate(split.filter("id = 'b'").withColumn("chrom", F.lit("chr1")), exons).collect()] == ["G"]
