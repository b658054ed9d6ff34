"""Overlaps read in packed windows: measures against plain loops, and what the plans shuffle."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.operators import candidates, evidence, intervals
from strandline.plans import queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def drawn(rng, n, lengths):
    starts = [rng.randint(-300, 3000) for _ in range(n)]
    return [(rng.choice(["a", "b", None]), rng.choice(["chr1", "1", "2", None]), s, s + rng.choice(lengths) - 1) for s in starts]


@pytest.mark.parametrize("lengths", [[1], [1, 40, 300], [7, 5000]])
def test_measures_equal_plain_loops(lengths):
    rng = random.Random(len(lengths))
    start2 = np.array([rng.randint(-200, 2000) for _ in range(120)])
    end2 = start2 + [rng.choice(lengths) - 1 for _ in start2]
    start = np.array([rng.randint(-400, 2300) for _ in range(300)])
    end = start + [rng.choice([1, 2, 50, 900]) - 1 for _ in start]
    common = np.array([[min(e, y) - max(s, x) + 1 for x, y in zip(start2, end2, strict=True)] for s, e in zip(start, end, strict=True)])
    assert intervals.best_bases(intervals.outer_of(start2, end2), start, end).tolist() == np.maximum(common.max(axis=1), 0).tolist()
    bases = {int(p) for x, y in zip(start2, end2, strict=True) for p in range(x, y + 1)}
    assert intervals.covered_bases(intervals.union_of(start2, end2), start, end).tolist() == [sum(p in bases for p in range(s, e + 1)) for s, e in zip(start, end, strict=True)]


def test_levels_equal_those_of_the_lists(spark):
    rng = random.Random(21)
    split = [(f"s{i}", *x) for i, x in enumerate(drawn(rng, 150, [1, 30, 65, 513, 2500]))]
    right = [(f"d{i}", *x) for i, x in enumerate(drawn(rng, 300, [1, 40, 300, 4000]))]
    left = spark.createDataFrame([*split, ("n", "a", "1", None, None)], "id string, sample string, chrom string, start long, end long")
    pairs = spark.createDataFrame(right, "did string, sample string, chrom string, start2 long, end2 long")
    depth = pairs.drop("did").filter("start2 % 3 > 0")
    same = ["id", "depth_bases", "depth_fraction", "depth_support", "disc_bases", "disc_fraction", "disc_support", "evidence_count", "evidence_level", "evidence_types"]
    key = lambda df: sorted(map(str, df.select(*same).collect()))
    levels = evidence.evidence_levels(left, depth, pairs, ("id",))
    assert key(levels) == key(evidence.merge_evidence(left, depth, pairs)) and levels.count() == 151
    assert evidence.evidence_levels(left, depth.limit(0), pairs.limit(0)).filter("depth_bases + disc_bases = 0").count() == 151


@pytest.mark.parametrize("name", ["level_counts", "given_level_counts"])
def test_counts_of_levels_make_no_lists(spark, name):
    text = plan(queries.QUERIES[name](spark, SF))
    assert "depth_range" not in text and "disc_ids" not in text


@pytest.mark.parametrize("name", ["depth_support", "discordant_support", "merge_evidence", "merge_given_evidence", "merged_candidates"])
def test_evidence_is_shuffled_packed_and_once(spark, name):
    text = physical(queries.QUERIES[name](spark, SF))
    moved = [x for x in text.split("\n") if "Exchange hashpartitioning" in x and "_near" in x]
    assert len(moved) == 1 and text.count("Exchange hashpartitioning") - text.lower().count("subquery") <= 1
    assert "SortMergeJoin" not in text  # no join by id, no pairs


@pytest.mark.parametrize("name", ["annotate", "annotated_candidates"])
def test_exons_are_read_with_the_evidence(spark, name):
    text = physical(queries.QUERIES[name](spark, SF))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "exon_detail" not in below and "SortMergeJoin" not in text


def test_packed_rows_are_few(spark):
    split = spark.range(40_000).selectExpr("'a' AS sample", "'chr1' AS _chrom", "id % 4000 AS start", "id % 4000 + id % 300 AS end", "id")
    windows, _ = intervals.to_windows(split, evidence.PLACE, 1024, {})
    rows = intervals.packed(windows.select("_window", "id", "start", "end").coalesce(1), 0, evidence.PLACE)
    assert rows.count() == 4
    assert rows.agg(F.sum(F.length("_data"))).first()[0] < 8 * 40_000


def test_exons_of_all_samples(spark):
    """Exons have no sample: each sample of a window meets them, and texts of chromosomes may hold anything."""
    rng = random.Random(5)
    names = ["1", "chr1", 'a"b\\c', "ü", None]
    split = [(f"s{i}", rng.choice(["a", "b", None]), rng.choice(names), s, s + rng.choice([5, 90, 700])) for i in range(80) for s in [rng.randint(0, 3000)]]
    exons = [(f"G{i % 7}", f"T{i % 5}", i, rng.choice(names), s, s + rng.choice([10, 60])) for i in range(90) for s in [rng.randint(0, 3000)]]
    left = spark.createDataFrame(split, "id string, sample string, chrom string, start long, end long")
    pairs = spark.createDataFrame([(f"d{i}", x[1], x[2], x[3], x[4] + 9) for i, x in enumerate(split)], "did string, sample string, chrom string, start2 long, end2 long")
    known = spark.createDataFrame(exons, "gene string, transcript string, exon long, chrom string, start2 long, end2 long")
    together = {r["id"]: r for r in evidence.merge_evidence(left, pairs.drop("did"), pairs, exons=known).collect()}
    alone = {r["id"]: r for r in evidence.annotate(left, known).collect()}
    assert len(together) == len(alone) == 80 and sum(r["n_exons"] for r in alone.values()) > 80
    for i, r in alone.items():
        assert [r[c] for c in evidence.ANNOTATION] == [together[i][c] for c in evidence.ANNOTATION] and together[i]["disc_support"]
    table = {r["Cluster_ID"]: r["annotation"] for r in candidates.merged_table(left, pairs.drop("did"), pairs, exons=known).collect()}
    assert all(table[i]["exon_detail"] == r["exon_detail"] and table[i]["gene"] == r["gene"] for i, r in alone.items())


def test_lists_of_a_window_equal_plain_loops():
    rng = random.Random(9)
    for _ in range(40):
        items = [(s, s + rng.choice([1, 40, 300]) - 1, f"D{rng.randint(0, 30)}") for s in [rng.randint(0, 900) for _ in range(rng.randint(1, 40))]]
        table = pa.table({"did": [d for *_, d in items], "start2": [s for s, *_ in items], "end2": [e for _, e, _ in items]})
        near = {n: evidence.prepare(n, table) for n in ("_depth", "_pairs")}
        spans = [(s, s + rng.choice([1, 60, 250]) - 1) for s in [rng.randint(-200, 1200) for _ in range(25)]]
        start, end = (np.array(x) for x in zip(*spans, strict=True))
        (_, records, texts), (_, hits, ids) = evidence.read_depth(start, end, near), evidence.read_pairs(start, end, near, 0.9)
        met = [[(a, b, d) for a, b, d in items if a <= e and b >= s] for s, e in spans]
        good = [[d for a, b, d in x if (min(e, b) - max(s, a) + 1) / (e - s + 1) >= 0.9] for x, (s, e) in zip(met, spans, strict=True)]
        assert texts.to_pylist() == [",".join(f"{a}-{b}" for a, b in sorted({y[:2] for y in x})) or None for x in met]
        assert (records.tolist(), hits.tolist()) == ([len(x) for x in met], [len(x) for x in good])
        assert ids.to_pylist() == [",".join(sorted(set(x))) or None for x in good]
