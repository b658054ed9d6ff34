"""Lists of overlaps made in windows, and the best overlap by blocks."""

import random

from strandline.operators import evidence
from strandline.operators.intervals import best_overlaps, to_windows


def intervals(rng, n, lengths):
    starts = [rng.randint(-300, 3000) for _ in range(n)]
    return [(rng.choice(["a", "b", None]), rng.choice(["chr1", "1", "2", None]), s, s + rng.choice(lengths) - 1) for s in starts]


def norm(chrom):
    return chrom and chrom.removeprefix("chr")


def test_lists_equal_all_pairs_whatever_the_lengths(spark):
    rng = random.Random(11)
    split = [(f"s{i}", *x) for i, x in enumerate(intervals(rng, 120, [1, 30, 64, 65, 513, 2500]))]
    right = [(f"d{i % 150}", *x) for i, x in enumerate(intervals(rng, 300, [1, 40, 300, 4000]))]
    left = spark.createDataFrame(split, "id string, sample string, chrom string, start long, end long")
    pairs = spark.createDataFrame(right, "did string, sample string, chrom string, start2 long, end2 long")
    got = {r["id"]: r for r in evidence.merge_evidence(left, pairs.drop("did"), pairs).collect()}
    assert len(got) == len(split)
    for i, sample, chrom, s, e in split:
        near = [(d, a, b) for d, m, c, a, b in right if m == sample and norm(c) == norm(chrom) and a <= e and b >= s]
        share = [(d, min(e, b) - max(s, a) + 1) for d, a, b in near]
        good = [d for d, o in share if o / (e - s + 1) >= 0.9]
        r = got[i]
        assert r["depth_records"] == len(near) and r["depth_range"] == (",".join(f"{a}-{b}" for a, b in sorted({x[1:] for x in near})) or None)
        assert r["disc_bases"] == max([o for _, o in share], default=0) and r["disc_records"] == len(good)
        assert r["disc_ids"] == (",".join(sorted(set(good))) or None) and r["disc_support"] == bool(good)


def test_best_overlap_by_blocks(spark):
    rng = random.Random(12)
    a = [(i, "x", s, s + rng.choice([0, 5, 100, 900])) for i in range(150) for s in [rng.randint(0, 2000)]]
    b = [("x", s, s + rng.choice([0, 3, 60, 200, 3000 if i == 7 else 40])) for i in range(400) for s in [rng.randint(0, 1500)]]
    got = best_overlaps(spark.createDataFrame(a, "id long, k string, start long, end long"), spark.createDataFrame(b, "k string, start2 long, end2 long"), "id", ("k",))
    want = {i: max(min(e, y) - max(s, x) + 1 for _, x, y in b) for i, _, s, e in a}
    assert {r["id"]: r["best"] for r in got.collect()} == {i: n for i, n in want.items() if n > 0}


def test_rows_with_lists_are_not_shuffled(spark):
    split = spark.createDataFrame([("s", "a", "1", 1, 9)], "id string, sample string, chrom string, start long, end long")
    pairs = spark.createDataFrame([("d", "a", "1", 1, 9)], "did string, sample string, chrom string, start2 long, end2 long")
    plan = evidence.merge_evidence(split, pairs.drop("did"), pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")  # nothing is exchanged after the lists are made


def test_evidence_is_dealt_to_few_windows(spark):
    split = spark.range(2000).selectExpr("'a' AS sample", "'chr1' AS _chrom", "id * 10 AS start", "id * 10 + id % 400 AS end")
    pairs = spark.range(2000).selectExpr("'a' AS sample", "'chr1' AS _chrom", "id * 10 AS start2", "id * 10 + id % 500 AS end2")
    _, dealt = to_windows(split, evidence.PLACE, evidence.list_width(split, pairs), {"x": pairs})
    assert dealt["x"].count() < 2 * 2000
