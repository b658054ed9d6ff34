"""Overlap joins of any mix of lengths against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import intervals


@pytest.mark.parametrize("lengths", [(1, 50), (1, 5_000_000), (60, 70), (513, 4097)])
def test_pairs_equal_a_plain_loop(spark, lengths):
    rng = random.Random(lengths[1])

    def some(n):
        out = []
        for i in range(n):
            a = rng.randint(0, 1_000_000)
            out.append((rng.choice(["1", "2", None]), a, a + int(lengths[0] * (lengths[1] / lengths[0]) ** rng.random()) - 1, i))
        return [*out, ("1", 5, 4, n), ("1", None, 4, n + 1), ("1", 64, 64, n + 2), ("1", 64, 127, n + 3), ("1", 0, 1 << 33, n + 4)]

    a, b = some(120), some(150)
    left = spark.createDataFrame(a, "chrom string, start long, end long, x long")
    right = spark.createDataFrame(b, "chrom string, start2 long, end2 long, y long")
    got = sorted((r["x"], r["y"]) for r in intervals.level_pairs(left, right, ("chrom",)).collect())
    want = sorted((p[3], q[3]) for p in a for q in b if p[0] == q[0] and None not in (p[1], q[1]) and p[1] <= p[2] and q[1] <= q[2] and p[1] <= q[2] and p[2] >= q[1])
    assert got == want
    assert {r["x"] for r in intervals.interval_join(left, right, "left_semi").collect()} == {x for x, _ in want}
    assert {r["x"] for r in intervals.interval_join(left, right, "left_anti").collect()} == {p[3] for p in a} - {x for x, _ in want}
    assert intervals.level_pairs(left, right.limit(0), ("chrom",)).count() == 0 == intervals.level_pairs(left.limit(0), right, ("chrom",)).count()


def test_a_few_long_intervals_do_not_gather_all_short_ones(spark):
    short = spark.range(20_000).select(F.lit("1").alias("chrom"), (F.col("id") * 25_000).alias("start"), (F.col("id") * 25_000 + 50).alias("end"))
    long = spark.range(10).select(F.lit("1").alias("chrom"), F.col("id").alias("start2"), (F.col("id") + 500_000_000).alias("end2"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    pairs = intervals.level_pairs(short, long, ("chrom",))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(jobs)  # nothing has run yet
    assert pairs.count() == 200_000
    crowd = intervals.in_levels(short, F.array(F.lit(8)), "start", "end").groupBy("_level", "_bin").count()
    assert crowd.agg(F.max("count")).first()[0] < 1500  # of 20,000
