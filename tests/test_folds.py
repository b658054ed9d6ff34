"""Folds in ranges against plain loops over whole keys."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from strandline.operators import folds


def slow_clusters(events, window):
    out, a, b, n = [], [], [], 0
    half_up = lambda x: int(statistics.median(x) + 0.5)
    for s, e in events:
        if not a or abs(s - half_up(a)) > window or abs(e - half_up(b)) > window:
            n, a, b = n + 1, [], []
        a.append(s)
        b.append(e)
        out.append(n)
    return out


def slow_cusum(ratios, k, h, edge, recover, recover_bins):
    """(first bin, last bin, largest sum) of each event; the sum starts anew after an event closes."""
    events, s, candidate, inside, quiet, begin, top = [], 0.0, None, False, 0, 0, 0.0
    for i, ratio in enumerate(ratios):
        gain = 1 - ratio - k
        if not inside and s == 0 and gain > 0:
            candidate = i
        s = max(0.0, s + gain)
        if not inside and s >= h:
            first = i if candidate is None else candidate
            begin = next((j for j in range(first, i + 1) if ratios[j] <= edge), first)
            inside, top, quiet = True, s, 0
        if inside:
            top = max(top, s)
            quiet = quiet + 1 if ratio >= recover else 0
            if quiet >= recover_bins:
                events.append((begin, i - quiet, top))
                s, candidate, inside, quiet = 0.0, None, False, 0
        if not inside and s == 0:
            candidate = None
    if inside:
        events.append((begin, len(ratios) - 1, top))
    return [e for e in events if e[1] >= e[0]]


def clusters_of(spark, rows, window, ranges):
    df = spark.createDataFrame(rows, "sample string, chrom string, sv_start long, sv_end long, qname string")
    got = folds.greedy_clusters(df, ["sample", "chrom"], ["qname"], window, "X", ranges=ranges).collect()
    assert len(got) == len(rows)
    return {tuple(r)[:5]: int(r["cluster_id"][2:]) for r in got}


def expected(rows, window):
    null_first = lambda x: [(v is not None, v) for v in x]
    out, n = {}, 0
    for key in sorted({r[:2] for r in rows}, key=null_first):
        own = sorted(r for r in rows if r[:2] == key)
        labels = slow_clusters([r[2:4] for r in own], window)
        out |= {r: n + x for r, x in zip(own, labels, strict=True)}
        n += labels[-1]
    return out


@pytest.mark.parametrize("ranges,span,window", [(1, 40, 20), (5, 900, 20), (24, 900, 20), (5, 40, 20), (24, 30, 3), (9, 1, 5)])
def test_clusters_equal_a_plain_loop(spark, ranges, span, window):
    rng = random.Random(span)
    rows = [("S", "chr1", s, s + rng.randint(5, 60), f"{i:04d}") for i, s in enumerate(rng.randint(1, span) for _ in range(400))]
    rows += [(None, "chr1", 5, 9, "a"), (None, "chr1", 5, 9, "b"), ("S", None, 5, 9, "a"), (None, None, 5, 9, "a"), ("T", "chr1", 5, 9, "a"), ("T", "chr1", 500, 509, "a")]
    assert clusters_of(spark, rows, window, ranges) == expected(rows, window)


def test_clusters_that_drift_never_meet_their_guess_early(spark):
    rows = [("S", "1", i // 3, i // 3 + 50, f"{i:05d}") for i in range(600)]  # one dense run: the guess of a range is shifted
    for ranges in (4, 9):
        assert clusters_of(spark, rows, 25, ranges) == expected(rows, 25)


def test_moving_median_splits_what_single_linkage_joins(spark):
    rows = [("S", "1", x, 204, f"{i}") for i, x in enumerate([141, 146, 146, 162, 167, 179])]
    assert sorted(clusters_of(spark, rows, 20, 3).values()) == [1, 1, 1, 1, 2, 2]
    assert folds.greedy_clusters(spark.createDataFrame([], "sample string, chrom string, sv_start long, sv_end long, qname string"), ["sample", "chrom"], ["qname"], 20, "X").count() == 0


def test_running_median():
    rng = random.Random(1)
    for spread in (1, 4, 1000):
        m, seen = folds.Median(), []
        for _ in range(300):
            x = rng.randint(1, spread)
            m.add(x)
            seen.append(x)
            assert m.value() == int(statistics.median(seen) + 0.5)
            m = folds.Median(*m.dump())


def test_cusum_resets_and_trims(spark):
    ratios = [1.0] * 10 + [0.2] * 20 + [1.0] * 10 + [0.1] * 20
    assert [(a, b) for a, b, _ in slow_cusum(ratios, 0.1, 5, 0.8, 0.8, 3)] == [(10, 29), (40, 59)]


@pytest.mark.parametrize("ranges,calm", [(1, 0.5), (7, 0.9), (7, 0.0), (24, 0.5), (24, 0.0)])
def test_cusum_events_equal_a_plain_loop(spark, ranges, calm):
    rng = random.Random(int(calm * 10))
    rows, want = [], []
    for key, n in (("a", 700), ("b", 90), (None, 60), ("c", 1)):
        low, depth = False, []
        for _ in range(n):
            low = rng.random() < (0.95 if low else 0.1 * (1 - calm))
            depth.append(rng.choice([2, 5, 8, 9]) if low or rng.random() > calm else 10)
        rows += [(key, 2 * i + 1, 2 * i + 2, float(x), 10.0) for i, x in enumerate(depth)]
        ratio = [(x + 0.1) / 10.1 for x in depth]
        for a, b, top in slow_cusum(ratio, 0.1, 1.0, 0.8, 0.8, 3):
            own = ratio[a : b + 1]
            want.append((key, 2 * a + 1, 2 * b + 2, b - a + 1, round(sum(depth[a : b + 1]) / len(own), 9), round(min(own), 9), round(top, 9)))
    df = spark.createDataFrame(rows, "gene string, start long, end long, depth double, baseline double")
    got = folds.cusum_events(df, ["gene"], h=1.0, del_ratio=9.0, min_bins=1, ranges=ranges).collect()
    got = [(r["gene"], r["start"], r["end"], r["n_bins"], round(r["mean_depth"], 9), round(r["min_ratio"], 9), round(r["max_cusum"], 9)) for r in got]
    assert sorted(got, key=str) == sorted(want, key=str) and want


def test_bins_without_depth_are_none(spark):
    df = spark.createDataFrame([("a", 1, 2, None, 1.0), ("a", None, 2, 1.0, 1.0), ("a", 3, 4, 1.0, None)], "gene string, start long, end long, depth double, baseline double")
    assert folds.cusum_events(df, ["gene"]).count() == 0 and folds.cusum_events(df.limit(0), ["gene"]).count() == 0


def test_one_dense_key_runs_in_many_tasks(spark):
    df = spark.range(60_000).select(F.lit("S").alias("sample"), F.lit("1").alias("chrom"), (F.col("id") * 7919 % 5000).alias("sv_start"), (F.col("id") * 7919 % 5000 + 40).alias("sv_end"), F.col("id").alias("qname"))
    got = folds.greedy_clusters(df, ["sample", "chrom"], ["qname"], 15, "X", ranges=16)
    labels = [int(r["cluster_id"][2:]) for r in got.orderBy("sv_start", "sv_end", "qname").collect()]
    events = sorted((i * 7919 % 5000, i * 7919 % 5000 + 40, i) for i in range(60_000))
    chunked, state, fold, n = [], folds.Greedy(15).start(), folds.Greedy(15), 0
    for a, b, _ in events:
        n += fold.step(state, a, b)
        chunked.append(n)
    assert labels == chunked
