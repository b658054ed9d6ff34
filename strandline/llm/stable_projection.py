"""Approximate nearest neighbours by stable projections in a kd-tree.

For the largest inner product, vectors get one more component that makes all norms equal, so that
the nearest in Euclidean distance is the largest in inner product. Gaussian (2-stable) projections to
``dims`` numbers keep distances up to a chi-square factor: |projected|^2 / |true|^2 is chi-square with ``dims``
degrees of freedom. A kd-tree over the projected points is searched in order of growing projected
distance; what is met is verified by exact inner products, and the search stops once a point that is as near as
the k-th found would, by the chi-square test with confidence ``sure``, have been met.

Scale: equal vectors are one point with their smallest ids (no more of them can be in a result). Points are dealt to
cells by a tree of cuts fitted on at most ``sample`` rows (a documented bound; every row is indexed); each cell is one task of bounded size
(cells of crowded places are split by hash) with a kd-tree of its own. Queries first search their own cell, which bounds their k-th distance,
and then only those cells that the same test does not rule out. Query rows are dealt in
blocks. No pair of a query and a row leaves a task, only each cell's best.

Edge cases: vectors that are null, zero, or hold a null or a non-finite component take no part; neither do
those of another length than the most common one. Ties go to the smaller id. Fewer candidates than k: all. Repeated
ids count as rows. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import stash

BEST = "q long, score double, id long"


def chi_square_quantile(p: float, dims: int) -> float:
    """Inverse of the chi-square distribution function, by bisection on its series."""

    def cdf(x: float) -> float:
        a, x = dims / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0

    lo, hi = 0.0, 10.0 * dims + 200
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


class Tree:
    """A kd-tree of leaves with the bounding boxes of their projected points."""

    def __init__(self, points: np.ndarray, leaf: int = 64):
        groups, self.leaves = [np.arange(len(points))], []
        while groups:
            own = groups.pop()
            spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(1)
            if len(own) <= leaf or spread.max() == 0:
                self.leaves.append(own)
                continue
            order = own[np.argsort(points[own, int(spread.argmax())], kind="stable")]
            groups += [order[: len(own) // 2], order[len(own) // 2 :]]
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance from each query to each leaf's box."""
        out = np.zeros((len(q), len(self.leaves)))
        for d in range(q.shape[1]):
            gap = np.maximum(np.maximum(self.low[None, :, d] - q[:, d : d + 1], q[:, d : d + 1] - self.high[None, :, d]), 0)
            out += gap * gap
        return out


def search(vectors, ids, tree, radius2, queries, projected, known, k, limit):
    """The k best (scores, ids) of each query among the vectors; known: squared distances that bound the k-th.

    Leaves are visited in the order of their projected distance. ``limit`` is the chi-square quantile.
    """
    n = len(queries)
    scores, names = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
    near = tree.distances(projected)
    order = np.argsort(near, axis=1, kind="stable")
    norms = (queries * queries).sum(axis=1)
    alive = np.arange(n)
    for turn in range(len(tree.leaves)):
        leaf = order[alive, turn]
        kth = np.minimum(known[alive], np.maximum(norms[alive] + radius2 - 2 * scores[alive, -1], 0))
        go = near[alive, leaf] <= limit * kth
        alive, leaf = alive[go], leaf[go]
        if not len(alive):
            break
        by_leaf = np.argsort(leaf, kind="stable")
        for part in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            rows, own = alive[part], tree.leaves[leaf[part[0]]]
            s = np.concatenate([scores[rows], queries[rows] @ vectors[own].T], axis=1)
            i = np.concatenate([names[rows], np.broadcast_to(ids[own], (len(rows), len(own)))], axis=1)
            top = np.lexsort((i, -s), axis=1)[:, :k]
            scores[rows], names[rows] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
    return scores, names


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding as array<double>) of the vectors that take part."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select("vec_id", v.cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def nearest(rows: DataFrame, is_query, k: int = 20, dims: int = 8, sure: float = 0.99, cell_rows: int = 16384, sample: int = 20000, seed: int = 5) -> DataFrame:
    """rows (vec_id, embedding); is_query a predicate Column -> query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    good = stash(usable(rows).withColumn("v", F.xxhash64("embedding")).withColumn("size", F.size("embedding")), "vectors")
    common = good.groupBy("size").count().orderBy(F.col("count").desc(), "size").first()
    size = common["size"] if common else 1
    good = good.filter(F.col("size") == size)
    # equal vectors: one point and its k + 1 smallest ids, found in two salted steps
    salted = good.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(256)))
    few = salted.select("v", "salt", "vec_id").withColumn("r", F.row_number().over(Window.partitionBy("v", "salt").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    ids = stash(few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "ids")
    asked = stash(good.filter(is_query).select("vec_id", "v"), "asked")
    point_rows = stash(good.join(ids.select(F.col("ids")[0].alias("vec_id"), F.col("v").alias("w")), "vec_id").filter("v = w").dropDuplicates(["v"]).select(F.col("vec_id").alias("id"), "v", "embedding"), "points")
    n = point_rows.count()
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    radius2 = point_rows.agg(F.max(norm2)).first()[0] or 0.0
    basis = np.random.default_rng(seed).standard_normal((size + 1, dims))
    limit = chi_square_quantile(sure, dims)

    def project(x: np.ndarray, query: bool) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(radius2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, last[:, None]], axis=1) @ basis

    cells = 1 << max(0, math.ceil(math.log2(max(n, 1) / cell_rows)))
    drawn = point_rows.orderBy(F.xxhash64("id")).limit(sample).select("embedding").collect() if cells > 1 else []
    cuts: list[tuple[int, float]] = []  # a heap of cuts: (dimension, value)
    parts = [project(np.array([r[0] for r in drawn]), False)] if drawn else []
    while len(cuts) < cells - 1:
        own = parts[len(cuts)]
        d = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
        value = float(np.median(own[:, d])) if len(own) else 0.0
        cuts.append((d, value))
        parts += [own[own[:, d] <= value], own[own[:, d] > value]]

    def cell_of(p: np.ndarray) -> np.ndarray:
        at = np.zeros(len(p), np.int64)
        for _ in range(int(math.log2(cells))):
            d, value = np.array([c[0] for c in cuts])[at], np.array([c[1] for c in cuts])[at]
            at = 2 * at + 1 + (p[np.arange(len(p)), d] > value)
        return at - (cells - 1)

    def matrix(column: pd.Series) -> np.ndarray:
        return np.array(column.tolist(), np.float64).reshape(-1, size)

    def deal(query: bool):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.assign(cell=cell_of(project(matrix(b["embedding"]), query)))

        return work

    points = point_rows.select("id", "embedding").mapInPandas(deal(False), "id long, embedding array<double>, cell long")
    crowded = points.groupBy("cell").count()
    split = {r["cell"]: max(1, math.ceil(r["count"] / (2 * cell_rows))) for r in crowded.collect()}  # one row a cell
    number = np.cumsum([0, *[split.get(c, 0) for c in range(cells)]])
    place = F.element_at(F.array(*[F.lit(int(x)) for x in number[:-1]]), (F.col("cell") + 1).cast("int")) + F.pmod(F.xxhash64("id"), F.element_at(F.array(*[F.lit(max(1, split.get(c, 1))) for c in range(cells)]), (F.col("cell") + 1).cast("int")))
    points = stash(points.select("id", "embedding", place.cast("long").alias("block")), "cells")
    queries = stash(point_rows.join(asked.select("v").distinct(), "v").select(F.col("id").alias("q"), "embedding"), "queries")

    def boxes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = project(matrix(b["embedding"]), False)
            yield pd.DataFrame({"block": b["block"], "p": list(p)})

    projected = points.mapInPandas(boxes, "block long, p array<double>")
    bounds = projected.groupBy("block").agg(*[f(F.col("p")[d]).alias(f"{f.__name__}{d}") for f in (F.min, F.max) for d in range(dims)]).orderBy("block").collect()
    blocks = np.array([b["block"] for b in bounds], np.int64)
    low = np.array([[b[f"min{d}"] for d in range(dims)] for b in bounds]).reshape(-1, dims)
    high = np.array([[b[f"max{d}"] for d in range(dims)] for b in bounds]).reshape(-1, dims)

    def box_distances(p: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(low[None] - p[:, None], p[:, None] - high[None]), 0)
        return (gap * gap).sum(axis=2)

    def route(first: bool):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for at in range(0, len(b), 2000):
                    part = b.iloc[at : at + 2000]
                    far = box_distances(project(matrix(part["embedding"]), True))
                    home = far.argmin(axis=1)
                    go = np.zeros(far.shape, bool)
                    go[np.arange(len(part)), home] = True
                    if not first:
                        go = ~go & (far <= limit * part["known"].to_numpy()[:, None])
                    row, block = np.nonzero(go)
                    known = np.full(len(row), np.inf) if first else part["known"].to_numpy()[row]
                    yield pd.DataFrame({"block": blocks[block], "q": part["q"].to_numpy()[row], "embedding": part["embedding"].to_numpy()[row], "known": known})

        return work

    routed = "block long, q long, embedding array<double>, known double"

    def visit(key, vectors: Iterator[pd.DataFrame], asked: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = pd.concat(vectors, ignore_index=True) if not isinstance(vectors, pd.DataFrame) else vectors
        q = pd.concat(asked, ignore_index=True) if not isinstance(asked, pd.DataFrame) else asked
        if not len(v) or not len(q):
            return pd.DataFrame({"q": [], "score": [], "id": []}).astype({"q": "int64", "id": "int64", "score": "float64"})
        x, tree, out = matrix(v["embedding"]), None, []
        tree = Tree(project(x, False))
        for at in range(0, len(q), 1000):
            part = q.iloc[at : at + 1000]
            m = matrix(part["embedding"])
            s, i = search(x, v["id"].to_numpy(), tree, radius2, m, project(m, True), part["known"].to_numpy(), k + 1, limit)
            row, col = np.nonzero(np.isfinite(s))
            out.append(pd.DataFrame({"q": part["q"].to_numpy()[row], "score": s[row, col], "id": i[row, col]}))
        return pd.concat(out, ignore_index=True)

    def searched(asked_rows: DataFrame) -> DataFrame:
        # a block's queries come in slices, each with the block's points
        sliced = asked_rows.withColumn("slice", F.pmod(F.xxhash64("q"), F.lit(slices)))
        spread = points.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
        return spread.groupBy("block", "slice").cogroup(sliced.groupBy("block", "slice")).applyInPandas(visit, BEST)

    n_queries = queries.count()
    slices = max(1, math.ceil(n_queries / 50_000))
    home = stash(searched(queries.mapInPandas(route(True), routed)), "home")
    kth = home.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    bound = F.when(F.col("n") > k, F.greatest(F.lit(0.0), norm2 + radius2 - 2 * F.col("kth"))).otherwise(F.lit(float("inf")))
    again = queries.join(kth, "q", "left").select("q", "embedding", F.coalesce(bound, F.lit(float("inf"))).alias("known"))
    rest = searched(again.mapInPandas(route(False), routed))
    best = home.union(rest).withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "id"))).filter(F.col("r") <= k + 1)
    # ids of the found points' copies, then each asking id without itself
    named = best.join(ids.select(F.col("ids")[0].alias("id"), "ids"), "id").select("q", "score", F.explode("ids").alias("vec_id"))
    asking = asked.join(ids.select("v", F.col("ids")[0].alias("q")), "v").select("q", F.col("vec_id").alias("query_id"))
    out = asking.join(named, "q").filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return out.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
