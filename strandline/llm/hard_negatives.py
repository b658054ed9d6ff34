"""Hard negatives by an orthogonal PCA rotation with early discards.

Scores are inner products of whole numbers. The second moments of all rows, summed by Spark, give an orthogonal rotation (any one is right, this one puts most of the
length into the leading components). Anchors are compared with blocks of rows: partial products of the leading components are accumulated, stage by stage, the rest is bounded by the
product of the residual norms plus a slack for rounding, and a pair goes as soon as it cannot reach what its anchor still takes. What
survives is verified by the integer product, and only verified scores are returned.

Two passes use that kernel: the ``positives`` best rows of the anchor's label, then, for each of their scores p, the ``k`` best rows of another label with ``share`` * p <= score <= p.

Scale: anchors are a stated set of queries against all rows, in blocks: rows are dealt to blocks of ``block_rows`` by hash (by label and hash for positives, so a
hot label has many blocks), anchors to groups of ``group_rows``, and each task takes one block and one group. No pair leaves a task, only the best of each block; Spark merges those, before the
shuffle already. The driver holds the d x d moments and counts.

Edge cases: rows with a null id, label or vector, an empty vector, or any null or non-finite component take no part, nor do vectors of another length than the most common one (ties: the shortest).
Anchors of equal id are asked once, with the smallest label and vector; a row is no candidate of its own id; other repeated rows count each. Ties go to the smaller id.
Scores must fit 64 bits (components of 2**55 and more saturate). Columns other than vec_id, embedding and label are not carried, so names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import discard, stash

STAGES = (8, 16, 32)  # leading components of each partial product
SLACK = 1e-9  # of the product of norms; rounding of rotated products stays far below
NOTHING = np.iinfo(np.int64).min


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v the components as whole numbers."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size(x) > 0)
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))).cast("long"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", "label", whole.alias("v"))


def matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(-1, size)


def rotation(rows: DataFrame, size: int) -> np.ndarray:
    """The eigenvectors of the second moments of all rows (v), by falling eigenvalue, as columns."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            x = matrix(batch["v"], size).astype(float)
            total += x.T @ x
        yield pd.DataFrame({"place": np.arange(size * size), "x": total.reshape(-1)})

    cells = rows.select("v").mapInPandas(moments, "place long, x double").groupBy("place").agg(F.sum("x").alias("x")).collect()
    whole = np.zeros(size * size)
    for c in cells:
        whole[c["place"]] = c["x"]
    whole = whole.reshape(size, size)
    return np.linalg.eigh((whole + whole.T) / 2)[1][:, ::-1].copy()


def first(group: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each group: higher scores, then smaller names."""
    order = np.lexsort((name, -score, group))
    own = group[order]
    fresh = np.append(True, own[1:] != own[:-1]) if len(own) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))
    return order[np.arange(len(own)) - begin < k]


class Block:
    """A block's rows, rotated, with residual norms behind each stage."""

    def __init__(self, vectors: np.ndarray, basis: np.ndarray):
        self.whole, self.turned = vectors, vectors @ basis
        self.edges = [*(s for s in STAGES if s < vectors.shape[1]), vectors.shape[1]]
        squares = np.cumsum((self.turned * self.turned)[:, ::-1], axis=1)[:, ::-1]
        self.rest = [np.sqrt(squares[:, e]) if e < vectors.shape[1] else np.zeros(len(vectors)) for e in self.edges]
        self.norm = np.sqrt(squares[:, 0])

    def part(self, at: slice) -> Block:
        out = object.__new__(Block)
        out.whole, out.turned, out.edges, out.rest, out.norm = self.whole[at], self.turned[at], self.edges, [r[at] for r in self.rest], self.norm[at]
        return out


def survivors(a: Block, b: Block, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, integer product) of the allowed pairs whose product lies within the row's [low, high]; others are mostly discarded unseen."""
    partial = a.turned[:, : a.edges[0]] @ b.turned[:, : a.edges[0]].T
    spare = a.rest[0][:, None] * b.rest[0] + SLACK * a.norm[:, None] * b.norm
    i, j = np.nonzero(allowed & (partial + spare >= low[:, None]) & (partial - spare <= high[:, None]))
    partial = partial[i, j]
    for stage in range(1, len(a.edges)):
        if not len(i):
            break
        own = slice(a.edges[stage - 1], a.edges[stage])
        partial += np.einsum("ij,ij->i", a.turned[i, own], b.turned[j, own])
        spare = a.rest[stage][i] * b.rest[stage][j] + SLACK * a.norm[i] * b.norm[j]
        stay = (partial + spare >= low[i]) & (partial - spare <= high[i])
        i, j, partial = i[stay], j[stay], partial[stay]
    score = np.einsum("ij,ij->i", a.whole[i], b.whole[j])
    stay = (score >= low[i]) & (score <= high[i])
    return i[stay], j[stay], score[stay]


def block_best(a: Block, b: Block, names: np.ndarray, allowed, floors: np.ndarray, tops: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of a and each of its ranges [floor, top], the k best rows of b: (row * ranges + range, score, name).

    allowed(slice) tells the pairs that count. Tiles grow, so the first ones raise the floors for the others.
    """
    ranges = floors.shape[1]
    kept = [np.zeros(0, np.int64)] * 3
    floors, at, width = floors.copy(), 0, 64
    while at < len(names):
        own = slice(at, min(at + width, len(names)))
        i, j, score = survivors(a, b.part(own), allowed(own), floors.min(axis=1).astype(float), tops.max(axis=1).astype(float))
        new = [kept]
        for r in range(ranges):
            use = (score >= floors[i, r]) & (score <= tops[i, r])
            new.append([i[use] * ranges + r, score[use], names[own][j[use]]])
        group, score, name = (np.concatenate(x) for x in zip(*new, strict=True))
        order = first(group, score, name, k)
        kept = [group[order], score[order], name[order]]
        full = np.bincount(kept[0], minlength=floors.size) == k
        least = np.full(floors.size, np.iinfo(np.int64).max)
        np.minimum.at(least, kept[0], kept[1])
        floors = np.where(full.reshape(floors.shape), np.maximum(floors, least.reshape(floors.shape)), floors)
        at, width = own.stop, min(2 * width, 1024)
    return kept[0], kept[1], kept[2]


def dealt(anchors: DataFrame, rows: DataFrame, groups: int, n_blocks: Column) -> tuple[DataFrame, DataFrame]:
    """Anchors (with _blocks, the numbers of the blocks they meet) and rows, by block and group."""
    a = anchors.withColumn("_group", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).withColumn("_block", F.explode("_blocks")).drop("_blocks")
    r = rows.withColumn("_block", F.pmod(F.xxhash64("vec_id", "v"), n_blocks)).withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return a, r


def mine(rows: DataFrame, is_anchor: Column, scale: int = 256, positives: int = 5, k: int = 5, share: tuple[int, int] = (80, 100), block_rows: int = 8192, group_rows: int = 1024) -> DataFrame:
    """rows (vec_id, embedding, label); is_anchor a predicate over vec_id -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    good = stash(usable(rows, scale), "hard-rows")
    common = good.groupBy(F.size("v").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    size, n = (common["size"], common["count"]) if common else (1, 0)
    good_size = good.filter(F.size("v") == size)
    basis = rotation(good_size, size)
    asked = good_size.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.*")
    anchors = stash(asked, "anchors")
    groups = max(1, math.ceil(anchors.count() / group_rows))
    span = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)

    # positives: blocks of the anchor's own label
    label_blocks = stash(good_size.groupBy("label").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("_n")), "label-blocks")
    same = good_size.join(label_blocks, "label")
    a, r = dealt(anchors.join(label_blocks, "label").withColumn("_blocks", span(F.col("_n"))).drop("_n"), same, groups, F.col("_n"))

    def search_same(key: tuple, own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(block):
            return pd.DataFrame({"anchor": [], "score": [], "id": []}, dtype="int64")
        ids, names = own["vec_id"].to_numpy(), block["vec_id"].to_numpy()
        floors, tops = np.full((len(own), 1), NOTHING), np.full((len(own), 1), np.iinfo(np.int64).max)
        g, s, i = block_best(Block(matrix(own["v"], size), basis), Block(matrix(block["v"], size), basis), names, lambda at: ids[:, None] != names[at], floors, tops, positives)
        return pd.DataFrame({"anchor": ids[g], "score": s, "id": i})

    place = ["label", "_block", "_group"]
    found = a.groupBy(*place).cogroup(r.select("vec_id", "v", *place).groupBy(*place)).applyInPandas(search_same, "anchor long, score long, id long")
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    near = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    near = stash(near, "positives")

    # negatives: all blocks, within the ranges that the positives give
    ranges = near.groupBy(F.col("anchor").alias("vec_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("tops"))
    n_blocks = max(1, math.ceil(n / block_rows))
    a, r = dealt(anchors.join(ranges, "vec_id").withColumn("_blocks", span(F.lit(n_blocks).cast("long"))), good_size, groups, F.lit(n_blocks))

    def search_other(key: tuple, own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(block):
            return pd.DataFrame({"anchor": [], "place": [], "score": [], "id": []}, dtype="int64")
        ids, names = own["vec_id"].to_numpy(), block["vec_id"].to_numpy()
        label, other = own["label"].to_numpy(), block["label"].to_numpy()
        floors, tops = np.full((len(own), positives), np.iinfo(np.int64).max), np.full((len(own), positives), NOTHING)
        for x, scores in enumerate(own["tops"]):
            tops[x, : len(scores)] = scores
            floors[x, : len(scores)] = [-((-share[0] * int(p)) // share[1]) for p in scores]  # rounded up
        allowed = lambda at: label[:, None] != other[at]
        g, s, i = block_best(Block(matrix(own["v"], size), basis), Block(matrix(block["v"], size), basis), names, allowed, floors, tops, k)
        return pd.DataFrame({"anchor": ids[g // positives], "place": g % positives + 1, "score": s, "id": i})

    place = ["_block", "_group"]
    found = a.select("vec_id", "label", "v", "tops", *place).groupBy(*place).cogroup(r.groupBy(*place)).applyInPandas(search_other, "anchor long, place int, score long, id long")
    best = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id")
    found = stash(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "negatives")
    pairs = near.select("anchor", F.col("place").cast("int").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = pairs.join(found, ["anchor", "place"])
    discard(good, anchors, label_blocks)
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
