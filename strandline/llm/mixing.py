"""Mixing sources to target weights by budgets on hash-random order.

Sources get targets in proportion to their weights, capped at ``max_epochs`` times their size, the
excess shared again among the others (water-filling); with ``min_epochs`` no target falls below that
many passes. Every document has a random key (a hash); within its source, documents are sorted by
the key in ranges, distributed prefix sums of their sizes are formed, and the source's exact budget
is cut: whole passes for all, and one partial pass that ends inside the document on the boundary.

Scale: the key space is divided into about sqrt(n) equal ranges per source, so both levels of the
prefix sum (ranges of a source, documents of a range) see about sqrt(n) rows per task however large
one source is. Text never enters a shuffle. Deterministic: keys depend on content alone.

Edge cases: null texts and texts without words have size 0 and take 0. Null sources form the last
source. Repeated rows and equal ids are taken like any other, in the order of (key, size); rows
equal in all of these are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), max_epochs: int = 2, min_epochs: int = 0
) -> DataFrame:
    """sizes (source, source_size) -> + weight, target (double), budget (long).

    Weights repeat over the sources in code point order, null last. ``share`` is the mix's size as
    a fraction of all words. One row per source: the windows below run over sources, not documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long")
    num, den = share
    s = sizes.withColumn("weight", w).withColumn("floor", F.col("source_size") * min_epochs).withColumn("cap", F.col("source_size") * max_epochs - F.col("floor"))
    s = s.withColumn("left", F.greatest(F.sum("source_size").over(every) * num - F.sum("floor").over(every) * den, F.lit(0)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # level if this source is the first not capped: (left/den - capped) / remaining weight
    s = s.withColumn("level", (F.col("left") - full * den).cast("double") / (rest * den).cast("double"))
    free = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("level").alias("level")))).over(every)["level"]
    s = s.withColumn("free", free)
    extra = F.when(F.col("free").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("free") * F.col("weight")))
    s = s.withColumn("target", F.greatest(extra, F.lit(0.0)) + F.col("floor"))
    return s.select("source", "source_size", "weight", "target", F.floor(F.col("target") + 0.5).cast("long").alias("budget"))


def mix(docs: DataFrame, seed: int = 7, ranges: int | None = None, carry: tuple[str, ...] = (), **targets) -> DataFrame:
    """docs (doc_id, text, source, ...) -> doc_id, source, key, size, source_size, target, taken.

    ``carry`` names further columns that the rows keep. taken counts words, repeats included; taken // size whole copies, and a cut one of taken % size words.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    n = docs.count()
    k = ranges or max(1, math.isqrt(n))
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), *carry)
    base = base.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * k / (1 << 32)).cast("long"))
    totals = base.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    sizes = totals.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    goals = source_targets(sizes, **targets)
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)))
    starts = starts.join(goals, starts.source.eqNullSafe(goals.source)).select(starts.source.alias("s"), F.col("range").alias("r"), "start", "source_size", "target", "budget")
    inside = Window.partitionBy("source", "range").orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = base.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ranked.join(starts, ranked.source.eqNullSafe(starts.s) & (F.col("range") == F.col("r")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    tail = F.col("budget") - passes * F.col("source_size") - F.col("start") - F.col("before")
    taken = passes * F.col("size") + F.least(F.greatest(tail, F.lit(0)), F.col("size"))
    return joined.select("doc_id", "source", "key", "size", "source_size", "target", taken.cast("long").alias("taken"), *carry)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of docs: a document's whole copies, and its cut copy where it has one.

    A document without words takes no part in budgets and stays once. n_chars follows a cut text.
    """
    rows = mix(docs.select("doc_id", "source", "text", F.struct("*").alias("_row")), carry=("text", "_row"), **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(1)).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0)).cast("int")
    cut = F.when(rest > 0, F.array(F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), rest), " "))).otherwise(F.array().cast("array<string>"))
    out = rows.withColumn("_copy", F.explode(F.concat(F.array_repeat("text", whole), cut)))
    same = F.col("_copy").eqNullSafe(F.col("text"))
    columns = {"text": F.col("_copy")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(same, F.col("_row.n_chars")).otherwise(F.length("_copy").cast("long"))
    return out.select(*[columns[c].alias(c) if c in columns else F.col(f"_row.`{c}`") for c in docs.columns])
