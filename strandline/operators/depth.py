"""Base depth, sliding windows, depth ratios, deletion runs and CUSUM bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.intervals import interval_join

BLOCK_BIN = 4096  # aligned blocks are short; a gene is a few to some hundred bins


def depth_runs(reads: DataFrame, regions: DataFrame, required: int = 0, excluded: int = 4 + 256 + 512 + 1024 + 2048, min_mapq: int = 20) -> DataFrame:
    """Depth over the regions (gene, chrom, start, end) as runs of equal sums: sample, gene, chrom, start, end, depth; zeros included, every position in one run.

    Each aligned block (M, =, X; D and N only advance) adds one at its start and takes one off after its end; depth is the running
    sum over those places, summed up with map-side combine, so neither reads nor regions are expanded to bases.
    """
    use = reads.filter((F.col("flag").bitwiseAND(required) == required) & (F.col("flag").bitwiseAND(excluded) == 0) & (F.col("mapq") >= min_mapq))
    ops = F.transform(F.regexp_extract_all("cigar", F.lit(r"([0-9]+[MDN=X])"), F.lit(1)), lambda x: F.struct(F.regexp_extract(x, "^[0-9]+", 0).cast("long").alias("n"), F.regexp_extract(x, ".$", 0).alias("op")))
    step = lambda acc, x: F.struct((acc["at"] + x["n"]).alias("at"), F.when(x["op"].isin("M", "=", "X"), F.concat(acc["b"], F.array(F.struct(acc["at"].alias("s"), (acc["at"] + x["n"] - 1).alias("e"))))).otherwise(acc["b"]).alias("b"))
    blocks = F.aggregate(ops, F.struct(F.col("pos").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("b")), step, lambda acc: acc["b"])
    b = use.select("sample", F.col("chrom").alias("c"), F.explode(blocks).alias("b")).select("sample", "c", "b.s", "b.e")
    place = regions.select("gene", "chrom", F.col("start").alias("start2"), F.col("end").alias("end2"))
    hit = interval_join(b.select("sample", F.col("c").alias("chrom"), F.col("s").alias("start"), F.col("e").alias("end")), place, bin_size=BLOCK_BIN)
    hit = hit.select("sample", "gene", "chrom", F.col("start").alias("s"), F.col("end").alias("e"), F.col("start2").alias("start"), F.col("end2").alias("end"))
    place = ["sample", "gene", "chrom", "start", "end"]
    two = lambda first, behind, d: F.explode(F.array(F.struct(first.alias("pos"), F.lit(d).alias("d")), F.struct((behind + 1).alias("pos"), F.lit(-d).alias("d")))).alias("x")
    steps = hit.select(*place, two(F.greatest("s", "start"), F.least("e", "end"), 1)).groupBy(*place, F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d"))
    edges = reads.select("sample").distinct().crossJoin(regions).select(*place, two(F.col("start"), F.col("end"), 0)).select(*place, "x.pos", F.col("x.d").cast("long").alias("d"))
    points = steps.union(edges).groupBy(*place, "pos").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*place).orderBy("pos")
    runs = points.withColumn("depth", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("pos").over(order)).filter("next is not null")
    return runs.select("sample", "gene", "chrom", F.col("pos").alias("start"), (F.col("next") - 1).alias("end"), "depth")


def joined_runs(runs: DataFrame) -> DataFrame:
    """Runs with neighbours of equal depth made one (blocks that end where others begin leave such)."""
    order = Window.partitionBy("sample", "gene", "chrom").orderBy("start")
    same = (F.col("depth") == F.lag("depth").over(order)) & (F.col("start") == F.lag("end").over(order) + 1)
    numbered = runs.withColumn("run", F.sum(F.when(same, 0).otherwise(1)).over(order))
    return numbered.groupBy("sample", "gene", "chrom", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("depth").alias("depth")).drop("run")


def pileup(reads: DataFrame, regions: DataFrame, required: int = 0, excluded: int = 4 + 256 + 512 + 1024 + 2048, min_mapq: int = 20) -> DataFrame:
    """depth_runs as a row a position: sample, gene, chrom, pos, depth."""
    runs = depth_runs(reads, regions, required, excluded, min_mapq)
    return runs.select("sample", "gene", "chrom", F.explode(F.sequence("start", "end")).alias("pos"), "depth")


def gene_mean_depth(depth: DataFrame, genes: DataFrame) -> DataFrame:
    """Sum of depth over the gene's length; missing positions count as zero."""
    inside = depth.join(genes, "gene").filter("pos between start and end").groupBy("gene", "start", "end").agg(F.sum("depth").alias("total"))
    out = genes.select("gene", "start", "end").distinct().join(inside, ["gene", "start", "end"], "left")
    return out.select("gene", "start", "end", (F.coalesce("total", F.lit(0)) / (F.col("end") - F.col("start") + 1)).alias("gene_mean"))


def sliding_windows(genes: DataFrame, size: int, step: int, min_size: int) -> DataFrame:
    """Windows from the gene's start, clipped at its end, those shorter than min_size dropped; number counts the kept ones."""
    w = genes.select("gene", "start", "end", F.explode(F.sequence("start", "end", F.lit(step).cast("long"))).alias("w_start"))
    w = w.withColumn("w_end", F.least(F.col("w_start") + size - 1, F.col("end"))).filter(F.col("w_end") - F.col("w_start") + 1 >= min_size)
    return w.withColumn("number", ((F.col("w_start") - F.col("start")) / step).cast("long") + 1).select("gene", "number", "w_start", "w_end")


def window_ratios(depth: DataFrame, genes: DataFrame, size: int = 500, step: int = 200, min_size: int = 200, min_gene_depth: float = 20.0, cutoff: float = 0.65) -> DataFrame:
    """Mean depth of each window over the gene's mean, and its status.

    A base belongs to at most ceil(size / step) windows: positions are dealt to them and summed with map-side combine.
    """
    windows = sliding_windows(genes, size, step, min_size)
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - F.col("start") - size + 1) / step))
    dealt = depth.join(genes, "gene").filter("pos between start and end").select("gene", "depth", F.explode(F.sequence(first.cast("long"), F.floor((F.col("pos") - F.col("start")) / step).cast("long"))).alias("i"))
    sums = dealt.groupBy("gene", (F.col("i") + 1).alias("number")).agg(F.sum("depth").alias("total"))
    means = gene_mean_depth(depth, genes).select("gene", "gene_mean")
    out = windows.join(sums, ["gene", "number"], "left").join(means, "gene")
    out = out.withColumn("window_mean", F.coalesce("total", F.lit(0)) / (F.col("w_end") - F.col("w_start") + 1))
    out = out.withColumn("ratio", F.when(F.col("gene_mean") > 0, F.col("window_mean") / F.col("gene_mean")))
    status = F.when(F.col("gene_mean") < min_gene_depth, "Low_gene_depth").when(F.col("ratio").isNull(), "NA").when(F.col("ratio") <= cutoff, "Del_window").otherwise("Normal_window")
    return out.select("gene", "number", "w_start", "w_end", "gene_mean", "window_mean", "ratio", status.alias("status"))


def window_candidates(ratios: DataFrame, min_windows: int = 3) -> DataFrame:
    """Runs of at least min_windows consecutive deletion windows (by place in the gene's list)."""
    order = Window.partitionBy("gene").orderBy("w_start")
    runs = ratios.withColumn("at", F.row_number().over(order)).filter("status = 'Del_window'")
    runs = runs.withColumn("run", F.col("at") - F.row_number().over(order))
    length = F.col("w_end") - F.col("w_start") + 1
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("number")), lambda x: F.concat(F.lit("W"), x.cast("string"))), ",")
    out = runs.groupBy("gene", "run").agg(F.min("w_start").alias("start"), F.max("w_end").alias("end"), F.count("*").alias("n_windows"), (F.sum(F.col("window_mean") * length) / F.sum(length)).alias("mean_depth"), F.avg("ratio").alias("mean_ratio"), F.min("ratio").alias("min_ratio"), F.max("ratio").alias("max_ratio"), ids.alias("window_ids"))
    return out.filter(F.col("n_windows") >= min_windows).drop("run")


def depth_bins(depth: DataFrame, size: int) -> DataFrame:
    start = (F.floor((F.col("pos") - 1) / size) * size + 1).cast("long")
    return depth.groupBy("gene", start.alias("start")).agg(F.max("pos").alias("end"), F.avg("depth").alias("depth"), F.count("*").alias("n_pos"))


def with_baseline(bins: DataFrame) -> DataFrame:
    """Baseline: the exact median of the gene's bins with depth; genes without any depth go."""
    base = bins.filter("depth > 0").groupBy("gene").agg(F.median("depth").alias("baseline"))
    return bins.join(base, "gene")


def base_ratios(depth: DataFrame) -> DataFrame:
    """Each base over its gene's median and mean (zeros included); null where they are zero."""
    s = base_summary(depth)
    over = lambda c: F.when(F.col(c) != 0, F.col("depth") / F.col(c))
    return depth.join(s, "gene").select("gene", "pos", "depth", over("median_depth").alias("by_median"), over("mean_depth").alias("by_mean"))


def base_summary(depth: DataFrame) -> DataFrame:
    return depth.groupBy("gene").agg(F.count("*").alias("sites"), F.median("depth").alias("median_depth"), F.avg("depth").alias("mean_depth"))
