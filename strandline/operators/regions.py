"""Gene regions, exon neighbours and the annotation build."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.intervals import merge_intervals

# Ranks of gene classifications; others count as 0.
CLASS_RANK = {"Definitive": 5, "Strong": 4, "Moderate": 3, "Limited": 2, "Disputed": 1}


def best_class(core: DataFrame) -> DataFrame:
    """core (gene, class, line) -> one row per gene; the highest class, the first line among equals."""
    rank = F.lit(0)
    for name, r in CLASS_RANK.items():
        rank = F.when(F.col("class") == name, r).otherwise(rank)
    return core.groupBy("gene").agg(F.min_by("class", F.struct(-rank, "line")).alias("class"))


def core_gene_regions(genes: DataFrame, core: DataFrame) -> DataFrame:
    """genes (gene, transcript, chrom, start, end) in the core list, one region per gene."""
    g = genes.join(best_class(core), "gene")
    out = g.groupBy("gene", "class").agg(F.array_join(F.array_sort(F.collect_set("transcript")), ",").alias("transcripts"), F.min("chrom").alias("chrom"), F.count_distinct("chrom").alias("n_chrom"), F.min("start").alias("start"), F.max("end").alias("end"))
    one = F.when(F.col("n_chrom") > 1, F.raise_error(F.concat(F.lit("gene on several chromosomes: "), F.col("gene")))).otherwise(F.col("chrom"))
    return out.withColumn("chrom", one).drop("n_chrom")


def missing_genes(core: DataFrame, genes: DataFrame) -> DataFrame:
    return core.select("gene").distinct().join(genes, "gene", "left_anti")


def target_regions(regions: DataFrame, lengths: DataFrame, flank: int = 5000) -> DataFrame:
    """Regions widened by flank and clipped to [1, chromosome length]; a missing chromosome is an error."""
    j = regions.join(lengths, "chrom", "left")
    known = F.when(F.col("length").isNull(), F.raise_error(F.concat(F.lit("no length of "), F.col("chrom")))).otherwise(F.col("length"))
    return j.withColumn("target_start", F.greatest(F.lit(1), F.col("start") - flank)).withColumn("target_end", F.least(known, F.col("end") + flank)).drop("length")


def merged_targets(targets: DataFrame) -> DataFrame:
    return merge_intervals(targets.select("chrom", F.col("target_start").alias("start"), F.col("target_end").alias("end"), "gene"), ["chrom"], "gene")


def to_bed(merged: DataFrame) -> DataFrame:
    return merged.select("chrom", (F.col("start") - 1).alias("start"), "end", F.col("gene").alias("genes"))


def exon_intron(exons: DataFrame) -> DataFrame:
    """exons (gene, transcript, chrom, exon, start, end, strand) with neighbours by coordinate and, by strand, up- and downstream."""
    order = Window.partitionBy("gene", "transcript", "chrom").orderBy("start", "end", "exon")
    e = exons.withColumn("prev_exon", F.lag("exon").over(order)).withColumn("next_exon", F.lead("exon").over(order))
    e = e.withColumn("left_intron", F.greatest(F.lit(0), F.col("start") - F.lag("end").over(order) - 1)).withColumn("right_intron", F.greatest(F.lit(0), F.lead("start").over(order) - F.col("end") - 1))
    e = e.withColumn("left_intron", F.when(F.col("prev_exon").isNotNull(), F.col("left_intron"))).withColumn("right_intron", F.when(F.col("next_exon").isNotNull(), F.col("right_intron")))
    side = lambda plus, minus: F.when(F.col("strand") == "+", F.col(plus)).when(F.col("strand") == "-", F.col(minus))
    return e.withColumn("upstream_exon", side("prev_exon", "next_exon")).withColumn("downstream_exon", side("next_exon", "prev_exon"))


def mane_exons(gtf: DataFrame, mane: DataFrame) -> DataFrame:
    """gtf (transcript, gene_name, chrom, start, end, strand, exon) on mane (transcript, mane_gene); gene names must not disagree."""
    return gtf.join(mane, "transcript").filter((F.coalesce("gene_name", F.lit("")) == "") | (F.col("gene_name") == F.col("mane_gene")))


def unmatched(mane: DataFrame, exons: DataFrame) -> DataFrame:
    return mane.join(exons, "transcript", "left_anti")


def gene_ranges(exons: DataFrame) -> DataFrame:
    return exons.groupBy("mane_gene", "transcript", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("exon_count"))
