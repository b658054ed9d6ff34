"""Gene structures, reports of missing genes, plot data of window ratios, and the order of result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.genome import chrom_rank, fixed_exact, range_text, strip_version


def exon_rank(exon: Column) -> Column:
    """Whole numbers as they are, anything else last."""
    text = exon.cast("string")
    return F.when(text.rlike(r"^\d{1,18}$"), text.cast("long")).otherwise(F.lit(999999))


def by_place(df: DataFrame, *then: str | Column, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Ordered by chromosome (1-22, X, Y, M, others by name), start, end, then the columns given: a range sort, for a sink to keep."""
    return df.orderBy(chrom_rank(F.col(chrom)), chrom, start, end, *then)


def exon_order(exons: DataFrame) -> DataFrame:
    """Exon rows (mane_gene, transcript, exon, ...) in the order of the exon table."""
    return by_place(exons, "mane_gene", "transcript", exon_rank(F.col("exon")), "exon")


def target_transcripts(core: DataFrame, mane: DataFrame) -> DataFrame:
    """gene, transcript of the core genes that mane (mane_gene, transcript, line) names; the last line of a gene counts."""
    last = mane.groupBy(F.col("mane_gene").alias("gene")).agg(strip_version(F.max_by("transcript", "line")).alias("transcript"))
    return core.select("gene").distinct().join(last, "gene")


def gene_structures(core: DataFrame, mane: DataFrame, parts: DataFrame) -> DataFrame:
    """One row for each target gene that parts (gene, transcript, feature, chrom, strand, start, end) hold under its transcript.

    The span is that of the transcript rows, else of the exons; exons and coding parts are listed by coordinate.
    """
    own = parts.join(target_transcripts(core, mane), ["gene", "transcript"])
    of = lambda feature, c: F.when(F.col("feature") == feature, c)
    spans = lambda f: F.array_join(F.transform(F.array_sort(F.collect_list(of(f, F.struct("start", "end")))), lambda x: range_text(x["start"], x["end"])), ",")
    counts = [F.count(of(f, F.lit(1))).alias(name) for f, name in (("exon", "n_exons"), ("CDS", "n_cds"), ("5UTR", "n_utr5"), ("3UTR", "n_utr3"))]
    edge = lambda agg, c: F.coalesce(agg(of("transcript", F.col(c))), agg(of("exon", F.col(c))))
    return own.groupBy("gene", "transcript").agg(F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), edge(F.min, "start").alias("tx_start"), edge(F.max, "end").alias("tx_end"), *counts, spans("exon").alias("exons"), spans("CDS").alias("cds"))


def missing_report(core: DataFrame, mane: DataFrame, parts: DataFrame) -> DataFrame:
    """category, gene, reason: core genes without a transcript, and those whose transcript has no part."""
    targets = target_transcripts(core, mane)
    said = lambda df, category, reason: df.select(F.lit(category).alias("category"), "gene", F.lit(reason).alias("reason"))
    no_mane = core.select("gene").distinct().join(targets, "gene", "left_anti")
    no_gtf = targets.join(parts, ["gene", "transcript"], "left_anti")
    return said(no_mane, "Missing_MANE", "Gene not found in RefSeq_MANE_Select file").union(said(no_gtf, "Missing_GTF", "MANE transcript not found in GTF"))


#: Order of the windows of a gene.
WINDOW_ORDER = ("w_start", "w_end", "window_id")


def plot_index(ratios: DataFrame) -> DataFrame:
    """Window ratios (gene, w_start, w_end, window_id, ...) with plot_index, from 1 in each gene."""
    return ratios.withColumn("plot_index", F.row_number().over(Window.partitionBy("gene").orderBy(*WINDOW_ORDER)))


def window_labels(ratios: DataFrame, normal: str = "Normal_window", most: int = 30) -> DataFrame:
    """gene, n_windows, n_labels, labels: the first ``most`` windows that are not normal, with their ratios, and how many more there are.

    The limit is that of the label box; n_labels counts all.
    """
    counts = ratios.groupBy("gene").agg(F.count("*").alias("n_windows"), F.count_if(F.col("status") != normal).alias("n_labels"))
    at = F.row_number().over(Window.partitionBy("gene").orderBy(*WINDOW_ORDER))
    first = ratios.filter(F.col("status") != normal).withColumn("_at", at).filter(F.col("_at") <= most)
    line = F.concat("window_id", F.lit(": "), F.coalesce(fixed_exact(F.col("ratio"), 3), F.lit("nan")))
    listed = first.groupBy("gene").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", line.alias("line")))), lambda x: x["line"]).alias("_lines"))
    more = F.when(F.col("n_labels") > most, F.array(F.concat(F.lit("... +"), (F.col("n_labels") - most).cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    text = F.array_join(F.concat(F.array(F.lit("Non-normal windows")), F.col("_lines"), more), "\n")
    out = counts.join(listed, "gene", "left")
    return out.select("gene", "n_windows", "n_labels", F.when(F.col("n_labels") > 0, text).otherwise("Non-normal windows: none").alias("labels"))
