"""The five depth tables of a sample, with every column a report has: genes, windows, ratios, deletion windows and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.genome import fixed_exact
from strandline.operators.depth import window_candidates


def described(rows: DataFrame, genes: DataFrame) -> DataFrame:
    """Rows of a gene with its class, transcript, chrom, strand, exon_count, gene_start and gene_end."""
    info = genes.select("gene", "class", "transcript", "chrom", "strand", "exon_count", F.col("start").alias("gene_start"), F.col("end").alias("gene_end"))
    return rows.join(info, "gene")


def head(sample: str) -> list[Column]:
    return [F.lit(sample).alias("SampleID"), F.col("gene").alias("Gene"), F.col("class").alias("Classification"), F.col("transcript").alias("Transcript")]


def number(c: str) -> Column:
    return fixed_exact(F.col(c), 4)


def window_name(gene: Column, place: Column) -> Column:
    return F.concat(gene, F.lit("_W"), place.cast("string"))


def gene_table(means: DataFrame, windows: DataFrame, genes: DataFrame, sample: str) -> DataFrame:
    """A row a gene: its mean depth and the number of its windows (0 for a gene too short for one)."""
    rows = described(means.select("gene", "gene_mean"), genes).join(windows.groupBy("gene").agg(F.count("*").alias("n")), "gene", "left")
    key = F.concat_ws("|", "gene", "transcript", "chrom", F.col("gene_start").cast("string"), F.col("gene_end").cast("string"))
    return rows.select(
        *head(sample), F.col("chrom").alias("Chrom"), F.col("gene_start").alias("Start"), F.col("gene_end").alias("End"), F.col("strand").alias("Strand"), F.col("exon_count").alias("ExonCount"), key.alias("Gene_Key"),
        (F.col("gene_end") - F.col("gene_start") + 1).alias("Gene_Length"), number("gene_mean").alias("Gene_Mean_Depth"), F.coalesce("n", F.lit(0)).cast("long").alias("Window_Count"),
    )


def ratio_table(ratios: DataFrame, genes: DataFrame, sample: str) -> DataFrame:
    """A row a window with its ratio, status and comment; the table of deletion windows is its rows with Is_Del_Window Yes, that of depths its first columns."""
    status = F.col("status")
    comment = (
        F.when(status == "Low_gene_depth", "Gene mean depth is lower than MIN_GENE_MEAN_DEPTH; window is not evaluated as deletion").when(status == "NA", "Depth ratio cannot be calculated")
        .when(status == "Del_window", "Depth ratio <= DEL_DEPTH_RATIO_CUTOFF").otherwise("Depth ratio > DEL_DEPTH_RATIO_CUTOFF")
    )
    rows = described(ratios, genes)
    return rows.select(
        *head(sample), window_name(F.col("gene"), F.col("number")).alias("Window_ID"), F.col("chrom").alias("Chrom"), F.col("w_start").alias("Start"), F.col("w_end").alias("End"), (F.col("w_end") - F.col("w_start") + 1).alias("Length"),
        F.col("gene_start").alias("Gene_Start"), F.col("gene_end").alias("Gene_End"), number("gene_mean").alias("Gene_Mean_Depth"), number("window_mean").alias("Window_Mean_Depth"), number("ratio").alias("Depth_Ratio"),
        F.when(status == "Del_window", "Yes").otherwise("No").alias("Is_Del_Window"), status.alias("Window_Status"), comment.alias("Comment"),
    )


def window_table(ratios: DataFrame, genes: DataFrame, sample: str) -> DataFrame:
    """A row a window with its mean depth."""
    return ratio_table(ratios, genes, sample).drop("Gene_Mean_Depth", "Depth_Ratio", "Is_Del_Window", "Window_Status", "Comment")


def candidate_table(ratios: DataFrame, genes: DataFrame, sample: str, min_windows: int = 3) -> DataFrame:
    """A row a run of deletion windows."""
    means = ratios.groupBy("gene").agg(F.max("gene_mean").alias("gene_mean"))  # one value a gene
    rows = described(window_candidates(ratios, min_windows), genes).join(means, "gene")
    ids = F.array_join(F.transform(F.split("window_ids", ","), lambda x: F.concat("gene", F.lit("_"), x)), ",")
    return rows.select(
        *head(sample), F.col("chrom").alias("Chrom"), F.col("start").alias("Start"), F.col("end").alias("End"), (F.col("end") - F.col("start") + 1).alias("Candidate_Length"), F.col("n_windows").alias("Window_Count"),
        number("gene_mean").alias("Gene_Mean_Depth"), number("mean_depth").alias("Candidate_Mean_Depth"), number("mean_ratio").alias("Mean_Depth_Ratio"), number("min_ratio").alias("Min_Depth_Ratio"), number("max_ratio").alias("Max_Depth_Ratio"),
        F.lit("Depth_candidate").alias("Candidate_Status"), ids.alias("Del_Window_IDs"), F.lit("Merged consecutive deletion-supporting windows").alias("Comment"),
    )
