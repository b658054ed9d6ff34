"""Read filters with reasons, split-read gaps, discordant pairs and insert-size statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.quantiles import exact_quantiles
from strandline.functions.genome import cigar_ref_length, has_flag, int_median, mask, pair_orientation, range_text, strand

BAD = mask("unmapped", "secondary", "qc_fail", "supplementary")
SPLIT = (mask("paired"), BAD + mask("duplicate"))
DISCORDANT = (mask("paired"), BAD + mask("duplicate", "mate_unmapped"))
PROPER = (mask("proper"), mask("unmapped", "mate_unmapped", "secondary", "duplicate", "supplementary"))  # QC failures stay


def reject_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that a row breaks (its condition is true), else null."""
    out = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        out = F.when(broken, F.lit(name)).otherwise(out)
    return out


def with_reason(reads: DataFrame, required: int, excluded: int, min_mapq: int) -> DataFrame:
    """Adds reason: why a read is not used, in the order of the checks."""
    flag = F.col("flag")
    return reads.withColumn("reason", reject_reason([
        ("invalid", F.col("pos").isNull() | (F.col("pos") < 1) | (F.col("chrom") == "*") | (F.col("cigar") == "*")),
        ("flag_required", flag.bitwiseAND(required) != required),
        ("flag_excluded", flag.bitwiseAND(excluded) != 0),
        ("low_mapq", F.col("mapq") < min_mapq),
    ]))


def used(reads: DataFrame, rule: tuple[int, int], min_mapq: int) -> DataFrame:
    return with_reason(reads, *rule, min_mapq).filter("reason is null").drop("reason")


def sa_entries(reads: DataFrame) -> DataFrame:
    """One row per valid supplementary alignment in the SA text (``rname,pos,strand,cigar,mapq,nm;``...)."""
    fields = F.transform(F.split("sa", ";"), lambda x: F.split(F.trim(x), ","))
    good = F.filter(fields, lambda x: (F.size(x) == 6) & x[1].rlike("^[0-9]+$") & x[4].rlike("^[0-9]+$") & x[5].rlike("^[0-9]+$"))
    out = reads.filter("sa is not null").withColumn("_x", F.explode(good))
    x = lambda i, t: F.col("_x")[i].cast(t)
    return out.select(*reads.columns, x(0, "string").alias("sa_chrom"), x(1, "long").alias("sa_pos"), x(2, "string").alias("sa_strand"), x(3, "string").alias("sa_cigar"), x(4, "int").alias("sa_mapq"), x(5, "int").alias("sa_nm"))


def sa_gaps(entries: DataFrame, min_mapq: int) -> DataFrame:
    """Junction of each primary and supplementary alignment; only Deletion_Gap has a gap [sv_start, sv_end]."""
    e = entries.filter(F.col("sa_mapq") >= min_mapq)
    e = e.withColumn("end", F.col("pos") + cigar_ref_length(F.col("cigar")) - 1).withColumn("sa_end", F.col("sa_pos") + cigar_ref_length(F.col("sa_cigar")) - 1)
    first = F.col("pos") <= F.col("sa_pos")
    e = e.withColumn("left_bp", F.when(first, F.col("end")).otherwise(F.col("sa_end"))).withColumn("right_bp", F.when(first, F.col("sa_pos")).otherwise(F.col("pos")))
    kind = F.when(F.col("chrom") != F.col("sa_chrom"), "Interchromosomal").when(F.col("left_bp") < F.col("right_bp") - 1, "Deletion_Gap").when(F.col("left_bp") == F.col("right_bp") - 1, "Adjacent_No_Gap").otherwise("Overlap_or_Complex")
    gap = lambda c: F.when(F.col("junction") == "Deletion_Gap", c)
    e = e.withColumn("junction", kind).withColumn("sv_start", gap(F.col("left_bp") + 1)).withColumn("sv_end", gap(F.col("right_bp") - 1))
    return e.withColumn("strand", strand(F.col("flag"))).withColumn("sv_length", F.col("sv_end") - F.col("sv_start") + 1)


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the first in a stated order."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_at", at).filter("_at = 1").drop("_at")


def pair_reasons(reads: DataFrame, min_insert: int = 500, only_fr: bool = True, min_mapq: int = 20) -> DataFrame:
    """Reads with the gap between the mates, and reason: why a read is no discordant pair, in the order of the checks (null if it is one)."""
    flag, length = F.col("flag"), cigar_ref_length(F.col("cigar"))
    mate = F.when(F.col("rnext") == "=", F.col("chrom")).otherwise(F.col("rnext"))
    r = reads.withColumn("orientation", pair_orientation(flag)).withColumn("sv_start", F.col("pos") + length).withColumn("sv_end", F.col("pnext") - 1)
    r = r.withColumn("sv_length", F.col("sv_end") - F.col("sv_start") + 1)
    r = r.withColumn("strand", strand(flag)).withColumn("mate_strand", F.when(has_flag(flag, "mate_reverse"), "-").otherwise("+"))
    named = lambda c: F.coalesce(~F.col(c).isin("", "*"), F.lit(False))
    sound = named("qname") & named("chrom") & named("cigar") & named("rnext") & (F.col("pos") >= 1) & (F.col("pnext") >= 1) & (F.col("mapq") >= min_mapq) & F.col("tlen").isNotNull()
    required, excluded = DISCORDANT
    return r.withColumn("reason", reject_reason([
        ("bad_sam", ~F.coalesce(sound & flag.isNotNull(), F.lit(False))),
        ("flag", (flag.bitwiseAND(required) != required) | (flag.bitwiseAND(excluded) != 0)),
        ("mate_chrom", mate != F.col("chrom")),
        ("tlen_sign", F.col("tlen") <= 0),
        ("insert_size", F.col("tlen") < min_insert),
        ("bad_sam", length <= 0),
        ("orientation", F.lit(only_fr) & (has_flag(flag, "reverse") | ~has_flag(flag, "mate_reverse"))),
        ("invalid_interval", F.col("sv_start") > F.col("sv_end")),
    ]))


#: What makes two rows one pair, and which row of a pair is taken.
PAIR_KEY, PAIR_ORDER = ["sample", "qname", "chrom", "pos", "sv_start", "sv_end", "tlen"], ["flag", "mapq", "cigar"]


def discordant_pairs(reads: DataFrame, min_insert: int = 500, only_fr: bool = True, min_mapq: int = 20) -> DataFrame:
    """Long-insert pairs on one chromosome, one row a fragment, with the gap between the mates."""
    r = pair_reasons(reads, min_insert, only_fr, min_mapq).filter("reason is null").drop("reason")
    return first_of(r, PAIR_KEY, PAIR_ORDER)


def reason_counts(rows: DataFrame, key: list[str], used_name: str, repeated_name: str) -> DataFrame:
    """reason, n: rows with a reason by it; of those without, one of each key is used and the others are repeats."""
    fine = rows.filter("reason is null").groupBy(*key).agg(F.count("*").alias("n"))
    fine = fine.agg(F.count("*").alias("once"), F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    named = F.array(F.struct(F.lit(used_name).alias("reason"), F.col("once").alias("n")), F.struct(F.lit(repeated_name).alias("reason"), (F.col("all") - F.col("once")).alias("n")))
    bad = rows.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    return bad.union(fine.select(F.explode(named).alias("x")).select("x.*"))


def pair_counters(reads: DataFrame, min_insert: int = 500, only_fr: bool = True, min_mapq: int = 20) -> DataFrame:
    """reason, n of all reads: each read is counted once."""
    return reason_counts(pair_reasons(reads, min_insert, only_fr, min_mapq), PAIR_KEY, "candidate_pairs", "duplicate_pair")


#: What makes two split events one: read, both alignments and the gap.
EVENT_KEY = ["sample", "qname", "chrom", "pos", "end", "cigar", "sa_chrom", "sa_pos", "sa_end", "sa_cigar", "sv_start", "sv_end"]


def event_reasons(gaps: DataFrame) -> DataFrame:
    """Junctions with reason: why one is no event (other junctions, coordinates that are not whole from 1 with the end not before the start)."""
    fine = (F.col("sv_start") >= 1) & (F.col("sv_end") >= F.col("sv_start")) & (F.col("sv_length") >= 1) & (F.coalesce("chrom", F.lit("NA")) != "NA")
    return gaps.withColumn("reason", reject_reason([("non_deletion", F.coalesce(F.col("junction") != "Deletion_Gap", F.lit(True))), ("invalid_coord", ~F.coalesce(fine, F.lit(False)))]))


def split_events(gaps: DataFrame) -> DataFrame:
    """Deletion gaps that hold as events, the first of each key."""
    return first_of(event_reasons(gaps).filter("reason is null").drop("reason"), EVENT_KEY, ["flag", "sa_mapq", "sa_strand"])


def event_counters(gaps: DataFrame) -> DataFrame:
    """reason, n of all junctions: each is counted once."""
    return reason_counts(event_reasons(gaps), EVENT_KEY, "used", "duplicate_event")


def with_status(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members with the status of their cluster."""
    return members.join(clusters.select("cluster_id", F.col("status").alias("cluster_status")), "cluster_id")


def count_text(values: Column) -> Column:
    """``k:v`` counts of an array, sorted, joined with commas."""
    kinds = F.array_sort(F.array_distinct(values))
    return F.array_join(F.transform(kinds, lambda k: F.concat(k, F.lit(":"), F.size(F.filter(values, lambda v: v == k)).cast("string"))), ",")


def cluster_summary(members: DataFrame, min_support: int, insert: bool = False) -> DataFrame:
    """Aggregates of each cluster and its status by the number of different reads."""
    aggs = [F.count_distinct("qname").alias("support_reads"), F.count("*").alias("support_records"), int_median(F.col("sv_start")).alias("start_median"), int_median(F.col("sv_end")).alias("end_median"),
            range_text(F.min("sv_start"), F.max("sv_start")).alias("start_range"), range_text(F.min("sv_end"), F.max("sv_end")).alias("end_range"), F.avg("sv_length").alias("length_mean"),
            range_text(F.min("sv_length"), F.max("sv_length")).alias("length_range"), F.array_join(F.array_sort(F.collect_set("qname")), ",").alias("read_names")]
    aggs += [count_text(F.collect_list(c)).alias(f"{c}_count") for c in ("strand", "sa_chrom", "sa_strand", "mate_strand") if c in members.columns]
    if insert:
        aggs.append(range_text(F.min("tlen"), F.max("tlen")).alias("insert_range"))
        aggs += [F.median("tlen").alias("insert_median"), F.avg("tlen").alias("insert_mean"), count_text(F.collect_list("orientation")).alias("orientations")]
    out = members.groupBy("sample", "chrom", "cluster_id").agg(*aggs)
    return out.withColumn("status", F.when(F.col("support_reads") >= min_support, "Pass").otherwise("LowSupport"))


def valid_tlen(reads: DataFrame, min_mapq: int = 20) -> DataFrame:
    return used(reads, PROPER, min_mapq).filter("tlen > 0").select("sample", "qname", "tlen")


def tlen_sample(tlen: DataFrame, most: int, seed: int = 20260701) -> DataFrame:
    """At most ``most`` rows in hash order: a uniform-like sample that reruns repeat."""
    return tlen.orderBy(F.md5(F.concat_ws("|", "sample", "qname", F.col("tlen").cast("string"), F.lit(str(seed)))), "sample", "qname", "tlen").limit(most)


def tlen_stats(tlen: DataFrame, n_mad: int = 3) -> DataFrame:
    """Count, moments, exact quantiles and the robust threshold median + n * 1.4826 * MAD, by sample."""
    counts = tlen.groupBy("sample", "tlen").agg(F.count("*").alias("c"))
    q = exact_quantiles(counts, ["sample"], "tlen", {"q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95, "p99": 0.99, "p995": 0.995}, "c")
    twice = F.abs(2 * F.col("tlen") - (2 * F.col("median")).cast("long")).alias("dev")  # a median of whole numbers is a whole number of halves
    mad = exact_quantiles(counts.join(q.select("sample", "median"), "sample").select("sample", twice, "c"), ["sample"], "dev", {"mad": 0.5}, "c").select("sample", (F.col("mad") / 2).alias("mad"))
    moments = tlen.groupBy("sample").agg(F.avg("tlen").alias("mean"), F.stddev_samp("tlen").alias("sd"))
    out = moments.join(q, "sample").join(mad, "sample").select("sample", "n", "mean", "sd", "median", "mad", "q1", "q3", "p95", "p99", "p995")
    return out.withColumn("threshold", F.col("median") + n_mad * 1.4826 * F.col("mad"))


def histogram(values: DataFrame, column: str, upper: float, bins: int = 100) -> DataFrame:
    """Counts in equal bins of [min, upper]; the last bin is closed."""
    kept = values.filter(F.col(column) <= upper)
    rows = kept.crossJoin(kept.agg(F.min(column).alias("_low")))  # one row, so nothing is gathered in one task
    at = F.least(F.floor((F.col(column) - F.col("_low")) / ((upper - F.col("_low")) / bins)), F.lit(bins - 1))
    return rows.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
