"""Truth table of simulated deletions; every draw is a hash of the event, so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.genome import file_safe


#: The size bins of simulated deletions (name, least, most).
SIZE_BINS = [("50_100", 50, 100), ("100_200", 100, 200), ("200_500", 200, 500), ("500_1000", 500, 1000), ("1000_2000", 1000, 2000), ("2000_5000", 2000, 5000), ("5000_10000", 5000, 10000)]


def first_genes(genes: DataFrame, most: int, order: list[str], read_length: int) -> DataFrame:
    """The first ``most`` genes, in a stated order, that are long enough for a read; 0 takes all."""
    whole = genes.withColumns({"start": F.least("start", "end"), "end": F.greatest("start", "end")}).filter(F.col("end") - F.col("start") + 1 >= read_length)
    return whole.orderBy(*order).limit(most) if most else whole


def sim_truth(genes: DataFrame, bins: list[tuple[str, int, int]], replicates: int, depth: float, read_length: int, seed: int = 1, *, prefix: str = "SIM", out_dir: str = "simulated", insert_mean: float = 350.0, insert_sd: float = 50.0, error_rate: float = 0.0) -> DataFrame:
    """genes (gene, transcript, chrom, strand, start, end, exon_count) x size bins (name, min, max) x replicates -> one event a row.

    Genes shorter than a read, or than a bin's least size, have no event, nor has one that would leave less than a read.
    Each draw is the MD5 of the event's names, so any engine can repeat it; a sample's name tells genes, not transcripts, apart.
    """
    sizes = F.array(*[F.struct(F.lit(n).alias("length_bin"), F.lit(a).cast("long").alias("bin_min_size"), F.lit(b).cast("long").alias("bin_max_size")) for n, a, b in bins])
    e = first_genes(genes, 0, [], read_length).withColumn("gene_length", F.col("end") - F.col("start") + 1)
    e = e.select("*", F.explode(sizes).alias("_s")).filter(F.col("gene_length") >= F.col("_s.bin_min_size"))
    e = e.select("*", "_s.*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).drop("_s")
    event = [F.col(c).cast("string") for c in ("gene", "transcript", "length_bin", "replicate")]

    def draw(tag: str, n: Column) -> Column:
        return F.conv(F.substring(F.md5(F.concat_ws("|", *event, F.lit(tag), F.lit(str(seed)))), 1, 8), 16, 10).cast("long") % n

    e = e.withColumn("del_size_bp", F.col("bin_min_size") + draw("size", F.least("bin_max_size", "gene_length") - F.col("bin_min_size") + 1))
    e = e.withColumn("del_start", F.col("start") + draw("start", F.col("gene_length") - F.col("del_size_bp") + 1))
    e = e.withColumn("del_haplotype_length", F.col("gene_length") - F.col("del_size_bp")).filter(F.col("del_haplotype_length") >= read_length)
    sample = F.concat_ws("_", F.lit(prefix), file_safe(F.col("gene")), F.lit("DEL"), "length_bin", F.concat(F.lit("rep"), "replicate"))
    fragments = lambda c: F.floor(F.lit(depth / 2) * F.col(c) / (2 * read_length) + 0.5)
    fastq = lambda n: F.concat(F.lit(f"{out_dir}/"), "sample", F.lit("/"), "sample", F.lit(f".R{n}.fastq"))
    return e.withColumn("sample", sample).select(
        "sample", "gene", "transcript", "chrom", "strand", F.col("start").alias("gene_start"), F.col("end").alias("gene_end"), "gene_length", "exon_count", "length_bin", "bin_min_size", "bin_max_size", "replicate",
        "del_start", (F.col("del_start") + F.col("del_size_bp") - 1).alias("del_end"), "del_size_bp", F.col("gene_length").alias("wt_haplotype_length"), "del_haplotype_length", F.lit(depth).alias("depth"),
        F.lit(depth / 2).alias("wt_depth"), F.lit(depth / 2).alias("del_depth"), F.lit(read_length).alias("read_length"), F.lit(insert_mean).alias("insert_mean"), F.lit(insert_sd).alias("insert_sd"), F.lit(error_rate).alias("error_rate"),
        fragments("gene_length").alias("wt_fragment_number"), fragments("del_haplotype_length").alias("del_fragment_number"), draw("event", F.lit(1 << 31)).alias("seed"), fastq(1).alias("r1_fastq"), fastq(2).alias("r2_fastq"),
    )


def _uniform(seed: int, *parts):
    """In (0, 1), from a hash of the parts."""
    return (F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1 << 32)) + 0.5) / float(1 << 32)


def read_pairs(haplotypes: DataFrame, read_length: int = 150, insert_mean: float = 350.0, insert_sd: float = 50.0, error_rate: float = 0.0, seed: int = 1, tries: int = 16) -> DataFrame:
    """haplotypes (name, seq, fragments) -> name, fragment, start0, insert, r1, r2, quality.

    The insert is normal within read length and sequence length: the first of ``tries`` draws inside, else the mean
    brought inside. Sequences shorter than a read have no pairs. r2 is the reverse complement of the fragment's end.
    """
    h = haplotypes.select("name", F.upper("seq").alias("seq"), "fragments").filter((F.length("seq") >= read_length) & (F.col("fragments") > 0))
    f = h.select("name", "seq", F.explode(F.sequence(F.lit(1).cast("long"), F.col("fragments").cast("long"))).alias("fragment"))
    own, most = (F.col("name"), F.col("fragment")), F.length("seq")

    def draw(i: int):
        z = F.sqrt(-2 * F.log(_uniform(seed, *own, F.lit(f"radius{i}")))) * F.cos(2 * F.pi() * _uniform(seed, *own, F.lit(f"angle{i}")))
        x = F.floor(z * insert_sd + insert_mean + 0.5)
        return F.when(x.between(F.lit(read_length), most), x)

    clamped = F.least(F.greatest(F.lit(int(insert_mean + 0.5)), F.lit(read_length)), most)
    f = f.withColumn("insert", F.coalesce(*[draw(i) for i in range(tries)], clamped).cast("int"))
    f = f.withColumn("start0", F.floor(_uniform(seed, *own, F.lit("start")) * (most - F.col("insert") + 1)).cast("int"))

    def with_errors(read, tag: str):
        if error_rate <= 0:
            return read

        def base(x, i):
            at = F.floor(_uniform(seed, *own, F.lit(f"base-{tag}"), i) * 3).cast("int") + 1
            wrong = (_uniform(seed, *own, F.lit(f"error-{tag}"), i) < error_rate) & x.isin("A", "C", "G", "T")
            return F.when(wrong, F.substring(F.array_join(F.filter(F.array(*map(F.lit, "ACGT")), lambda y: y != x), ""), at, 1)).otherwise(x)

        return F.array_join(F.transform(F.split(read, "(?!$)"), base), "")

    r1 = F.substring("seq", F.col("start0") + 1, F.lit(read_length))
    r2 = F.reverse(F.translate(F.substring("seq", F.col("start0") + F.col("insert") - read_length + 1, F.lit(read_length)), "ACGT", "TGCA"))
    return f.select("name", "fragment", "start0", "insert", with_errors(r1, "1").alias("r1"), with_errors(r2, "2").alias("r2"), F.repeat(F.lit("I"), read_length).alias("quality"))
