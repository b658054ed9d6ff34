"""Text sources and sinks: TSV with NA, column aliases, BED, SAM text, GTF, gene lists and settings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.functions.genome import gtf_attribute, na_to_null, strip_version


def read_tsv(spark: SparkSession, path: str, schema: StructType | None = None, required: list[str] | None = None) -> DataFrame:
    """A table with a header; NA, empty and missing cells are null. Required columns must be there."""
    df = spark.read.csv(path, sep="\t", header=True, nullValue="NA", enforceSchema=False, schema=schema, quote="", escape="")
    if lost := [c for c in required or [] if c not in df.columns]:
        raise ValueError(f"columns missing in {path}: {', '.join(lost)}")
    return df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def read_loose(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header, its cells parted by tabs where a line has one, else by white space. All columns are text, trimmed; NA, empty and missing cells
    are null, cells too many belong to the last one, blank lines go, and so do repeats of the header (of further files). An empty table or column name is an error."""
    lines = spark.read.text(path).select(F.rtrim(F.col("value"), F.lit("\r")).alias("value")).filter(r"value rlike '\\S'")
    first = lines.first()
    if first is None:
        raise ValueError(f"no header in {path}")
    header = first["value"].strip()
    names = [x.strip() for x in (header.split("\t") if "\t" in header else header.split())]
    if not all(names):
        raise ValueError(f"an empty column name in {path}")
    cells = F.when(F.col("value").contains("\t"), F.split("value", "\t", len(names))).otherwise(F.split(F.trim("value"), r"\s+", len(names)))
    rows = lines.filter(F.trim(F.col("value")) != header).select(cells.alias("cells"))
    return rows.select(*[na_to_null(F.trim(F.get("cells", F.lit(i)))).alias(c) for i, c in enumerate(names)])


def resolve_columns(df: DataFrame, wanted: dict[str, list[str]], optional: tuple[str, ...] = ()) -> DataFrame:
    """Renames by ordered aliases, exact names first, then any case."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    out = []
    for name, aliases in wanted.items():
        found = next((a for a in aliases if a in df.columns), None) or next((lower[a.lower()] for a in aliases if a.lower() in lower), None)
        if found is None and name not in optional:
            raise ValueError(f"none of the columns {aliases} is there")
        out.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def tsv_line(df: DataFrame) -> F.Column:
    """A row as text: cells as they are, but control characters as blanks and null or empty ones as NA."""
    cell = lambda c, t: F.translate(F.col(f"`{c}`"), "\r\n\t", "   ") if t == "string" else F.col(f"`{c}`").cast("string")
    filled = [F.when(F.coalesce(cell(c, t), F.lit("")) == "", F.lit("NA")).otherwise(cell(c, t)) for c, t in df.dtypes]
    return F.concat_ws("\t", *filled).alias("value")


def write_tsv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """A table with header, also if it has no rows; null and empty cells are NA, control characters are blanks, all else is raw."""
    lines, head = df.select(tsv_line(df)), "\t".join(df.columns)
    if one_file:  # the header is the first row of the one task
        spark = df.sparkSession
        top = spark.createDataFrame([(head,)], "value string").coalesce(1)
        top.union(lines.coalesce(1)).coalesce(1).write.mode("overwrite").text(path)
    else:
        lines.write.mode("overwrite").text(path)
        write_header(df.sparkSession, path, head)


HEADER = "header.txt"


def write_header(spark: SparkSession, folder: str, head: str) -> None:
    """The header as a file whose name comes before those of the parts."""
    jvm = spark._jvm.org.apache.hadoop.fs
    at = jvm.Path(f"{folder}/{HEADER}")
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(f"{head}\n".encode()))
    out.close()


def write_ordered(df: DataFrame, path: str, order: list, parts: int | None = None) -> None:
    """A table in a stated order, over many tasks: parts of ranges, sorted, in the order of their names, behind one header file. ``cat header.txt part-*`` is the whole table."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    dealt.select(tsv_line(df)).write.mode("overwrite").text(path)
    write_header(df.sparkSession, path, "\t".join(df.columns))


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """What write_ordered (or write_tsv in many files) wrote: text columns, NA as null, _part and _line (the order of rows)."""
    names = spark.read.text(f"{path}/{HEADER}").first()["value"].split("\t")
    lines = spark.read.text(path, pathGlobFilter="part-*").select("value", F.col("_metadata.file_name").alias("_part"), F.monotonically_increasing_id().alias("_line"))
    cells = F.split("value", "\t")
    return lines.select(*[na_to_null(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(names)], "_part", "_line")


def write_bed(df: DataFrame, path: str) -> None:
    """chrom, start (from 0), end, genes, without header; starts must be below ends."""
    checked = df.withColumn("start", F.when(F.col("start").between(0, F.col("end") - 1), F.col("start")).otherwise(F.raise_error(F.lit("an empty or negative interval"))))
    checked.select("chrom", "start", "end", "genes").coalesce(1).write.mode("overwrite").csv(path, sep="\t", quote="", escape="")


def key_values(df: DataFrame) -> DataFrame:
    """One row as (key, value) rows, by key."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns])
    return df.select(F.explode(pairs).alias("x")).select("x.*").orderBy("key")


def read_sam(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """Reads from SAM text: the mandatory fields used here and the SA tag."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter("value not like '@%'").filter(F.size(f) >= 11)
    tag = F.filter(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0))), lambda x: x.startswith("SA:Z:"))
    at = lambda i, t: f[i].try_cast(t)
    return rows.select(F.lit(sample).alias("sample"), f[0].alias("qname"), at(1, "int").alias("flag"), f[2].alias("chrom"), at(3, "long").alias("pos"), at(4, "int").alias("mapq"), f[5].alias("cigar"), f[6].alias("rnext"), at(7, "long").alias("pnext"), at(8, "long").alias("tlen"), F.substring(F.get(tag, 0), 6, 1 << 30).alias("sa"))


def read_gtf(spark: SparkSession, path: str, feature: str = "exon") -> DataFrame:
    rows = spark.read.csv(path, sep="\t", comment="#", quote="", schema="chrom string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string")
    a = F.col("attributes")
    return rows.filter(F.col("feature") == feature).select(strip_version(gtf_attribute(a, "transcript_id")).alias("transcript"), gtf_attribute(a, "gene_name").alias("gene_name"), gtf_attribute(a, "exon_number").alias("exon"), "chrom", "start", "end", "strand")


def read_gtf_parts(spark: SparkSession, path: str) -> DataFrame:
    """gene, transcript (without version), transcript_full, feature, chrom, strand, start, end, exon, exon_id of all features; rows without whole coordinates, gene or transcript go."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(r"trim(value) <> '' and not value like '#%'").filter(F.size(f) >= 9)
    a, exon = F.get(f, 8), F.coalesce(gtf_attribute(F.get(f, 8), "exon_number"), F.lit("NA"))
    full = gtf_attribute(a, "transcript_id")
    out = rows.select(F.coalesce(gtf_attribute(a, "gene_name"), gtf_attribute(a, "gene_id")).alias("gene"), strip_version(full).alias("transcript"), full.alias("transcript_full"), f[2].alias("feature"), f[0].alias("chrom"), f[6].alias("strand"),
                      f[3].try_cast("long").alias("start"), f[4].try_cast("long").alias("end"), exon.alias("exon"), F.coalesce(gtf_attribute(a, "exon_id"), F.concat(full, F.lit("."), exon)).alias("exon_id"))
    return out.dropna(subset=["gene", "transcript", "start", "end"])


def derived_path(path: str, kind: str) -> str:
    """Name of a table beside the main one: x.clusters.tsv or x.tsv -> x.kind.tsv, anything else gets .kind.tsv."""
    return re.sub(r"(\.clusters)?\.tsv$", "", path) + f".{kind}.tsv"


def _depth_fields(spark: SparkSession, path: str) -> DataFrame:
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).select("value", F.get(f, 0).alias("chrom"), F.get(f, 1).alias("p"), F.get(f, 2).alias("d"), F.monotonically_increasing_id().alias("line"))


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, depth without header; short rows and those that do not parse go, and of a repeated position the last line stays."""
    rows = _depth_fields(spark, path).select("chrom", F.col("p").try_cast("long").alias("pos"), F.col("d").try_cast("double").alias("depth"), "line")
    return rows.filter("pos is not null and depth is not null").groupBy("chrom", "pos").agg(F.max_by("depth", "line").alias("depth"))


def read_depth_strict(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, depth without header; blank lines and comments go, any other line that is not one stops the job with its text."""
    rows = _depth_fields(spark, path).filter(r"trim(value) <> '' and not value rlike '^\\s*#'")
    whole = F.col("chrom").isNotNull() & F.col("p").rlike(r"^\d+$") & (F.col("p").try_cast("long") >= 1) & F.col("d").rlike(r"^-?\d+(\.\d+)?$")
    fine = lambda c: F.when(F.coalesce(whole, F.lit(False)), c).otherwise(F.raise_error(F.concat(F.lit("not a depth line: "), "value")))
    return rows.select(fine(F.col("chrom")).alias("chrom"), fine(F.col("p")).cast("long").alias("pos"), fine(F.col("d")).cast("double").alias("depth"))


def read_core_genes(spark: SparkSession, path: str) -> DataFrame:
    """gene, class, line: white-space separated, comments with #; the first data line is a header if its gene is "gene"."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).filter("trim(value) <> '' and trim(value) not like '#%'")
    first = rows.agg(F.min("line").alias("_first"))
    rows = rows.select(f[0].alias("gene"), F.coalesce(F.get(f, 1), F.lit("NA")).alias("class"), "line").crossJoin(first)  # one row
    return rows.filter("not (line = _first and lower(gene) = 'gene')").drop("_first")


def read_exons(spark: SparkSession, path: str) -> DataFrame:
    """gene, transcript, exon (without EX), chrom, start, end, strand of an exon table; coordinates that are not start <= end are an error."""
    names = ["Gene", "Transcript", "Exon", "Chrom", "Start", "End", "Strand"]
    rows = read_tsv(spark, path, required=names)
    ok = F.coalesce(F.col("Start").rlike(r"^\d+$") & F.col("End").rlike(r"^\d+$") & (F.col("Start").try_cast("long") <= F.col("End").try_cast("long")), F.lit(False))
    at = lambda c: F.when(ok, F.col(c)).otherwise(F.raise_error(F.concat_ws(" ", F.lit("invalid exon coordinates:"), "Gene", "Exon", "Start", "End"))).cast("long")
    return rows.select(F.col("Gene").alias("gene"), F.col("Transcript").alias("transcript"), F.regexp_replace("Exon", "(?i)^EX", "").alias("exon"), F.col("Chrom").alias("chrom"), at("Start").alias("start"), at("End").alias("end"), F.col("Strand").alias("strand"))


def read_mane(spark: SparkSession, path: str, keep_version: bool = False) -> DataFrame:
    """mane_gene, transcript, raw of a table name, transcript, status: a header is recognised by its words; only MANE Select or an empty status stays."""
    f = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    rows = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    first = rows.agg(F.min("line").alias("_first"))
    head = (F.col("line") == F.col("_first")) & F.col("value").rlike("(?i)gene|name|symbol") & F.col("value").rlike("(?i)RefSeq|transcript|MANE")
    rows = rows.crossJoin(first).filter(~head).filter(r"trim(value) <> '' and not value rlike '^\\s*#'")
    cell = lambda i: F.trim(F.coalesce(F.get(f, i), F.lit("")))
    rows = rows.select(cell(0).alias("mane_gene"), cell(1).alias("raw"), cell(2).alias("status")).filter("mane_gene <> '' and raw <> ''")
    rows = rows.filter((F.col("status") == "") | F.col("status").rlike(r"(?i)MANE\s*Select"))
    return rows.select("mane_gene", (F.col("raw") if keep_version else strip_version(F.col("raw"))).alias("transcript"), "raw")


def mane_summary(spark: SparkSession, path: str) -> DataFrame:
    """name, RefSeq_prot (without version), MANE_status of the summary file: columns 4, 6 and the fifth from the end; the first line is a header."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    rows = rows.crossJoin(rows.agg(F.min("line").alias("_first"))).filter("line > _first")
    return rows.select(F.get(f, 3).alias("name"), F.regexp_replace(F.get(f, 5), r"\.\d+$", "").alias("RefSeq_prot"), F.get(f, F.size(f) - 5).alias("MANE_status"))


def read_window_ratios(spark: SparkSession, path: str) -> DataFrame:
    """A window-ratio table with Start, End and Depth_Ratio as numbers; rows where one is not a number go."""
    rows = read_tsv(spark, path, required=["Gene", "Start", "End", "Depth_Ratio"])
    number = {c: F.col(c).try_cast("double") for c in ("Start", "End", "Depth_Ratio")}
    return rows.withColumns(number).dropna(subset=list(number))


def read_positive(spark: SparkSession, path: str, column: str = "TLEN") -> DataFrame:
    """One column of a table as positive numbers; all else goes."""
    return read_tsv(spark, path, required=[column]).select(F.col(column).try_cast("double").alias(column)).filter(F.col(column) > 0)


#: Columns of the table of split events.
SPLIT_EVENT_COLUMNS = "Sample Read_Name Flag Primary_Chrom Primary_Start Primary_End Primary_CIGAR Primary_MAPQ Primary_Strand SA_Chrom SA_Start SA_End SA_CIGAR SA_MAPQ SA_Strand SA_NM Left_Breakpoint Right_Breakpoint SV_Chrom SV_Start SV_End SV_Length Junction_Type SA_Tag".split()


def read_split_events(spark: SparkSession, path: str) -> DataFrame:
    """The table of split events, all 24 columns required, numbers as numbers (null where they are none)."""
    rows = read_tsv(spark, path, required=SPLIT_EVENT_COLUMNS).select(*SPLIT_EVENT_COLUMNS)
    number = {c: F.col(c).try_cast("long") for c in SPLIT_EVENT_COLUMNS if re.search(r"Flag|Start|End|MAPQ|NM$|Breakpoint|Length", c)}
    return rows.withColumns(number)


def read_chrom_lengths(spark: SparkSession, path: str) -> DataFrame:
    """chrom, length from the @SQ lines of a SAM header; lengths of 0 go."""
    line = spark.read.text(path).filter("value like '@SQ%'")
    rows = line.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("value", r"\tLN:(\d+)", 1).try_cast("long").alias("length"))
    return rows.filter("chrom <> '' and chrom <> '*' and length > 0")


def union_files(spark: SparkSession, pattern: str, column: str = "Depth_File") -> DataFrame:
    """All tables that match the pattern as one, with the name of the file each row is from."""
    rows = spark.read.csv(pattern, sep="\t", header=True, nullValue="NA", enforceSchema=False)
    return rows.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias(column), "*")


def parse_settings(text: str) -> dict[str, str]:
    """KEY=VALUE lines; comments whole-line or after `` #``; quotes go; the last of equal keys counts."""
    out = {}
    for line in text.splitlines():
        if m := re.match(r"\s*([A-Za-z_]\w*)\s*=\s*(.*)$", line):
            value = re.sub(r"\s+#.*$", "", m[2]).strip()
            out[m[1]] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def parse_samples(text: str) -> list[tuple[str, str]]:
    """Two tab-separated columns, sample and path, each unique."""
    rows = [tuple(x.strip() for x in line.split("\t")) for line in text.splitlines() if line.strip() and not line.startswith("#")]
    if any(len(r) != 2 or not all(r) for r in rows):
        raise ValueError("a sample line needs a name and a path")
    for column in zip(*rows, strict=True):
        if len(set(column)) < len(rows):
            raise ValueError("samples and paths must be unique")
    return rows


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, seq (upper case): a record a row, so a file is split between records."""
    rows = spark.read.option("lineSep", "\n>").text(path).filter("trim(value) <> ''")
    head = F.regexp_extract("value", r"^>?([^\s]+)", 1)
    return rows.select(head.alias("name"), F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s+", "")).alias("seq"))


def fasta_regions(fasta: DataFrame, regions: DataFrame) -> DataFrame:
    """fasta (name, seq), regions (chrom, start, end from 1, both included) -> regions with seq; a region past the end is cut."""
    return regions.join(fasta.withColumnRenamed("name", "chrom"), "chrom").withColumn("seq", F.substring("seq", F.col("start"), F.col("end") - F.col("start") + 1))


def write_fastq(pairs: DataFrame, path: str) -> None:
    """Read pairs (name, fragment, start0, insert, r1, r2, quality) as the folders R1 and R2 under ``path``, in one order, beside the pairs they are written from."""
    ident = F.concat_ws(":", "name", F.concat(F.lit("frag="), "fragment"), F.concat(F.lit("hap_start0="), "start0"), F.concat(F.lit("insert="), "insert"))
    ordered = pairs.withColumn("id", ident).repartitionByRange("name", "fragment").sortWithinPartitions("name", "fragment")
    ordered.select("id", "r1", "r2", "quality").write.mode("overwrite").parquet(f"{path}/pairs")  # one order for both
    back = pairs.sparkSession.read.parquet(f"{path}/pairs")
    for n in ("1", "2"):
        record = F.concat(F.lit("@"), "id", F.lit(f"/{n}\n"), f"r{n}", F.lit("\n+\n"), "quality")
        back.select(record.alias("value")).write.mode("overwrite").text(f"{path}/R{n}")


#: The columns kept of the tissue atlas.
ATLAS_COLUMNS = ["Gene", "Gene description", "RNA tissue specificity", "RNA tissue specific nTPM"]


def atlas_columns(spark: SparkSession, path: str) -> DataFrame:
    """The atlas columns of a TSV, without surrounding quotes; missing cells are empty, a missing column is an error."""
    df = spark.read.csv(path, sep="\t", header=True, quote='"')
    if lost := [c for c in ATLAS_COLUMNS if c not in df.columns]:
        raise ValueError(f"columns missing in {path}: {', '.join(lost)}")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in ATLAS_COLUMNS])
