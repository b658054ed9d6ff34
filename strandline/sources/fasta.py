"""FASTA by byte ranges: an offset index made from splits of the file, and regions read at their own bytes. No contig is ever a row.

Edge cases: blank lines at a contig's end are allowed, lines of other lengths within it are an error, as offsets would then be wrong. Regions are clipped to the contig; those of unknown contigs, reversed, null or
wholly outside give null. Lines end in LF or CR LF. An empty file has an empty index.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECES = "split long, piece long, contig string, offset long, bases long, width long, first long, last long, inner_low long, inner_high long, tail long"


def split_pieces(file, size: int, begin: int, end: int, step: int = 1 << 20) -> Iterator[dict]:
    """The runs of sequence lines of one contig among the lines that begin in [begin, end): name (None: it goes on from before), offset, bases, width of the first line with its end, and line
    lengths: the first, the last, the extremes of all but the last, and how many trailing lines are empty."""
    at = begin
    if begin:  # the line that begins before belongs to the split before
        at = begin - 1
        while at < size:
            raw = file.read_at(min(step, size - at), at)
            cut = raw.find(b"\n")
            if cut >= 0:
                at += cut + 1
                break
            at += len(raw)
    own = {"contig": None, "offset": None, "bases": 0, "width": 0, "first": 0, "last": 0, "inner_low": None, "inner_high": None, "tail": 0}
    started, rest = False, b""
    while at < end or rest:
        raw = file.read_at(min(step, size - at - len(rest)), at + len(rest)) if at + len(rest) < size else b""
        data = rest + raw
        lines = data.split(b"\n")
        rest = lines.pop() if raw else b""
        if not raw and lines and not lines[-1]:
            lines.pop()
        for line in lines:
            if at >= end:
                rest = b""
                break
            n, text = len(line) + 1, line.rstrip(b"\r")
            if text.startswith(b">"):
                if started:
                    yield own
                own = {"contig": (text[1:].split() or [b""])[0].decode(), "offset": at + n, "bases": 0, "width": 0, "first": 0, "last": 0, "inner_low": None, "inner_high": None, "tail": 0}
                started = True
            else:
                started = True
                if own["width"]:  # the line before was not the last one
                    own["inner_low"] = own["last"] if own["inner_low"] is None else min(own["inner_low"], own["last"])
                    own["inner_high"] = max(own["inner_high"] or 0, own["last"])
                if text:
                    own |= {"bases": own["bases"] + len(text), "last": len(text), "tail": 0}
                    if not own["width"]:
                        own |= {"width": n, "first": len(text)}
                else:
                    own["tail"] += 1
            at += n
        if at >= end:
            break
    if started:
        yield own


def fasta_index(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """contig, length, offset (of its first base), line_bases, line_width; the first of contigs of equal name. Each split of the file is one task."""
    system, at = fs.FileSystem.from_uri(path)
    size = system.get_file_info(at).size
    n = -(-size // split_bytes)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, place = fs.FileSystem.from_uri(path)
        for batch in batches:
            for i in batch["id"].tolist():
                with own.open_input_file(place) as f:
                    rows = [{"split": i, "piece": k, **x} for k, x in enumerate(split_pieces(f, size, i * split_bytes, min((i + 1) * split_bytes, size)))]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")], dtype=object)

    pieces = spark.range(0, n, 1, max(1, n)).mapInPandas(work, PIECES)
    number = F.sum(F.col("contig").isNotNull().cast("int")).over(Window.orderBy("split", "piece"))  # a row a contig and split
    rows = pieces.withColumn("number", number).filter("number > 0")
    order = F.struct("split", "piece")
    head = F.min(F.when(F.col("bases") > 0, F.struct("split", "piece", "first", "width")))
    more = F.coalesce(F.max("bases").over(Window.partitionBy("number").orderBy("split", "piece").rowsBetween(1, Window.unboundedFollowing)), F.lit(0)) > 0
    rows = rows.withColumn("low", F.least("inner_low", F.when(more & (F.col("bases") > 0), F.col("last")))).withColumn("high", F.greatest("inner_high", "last"))
    found = rows.groupBy("number").agg(F.min_by("contig", order).alias("contig"), F.sum("bases").alias("length"), F.min_by("offset", order).alias("offset"), head.alias("head"), F.min("low").alias("low"), F.max("high").alias("high"))
    even = (F.coalesce("low", F.col("head.first")) == F.col("head.first")) & (F.col("high") <= F.col("head.first"))
    fine = F.when(F.col("length") == 0, F.lit(0).cast("long")).when(even, F.col("head.first")).otherwise(F.raise_error(F.concat(F.lit("lines of different lengths in "), "contig")).cast("long"))
    out = found.select("number", "contig", "length", "offset", fine.alias("line_bases"), F.coalesce("head.width", F.lit(0)).alias("line_width"))
    return out.groupBy("contig").agg(F.min_by(F.struct("length", "offset", "line_bases", "line_width"), "number").alias("x")).select("contig", "x.*")


def fasta_regions(spark: SparkSession, path: str, regions: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """regions (contig, start, end; closed, from 1; more columns) with sequence, upper-cased: each row reads its own bytes of the file."""
    index = fasta_index(spark, path) if index is None else index
    a, b = F.greatest(F.col("start") - 1, F.lit(0)), F.least("end", "length")
    byte = lambda p: F.col("offset") + F.floor(p / F.col("line_bases")) * F.col("line_width") + p % F.col("line_bases")
    placed = regions.join(index.withColumnRenamed("contig", "_contig"), F.col("contig") == F.col("_contig"), "left")
    some = F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("line_bases") > 0) & (a < b)
    placed = placed.withColumn("_from", F.when(some, byte(a)).cast("long")).withColumn("_to", F.when(some, byte(b - 1) + 1).cast("long"))

    @F.pandas_udf("string")
    def fetch(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        system, at = fs.FileSystem.from_uri(path)
        with system.open_input_file(at) as f:
            for begins, ends in batches:
                yield pd.Series([None if pd.isna(x) else f.read_at(int(y) - int(x), int(x)).replace(b"\n", b"").replace(b"\r", b"").decode().upper() for x, y in zip(begins, ends, strict=True)], dtype=object)

    return placed.select(*regions.columns, fetch("_from", "_to").alias("sequence"))
