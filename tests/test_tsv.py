"""TSV as it stands in files: raw quotes, white space, and tables in order over many parts."""

import glob

import pytest
from pyspark.sql import functions as F

from strandline.operators import reads
from strandline.sources import tables

ODD = ['a"b', '"x', "back\\slash", "  lead", "tail  ", "tab\there", "line\nbreak", "'", '""', ""]


def test_cells_are_raw(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_tsv(spark.createDataFrame([(i, x, None) for i, x in enumerate(ODD)], "n long, a string, b string"), path)
    text = "".join(open(f).read() for f in glob.glob(f"{path}/part-*")).split("\n")
    want = [x.replace("\t", " ").replace("\n", " ") or "NA" for x in ODD]
    assert text[:-1] == ["n\ta\tb", *(f"{i}\t{x}\tNA" for i, x in enumerate(want))]


def test_a_leading_quote_does_not_swallow_tabs(spark, tmp_path):
    (tmp_path / "q.tsv").write_text('a\tb\tc\n1\t"x\t2\n3\ty"\tNA\n')
    assert [tuple(r) for r in tables.read_tsv(spark, str(tmp_path / "q.tsv")).collect()] == [("1", '"x', "2"), ("3", 'y"', None)]


def test_white_space_tables(spark, tmp_path):
    (tmp_path / "w.txt").write_text("  a b   c \r\n1  x  2\r\n\n 3\tNA\t\n4 y\n5 z 6 7\n")
    assert [tuple(r) for r in tables.read_loose(spark, str(tmp_path / "w.txt")).orderBy("a").collect()] == [("1", "x", "2"), ("3", None, None), ("4", "y", None), ("5", "z", "6 7")]
    (tmp_path / "e.txt").write_text("\n")
    with pytest.raises(ValueError, match="no header"):
        tables.read_loose(spark, str(tmp_path / "e.txt"))


def test_ordered_parts_are_the_sorted_table(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"), F.concat(F.lit('"'), (F.col("id") % 7).cast("string")).alias("q"))
    tables.write_ordered(df, path, ["q", F.col("n").desc()], parts=6)
    assert len(glob.glob(f"{path}/part-*")) == 6
    text = "".join(open(f).read() for f in [f"{path}/{tables.HEADER}", *sorted(glob.glob(f"{path}/part-*"))]).splitlines()
    want = [(str(r["n"]), r["q"]) for r in df.orderBy("q", F.col("n").desc()).collect()]
    assert text[0] == "n\tq" and [tuple(x.split("\t")) for x in text[1:]] == want
    assert [(r["n"], r["q"]) for r in tables.read_ordered(spark, path).orderBy("_part", "_line").collect()] == want
    tables.write_ordered(df.limit(0), str(tmp_path / "none"), ["n"])
    assert open(tmp_path / "none" / tables.HEADER).read() == "n\tq\n" and tables.read_ordered(spark, str(tmp_path / "none")).count() == 0


def test_bed_key_values_histogram(spark, tmp_path):
    beds = spark.createDataFrame([("chr1", 0, 5, "A,B")], "chrom string, start long, end long, genes string")
    tables.write_bed(beds, str(tmp_path / "b"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "b")).collect()] == ["chr1\t0\t5\tA,B"]
    with pytest.raises(Exception, match="empty or negative"):
        tables.write_bed(beds.withColumn("start", F.lit(5)), str(tmp_path / "bad"))
    assert [tuple(r) for r in tables.key_values(spark.createDataFrame([(1, "x")], "b long, a string")).collect()] == [("a", "x"), ("b", "1")]
    assert hasattr(reads, "histogram")


def test_columns_by_alias(spark):
    df = spark.createDataFrame([(1, 2)], "GENE long, start long")
    assert tables.resolve_columns(df, {"gene": ["Gene", "gene_name"], "start": ["start"], "end": ["end"]}, ("end",)).collect()[0].asDict() == {"gene": 1, "start": 2, "end": None}
    with pytest.raises(ValueError, match="none of the columns"):
        tables.resolve_columns(df, {"end": ["stop"]})
