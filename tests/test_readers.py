import pytest
from pyspark.sql import functions as F

from strandline.functions import checks
from strandline.functions import genome as G
from strandline.operators import depth, evidence
from strandline.sources import tables


def put(tmp_path, text, name="x.tsv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_depth_readers(spark, tmp_path):
    path = put(tmp_path, "chr1 5 10\nchr1 5\nbad\nchr1\t6\tx\nchr1 5 12\n\n")
    assert rows(tables.read_depth(spark, path)) == [("chr1", 5, 12.0)]
    assert rows(tables.read_depth_strict(spark, put(tmp_path, "# c\n\nchr1 1 2.5\n", "a"))) == [("chr1", 1, 2.5)]
    with pytest.raises(Exception, match="not a depth line"):
        tables.read_depth_strict(spark, path).collect()


def test_genes_exons_and_mane(spark, tmp_path):
    core = tables.read_core_genes(spark, put(tmp_path, "# c\nGene Class\nA Strong\nGENE x\nB\n"))
    assert rows(core.select("gene", "class")) == [("A", "Strong"), ("B", "NA"), ("GENE", "x")]
    head = "Gene\tTranscript\tExon\tChrom\tStart\tEnd\tStrand\n"
    assert rows(tables.read_exons(spark, put(tmp_path, head + "A\tT\tex3\tchr1\t5\t9\t+\n", "e"))) == [("A", "T", "3", "chr1", 5, 9, "+")]
    with pytest.raises(Exception, match="invalid exon"):
        tables.read_exons(spark, put(tmp_path, head + "A\tT\t3\tchr1\t9\t5\t+\n", "f")).collect()
    mane = "name\tRefSeq_prot\tMANE_status\nA\tNM_1.4\tMANE Select\nB\tNM_2.1\tMANE Plus Clinical\nC\tNM_3.1_2\t\n"
    assert rows(tables.read_mane(spark, put(tmp_path, mane, "m"))) == [("A", "NM_1", "NM_1.4"), ("C", "NM_3", "NM_3.1_2")]
    summary = "\t".join("abcdefghijk") + "\n" + "\t".join(["1", "2", "3", "G", "5", "NM_9.2", "MANE Select", "8", "9", "10", "11"]) + "\n"
    assert rows(tables.mane_summary(spark, put(tmp_path, summary, "s"))) == [("G", "NM_9", "MANE Select")]


def test_gtf_sam_and_files(spark, tmp_path):
    gtf = 'chr1\ts\texon\t1\t9\t.\t+\t.\ttranscript_id "NM_1.2"; gene_name "A"; exon_number 3;\nchr1\ts\tCDS\t1\t9\t.\t+\t.\tx\n'
    assert rows(tables.read_gtf(spark, put(tmp_path, gtf, "g")).select("transcript", "gene_name", "exon")) == [("NM_1", "A", "3")]
    sam = "@HD\tVN:1\n@SQ\tSN:chr1\tLN:100\n@SQ\tSN:chr2\tLN:0\nr\t99\tchr1\t5\t60\t10M\t=\t50\t55\t*\t*\tNM:i:0\tSA:Z:chr1,9,+,5M,60,0;\n"
    path = put(tmp_path, sam, "b.sam")
    assert rows(tables.read_chrom_lengths(spark, path)) == [("chr1", 100)]
    assert rows(tables.read_sam(spark, path, "S").select("qname", "flag", "pos", "sa")) == [("r", 99, 5, "chr1,9,+,5M,60,0;")]
    put(tmp_path, "a\tb\n1\t2\n", "p.one.tsv"), put(tmp_path, "a\tb\n3\tNA\n", "q.one.tsv")
    assert rows(tables.union_files(spark, str(tmp_path / "*.one.tsv"))) == [("p.one.tsv", "1", "2"), ("q.one.tsv", "3", None)]
    ratios = "Gene\tStart\tEnd\tDepth_Ratio\nA\t1\t2\t0.5\nA\tx\t2\t0.5\nA\t1\t2\tNA\n"
    assert rows(tables.read_window_ratios(spark, put(tmp_path, ratios, "r"))) == [("A", 1.0, 2.0, 0.5)]
    assert rows(tables.read_positive(spark, put(tmp_path, "TLEN\n5\n-5\nx\n", "t"))) == [(5.0,)]


def test_candidate_coordinates_and_support(spark):
    df = spark.createDataFrame([("1", "NA", "9", "20", "10", "Split, depth", None, None), ("2", "5", "6", None, None, "NA", "no", "3"), ("3", "5", "6", None, None, None, None, "3")],
                               "Chrom string, Best_Start string, Best_End string, Split_Start string, Split_End string, Evidence_Types string, Depth_Support string, Depth_Record_Count string")
    got = evidence.candidate_coordinates(df).withColumn("d", evidence.infer_support(df, "Depth", ["Depth_Support"], ["Depth_Record_Count"])).orderBy("Chrom").collect()
    assert [(r["coordinate_source"], r["start"], r["end"], r["d"]) for r in got] == [("Split", 10, 20, "Yes"), ("Best", 5, 6, "No"), ("Best", 5, 6, "Yes")]
    with pytest.raises(Exception, match="no valid coordinate"):
        evidence.candidate_coordinates(df.withColumn("Best_Start", F.lit("x")).withColumn("Split_Start", F.lit(None))).collect()
    meta = spark.createDataFrame([("a", "s1", "2"), ("a", "s1", "2"), ("a", "s2", "1.5"), ("b", "s1", "NA")], "id string, src string, v string")
    assert rows(evidence.numeric_sum(meta, "id", "src", "v")) == [("a", 3.5), ("b", None)]


def test_small_functions(spark):
    one = spark.createDataFrame([("EX12", None, "x/S_GENE1_NM_1_a.depth.tsv", "a b:c", 0.3125)], "i string, n string, f string, s string, d double")
    i, n = G.exon_names(F.col("i"), F.col("n"))
    assert tuple(one.select(i, n, G.gene_of_file(F.col("f")), G.file_safe(F.col("s")), G.fixed(F.col("d"), 3)).first()) == ("EX12", "12", "GENE1", "a_b_c", "0.312")
    ranks = spark.createDataFrame([("chr10",), ("2",), ("chrX",), ("MT",), ("other",)], "c string")
    assert [r[0] for r in ranks.select(G.chrom_rank(F.col("c"))).collect()] == [10, 2, 23, 25, 1000]
    assert [r[0] for r in ranks.filter(G.is_canonical(F.col("c"))).collect()] == ["chr10", "2", "chrX"]


def test_checks():
    assert checks.cusum_settings({"k": "0.1", "min_bins": "3", "baseline": "auto"}) == {"k": 0.1, "min_bins": 3, "baseline": "auto"}
    for bad in ({"edge": "1.5"}, {"min_len": "0"}, {"h": "0"}, {"k": "x"}, {"other": 1}):
        with pytest.raises(ValueError):
            checks.cusum_settings(bad)


def test_gene_without_depth_inside_keeps_its_mean_and_windows(spark):
    genes = spark.createDataFrame([("a", 10, 20)], "gene string, start long, end long")
    lines = spark.createDataFrame([("a", 99, 5)], "gene string, pos long, depth long")
    assert [tuple(r) for r in depth.gene_mean_depth(lines, genes).collect()] == [("a", 10, 20, 0.0)]
    assert depth.window_ratios(lines, genes, 5, 5, 1).count() == 3


def test_discordant_pairs_alone_leave_the_level_low(spark):
    split = spark.createDataFrame([("x", "S", "1", 100, 200)], "id string, sample string, chrom string, start long, end long")
    none = spark.createDataFrame([], "sample string, chrom string, start2 long, end2 long")
    disc = spark.createDataFrame([("D", "S", "1", 90, 210)], "did string, sample string, chrom string, start2 long, end2 long")
    assert [(r["evidence_level"], r["evidence_types"], r["depth_support"]) for r in evidence.merge_evidence(split, none, disc).collect()] == [("Low", "Split,Discordant", False)]
