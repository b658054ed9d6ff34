import pytest

from strandline.operators import reads, reports, simulate
from strandline.sources import tables


def test_order_of_tables(spark):
    rows = [("chr10", 1, 5, "a", "2"), ("chr2", 7, 9, "a", "10"), ("chr2", 7, 9, "a", "x"), ("chr2", 7, 9, "a", "9"), ("chrUn", 1, 2, "b", "1"), ("chrX", 1, 2, "b", "1"), ("MT", 1, 2, "c", "1"), ("2", 3, 4, "z", None)]
    exons = spark.createDataFrame([(c, s, e, g, "T", x) for c, s, e, g, x in rows], "chrom string, start long, end long, mane_gene string, transcript string, exon string")
    assert [(r["chrom"], r["exon"]) for r in reports.exon_order(exons).collect()] == [("2", None), ("chr2", "9"), ("chr2", "10"), ("chr2", "x"), ("chr10", "2"), ("chrX", "1"), ("MT", "1"), ("chrUn", "1")]
    assert reports.by_place(exons.limit(0), "mane_gene").collect() == []


def test_structures_and_missing_genes(spark):
    core = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), ("D",)], "gene string")
    mane = spark.createDataFrame([("A", "NM_1.1", 1), ("A", "NM_2.3", 2), ("B", "NM_3.1", 3), ("D", "NM_4.1", 4), ("E", "NM_5.1", 5)], "mane_gene string, transcript string, line long")
    parts = [("A", "NM_2", "exon", 50, 60), ("A", "NM_2", "exon", 10, 20), ("A", "NM_2", "CDS", 15, 20), ("A", "NM_1", "exon", 1, 2), ("B", "NM_9", "exon", 1, 2), ("D", "NM_4", "transcript", 5, 99), ("D", "NM_4", "exon", 7, 80)]
    parts = spark.createDataFrame([(g, t, f, "chr1", "+", s, e) for g, t, f, s, e in parts], "gene string, transcript string, feature string, chrom string, strand string, start long, end long")
    got = {r["gene"]: (r["tx_start"], r["tx_end"], r["n_exons"], r["n_utr5"], r["exons"], r["cds"]) for r in reports.gene_structures(core, mane, parts).collect()}
    assert got == {"A": (10, 60, 2, 0, "10-20,50-60", "15-20"), "D": (5, 99, 1, 0, "7-80", "")}
    assert sorted((r["category"], r["gene"]) for r in reports.missing_report(core, mane, parts).collect()) == [("Missing_GTF", "B"), ("Missing_MANE", "C")]


def test_window_labels(spark):
    rows = [("a", i, i + 9, f"W{i}", 0.5, "Del_window") for i in range(1, 34)] + [("a", 90, 99, "W90", 1.0, "Normal_window"), ("b", 1, 9, "W1", 1.0, "Normal_window"), ("c", 1, 9, "W1", None, "NA")]
    df = spark.createDataFrame(rows, "gene string, w_start long, w_end long, window_id string, ratio double, status string")
    got = {r["gene"]: r for r in reports.window_labels(df).collect()}
    lines = got["a"]["labels"].split("\n")
    assert (len(lines), lines[0], lines[1], lines[-1], got["a"]["n_labels"]) == (32, "Non-normal windows", "W1: 0.500", "... +3 more", 33)
    assert (got["b"]["labels"], got["c"]["labels"]) == ("Non-normal windows: none", "Non-normal windows\nW1: nan")
    assert [r["plot_index"] for r in reports.plot_index(df.filter("gene = 'a'")).orderBy("w_start").collect()] == list(range(1, 35))


def test_pair_counters_count_each_read_once(spark):
    base = {"sample": "S", "qname": "q", "flag": 33, "chrom": "1", "pos": 100, "mapq": 60, "cigar": "50M", "rnext": "=", "pnext": 700, "tlen": 650}
    odd = [{}, {}, {"rnext": "*"}, {"pnext": None}, {"mapq": 3}, {"flag": None}, {"flag": 1057}, {"rnext": "2"}, {"tlen": -650}, {"tlen": 499}, {"cigar": "50S"}, {"flag": 1}, {"pnext": 120}]
    rows = [tuple((base | x).values()) for x in odd]
    df = spark.createDataFrame(rows, "sample string, qname string, flag int, chrom string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long")
    got = {r["reason"]: r["n"] for r in reads.pair_counters(df).collect()}
    assert got == {"candidate_pairs": 1, "duplicate_pair": 1, "bad_sam": 5, "flag": 1, "mate_chrom": 1, "tlen_sign": 1, "insert_size": 1, "orientation": 1, "invalid_interval": 1}
    assert reads.discordant_pairs(df).count() == 1
    assert {r["reason"]: r["n"] for r in reads.pair_counters(df.limit(0)).collect()} == {"candidate_pairs": 0, "duplicate_pair": 0}


def test_truth_table(spark):
    genes = spark.createDataFrame([("A/1", "T", "chr1", "+", 1, 400, 3), ("B", "T", "chr1", "+", 9000, 1, 1), ("C", "T", "chr1", "-", 1, 149, 1), ("D", "T", "chr1", "-", 1, 180, 1)], "gene string, transcript string, chrom string, strand string, start long, end long, exon_count long")
    truth = simulate.sim_truth(genes, simulate.SIZE_BINS, 3, 30.0, 150)
    rows = truth.collect()
    assert len(truth.columns) == 30 and rows == simulate.sim_truth(genes, simulate.SIZE_BINS, 3, 30.0, 150).collect()
    assert {r["gene"] for r in rows} <= {"A/1", "B"} and len([r for r in rows if r["gene"] == "B"]) >= 18
    for r in rows:
        assert r["gene_start"] <= r["del_start"] <= r["del_end"] <= r["gene_end"]
        assert r["bin_min_size"] <= r["del_size_bp"] <= r["bin_max_size"] and r["del_haplotype_length"] >= 150
    assert any(r["r1_fastq"].startswith("simulated/SIM_A_1_DEL_50_100_rep") for r in rows)
    assert simulate.first_genes(genes, 1, ["gene"], 150).first()["gene"] == "A/1"


def test_gtf_parts(spark, tmp_path):
    lines = ["# c", 'chr1\tx\texon\t5\t9\t.\t+\t.\tgene_id "G"; transcript_id "NM_1.2"; exon_number "3";', 'chr1\tx\tCDS\t5\tnine\t.\t+\t.\tgene_id "G"; transcript_id "NM_1.2";', "chr1\tx\tCDS", 'chr1\tx\t5UTR\t1\t2\t.\t-\t.\tgene_id "I"; gene_name "H"; transcript_id "NM_2"; exon_id "e";', 'chr1\tx\tCDS\t1\t2\t.\t-\t.\tgene_id "I";']
    (tmp_path / "x.gtf").write_text("\n".join(lines) + "\n")
    got = sorted(map(tuple, tables.read_gtf_parts(spark, str(tmp_path / "x.gtf")).collect()))
    assert got == [("G", "NM_1", "NM_1.2", "exon", "chr1", "+", 5, 9, "3", "NM_1.2.3"), ("H", "NM_2", "NM_2", "5UTR", "chr1", "-", 1, 2, "NA", "e")]


@pytest.mark.parametrize(("path", "want"), [("a.clusters.tsv", "a.all_clusters.tsv"), ("d.x/a.tsv", "d.x/a.all_clusters.tsv"), ("a.txt", "a.txt.all_clusters.tsv")])
def test_derived_path(path, want):
    assert tables.derived_path(path, "all_clusters") == want
