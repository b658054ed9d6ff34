import random

from strandline.operators.simulate import read_pairs
from strandline.sources import tables

TURN = str.maketrans("ACGT", "TGCA")


def test_pairs_come_from_their_sequence(spark, tmp_path):
    rng = random.Random(5)
    seqs = {"a": "".join(rng.choices("ACGT", k=900)), "b": "".join(rng.choices("acgtN", k=160)), "short": "ACGT"}
    df = spark.createDataFrame([(n, s, 40) for n, s in seqs.items()], "name string, seq string, fragments int")
    rows = read_pairs(df, 100, 300, 30).orderBy("name", "fragment").collect()
    assert [r["name"] for r in rows] == ["a"] * 40 + ["b"] * 40
    for r in rows:
        s = seqs[r["name"]].upper()[r["start0"] : r["start0"] + r["insert"]]
        assert len(s) == r["insert"] >= 100 and r["r1"] == s[:100] and r["r2"] == s[-100:].translate(TURN)[::-1]
    wrong = read_pairs(df.filter("name = 'a'"), 100, 300, 30, error_rate=0.1).orderBy("fragment").collect()
    share = sum(x != y for r, w in zip(rows, wrong) for x, y in zip(r["r1"], w["r1"], strict=True)) / 4000
    assert 0.07 < share < 0.13
    tables.write_fastq(read_pairs(df, 100, 300, 30), str(tmp_path / "out"))
    r1, r2 = (["\n".join(p.read_text() for p in sorted((tmp_path / "out" / d).glob("part-*"))).split("\n")] for d in ("R1", "R2"))
    ids = [[x[:-2] for x in side[0] if x.startswith("@")] for side in (r1, r2)]
    assert len(ids[0]) == 80 and ids[0] == ids[1]


def test_fasta_and_atlas(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">one extra\nacgt\nAC\n>two\nGG\n\n")
    fasta = tables.read_fasta(spark, str(tmp_path / "x.fa"))
    assert {r["name"]: r["seq"] for r in fasta.collect()} == {"one": "ACGTAC", "two": "GG"}
    cut = spark.createDataFrame([("one", 2, 4), ("two", 2, 9)], "chrom string, start int, end int")
    assert {r["chrom"]: r["seq"] for r in tables.fasta_regions(fasta, cut).collect()} == {"one": "CGT", "two": "G"}
    head = "\t".join(f'"{c}"' for c in ["Other", *tables.ATLAS_COLUMNS])
    (tmp_path / "a.tsv").write_text(head + '\nx\t"G1"\t"some gene"\tlow\t\n')
    assert [tuple(r) for r in tables.atlas_columns(spark, str(tmp_path / "a.tsv")).collect()] == [("G1", "some gene", "low", "")]
