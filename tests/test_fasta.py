"""FASTA index and regions against whole sequences in memory."""

import random

import pytest

from strandline.sources import fasta


def text_of(contigs, width, end):
    out = []
    for name, seq in contigs:
        out.append(f">{name} described{end}")
        out += [seq[i : i + width] + end for i in range(0, len(seq), width)]
    return "".join(out)


@pytest.mark.parametrize("width,end,split", [(60, "\n", 64 << 20), (7, "\n", 1000), (50, "\r\n", 333)])
def test_regions_equal_slices(spark, tmp_path, width, end, split):
    rng = random.Random(width)
    contigs = [("long", "".join(rng.choice("acgtN") for _ in range(5003))), ("none", ""), ("short", "ACG"), ("even", "acgt" * width)]
    (tmp_path / "x.fa").write_bytes(text_of(contigs, width, end).encode())
    path = str(tmp_path / "x.fa")
    index = fasta.fasta_index(spark, path, split)
    assert {(r["contig"], r["length"]) for r in index.collect()} == {(n, len(s)) for n, s in contigs}
    asked = [("long", a := rng.randint(1, 5100), a + rng.randint(0, 300)) for _ in range(40)] + [("long", 1, 9000), ("long", -5, 3), ("long", 9, 8), ("gone", 1, 2), ("none", 1, 2), ("short", 3, 3), ("short", 4, 9), ("even", 1, 4 * width), (None, 1, 2), ("short", None, 2)]
    known = dict(contigs)

    def want(c, a, b):
        found = "" if c not in known or a is None else known[c][max(a - 1, 0) : max(b, 0)].upper()
        return found or None

    got = fasta.fasta_regions(spark, path, spark.createDataFrame(asked, "contig string, start long, end long"), index).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(*r, want(*r)) for r in asked], key=str)


def test_uneven_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "bad.fa").write_text(">a\nACGT\nAC\nACGT\n")
    with pytest.raises(Exception, match="lines of different lengths in a"):
        fasta.fasta_index(spark, str(tmp_path / "bad.fa")).collect()
    (tmp_path / "empty.fa").write_text("")
    assert fasta.fasta_index(spark, str(tmp_path / "empty.fa")).count() == 0
    (tmp_path / "cut.fa").write_text(">a\nACGT\nAC")
    assert [r["length"] for r in fasta.fasta_index(spark, str(tmp_path / "cut.fa"), 4).collect()] == [6]
