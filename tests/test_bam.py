"""BAM: splits, index look-ups and the sorted sink against plain loops."""

import json
import random
import re

import pytest

from strandline.sources import bam

REFS = [("chr1", 3_000_000), ("chr2", 500_000), ("chrUn", 100)]
TYPES = "sample string, qname string, flag int, chrom string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, sa string"


def reads_of(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        chrom, length = rng.choice(REFS[:2])
        cigar = rng.choice(["100M", "50M3I47M", "30S70M", "20M5000N30M", "10M2D88M5H", "100="])
        out.append(("S", f"r{i}", rng.choice([99, 147, 1024]), chrom, rng.randint(1, length - 6000), rng.randint(0, 60), cigar, rng.choice(["=", "chr2", "*"]), rng.randint(0, 900), rng.randint(-500, 500), rng.choice([None, "chr2,5,+,50M50S,20,1;"])))
    out = [(*r[:7], "=" if r[7] == r[3] else r[7], *r[8:]) for r in out]
    return [*out, (None, "u1", 4, "*", 0, 0, "*", "*", 0, 0, None), ("S", "u2", 77, "*", 0, 0, "*", "*", 0, 0, None)]


def span(r):
    return r[4], r[4] + max(1, sum(int(n) for n, op in re.findall(r"(\d+)([A-Z=])", r[6]) if op in "MDN=X")) - 1


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bam") / "x.bam")
    reads = reads_of(4000)
    bam.write_bam(spark.createDataFrame(reads, TYPES), path, REFS, parts=5)
    return path, reads


def one_file(path, to, index):
    manifest = json.loads(bam.load(f"{path}/manifest.json"))
    to.write_bytes(b"".join(bam.load(f"{path}/{n}") for n in ("header.bgzf", *(p["name"] for p in manifest["parts"]), "end.bgzf")))
    if index:
        (to.parent / f"{to.name}.bai").write_bytes(bam.merged_index(path))
    return str(to)


REGIONS = [("chr1", 1, 200), ("chr1", 1_000_000, 1_000_900), ("chr1", 1_000_500, 1_020_000), ("chr2", 400_000, 500_000), ("chr7", 1, 9), ("chrUn", 1, 100)]


def over(reads, regions):
    return sorted((r for r in reads if r[3] != "*" and any(c == r[3] and span(r)[0] <= b and span(r)[1] >= a for c, a, b in regions)), key=str)


def test_round_trip_in_any_splits(spark, folder, tmp_path):
    path, reads = folder
    want = sorted(reads, key=str)
    whole = one_file(path, tmp_path / "y.bam", False)
    for place in (path, whole):
        for size in (700, 9_000, 1 << 25):
            assert rows(bam.read_bam(spark, place, split_bytes=size)) == want
    assert bam.read_bam(spark, whole, split_bytes=9_000).rdd.getNumPartitions() > 4


def test_parts_are_sorted_and_one_valid_gzip_file(spark, folder, tmp_path):
    import gzip

    path, reads = folder
    data = gzip.decompress(open(one_file(path, tmp_path / "z.bam", False), "rb").read())
    refs, at, places = {n: i for i, (n, _) in enumerate(REFS)}, len(bam.header_bytes("@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{x}\n" for n, x in REFS), REFS)), []
    while at < len(data):
        size, ref, pos = bam.struct.unpack_from("<iii", data, at)
        places.append((ref if ref >= 0 else 99, pos))
        at += 4 + size
    assert places == sorted(places) == sorted((refs.get(r[3], 99), r[4] - 1) for r in reads)


def test_regions_by_index_equal_a_scan(spark, folder, tmp_path):
    path, reads = folder
    for place in (path, one_file(path, tmp_path / "a.bam", True), one_file(path, tmp_path / "b.bam", False)):
        assert rows(bam.read_bam(spark, place, REGIONS)) == over(reads, REGIONS)
        assert bam.read_bam(spark, place, []).count() == 0
    rng = random.Random(3)
    for _ in range(3):
        some = [(c, a := rng.randint(1, 400_000), a + rng.randint(0, 30_000)) for c in ("chr1", "chr2") for _ in range(5)]
        assert rows(bam.read_bam(spark, path, some)) == over(reads, some)


def test_an_index_lookup_reads_little(folder):
    path, reads = folder
    reader = bam.BamReader({"path": path, "regions": json.dumps([("chr2", 100, 5_000)])})
    splits = reader.partitions()
    assert len(splits) < 5
    met = sum(1 for s in splits for _ in reader.records(s))
    assert len(over(reads, [("chr2", 100, 5_000)])) <= met < 500


def test_bins_hold_what_overlaps_them():
    rng = random.Random(5)
    for _ in range(500):
        a, c = rng.randint(0, 1 << 28), rng.randint(0, 1 << 28)
        b, d = a + rng.choice([1, 100, 1 << 20]), c + rng.choice([1, 1 << 15, 1 << 27])
        if a < d and b > c:
            assert bam.bin_of(a, b) in bam.bins_over(c, d)


def test_a_second_sort_changes_nothing(spark, folder, tmp_path):
    path, reads = folder
    again = str(tmp_path / "again.bam")
    bam.write_bam(bam.read_bam(spark, path).orderBy("qname"), again, REFS, parts=3)
    data = [b"".join(bam.zlib.decompress(x, 31) for x in blocks(one_file(p, tmp_path / f"{i}.bam", False))) for i, p in enumerate((path, again))]
    assert data[0] == data[1]


def blocks(path):
    data, at = open(path, "rb").read(), 0
    while at < len(data):
        n = bam.block_size(data, at)
        yield data[at : at + n]
        at += n


def test_filters_narrow_the_scan(spark, folder):
    path, reads = folder
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = bam.read_bam(spark, path, pushdown=True).filter("chrom = 'chr2' and pos >= 1000 and pos < 40000 and mapq > 20")
        assert rows(got) == sorted((r for r in reads if r[3] == "chr2" and 1000 <= r[4] < 40000 and r[5] > 20), key=str)
        reader = bam.PushedBamReader({"path": path})
        list(reader.pushFilters([bam.EqualTo(("chrom",), "chr2"), bam.GreaterThanOrEqual(("pos",), 1000), bam.LessThan(("pos",), 40000)]))
        assert reader.regions == [("chr2", 1000, 39999)]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_edges(spark, tmp_path):
    none, long = str(tmp_path / "none.bam"), str(tmp_path / "long.bam")
    bam.write_bam(spark.createDataFrame([], TYPES), none, REFS)
    assert bam.read_bam(spark, none).count() == 0 and bam.read_bam(spark, one_file(none, tmp_path / "n.bam", True), [("chr1", 1, 9)]).count() == 0
    big = [("S", f"q{i}", None, "chr1", 5 + i, None, None, None, None, None, "x" * 200_000) for i in range(3)]  # records of several blocks
    bam.write_bam(spark.createDataFrame([(*r, "more") for r in big], TYPES + ", extra string"), long, REFS, parts=1)
    want = [("S", f"q{i}", 0, "chr1", 5 + i, 0, "*", "*", 0, 0, "x" * 200_000) for i in range(3)]
    assert rows(bam.read_bam(spark, long, split_bytes=300)) == want and rows(bam.read_bam(spark, long, [("chr1", 6, 6)], sample="T")) == [("T", *want[1][1:])]
    with pytest.raises(Exception, match="not in the header: chr8"):
        bam.write_bam(spark.createDataFrame([("S", "q", 0, "chr8", 5, 0, "5M", "*", 0, 0, None)], TYPES), str(tmp_path / "bad.bam"), REFS)


def test_reads_cost_no_python_call_each(folder, tmp_path, monkeypatch):
    import sys
    import types

    import pyarrow as pa

    def calls(run):
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(1) if event == "call" else None)
        try:
            run()
        finally:
            sys.setprofile(None)
        return len(seen)

    path, reads = folder
    reader = bam.BamReader({"path": path})
    found = []
    assert calls(lambda: found.extend(b for s in reader.partitions() for b in reader.read(s))) < len(reads)
    assert sum(b.num_rows for b in found) == len(reads)
    monkeypatch.setattr(bam, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    writer = bam.BamWriter({"path": str(tmp_path / "w.bam"), "refs": json.dumps(REFS)})
    assert calls(lambda: writer.write(iter(found))) < len(reads)


def test_region_lookups_cost_no_python_call_each(folder):
    import sys

    path, reads = folder
    reader, seen = bam.BamReader({"path": path, "regions": json.dumps([("chr1", 1, 3_000_000)])}), []
    sys.setprofile(lambda frame, event, arg: seen.append(1) if event == "call" else None)
    try:
        found = [b.num_rows for s in reader.partitions() for b in reader.read(s)]
    finally:
        sys.setprofile(None)
    assert sum(found) == len(over(reads, [("chr1", 1, 3_000_000)])) and len(seen) < sum(found)
