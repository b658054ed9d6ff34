"""BAM as a Spark data source: split or indexed scans, and a sorted, indexed sink whose parts concatenate.

Reading (format ``bam``): a file is dealt to byte ranges. A range begins at the first BGZF block behind its start, and there at the first place from which records follow one
another; it owns the records that begin in its blocks. With ``regions`` and an index (``.bai`` beside the file, or the parts' own) only the chunks that the index
names are read; each read that overlaps any region comes once. With ``pushdown`` equality and ranges on chrom and pos narrow the scan in the same way.

Writing: ``write_bam`` deals reads to ranges of (reference, position), sorted, unmapped ones last; each task writes one part of BGZF blocks and that part's index (bins
and 16-kilobase windows). A manifest names the parts that were committed, with their extent on each reference, so a scan by region opens only
parts that can hold a read. ``header.bgzf``, the parts in order and ``end.bgzf`` are one valid BAM file; ``merged_index`` is its index, made from the parts' without reading them.

The driver holds the header, the regions asked for and one entry a part. Paths are those that pyarrow can open from every executor.

Edge cases: reads without reference or position are unmapped and are found by whole scans only. Null text is ``*``, null numbers are 0. An empty table gives a header
and no parts. Extra columns are not written. A reference that the header does not name is an error, and so is a file cut off within a record.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

SCHEMA = "sample string, qname string, flag int, chrom string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, sa string"
ARROW = pa.schema([(c, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for c, t in (x.split() for x in SCHEMA.split(", "))])
OPS = "MIDNSHP=X"  # CIGAR letters by code
TAKES = {"M", "D", "N", "=", "X"}  # those that advance on the reference
HEAD = struct.Struct("<iiBBHHHiiii")  # of a record, behind its size
HEADS = np.dtype("<i4, <i4, <i4, u1, u1, <u2, <u2, <u2, <i4, <i4, <i4, <i4")
HEADS.names = "size ref pos n_name mapq bin n_ops flag n_seq mate mate_pos tlen".split()
BLOCK = 65280  # bytes of data in a block
LEVELS = [(1, 26), (9, 23), (73, 20), (585, 17), (4681, 14)]  # first bin and shift of each level below the whole reference
WINDOW = 14  # shift of the linear index
READ = 1 << 18  # bytes of a file read at once
STRETCH = 1 << 20  # bytes of data whose records are read at once


# ---- blocks ----------------------------------------------------------------------------------


def block_of(data: bytes) -> bytes:
    """One BGZF block: a gzip member that tells its own size."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def block_size(data: bytes, at: int) -> int:
    """Size of the block that begins at a place, 0 if none does."""
    if data[at : at + 4] != b"\x1f\x8b\x08\x04" or len(data) < at + 18:
        return 0
    extra, at = struct.unpack_from("<H", data, at + 10)[0], at + 12
    end = at + extra
    while at + 4 <= min(end, len(data)):
        kind, n = data[at : at + 2], struct.unpack_from("<H", data, at + 2)[0]
        if kind == b"BC" and n == 2 and at + 6 <= len(data):
            return struct.unpack_from("<H", data, at + 4)[0] + 1
        at += 4 + n
    return 0


class Blocks:
    """Sequential reading of a file's blocks from a known block start, as one growing buffer of data with the block of each stretch."""

    def __init__(self, file: pa.NativeFile, size: int, at: int):
        self.file, self.size, self.next = file, size, at
        self.data = bytearray()
        self.raw, self.raw_at = b"", 0
        self.starts: list[tuple[int, int]] = []  # (place in data, place of the block in the file)

    def more(self) -> bool:
        """Appends the next block's data; False at the end of the file."""
        if self.next >= self.size:
            return False
        if self.next < self.raw_at or min(self.next + (1 << 16), self.size) > self.raw_at + len(self.raw):
            self.raw, self.raw_at = self.file.read_at(min(READ, self.size - self.next), self.next), self.next
        raw = self.raw[self.next - self.raw_at : self.next - self.raw_at + (1 << 16)]
        n = block_size(raw, 0)
        if not n or n > len(raw):
            raise ValueError(f"no whole BGZF block at byte {self.next}")
        self.starts.append((len(self.data), self.next))
        self.data += zlib.decompress(raw[12 + struct.unpack_from("<H", raw, 10)[0] : n - 8], -15)
        self.next += n
        return True

    def need(self, n: int) -> bool:
        while len(self.data) < n:
            if not self.more():
                return False
        return True

    def drop(self, at: int) -> int:
        """Forgets data before ``at``; the new place of it."""
        keep = max((i for i, (p, _) in enumerate(self.starts) if p <= at), default=0)
        cut = self.starts[keep][0] if self.starts else 0
        del self.data[:cut]
        self.starts = [(p - cut, b) for p, b in self.starts[keep:]]
        return at - cut

    def place(self, offset: int) -> int:
        """The first place in data, as far as it is there, that is not before a virtual offset."""
        p, b = next((x for x in self.starts if x[1] >= offset >> 16), (len(self.data), None))
        return p + (offset & 0xFFFF) if b == offset >> 16 else p


def first_block(file: pa.NativeFile, size: int, at: int) -> int:
    """The first block that begins at or behind a byte: its header is there, and another block or the end follows it."""
    while at < size:
        raw = file.read_at(min(1 << 18, size - at), at)
        for found in re.finditer(rb"\x1f\x8b\x08\x04", raw):
            n = block_size(raw, found.start())
            if n and (at + found.start() + n == size or block_size(file.read_at(min(64, size - at - found.start() - n), at + found.start() + n), 0)):
                return at + found.start()
        at += max(1, len(raw) - 17)
    return size


# ---- records ---------------------------------------------------------------------------------


def header_bytes(text: str, refs: list[tuple[str, int]]) -> bytes:
    out = [b"BAM\1", struct.pack("<i", len(text.encode())), text.encode(), struct.pack("<i", len(refs))]
    for name, length in refs:
        out.append(struct.pack(f"<i{len(name) + 1}si", len(name) + 1, name.encode() + b"\0", length))
    return b"".join(out)


def read_header(blocks: Blocks) -> tuple[list[tuple[str, int]], int]:
    """(references, place of the first record in data)."""

    def number(at: int) -> int:
        if not blocks.need(at + 4):
            raise ValueError("the header is cut off")
        return struct.unpack_from("<i", blocks.data, at)[0]

    n_text = number(4)
    if bytes(blocks.data[:4]) != b"BAM\1":
        raise ValueError("not a BAM file")
    at, refs = 12 + n_text, []
    for _ in range(number(8 + n_text)):
        n = number(at)
        length = number(at + 4 + n)
        refs.append((bytes(blocks.data[at + 4 : at + 3 + n]).decode(), length))
        at += 8 + n
    return refs, at


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds [begin, end)."""
    for first, shift in reversed(LEVELS):
        if begin >> shift == (end - 1) >> shift:
            return first + (begin >> shift)
    return 0


def bins_over(begin: int, end: int) -> set[int]:
    """All bins that overlap [begin, end)."""
    return {0}.union(*(range(first + (begin >> shift), first + ((end - 1) >> shift) + 1) for first, shift in LEVELS))


def bins_of(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``bin_of`` of many."""
    out = np.zeros(len(begin), np.int64)
    for first, shift in LEVELS:
        out = np.where(begin >> shift == (end - 1) >> shift, first + (begin >> shift), out)
    return out


@functools.lru_cache(1 << 16)
def cigar_bytes(text: str) -> tuple[bytes, int]:
    """(operations, bases of the reference)."""
    ops = [(int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", text)]
    return b"".join(struct.pack("<I", n << 4 | OPS.index(op)) for n, op in ops), sum(n for n, op in ops if op in TAKES)


@functools.lru_cache(1 << 16)
def cigar_text(data: bytes) -> tuple[str, int]:
    """(text, bases of the reference)."""
    ops = [(o >> 4, OPS[o & 15]) for (o,) in struct.iter_unpack("<I", data)]
    return "".join(f"{n}{op}" for n, op in ops) or "*", sum(n for n, op in ops if op in TAKES)


def by_value(column: pa.Array, made) -> tuple[list, np.ndarray]:
    """(made(value) of each different value, the number of each row's)."""
    found = column.dictionary_encode()
    return [made(x) for x in found.dictionary.to_pylist()], found.indices.to_numpy()


def packed(batch: pa.RecordBatch, refs: dict[str, int]) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """(records with their sizes, reference or -1, begin, end) of rows; places from 0."""
    text = lambda c, none: pc.fill_null(batch.column(c), none)
    number = lambda c: pc.fill_null(batch.column(c), 0).to_numpy().astype(np.int64)
    known, at = by_value(text("chrom", "*"), lambda x: -1 if x == "*" else refs[x])
    ref = np.array(known, np.int64)[at]
    known, at = by_value(text("rnext", "*"), lambda x: {"*": -1, "=": -2}[x] if x in ("*", "=") else refs[x])
    mate = np.array(known, np.int64)[at]
    known, at = by_value(text("cigar", ""), cigar_bytes)
    ops, length = pa.array([x[0] for x in known], pa.binary()).take(pa.array(at)), np.array([x[1] for x in known], np.int64)[at]
    begin = number("pos") - 1
    end = begin + np.maximum(1, length)
    name, sep = text("qname", "*").cast(pa.binary()), pa.scalar(b"", pa.binary())
    tags = []
    for key, c in ((b"RGZ", "sample"), (b"SAZ", "sa")):
        tags.append(pc.fill_null(pc.binary_join_element_wise(pa.scalar(key), batch.column(c).cast(pa.binary()), pa.scalar(b"\0"), sep), b""))
    n_name, n_ops = pc.binary_length(name).to_numpy().astype(np.int64) + 1, pc.binary_length(ops).to_numpy().astype(np.int64) // 4
    size = 32 + n_name + 4 * n_ops + sum(pc.binary_length(x).to_numpy().astype(np.int64) for x in tags)
    fields = [size, ref, begin, n_name, number("mapq"), bins_of(np.maximum(begin, 0), np.maximum(end, 1)), n_ops, number("flag"), np.zeros(len(ref), np.int64), np.where(mate == -2, ref, mate), number("pnext") - 1, number("tlen")]
    heads = np.zeros(len(ref), HEADS)
    for field, values in zip(HEADS.names, fields, strict=True):
        heads[field] = values
        if (heads[field] != values).any():
            raise ValueError(f"{field} does not fit a record")
    head = pa.Array.from_buffers(pa.binary(HEADS.itemsize), len(ref), [None, pa.py_buffer(heads)]).cast(pa.binary())
    return pc.binary_join_element_wise(head, name, pa.scalar(b"\0"), ops, *tags, sep), np.where(begin >= 0, ref, -1), begin, end


def slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.BinaryArray:
    """Stretches of data."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    own = data[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(own)])


SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_SIZE = np.array([SIZES.get(chr(i), 0) for i in range(256)])


def text_tags(data: np.ndarray, at: np.ndarray, end: np.ndarray, names: list[str]) -> dict[str, pa.Array]:
    """Text tags of records whose tags are at [at, end), null where there is none; all records go one tag on at a time."""
    at, zeros, live = at.copy(), np.flatnonzero(data == 0), np.flatnonzero(at + 3 <= end)
    begins, lengths = ({n: np.full(len(at), k) for n in names} for k in (-1, 0))
    while len(live):
        a = at[live]
        kind, v = data[a + 2], a + 3
        then = v + _SIZE[kind]
        texts = np.flatnonzero((kind == ord("Z")) | (kind == ord("H")))
        stops = zeros[np.minimum(np.searchsorted(zeros, v[texts]), len(zeros) - 1)] if len(texts) else v[:0]
        then[texts] = np.where(stops >= v[texts], stops + 1, 0)
        lists = np.flatnonzero(kind == ord("B"))
        counts = sum(data[v[lists] + 1 + i].astype(np.int64) << 8 * i for i in range(4))
        then[lists] = v[lists] + 5 + _SIZE[data[v[lists]]] * counts
        if (then <= v).any() or (then > end[live]).any():
            raise ValueError("a tag of unknown type, or cut off")
        for n in names:
            own = texts[(data[a[texts]] == ord(n[0])) & (data[a[texts] + 1] == ord(n[1]))]
            begins[n][live[own]], lengths[n][live[own]] = v[own], then[own] - 1 - v[own]
        at[live] = then
        live = live[then + 3 <= end[live]]
    return {n: pc.if_else(pa.array(begins[n] >= 0), slices(data, begins[n], lengths[n]), pa.scalar(None, pa.binary())).cast(pa.string()) for n in names}


def plausible(data: bytearray, at: int, n_refs: int) -> int:
    """Where the record that might begin at a place ends, 0 if none can."""
    size = struct.unpack_from("<i", data, at)[0]
    ref, pos, n_name, _, _, n_ops, _, n_seq, mate, mate_pos, _ = HEAD.unpack_from(data, at + 4)
    least = 32 + n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq
    if not (n_name and n_seq >= 0 and least <= size < 1 << 28 and -1 <= ref < n_refs and -1 <= mate < n_refs and pos >= -1 and mate_pos >= -1):
        return 0
    name = data[at + 36 : at + 36 + n_name]
    return at + 4 + size if not len(name) == n_name or name[-1] == 0 and all(33 <= c < 127 for c in name[:-1]) else 0


def first_record(blocks: Blocks, n_refs: int, chain: int = 8) -> int | None:
    """The first place in data from which ``chain`` records follow one another, or all up to the file's end."""
    at = 0
    while blocks.need(at + 36):
        here, seen = at, 0
        while seen < chain:
            if not blocks.need(here + 36):
                break
            here = plausible(blocks.data, here, n_refs)
            if not here:
                break
            seen += 1
            if not blocks.need(here):
                here = 0
                break
        if here and (seen == chain or here == len(blocks.data)):
            return at
        at += 1
    return None


# ---- index -----------------------------------------------------------------------------------


class Index:
    """Bins with chunks, and the least offset of each window, by reference."""

    def __init__(self):
        self.bins: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.windows: dict[int, dict[int, int]] = {}
        self.extent: dict[int, tuple[int, int]] = {}

    def add(self, ref: np.ndarray, begin: np.ndarray, end: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        """Places and virtual offsets of mapped records that begin in one block; they come in the order of the file."""
        where = ref << 16 | bins_of(begin, end)
        kinds, first = np.unique(where, return_index=True)
        last = len(where) - 1 - np.unique(where[::-1], return_index=True)[1]
        for k, x, y in zip(kinds.tolist(), start[first].tolist(), stop[last].tolist(), strict=True):
            chunks = self.bins.setdefault(k >> 16, {}).setdefault(k & 0xFFFF, [])
            if chunks and chunks[-1][1] >> 16 == x >> 16:  # goes on in the same block
                chunks[-1] = (chunks[-1][0], y)
            else:
                chunks.append((x, y))
        low, high = begin >> WINDOW, end - 1 >> WINDOW
        kinds, first = np.unique(ref << 32 | low, return_index=True)
        for i in np.union1d(first, np.flatnonzero(high > low)).tolist():
            windows = self.windows.setdefault(int(ref[i]), {})
            for w in range(int(low[i]), int(high[i]) + 1):
                windows.setdefault(w, int(start[i]))
        for r in np.unique(ref).tolist():
            a, b = int(begin[ref == r].min()), int(end[ref == r].max())
            low, high = self.extent.get(r, (a, b))
            self.extent[r] = (min(low, a), max(high, b))

    def merge(self, other: Index, shift: int) -> None:
        """Adds the index of what follows, ``shift`` bytes behind the begin."""
        shift <<= 16
        for ref, bins in other.bins.items():
            for b, chunks in bins.items():
                self.bins.setdefault(ref, {}).setdefault(b, []).extend((x + shift, y + shift) for x, y in chunks)
        for ref, windows in other.windows.items():
            for w, x in windows.items():
                self.windows.setdefault(ref, {}).setdefault(w, x + shift)

    def chunks(self, ref: int, begin: int, end: int) -> list[tuple[int, int]]:
        """Ranges of virtual offsets that hold all records over [begin, end), and others."""
        windows = self.windows.get(ref, {})
        least = min((x for w, x in windows.items() if w >= begin >> WINDOW), default=None)
        own = self.bins.get(ref, {})
        return [] if least is None else [(max(x, least), y) for b in bins_over(begin, end) & own.keys() for x, y in own[b] if y > least]

    def dump(self, n_refs: int) -> bytes:
        """In the public .bai layout."""
        out = [b"BAI\1", struct.pack("<i", n_refs)]
        for ref in range(n_refs):
            bins, windows = self.bins.get(ref, {}), self.windows.get(ref, {})
            out.append(struct.pack("<i", len(bins)))
            for b in sorted(bins):
                out.append(struct.pack(f"<Ii{2 * len(bins[b])}Q", b, len(bins[b]), *(x for c in bins[b] for x in c)))
            last, line = 0, []
            for w in range(max(windows, default=-1) + 1):
                last = windows.get(w, last)
                line.append(last)
            out.append(struct.pack(f"<i{len(line)}Q", len(line), *line))
        return b"".join(out)

    @classmethod
    def load(cls, data: bytes) -> Index:
        out, at = cls(), 8
        for ref in range(struct.unpack_from("<i", data, 4)[0]):
            n, at = struct.unpack_from("<i", data, at)[0], at + 4
            for _ in range(n):
                b, k = struct.unpack_from("<Ii", data, at)
                flat, at = struct.unpack_from(f"<{2 * k}Q", data, at + 8), at + 8 + 16 * k
                if b < 37450:  # others are counters
                    out.bins.setdefault(ref, {})[b] = list(zip(flat[::2], flat[1::2], strict=True))
            n, at = struct.unpack_from("<i", data, at)[0], at + 4
            out.windows[ref] = dict(enumerate(struct.unpack_from(f"<{n}Q", data, at)))
            at += 8 * n
        return out


def joined(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges in order, so each record is read once."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(chunks):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out


# ---- the source ------------------------------------------------------------------------------


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def load(path: str) -> bytes:
    system, at = opened(path)
    with system.open_input_stream(at) as f:
        return f.read()


def there(path: str) -> int | None:
    """Size of a file, None if there is none."""
    system, at = opened(path)
    found = system.get_file_info(at)
    return found.size if found.type == fs.FileType.File else None


@dataclass
class Split(InputPartition):
    path: str
    index: str | None  # of the file, if the regions are looked up
    begin: int  # bytes of the file whose blocks are owned
    end: int
    headed: bool  # the file has a header of its own


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.sample = options["path"].rstrip("/"), options.get("sample")
        self.split_bytes = int(options.get("splitbytes", 32 << 20))
        self.regions: list[tuple[str, int, int]] | None = [(c, int(a), int(b)) for c, a, b in json.loads(options["regions"])] if "regions" in options else None

    @functools.cached_property
    def manifest(self) -> dict:
        return json.loads(load(f"{self.path}/manifest.json"))

    @functools.cached_property
    def refs(self) -> list[tuple[str, int]]:
        """Names and lengths; read again by each task, as what the driver has found out does not travel."""
        if (size := there(self.path)) is None:
            return [(n, x) for n, x in self.manifest["refs"]]
        system, at = opened(self.path)
        with system.open_input_file(at) as f:
            return read_header(Blocks(f, size, 0))[0]

    def overlapping(self) -> dict[int, list[tuple[int, int]]]:
        """Regions by reference number, as [begin, end) from 0."""
        number, out = {name: i for i, (name, _) in enumerate(self.refs)}, {}
        for chrom, a, b in self.regions or []:
            if chrom in number and a <= b:
                out.setdefault(number[chrom], []).append((max(a - 1, 0), b))
        return out

    def partitions(self) -> list[InputPartition]:
        files = []  # (path, size, index, headed)
        if (size := there(self.path)) is not None:
            index = next((x for x in (f"{self.path}.bai", re.sub(r"\.bam$", ".bai", self.path)) if x != self.path and there(x) is not None), None)
            files.append((self.path, size, index, True))
        else:
            asked = self.overlapping()
            for part in self.manifest["parts"]:
                extent = {int(r): x for r, x in part["extent"].items()}
                if self.regions is None or any(a < extent[r][1] and b > extent[r][0] for r, own in asked.items() if r in extent for a, b in own):
                    files.append((f"{self.path}/{part['name']}", part["bytes"], f"{self.path}/{part['name']}.bai", False))
        out: list[InputPartition] = []
        for path, size, index, headed in files:
            if self.regions is not None and index:
                out.append(Split(path, index, 0, size, headed))
            else:
                out += [Split(path, None, at, min(at + self.split_bytes, size), headed) for at in range(0, size, self.split_bytes)]
        return out or [Split(self.path, None, 0, 0, False)]

    def stretches(self, split: Split) -> Iterator[tuple[bytes, list[int]]]:
        """The records that begin in the split's blocks, or in the chunks of its index, as data and their places in it."""
        size = there(split.path)
        if not split.end or size is None:
            return
        system, at = opened(split.path)
        with system.open_input_file(at) as file:
            if split.index:
                index = Index.load(load(split.index))
                ranges = joined([c for ref, own in self.overlapping().items() for a, b in own for c in index.chunks(ref, a, b)])
            else:
                ranges = [(first_block(file, size, split.begin) << 16, split.end << 16)]
            for begin, end in ranges:
                blocks = Blocks(file, size, begin >> 16)
                if begin >> 16 >= size or begin >= end:
                    continue
                if split.index:
                    place = begin & 0xFFFF
                elif begin == 0 and split.headed:
                    place = read_header(blocks)[1]
                else:
                    place = first_record(blocks, len(self.refs)) if begin else 0
                while place is not None:
                    while len(blocks.data) - place < STRETCH and blocks.next << 16 < end and blocks.more():
                        pass
                    data, stop, at, found = blocks.data, blocks.place(end), place, []
                    whole = len(data)
                    while at < stop and at + 4 <= whole:
                        then = at + 4 + int.from_bytes(data[at : at + 4], "little", signed=True)
                        if then > whole:
                            break
                        if then < at + 36:
                            raise ValueError("a record is too short")
                        found.append(at - place)
                        at = then
                    if found:
                        yield bytes(data[place:at]), found
                    if at < stop and not blocks.more():
                        raise ValueError("a record is cut off")
                    if at >= stop and (blocks.next << 16 >= end or blocks.next >= size):
                        break
                    place = blocks.drop(at)

    def records(self, split: Split) -> Iterator[bytes]:
        """The records of ``stretches``, one by one, without their sizes."""
        for data, starts in self.stretches(split):
            for a, b in zip(starts, [*starts[1:], len(data)], strict=True):
                yield data[a + 4 : b]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        names = pa.array([*(n for n, _ in self.refs), "*", "="])
        none, same = len(names) - 2, len(names) - 1
        asked = {r: np.array(joined(own)) for r, own in self.overlapping().items()} if self.regions is not None else None
        for raw, places in self.stretches(split):
            data, starts = np.frombuffer(raw, np.uint8), np.array(places)
            ends = np.append(starts[1:], len(data))
            x = data[starts[:, None] + np.arange(HEADS.itemsize)].view(HEADS)[:, 0]
            wide = lambda c, x=x: x[c].astype(np.int64)
            ops = starts + HEADS.itemsize + wide("n_name")
            known, at = by_value(slices(data, ops, 4 * wide("n_ops")), cigar_text)
            if asked is not None:
                pos = wide("pos")
                end = pos + np.maximum(1, np.array([n for _, n in known], np.int64)[at])
                keep = np.zeros(len(x), bool)
                for r, own in asked.items():
                    rows = np.flatnonzero((x["ref"] == r) & (pos >= 0))
                    first = np.searchsorted(own[:, 1], pos[rows], "right")  # the first region that ends behind it
                    keep[rows] = np.append(own[:, 0], np.iinfo(np.int64).max)[first] < end[rows]
                x, starts, ends, ops, at = x[keep], starts[keep], ends[keep], ops[keep], at[keep]
            ref, mate, wide = x["ref"], x["mate"], lambda c, x=x: x[c].astype(np.int64)
            tags = text_tags(data, ops + 4 * wide("n_ops") + (wide("n_seq") + 1) // 2 + wide("n_seq"), ends, ["RG", "SA"])
            columns = [
                pa.array([self.sample] * len(x), pa.string()) if self.sample else tags["RG"], slices(data, starts + HEADS.itemsize, wide("n_name") - 1).cast(pa.string()), pa.array(x["flag"].astype(np.int32)),
                names.take(pa.array(np.where(ref >= 0, ref, none))), pa.array(wide("pos") + 1), pa.array(x["mapq"].astype(np.int32)), pa.array([c for c, _ in known], pa.string()).take(pa.array(at)),
                names.take(pa.array(np.where((mate == ref) & (ref >= 0), same, np.where(mate >= 0, mate, none)))), pa.array(wide("mate_pos") + 1), pa.array(wide("tlen")), tags["SA"],
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=ARROW)


class PushedBamReader(BamReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrows the regions; all filters stay with Spark too, as a region also finds reads that begin before it."""
        chroms, low, high = None, 1, 1 << 29
        for f in filters:
            if f.__class__ in (EqualTo, In) and f.attribute == ("chrom",):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                chroms = own if chroms is None else chroms & own
            elif getattr(f, "attribute", None) == ("pos",):
                low = max(low, f.value + isinstance(f, GreaterThan)) if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)) else low
                high = min(high, f.value - isinstance(f, LessThan)) if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)) else high
            yield f
        if chroms is not None and "*" not in chroms:
            own = [(c, low, high) for c in sorted(c for c in chroms if c is not None)]
            self.regions = own if self.regions is None else [r for r in self.regions if r[0] in chroms]


@dataclass
class Part(WriterCommitMessage):
    name: str | None
    bytes: int = 0
    number: int = 0
    extent: dict | None = None


class BamWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.refs = [(n, int(x)) for n, x in json.loads(options["refs"])]

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        number = TaskContext.get().partitionId()
        refs, index, name = {n: i for i, (n, _) in enumerate(self.refs)}, Index(), None
        system, root = opened(self.path)
        file, at, data = None, 0, bytearray()
        for batch in batches:
            if not batch.num_rows:
                continue
            if file is None:
                name = f"part-{number:05d}-{uuid.uuid4().hex[:8]}.bgzf"
                system.create_dir(root, recursive=True)
                file = system.open_output_stream(f"{root}/{name}")
            records, ref, begin, end = packed(batch, refs)
            raw, edges = memoryview(records.buffers()[2]), np.frombuffer(records.buffers()[1], np.int32)[: len(records) + 1].astype(np.int64)
            i = 0
            while i < len(records):
                k = int(np.searchsorted(edges, edges[i] + BLOCK - len(data), "right")) - 1  # records up to here fit the block
                if k <= i and data:
                    at += file.write(block_of(bytes(data)))
                    data.clear()
                    continue
                k = max(k, i + 1)
                place = (at << 16 | len(data)) - edges[i]
                start, stop = place + edges[i:k], place + edges[i + 1 : k + 1]
                data += raw[edges[i] : edges[k]]
                while len(data) > BLOCK:  # a record of more than one block
                    at += file.write(block_of(bytes(data[:BLOCK])))
                    del data[:BLOCK]
                    stop = np.array([at << 16 | min(len(data), BLOCK)])
                mapped = ref[i:k] >= 0
                if mapped.any():
                    index.add(*(c[i:k][mapped] for c in (ref, begin, end)), start[mapped], stop[mapped])
                i = k
        if file is None:
            return Part(None)
        at += file.write(block_of(bytes(data))) if data else 0
        file.close()
        with system.open_output_stream(f"{root}/{name}.bai") as f:
            f.write(index.dump(len(self.refs)))
        return Part(name, at, number, {str(r): list(x) for r, x in index.extent.items()})

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = opened(self.path)
        system.create_dir(root, recursive=True)
        text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{x}\n" for n, x in self.refs)
        head = header_bytes(text, self.refs)
        blocks = b"".join(block_of(head[i : i + BLOCK]) for i in range(0, len(head), BLOCK))
        parts = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.number)
        manifest = {"refs": self.refs, "header_bytes": len(blocks), "parts": [{"name": m.name, "bytes": m.bytes, "extent": m.extent} for m in parts]}
        for name, data in (("header.bgzf", blocks), ("end.bgzf", block_of(b"")), ("manifest.json", json.dumps(manifest).encode())):
            with system.open_output_stream(f"{root}/{name}") as f:
                f.write(data)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = opened(self.path)
        for m in messages:
            if isinstance(m, Part) and m.name:
                system.delete_file(f"{root}/{m.name}")


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (PushedBamReader if self.options.get("pushdown") == "true" else BamReader)(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BamWriter(dict(self.options))


def read_bam(spark: SparkSession, path: str, regions: list[tuple[str, int, int]] | None = None, sample: str | None = None, split_bytes: int = 32 << 20, pushdown: bool = False) -> DataFrame:
    """Reads of a BAM file, or of a folder of write_bam, that overlap any of the regions (chrom, start, end; closed, from 1), or all of them.

    ``sample`` is the sample column, else the read group. ``pushdown`` needs spark.sql.python.filterPushdown.enabled.
    """
    spark.dataSource.register(BamSource)
    found = spark.read.format("bam").option("splitbytes", split_bytes).option("pushdown", str(pushdown).lower())
    found = found if regions is None else found.option("regions", json.dumps(regions))
    return (found if sample is None else found.option("sample", sample)).load(path)


def write_bam(reads: DataFrame, path: str, refs: list[tuple[str, int]], parts: int | None = None) -> None:
    """Reads as a new folder of sorted parts with indexes; ``refs`` are names and lengths of all references, in order. Equal places are in the order of all columns."""
    spark = reads.sparkSession
    spark.dataSource.register(BamSource)
    order = {name: i for i, (name, _) in enumerate(refs)}
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair]) if order else F.lit(None)
    mapped = F.col("chrom").isNotNull() & (F.col("chrom") != "*")
    rank = F.when(mapped, F.coalesce(ranks[F.col("chrom")], F.raise_error(F.concat(F.lit("not in the header: "), "chrom")).cast("int")) if order else F.lit(0)).otherwise(F.lit(1 << 30))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    rows = reads.select(*[(F.col(c) if c in reads.columns else F.lit(None)).cast(t).alias(c) for c, t in (x.split() for x in SCHEMA.split(", "))]).withColumn("_rank", rank)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one number that orders nearly all rows comes first, so few are compared by their texts
    rows = rows.withColumn("_place", F.col("_rank").cast("long") * (1 << 32) + F.least(F.greatest(F.coalesce("pos", F.lit(0)), F.lit(0)), F.lit((1 << 31) - 1)))
    by = ["_place", "pos", *[c for c in names if c not in ("pos", "chrom")]]
    rows.repartitionByRange(n, *by).sortWithinPartitions(*by).select(*names).write.format("bam").option("refs", json.dumps(refs)).mode("append").save(path)


def merged_index(path: str) -> bytes:
    """The .bai of header, parts and end as one file, from the parts' indexes: one part's at a time, and what a reference's bins and windows take."""
    manifest, out = json.loads(load(f"{path}/manifest.json")), Index()
    at = manifest["header_bytes"]
    for part in manifest["parts"]:
        out.merge(Index.load(load(f"{path}/{part['name']}.bai")), at)
        at += part["bytes"]
    return out.dump(len(manifest["refs"]))
