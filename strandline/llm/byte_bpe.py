"""Byte-level BPE by ranks: vectorised pre-tokenisation, cached pair merging, and decoding.

Texts are cut as the public pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` cuts them, without a
regular expression: an array gives the class of every code point (with one code point of look-ahead), each class is a
transition function on nine states, and the state before every code point comes from a scan of those functions, whose composition
is associative. All functions that compositions can reach form a small monoid, so the scan is look-ups of numbers in its
table: blocks of a batch are scanned side by side, their results among themselves, and both are joined.

The slices between boundaries are numbered by Arrow, and only different ones that the worker does not remember are merged: pairs of least
rank first, leftmost first, as all slices of a batch in numpy rounds, or with a heap for long slices.

Scale: one map over the texts, no shuffle. The vocabulary (a file whose size does not depend on the input) is read by each worker; its memo of at
most ``memo_size`` slices is emptied when full. Offsets of tokens go with the ids, so any run of tokens can be found in the text.

Edge cases: null and empty texts have no ids, and decode to no bytes. Very long texts are read whole, a long slice in n log n steps. Repeated rows and
equal or null ids are encoded each. Columns other than doc_id and text are not carried, so names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

MEMO_SIZE = 400_000
LONG = 64  # bytes; longer slices are merged one by one with a heap
#: Code points with the property White_Space.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters and numbers that Unicode 16 adds, which the interpreter's own data may lack.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
# Classes: a blank before a non-space, other white space before a non-space, white space before white space or the end, numbers, other,
# an apostrophe, s t m d, the first of "re" "ve" "ll", other letters.
BLANK, LAST, WHITE_RUN, NUMBER, OTHER, QUOTE, SHORT, PAIR, LETTER = range(9)
# States: nothing before; in letters, numbers, other, white space; after a blank that joins what follows; after an apostrophe that begins a slice;
# inside a suffix; after a whole slice.
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_WHITE, JOINING, QUOTED, SUFFIX, WHOLE = range(9)
NONE = np.int64(1) << 62


def step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point of class ``kind``, and whether a slice begins at it."""
    if kind == BLANK:
        return JOINING, True
    if kind == LAST:
        return WHOLE, True
    if kind == WHITE_RUN:
        return IN_WHITE, state != IN_WHITE
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, JOINING)
    if kind in (OTHER, QUOTE):
        inside = state in (IN_OTHER, JOINING, QUOTED)
        return (IN_OTHER if inside or kind == OTHER else QUOTED), not inside
    if state == SUFFIX or state == QUOTED and kind == SHORT:
        return WHOLE, False
    if state == QUOTED and kind == PAIR:
        return SUFFIX, False
    return IN_LETTERS, state not in (IN_LETTERS, JOINING)


@functools.lru_cache(maxsize=1)
def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the classes' functions, of those after a text's begin, composition table, functions as rows), and whether a slice begins, by state and class.

    The functions are closed under composition.
    """
    own = [tuple(step(s, kind)[0] for s in range(9)) for kind in range(9)]
    fresh = [tuple([step(BEGIN, kind)[0]] * 9) for kind in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys([*own, *fresh]))}
    queue = list(known)
    while queue:
        f = queue.pop()
        for g in list(known):
            for both in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if both not in known:
                    known[both] = len(known)
                    queue.append(both)
    rows = np.array(list(known), np.uint8)
    then = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], np.uint16)  # [first, second]
    begins = np.array([[step(s, kind)[1] for kind in range(9)] for s in range(9)])
    return np.array([known[f] for f in own], np.uint16), np.array([known[f] for f in fresh], np.uint16), then, rows, begins


def composed(functions: np.ndarray, then: np.ndarray, width: int = 512) -> np.ndarray:
    """For each place, the number of the composition of all functions up to it."""
    n = len(functions)
    if n <= width:
        out = functions.copy()
        for i in range(1, n):
            out[i] = then[out[i - 1], out[i]]
        return out
    blocks = -(-n // width)
    grid = np.concatenate([functions, np.zeros(blocks * width - n, functions.dtype)]).reshape(blocks, width).T.copy()
    flat, m = then.reshape(-1), then.shape[1]
    for i in range(1, width):
        grid[i] = flat[grid[i - 1].astype(np.intp) * m + grid[i]]
    before = composed(grid[-1], then, width)[:-1].astype(np.intp)  # all earlier blocks
    grid[:, 1:] = flat[before[None, :] * m + grid[:, 1:]]
    return grid.T.reshape(-1)[:n]


@functools.lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The class of every code point, without look-ahead."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            out[c] = LETTER if major == "L" else NUMBER
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for a, b in ranges:
            out[a : b + 1] = kind
    out[WHITE] = WHITE_RUN
    out[ord("'")] = QUOTE
    out[[ord(c) for c in "stmd"]] = SHORT
    return out


def boundaries(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Whether a slice begins at each code point; ``heads`` are the places where texts begin (none empty)."""
    if not len(points):
        return np.zeros(0, bool)
    own, fresh, then, rows, begins = machine()
    kind = kinds()[points]
    inner = np.ones(len(points), bool)  # has a next code point in its text
    inner[heads[1:] - 1] = inner[-1] = False
    after = np.append(points[1:], 0)
    white = kind == WHITE_RUN
    last = white & inner & ~np.append(white[1:], False)
    kind[last] = np.where(points[last] == 0x20, BLANK, LAST)
    r, v, e, small_l = map(ord, "rvel")
    kind[inner & (((points == r) | (points == v)) & (after == e) | (points == small_l) & (after == small_l))] = PAIR
    functions = own[kind]
    functions[heads] = fresh[kind[heads]]
    states = rows[:, BEGIN][composed(functions, then)]
    before = np.append(np.uint8(BEGIN), states[:-1])
    before[heads] = BEGIN
    return begins.reshape(-1)[before.astype(np.intp) * 9 + kind]


class Ranks:
    """A vocabulary of ranks (lines of base64 and number), with merging and decoding."""

    def __init__(self, path: str, memo_size: int = MEMO_SIZE):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        words: list[bytes] = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for word, i in self.ranks.items():
            words[i] = word
        self.words = pa.array(words, pa.binary())
        self.sizes = np.array([len(x) for x in words], np.int64)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for word, i in self.ranks.items():
            for cut in range(1, len(word)):
                a, b = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self.keys = np.array([*sorted(pairs), NONE], np.int64)
        self.merged = np.array([*(pairs[x] for x in sorted(pairs)), NONE], np.int64)
        self.memo: dict[bytes, bytes] = {}
        self.memo_size = memo_size

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that each pair of ids merges to, NONE where it does not merge."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one slice: a heap of (rank, place) over a linked list."""
        ranks, n = self.ranks, len(piece)
        stop, back = [*range(1, n + 1)], [*range(-1, n - 1)]  # end and predecessor of the part that begins at a place
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if stop[i] < 0 or stop[i] >= n or stop[stop[i]] != end:
                continue  # one of its parts is merged already
            gone = stop[i]
            stop[i], stop[gone] = end, -1
            if end < n:
                back[end] = i
                if (r := ranks.get(piece[i : stop[end]])) is not None:
                    heapq.heappush(heap, (r, i, stop[end]))
            if i and (r := ranks.get(piece[back[i] : end])) is not None:
                heapq.heappush(heap, (r, back[i], end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : stop[i]]])
            i = stop[i]
        return out

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit numbers, of slices; a merge of each slice a round."""
        out: list[bytes] = [b""] * len(pieces)
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.append(np.where(owner[1:] == owner[:-1], self.rank(ids[:-1], ids[1:]), NONE), NONE)[: len(ids)]  # of each part with the next one
        while len(ids):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            low = np.minimum.reduceat(rank, first)
            ends = np.append(first[1:], len(ids))
            done = low == NONE
            for i, j in zip(first[done].tolist(), ends[done].tolist(), strict=True):
                out[owner[i]] = ids[i:j].astype("<u4").tobytes()
            each = np.repeat(low, ends - first)
            hit = np.flatnonzero((rank == each) & (rank != NONE))
            hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])] if len(hit) else hit  # leftmost
            ids[hit] = rank[hit]
            stays = each != NONE
            stays[hit + 1] = False
            hit = np.cumsum(stays)[hit] - 1
            ids, owner, rank = ids[stays], owner[stays], rank[stays]
            for at in (hit, hit[hit > 0] - 1):  # only pairs with the new part change
                then = np.minimum(at + 1, len(ids) - 1)
                rank[at] = np.where((then > at) & (owner[at] == owner[then]), self.rank(ids[at], ids[then]), NONE)
        return out

    def learn(self, pieces: list[bytes]) -> None:
        """Puts the ids of slices into the memo."""
        hard = []
        for x in pieces:
            i = self.ranks.get(x)
            if i is not None:
                self.memo[x] = i.to_bytes(4, "little")
            elif len(x) > LONG:
                self.memo[x] = np.array(self.merge_long(x), "<u4").tobytes()
            else:
                hard.append(x)
        self.memo.update(zip(hard, self.merge_many(hard), strict=True))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, the byte of its own text at which each token begins, ends of the texts among the ids)."""
        data = b"".join(texts)
        raw = np.frombuffer(data, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(lengths) - lengths
        places = np.flatnonzero((raw & 0xC0) != 0x80)  # of code points
        points = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
        heads = np.searchsorted(places, begin[lengths > 0])
        cuts = places[boundaries(points, heads)]
        offsets = np.append(cuts, len(raw)).astype(np.int32)
        slices = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]).dictionary_encode()
        known, number = slices.dictionary.to_pylist(), slices.indices.to_numpy()
        if len(self.memo) > self.memo_size:
            self.memo.clear()
        self.learn([x for x in known if x not in self.memo])
        found = [self.memo[x] for x in known]
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, start = np.frombuffer(b"".join(found), "<u4"), np.cumsum(n) - n
        each = n[number]
        stop = np.cumsum(each)
        ids = pool[np.repeat(start[number] - stop + each, each) + np.arange(stop[-1] if len(stop) else 0)]
        ends = np.append(0, stop)[np.searchsorted(cuts, begin + lengths)]
        sizes = self.sizes[ids]
        at = np.cumsum(sizes) - sizes - np.repeat(begin, np.diff(ends, prepend=0))
        return ids, at, ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids, runs given by their ends."""
        text = self.words.take(pa.array(ids, pa.int32()))
        edges = np.append(0, np.cumsum(self.sizes[ids]))[np.append(0, ends)]
        whole = b"".join(text.to_pylist()) if not len(text) else text.buffers()[2].to_pybytes()
        return [whole[i:j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, memo_size: int = MEMO_SIZE) -> Ranks:
    return Ranks(path, memo_size)


def parts(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of rows of about ``limit`` bytes."""
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    return (slice(i, j) for i, j in zip(edges, edges[1:], strict=False) if i < j)


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, ranks: str, memo_size: int = MEMO_SIZE, part_bytes: int = 1 << 20) -> DataFrame:
    """docs (doc_id, text) -> doc_id, ids (array of int), starts (array of int: the byte of the UTF-8 text at which each token begins)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for own in parts(np.fromiter(map(len, texts), np.int64, len(texts)), part_bytes):
                ids, at, ends = vocabulary(ranks, memo_size).encode(texts[own])
                yield pa.RecordBatch.from_arrays([batch.column(0)[own], lists(ids.astype(np.int32), ends), lists(at, ends)], ["doc_id", "ids", "starts"])

    numbers = ArrayType(IntegerType())
    fields = [docs.select("doc_id").schema[0], StructField("ids", numbers), StructField("starts", numbers)]
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, StructType(fields))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """encoded (doc_id, ids) -> doc_id, ids, decoded (binary); null ids decode to no bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            edges = ids.offsets.to_numpy()
            texts = vocabulary(ranks).decode(ids.values.to_numpy()[edges[0] : edges[-1]], edges[1:] - edges[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(work, StructType([*rows.schema.fields, StructField("decoded", BinaryType())]))
