"""Pattern packing by non-negative least squares.

Texts become token pieces of at most ``max_tokens``. Their length histogram (at most ``max_tokens``
bins) goes to the driver, where few-document patterns (one to three lengths, in units of ``unit``
tokens, that fill a sequence exactly) are enumerated and their repeat counts fitted to the histogram
by non-negative least squares; the counts are rounded and realised with actual lengths, and what is
left is packed by best fit, longest first, into the remaining space and new sequences. All of this works on counts, so
its cost does not depend on the number of documents. The plan maps (length, rank of the piece among its length) to
a sequence and an offset; ranks are made in two distributed steps.

Scale: tokenising is one map over the texts, which never enter a shuffle; small piece rows are
written once. Ranks use about sqrt(n) hash ranges per length, so a length that a third of all pieces
share is spread. The plan's size depends on the number of lengths, not on the documents.

Edge cases: null texts are empty; an empty text is its end token alone. Repeated rows and equal ids
are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import stash

BREAK = re.compile(r"(?<=\S)(?= )")
#: A blank or control character before a space (RE2): such texts are cut by BREAK, all others at each space.
ODD = r"[\s\v\x1c-\x1f\x85\p{Z}] "
#: A chunk that is empty or ends in a blank.
BLANK_END = r"(^|[\s\v\x1c-\x1f\x85\p{Z}])\z"
#: Chunks a worker keeps, at about 160 bytes each.
MEMO_SIZE = 800_000
#: Characters of texts encoded at once.
PART_CHARS = 4 << 20
#: Chunks encoded as one text: a call for each would cost as much as the merges.
JOINED = 4000


class Encoder:
    """Token ids, as little-endian unsigned 32-bit bytes, of texts under a tokenizers file.

    A byte-level BPE splits text before a space that follows a non-space, so chunks between such
    places are encoded apart, and each different chunk once: texts are split and their chunks numbered by Arrow, only
    different chunks pass through Python, and ids are gathered by number. A memo of at most ``memo_size`` chunks
    is kept by the worker, and emptied when full.
    """

    def __init__(self, path: str, memo_size: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)  # by id; a byte is one character of the vocabulary
        for token, i in vocab.items():
            self.n_bytes[i] = len(token)
        self.memo: dict[str, bytes] = {}  # by what follows the chunk's first space
        self.memo_size = memo_size

    def whole(self, texts: list[str]) -> list[bytes]:
        found = [array("I", x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for x in found:
                x.byteswap()
        return [x.tobytes() for x in found]

    def learn(self, rests: pa.Array) -> list[bytes]:
        """Puts the ids of " " + x into the memo and returns them. Those that end in a blank, which could join the next space, are encoded apart."""
        names = rests.to_numpy(zero_copy_only=False).tolist()
        apart = np.asarray(pc.match_substring_regex(rests, BLANK_END))
        whole, joined = np.flatnonzero(apart).tolist(), np.flatnonzero(~apart)
        found: list[bytes] = [b""] * len(names)
        for i, x in zip(whole, self.whole([" " + names[i] for i in whole]), strict=True):
            found[i] = x
        sizes, row = np.asarray(pc.binary_length(rests), np.int64) + 1, joined.tolist()
        for at in range(0, len(row), JOINED):
            part = row[at : at + JOINED]
            ids = self.whole([" " + " ".join([names[i] for i in part])])[0]
            stops = (4 * np.searchsorted(np.cumsum(self.n_bytes[np.frombuffer(ids, "<u4")]), np.cumsum(sizes[part])) + 4).tolist()
            for i, lo, hi in zip(part, [0, *stops], stops, strict=False):
                found[i] = ids[lo:hi]
        self.memo.update(zip(names, found, strict=True))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        own = pa.array(texts, pa.large_string())
        odd = np.asarray(pc.match_substring_regex(own, ODD))
        lists = pc.split_pattern(own, " ")
        if odd.any():
            cut = [BREAK.split(x) for x in own.filter(pa.array(odd)).to_pylist()]
            parts = lists.to_pylist()
            for i, (first, *rest) in zip(np.flatnonzero(odd).tolist(), cut, strict=True):
                parts[i] = [first, *(x[1:] for x in rest)]
            lists = pa.array(parts, pa.large_list(pa.large_string()))
        begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        heads = np.zeros(begin[-1], bool)
        heads[begin[:-1]] = True
        flat = lists.flatten()
        first = self.whole(flat.filter(pa.array(heads)).to_pylist())
        chunks = flat.filter(pa.array(~heads)).dictionary_encode()
        known, number = chunks.dictionary, chunks.indices.to_numpy()
        if len(self.memo) > self.memo_size:
            self.memo.clear()
        ids = list(map(self.memo.get, known.to_numpy(zero_copy_only=False).tolist()))
        fresh = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(fresh, self.learn(known.take(pa.array(fresh, pa.int64()))), strict=True):
            ids[i] = x
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ids, start = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(n) - n
        each = n[number]
        stop = np.cumsum(each)
        ids = ids[np.repeat(start[number] - stop + each, each) + np.arange(stop[-1] if len(stop) else 0)]
        edge = np.concatenate([[0], stop])[begin - np.arange(len(begin))].tolist()
        return [head + ids[i:j].tobytes() for head, i, j in zip(first, edge, edge[1:], strict=False)]


@functools.lru_cache(maxsize=2)
def encoder(path: str, memo_size: int) -> Encoder:
    return Encoder(path, memo_size)


def by_size(batch: pd.DataFrame, limit: int) -> Iterator[pd.DataFrame]:
    """Runs of rows whose texts have about ``limit`` characters."""
    if len(batch):
        for _, rows in batch.groupby(batch["text"].str.len().cumsum() // limit, sort=False):
            yield rows


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 0, memo_size: int = MEMO_SIZE, part_chars: int = PART_CHARS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, piece, start, length, ids_crc32; only the first piece may be shorter."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in by_size(batch, part_chars):
                rows = []
                for doc_id, ids in zip(part["doc_id"], encoder(tokenizer, memo_size).encode(part["text"].tolist()), strict=True):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % max_tokens + 1
                    for piece, start in enumerate([0, *range(first, n, max_tokens)]):
                        own = ids[4 * start : 4 * (first if piece == 0 else start + max_tokens)]
                        rows.append((doc_id, piece, start, len(own) // 4, zlib.crc32(own)))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = texts.mapInPandas(pieces, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """min |ax - b| over x >= 0 by the active set method (Lawson and Hanson)."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tol = 1e-10 * max(1.0, np.abs(b).max(initial=0))
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[active] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= tol:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if s.min(initial=1) > 0:
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            step = np.min(x[at][low] / (x[at][low] - s[low] + 1e-300))
            x[at] += step * (s - x[at])
            active[at[x[at] <= 1e-14]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def exact_patterns(units: int, depth: int) -> list[tuple[int, ...]]:
    """All non-increasing tuples of at most ``depth`` positive unit counts with the sum ``units``."""

    def more(left: int, most: int, depth: int) -> Iterator[tuple[int, ...]]:
        if 0 < left <= most:
            yield (left,)
        if depth > 1:
            for first in range(min(most, left - 1), 0, -1):
                if first * depth < left:
                    break
                for rest in more(left - first, first, depth - 1):
                    yield (first, *rest)

    return list(more(units, units, depth))


def plan_packing(counts: np.ndarray, max_tokens: int = 2048, unit: int = 8, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """counts by length (0 .. max_tokens) -> [(lengths of one sequence, repeats)]; uses every piece once."""
    left = counts.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[max_tokens]:
        plan.append(((max_tokens,), int(left[max_tokens])))
        left[max_tokens] = 0
    units = max_tokens // unit
    of = -(-np.arange(max_tokens + 1) // unit)
    histogram = np.bincount(of, weights=left, minlength=units + 1)
    patterns = [p for p in exact_patterns(units, depth) if all(histogram[u] for u in p)]
    open_bins: list[list] = []
    if patterns:
        a = np.zeros((units + 1, len(patterns)))
        for j, p in enumerate(patterns):
            for u in p:
                a[u, j] += 1
        fitted = nnls(a, histogram / histogram.sum()) * histogram.sum()
        for j in np.argsort(-fitted, kind="stable"):
            p, have = patterns[j], np.bincount(of, weights=left, minlength=units + 1)
            repeats = min([int(fitted[j] + 0.5), *(int(have[u]) // p.count(u) for u in p)])
            slots = []
            for u in p if repeats > 0 else ():
                runs, need = [], repeats  # the longest of the unit first
                for length in range(min(u * unit, max_tokens), (u - 1) * unit, -1):
                    take = min(need, int(left[length]))
                    if take:
                        runs.append([length, take])
                        left[length] -= take
                        need -= take
                slots.append(runs)
            while slots and slots[0]:
                n = min(runs[0][1] for runs in slots)
                open_bins.append([tuple(runs[0][0] for runs in slots), n])
                for runs in slots:
                    runs[0][1] -= n
                    if not runs[0][1]:
                        runs.pop(0)
    free: list[list[list]] = [[] for _ in range(max_tokens + 1)]
    for lengths, n in open_bins:
        free[max_tokens - sum(lengths)].append([lengths, n])
    for length in range(max_tokens, 0, -1):
        need = int(left[length])
        space = length
        while need and space <= max_tokens:
            if not free[space]:
                space += 1
                continue
            lengths, n = free[space][-1]
            take = min(n, need)
            free[space][-1][1] -= take
            if not free[space][-1][1]:
                free[space].pop()
            free[space - length].append([(*lengths, length), take])
            need -= take
            space = max(length, space - length) if space - length >= length else space
        if need:
            each = max_tokens // length
            for copies, n in ((each, need // each), (need % each, 1)):
                if copies and n:
                    free[max_tokens - copies * length].append([(length,) * copies, n])
    return plan + [(tuple(lengths), n) for groups in free for lengths, n in groups]


def slot_table(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by (length, rank): sorted keys of intervals of ranks, with first rank, first sequence and offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 48) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def rank_in_length(pieces: DataFrame, n: int) -> DataFrame:
    """Adds rank (from 0) among the pieces of the same length, by hash order."""
    ranges = max(1, math.isqrt(n))
    rows = pieces.withColumn("hash", F.xxhash64("doc_id", "piece", "ids_crc32")).withColumn("range", F.pmod("hash", F.lit(ranges)))
    order = Window.partitionBy("length", "range").orderBy("hash", "doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("at", F.row_number().over(order) - 1)
    ahead = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("range", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(ranges))).groupBy("length", "range").count()
    starts = starts.select("length", "range", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    return rows.join(starts, ["length", "range"]).withColumn("rank", F.col("before") + F.col("at")).drop("hash", "range", "at", "before")


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 0, unit: int = 8, depth: int = 3, memo_size: int = MEMO_SIZE, part_chars: int = PART_CHARS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset. memo_size and part_chars trade memory for speed only."""
    pieces = stash(token_pieces(docs, tokenizer, max_tokens, end_id, memo_size, part_chars), "pieces")
    counts = np.zeros(max_tokens + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most max_tokens rows
        counts[row["length"]] = row["count"]
    slots = slot_table(plan_packing(counts, max_tokens, unit, depth))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            at = np.searchsorted(slots["key"], (x["length"].to_numpy() << 48) + x["rank"].to_numpy(), side="right") - 1
            x["sequence_id"] = slots["sequence"][at] + x["rank"] - slots["rank"][at]
            x["offset"] = slots["offset"][at]
            yield x.drop(columns="rank")

    ranked = rank_in_length(pieces, int(counts.sum())).select(F.col("doc_id").cast("string").alias("doc_id"), "piece", "start", "length", "ids_crc32", "rank")
    out = ranked.mapInPandas(place, "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
