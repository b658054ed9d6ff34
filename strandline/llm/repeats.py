"""Exact repeated passages by enhanced suffix arrays and their common-prefix interval trees.

A byte is removed if a string of ``min_bytes`` bytes that covers it also starts anywhere else. The suffixes of
a corpus are split into groups in which all equal strings of that length must meet, and each group
gets a suffix array with common-prefix lengths; a stack scan walks its interval tree, tests each interval's
left extensions for diversity, and gives the maximal repeats with all their occurrences.

Grouping: each string of min_bytes has one anchor, its leftmost smallest hashed gram (a minimizer), chosen by
content alone; equal strings have equal anchors at equal places. An anchor owns a run of consecutive starts,
whose text is its segment. Of equal segments one stands for all (if they lie in different places all their
starts repeat), so only different segments with a common anchor are compared:

* groups of at most ``group_limit`` segments are sorted into suffix arrays, many groups in one array;
* larger groups, which one task could not hold, are bisected: ranges of starts (relative to the anchor) are
  dropped if the bytes that all their strings share are unique, resolved if their whole text is the same
  elsewhere, and halved otherwise. Each level is an aggregation with map-side combine. Both ways are exact.

Equality is judged on 64-bit hashes of segments together with their anchors' hashes; whole texts are named by a
64-bit hash and their length. Whole copies count as repeats of each other.

Scale: anchors are about one per 2/(min_bytes - gram) bytes, numbers only; no task sees a group beyond the limit
or more than one text at a time. Spans are collected per text, which its length bounds.

Edge cases: null texts are empty; texts shorter than min_bytes lose nothing. Very long texts are read whole.
Repeated rows are copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import discard, others, small_batches, stash
from strandline.llm.order_minhash import MULTIPLIER, _powers, mix

BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
PART_BYTES = 1 << 17  #: of texts or segments a worker has at once (or one text or group, if larger); its arrays take some 250 times that
ANCHOR_SCHEMA = "k long, n long, pos long, lo long, hi long, anchor long, seg long"


def gram_of(min_bytes: int) -> int:
    return max(8, min_bytes // 6)


# ---- anchors ---------------------------------------------------------------------------------


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, in linear time."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).reshape(-1)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(texts: list[bytes], min_bytes: int) -> tuple[np.ndarray, ...]:
    """(text number, pos, lo, hi, anchor, seg) of the anchors of the texts; texts shorter than min_bytes have none."""
    gram = gram_of(min_bytes)
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < min_bytes:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    p, q = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUES[data] * p[:-1], dtype=np.uint64)])
    grams = mix((sums[gram:] - sums[:-gram]) * q[: len(data) - gram + 1])
    low_bits = np.uint64((1 << max(24, len(data).bit_length())) - 1)
    place = sliding_min((grams & ~low_bits) | np.arange(len(grams), dtype=np.uint64), min_bytes - gram + 1)
    place = (place & low_bits).astype(np.int64)
    windows = np.maximum(sizes - min_bytes + 1, 0)
    text = np.repeat(np.arange(len(texts)), windows)
    start = np.repeat(ends - sizes, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    own = place[start]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])])) if len(own) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(own)]])[: len(first)] - 1
    pos, lo, hi, text = own[first], start[first], start[last], text[first]
    seg = mix((sums[hi + min_bytes] - sums[lo]) * q[lo] + mix(((hi - lo) << 20 | (pos - lo)).astype(np.uint64)))
    begin = (ends - sizes)[text]
    return text, pos - begin, lo - begin, hi - begin, grams[pos].view(np.int64), seg.view(np.int64)


# ---- suffix arrays ---------------------------------------------------------------------------


def maximal_repeats(segments: list[bytes], min_bytes: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Maximal repeats of at least min_bytes in the segments: (length, segment numbers, starts in them).

    Suffixes are ranked by doubling prefixes and sorted by as many bytes as the longest segment has; the interval tree of
    their common-prefix lengths is walked with a stack. A segment's edge counts as an extension of its own.
    """
    sizes = np.array([len(x) for x in segments], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64)
    total = len(data)
    valid = np.maximum(sizes - min_bytes + 1, 0)
    suffix = np.repeat(ends - sizes, valid) + np.arange(valid.sum()) - np.repeat(np.cumsum(valid) - valid, valid)
    if not len(suffix):
        return []
    owner = np.repeat(np.arange(len(segments)), valid)
    h, rank, ranks = 4, np.zeros(total, np.int64), []
    padded = np.concatenate([data + 1, np.zeros(4, np.int64)])
    for j in range(4):
        rank = rank * 257 + padded[j : j + total]
    rank = np.unique(rank, return_inverse=True)[1]
    ranks.append((h, np.concatenate([rank + 1, [0]])))
    while h * 4 <= min_bytes:
        later = np.zeros(total, np.int64)
        later[: total - h] = rank[h:] + 1 if total > h else 0
        rank = np.unique(rank * (total + 1) + later, return_inverse=True)[1]
        h *= 2
        ranks.append((h, np.concatenate([rank + 1, [0]])))
    top = ranks[-1][1]
    reach = [np.minimum(suffix + i * h, total) for i in range(-(-int(sizes.max()) // h))]  # as deep as the longest segment
    order = np.lexsort([top[x] for x in reversed(reach)])
    sa, owner = suffix[order], owner[order]
    left, right = sa[:-1].copy(), sa[1:].copy()
    lcp, going = np.zeros(len(left), np.int64), np.ones(len(left), bool)
    for size, r in [*[(h, top)] * len(reach), *reversed(ranks[:-1])]:
        same = (r[np.minimum(left + lcp, total)] == r[np.minimum(right + lcp, total)]) & (np.maximum(left, right) + lcp + size <= total)
        if size == h:
            same &= going
            going = same
        lcp += np.where(same, size, 0)
    for _ in range(3):
        a, b = left + lcp, right + lcp
        ok = np.maximum(a, b) < total
        lcp += ok & (data[np.minimum(a, total - 1)] == data[np.minimum(b, total - 1)])  # stops by itself at a difference
    edge = ends[owner]
    lcp = np.minimum(lcp, np.minimum(edge[:-1] - left, edge[1:] - right))
    inside = sa > edge - sizes[owner]
    before = np.where(inside, data[sa - 1], -1 - np.arange(len(sa)))
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    found = []
    long = np.flatnonzero(lcp >= min_bytes)
    if not len(long):
        return []
    breaks = np.flatnonzero(np.diff(long) > 1)
    for a, b in zip(np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(long) - 1]]), strict=True):
        lo, hi = int(long[a]), int(long[b])  # lcp[lo .. hi] are long: suffixes lo .. hi + 1
        stack: list[tuple[int, int]] = []
        for i, depth in enumerate([*lcp[lo : hi + 1].tolist(), 0], lo):
            start = i
            while stack and stack[-1][0] > depth:
                value, start = stack.pop()
                if changes[i] != changes[start]:
                    found.append((value, start, i))
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, start))
    begin = ends - sizes
    return [(value, owner[i : j + 1], sa[i : j + 1] - begin[owner[i : j + 1]]) for value, i, j in found]


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Sorted, disjoint and not touching spans with the same cover; spans is (n, 2)."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    stop = np.maximum.accumulate(spans[:, 1])
    fresh = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > stop[:-1]]))
    return np.stack([spans[fresh, 0], stop[np.concatenate([fresh[1:], [len(spans)]]) - 1]], axis=1)


# ---- the operator ----------------------------------------------------------------------------


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("k", F.xxhash64(text)).withColumn("n", F.octet_length(text).cast("long"))


def _by_size(batch: pd.DataFrame, limit: int = PART_BYTES) -> Iterator[pd.DataFrame]:
    if len(batch):
        part = (batch["n"].cumsum() - 1) // limit
        for _, rows in batch.groupby(part, sort=False):
            yield rows


def anchor_rows(docs: DataFrame, min_bytes: int) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows in _by_size(batch):
                text, pos, lo, hi, anchor, seg = anchors([x.encode() for x in rows["text"]], min_bytes)
                yield pd.DataFrame({"k": rows["k"].to_numpy()[text], "n": rows["n"].to_numpy()[text], "pos": pos, "lo": lo, "hi": hi, "anchor": anchor, "seg": seg})

    return docs.filter(F.col("n") >= min_bytes).select("k", "n", "text").mapInPandas(work, ANCHOR_SCHEMA)


def segments_of(docs: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of the wanted segments (k, n, anchor, pos, lo, hi, size)."""
    by_text = wanted.groupBy(F.col("k").alias("wk"), F.col("n").alias("wn")).agg(F.collect_list(F.struct("anchor", "pos", "lo", "hi", "size")).alias("wanted"))
    by_text = stash(by_text, "wanted")
    joined = docs.select("k", "n", "text").join(by_text, (F.col("k") == F.col("wk")) & (F.col("n") == F.col("wn"))).select("k", "n", "text", "wanted")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = set()
        for batch in batches:
            for rows in _by_size(batch):
                out = []
                for k, n, text, wanted in rows.itertuples(index=False):
                    if (k, n) not in done:
                        done.add((k, n))
                        data = text.encode()
                        out += [(k, n, w["anchor"], w["pos"], w["lo"], w["hi"], w["size"], data[w["lo"] : w["hi"] + min_bytes]) for w in wanted]
                yield pd.DataFrame(out, columns=["k", "n", "anchor", "pos", "lo", "hi", "size", "bytes"])

    out = stash(joined.mapInPandas(cut, "k long, n long, anchor long, pos long, lo long, hi long, size long, bytes binary"), "segment-texts")
    discard(by_text)
    return out


def later_ones(rows: list[tuple], rank: np.ndarray, length: int, segment: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments, starts and stops of a repeat's occurrences but the first by (text, place), as far as they do not overlap that one."""
    place = start + np.array([rows[i][3] for i in segment])
    first = np.lexsort((place, rank[segment]))[0]
    begin = np.where(rank[segment] == rank[segment[first]], np.maximum(start, start + place[first] + length - place), start)
    other = (begin < start + length) & (np.arange(len(start)) != first)
    return segment[other], begin[other], (start + length)[other]


def sorted_groups(segments: DataFrame, min_bytes: int, keep_first: bool = False, batch_bytes: int = PART_BYTES) -> DataFrame:
    """Spans (k, n, start, stop) of repeats within groups, by suffix arrays over whole groups at a time."""

    def solve(rows: list[tuple]) -> pd.DataFrame:
        out = []
        texts = sorted({x[1:3] for x in rows})
        number = dict(zip(texts, range(len(texts)), strict=True))
        rank = np.array([number[x[1:3]] for x in rows])
        for length, segment, start in maximal_repeats([x[4] for x in rows], min_bytes):
            spans = later_ones(rows, rank, length, segment, start) if keep_first else (segment, start, start + length)
            out.append(np.stack(spans, axis=1))
        found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        found = found[np.argsort(found[:, 0], kind="stable")]
        spans = []
        for part in np.split(found, np.flatnonzero(np.diff(found[:, 0])) + 1) if len(found) else []:
            _, k, n, lo, _ = rows[part[0, 0]]
            spans += [(k, n, lo + a, lo + b) for a, b in merge_spans(part[:, 1:]).tolist()]
        return pd.DataFrame(spans, columns=["k", "n", "start", "stop"])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if size > batch_bytes and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(tuple(row))
                size += len(row[4])
        if rows:
            yield solve(rows)

    ordered = segments.select("anchor", "k", "n", "lo", "bytes").repartition("anchor").sortWithinPartitions("anchor", "k", "n", "lo")
    return ordered.mapInPandas(work, "k long, n long, start long, stop long")


def after_first(lo, stop, first, pos):
    """Start of what goes of the later occurrence [lo, stop) at anchor ``pos`` whose first one is at the anchor ``first``: what does not overlap that one."""
    own = (first["k"] == F.col("k")) & (first["n"] == F.col("n"))
    return F.when(own, F.greatest(lo, stop - pos + first["pos"])).otherwise(lo)


def bisected_groups(segments: DataFrame, min_bytes: int, keep_first: bool = False) -> DataFrame | None:
    """The same spans for groups of any size: ranges of starts, relative to the anchor, are halved level by level."""
    width = 1 << (min_bytes - 1).bit_length()
    schema = "k long, n long, anchor long, pos long, lo long, hi long, bytes binary, cell long, core long, whole long"

    def level(size: int):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import xxhash

            for batch in batches:
                out = []
                for k, n, anchor, pos, lo, hi, data in batch.itertuples(index=False):
                    for cell in range((pos - hi) // size, (pos - lo) // size + 1):
                        far, near = pos - (cell + 1) * size + 1, pos - cell * size  # the cell's first and last start
                        a, b = max(far, lo), min(near, hi)
                        part = data[a - lo : b - lo + min_bytes]
                        core = part[max(near - a, 0) : max(far + min_bytes - a, 0)]  # what all strings of the whole cell share
                        whole = xxhash.xxh3_64_intdigest(part, seed=(near - b) * width + a - far)
                        out.append((k, n, anchor, pos, a, b, part, cell, xxhash.xxh3_64_intdigest(core), whole))
                frame = pd.DataFrame(out, columns=["k", "n", "anchor", "pos", "lo", "hi", "bytes", "cell", "core", "whole"])
                for c in ("core", "whole"):
                    frame[c] = frame[c].astype("uint64").to_numpy().view(np.int64)
                yield frame

        return work

    rows, found, size = segments.select("k", "n", "anchor", "pos", "lo", "hi", "bytes"), [], width
    where = F.struct("k", "n", "pos")
    while size:
        cells = stash(rows.mapInPandas(level(size), schema), "cells")
        kinds = stash(cells.groupBy("anchor", "cell", "core", "whole").agg(F.min(where).alias("first"), F.max(where).alias("last")), "kinds")
        cores = stash(kinds.groupBy("anchor", "cell", "core").agg(F.count("*").alias("kinds"), F.max((F.col("first") != F.col("last")).cast("int")).alias("same")).filter("kinds > 1 or same = 1"), "cores")
        if cores.isEmpty():
            discard(cells, kinds, cores)
            break
        judged = kinds.join(cores, ["anchor", "cell", "core"])
        before, judged = (judged_before if found else None), stash(cells.join(judged.drop("same"), ["anchor", "cell", "core", "whole"]), "judged")
        discard(cells, kinds, cores, before)
        judged_before = judged
        stop = F.col("hi") + min_bytes
        hit = judged.filter("first <> last")
        if keep_first:
            hit = hit.filter(where != F.col("first")).withColumn("lo", after_first(F.col("lo"), stop, F.col("first"), F.col("pos")))
        found.append(stash(hit.select("k", "n", F.col("lo").alias("start"), stop.alias("stop")).filter("start < stop"), "found"))
        # one occurrence of each kind goes on, as a partner or to be resolved
        rows = judged.filter((F.col("kinds") > 1) & (where == F.col("first"))).select("k", "n", "anchor", "pos", "lo", "hi", "bytes")
        size //= 2
    out = None
    for x in found:
        out = x if out is None else out.union(x)
    return out


def repeated_spans(docs: DataFrame, min_bytes: int = 400, group_limit: int = 1024, keep_first: bool = False) -> DataFrame:
    """docs with k, n, text -> (k, n, spans): the spans of each different text that repeat, sorted and disjoint; written.

    keep_first leaves each repeat's first occurrence, by (k, n, place). Equal texts count as one text then.
    """
    rows = stash(anchor_rows(docs, min_bytes), "anchors")
    where = F.struct("k", "n", "pos", "lo", "hi")
    kinds = rows.groupBy("anchor", "seg").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    kinds = stash(kinds.withColumn("same", F.col("first") != F.col("last")), "segments")
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("size"), F.min("same").alias("all_same")).filter((F.col("size") > 1) & (F.lit(keep_first) | ~F.col("all_same")))
    groups = stash(groups.select("anchor", "size"), "groups")
    segments = segments_of(docs, kinds.join(groups, "anchor").select("anchor", "size", "first.*"), min_bytes)
    discard(groups)
    again = rows.join(kinds.filter("same").select("anchor", "seg", "first"), ["anchor", "seg"])
    start, stop = F.col("lo"), F.col("hi") + min_bytes
    if keep_first:
        again = again.filter(where != F.col("first"))
        start = after_first(start, stop, F.col("first"), F.col("pos"))
    parts = [stash(again.select("k", "n", start.alias("start"), stop.alias("stop")).filter("start < stop"), "same-segments")]
    discard(rows, kinds)
    parts.append(stash(sorted_groups(segments.filter(F.col("size") <= group_limit), min_bytes, keep_first), "sorted-spans"))
    large = stash(segments.filter(F.col("size") > group_limit), "large-groups")
    discard(segments)
    if not large.isEmpty() and (more := bisected_groups(large, min_bytes, keep_first)) is not None:
        parts.append(stash(more, "bisected-spans"))
    discard(large)
    spans = parts[0]
    for x in parts[1:]:
        spans = spans.union(x)
    if not keep_first:
        copies = docs.filter(F.col("n") >= min_bytes).groupBy("k", "n").count().filter("count > 1")
        spans = spans.union(copies.select("k", "n", F.lit(0).cast("long").alias("start"), F.col("n").alias("stop")))
    out = stash(spans.distinct().groupBy("k", "n").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans")), "spans")
    discard(*parts)
    return out


def _removed(docs: DataFrame, min_bytes: int, group_limit: int, kept_type: str, keep_first: bool = False) -> DataFrame:
    """(_row: the whole row, text, n, _has: something repeats, _cut: spans, kept); the row keeps any column names.

    Only texts in which something repeats go through Python; _cut is null for the rest. kept_type string drops
    the rest of a character that is cut through.
    """
    small_batches(docs.sparkSession)
    named = _identified(docs.select("text", F.struct("*").alias("_row")))
    spans = repeated_spans(named, min_bytes, group_limit, keep_first).withColumnsRenamed({"k": "sk", "n": "sn"})

    @F.pandas_udf(f"spans array<struct<start:long,stop:long>>, kept {kept_type}")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, all_spans in parts:
            out_spans, out_kept = [], []
            for text, found in zip(texts, all_spans, strict=True):
                if found is None:
                    out_spans.append(None)
                    out_kept.append(None)
                    continue
                data = text.encode()
                merged = merge_spans(np.array([(x["start"], x["stop"]) for x in found], np.int64).reshape(-1, 2))
                edges = [0, *merged.reshape(-1).tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out_kept.append(kept if kept_type == "binary" else kept.decode("utf-8", "ignore"))
                out_spans.append([{"start": a, "stop": b} for a, b in merged.tolist()])
            yield pd.DataFrame({"spans": out_spans, "kept": out_kept})

    cut = cut.asNondeterministic()  # else a filter on its result is pushed below and runs it a second time, in workers of its own
    has = F.col("sk").isNotNull()
    joined = named.join(spans, (F.col("k") == F.col("sk")) & (F.col("n") == F.col("sn")), "left")
    return joined.select("text", "_row", "n", has.alias("_has"), cut(F.when(has, F.col("text")), F.col("spans")).alias("_cut"))


def remove_repeats(docs: DataFrame, min_bytes: int = 400, group_limit: int = 1024) -> DataFrame:
    """docs (text, ...) -> the same columns, n_bytes, removed_spans (maximal), kept_bytes (binary), which replace columns of these names in any case."""
    out = _removed(docs, min_bytes, group_limit, "binary")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    spans, kept = F.coalesce("_cut.spans", none), F.coalesce("_cut.kept", F.coalesce("text", F.lit("")).cast("binary"))
    rest = [F.col(f"_row.`{c}`") for c in others(docs.columns, ("n_bytes", "removed_spans", "kept_bytes"))]
    return out.select(*rest, F.col("n").alias("n_bytes"), spans.alias("removed_spans"), kept.alias("kept_bytes"))


def drop_repeats(docs: DataFrame, min_bytes: int, group_limit: int = 1024, keep_first: bool = True) -> DataFrame:
    """docs with the repeats cut out of their texts (and n_chars set anew), but by default for their first occurrence, which stays in one
    text (the smallest by hash; equal texts count as one); documents of which no word is left go.

    A cut through a character drops the rest of that character.
    """
    changed = F.col("_has")
    out = _removed(docs, min_bytes, group_limit, "string", keep_first).withColumn("_text", F.when(changed, F.col("_cut.kept")).otherwise(F.col("text")))
    out = out.filter(~changed | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    columns = {"text": F.col("_text"), "n_chars": F.when(changed, F.length("_text").cast("long")).otherwise(F.col("_row.n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return out.select(*[columns[c].alias(c) if c in columns else F.col(f"_row.`{c}`") for c in docs.columns])
