"""Interval joins, unions, coverage and differences on closed intervals."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strandline.functions.genome import overlap_length


def in_bins(df: DataFrame, bin_size: int, start: str = "start", end: str = "end") -> DataFrame:
    """A row for each bin that [start, end] touches, with the bin's number in _bin; reversed and null intervals touch none."""
    at = lambda c: F.floor(F.col(c) / bin_size)
    return df.filter(F.col(start) <= F.col(end)).withColumn("_bin", F.explode(F.sequence(at(start), at(end))))


def binned_pairs(left: DataFrame, right: DataFrame, keys: tuple[str, ...], bin_size: int, more: Column | None = None) -> DataFrame:
    """Overlapping pairs with _bin, each in the first bin that both touch: the shuffle is by keys and bin, so crowded keys spread.

    Sort-merge even where a side is small: the work is the pairs, and a broadcast would leave them to as many tasks as the other side has files.
    ``more`` is a further condition on start, end, start2, end2, judged inside the join.
    """
    a, b = in_bins(left, bin_size), in_bins(right, bin_size, "start2", "end2")
    b = b.withColumnsRenamed({c: f"_r_{c}" for c in (*keys, "_bin")})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    on += [F.col("_bin") == F.col("_r__bin"), F.col("start") <= F.col("end2"), F.col("end") >= F.col("start2")]
    on += [F.col("_bin") == F.greatest(F.floor(F.col("start") / bin_size), F.floor(F.col("start2") / bin_size))]
    if more is not None:
        on.append(more)
    return a.hint("merge").join(b, on).drop("_r__bin", *[f"_r_{k}" for k in keys])


LEAST, STEP = 6, 3  # level k has bins of 2 ** (LEAST + STEP * k) bases
FAR = 2  # levels further apart than this meet in bins that many levels below the longer one's


def level_of(start: Column, end: Column) -> Column:
    """The level whose bins are as long as the interval, up to eight times as long."""
    return F.greatest(F.lit(0), F.ceil((F.log2(end - start + 1) - LEAST) / STEP)).cast("int")


def meeting_level(a: Column, b: Column) -> Column:
    """Where intervals of two levels meet: the longer one is then dealt to 65 bins at most, the shorter one to two."""
    top = F.greatest(a, b)
    return F.when(F.abs(a - b) <= FAR, top).otherwise(top - FAR)


def in_levels(df: DataFrame, levels: Column, start: str, end: str) -> DataFrame:
    """A row for each bin that [start, end] touches on the levels where it meets intervals of ``levels`` (an array), with _own (its level), _level and _bin."""
    own = df.filter(F.col(start) <= F.col(end)).withColumn("_own", level_of(F.col(start), F.col(end)))
    dealt = own.withColumn("_level", F.explode(F.array_distinct(F.transform(levels, lambda k: meeting_level(F.col("_own"), k)))))
    at = lambda c: F.call_function("shiftright", F.col(c).cast("long"), LEAST + STEP * F.col("_level"))
    return dealt.withColumn("_bin", F.explode(F.sequence(at(start), at(end))))


def level_pairs(left: DataFrame, right: DataFrame, keys: tuple[str, ...], more: Column | None = None) -> DataFrame:
    """Overlapping pairs of left (keys, start, end) and right (keys, start2, end2), each once, whatever mix of lengths there is.

    Intervals have the level of their length, and two meet on one level, in the first bin that both touch there. A few long intervals so meet many short ones in up to 65 bins
    for each two of the long one's, and not in one. Which levels the other side has (at most twenty numbers) is a scalar subquery of the plan: nothing runs before the join does.
    """
    present = lambda df, s, e: df.filter(F.col(s) <= F.col(e)).agg(F.collect_set(level_of(F.col(s), F.col(e)))).scalar()
    a = in_levels(left.withColumn("_levels", present(right, "start2", "end2")), F.col("_levels"), "start", "end").drop("_levels")
    b = in_levels(right.withColumn("_levels", present(left, "start", "end")), F.col("_levels"), "start2", "end2").drop("_levels")
    b = b.withColumnsRenamed({c: f"_r_{c}" for c in (*keys, "_bin", "_level", "_own")})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    on += [F.col("_level") == F.col("_r__level"), F.col("_bin") == F.col("_r__bin"), F.col("start") <= F.col("end2"), F.col("end") >= F.col("start2")]
    first = F.call_function("shiftright", F.greatest("start", "start2").cast("long"), LEAST + STEP * F.col("_level"))
    on += [F.col("_level") == meeting_level(F.col("_own"), F.col("_r__own")), F.col("_bin") == first]
    if more is not None:
        on.append(more)
    return a.hint("merge").join(b, on).drop("_own", "_level", "_bin", "_r__own", "_r__level", "_r__bin", *[f"_r_{k}" for k in keys])


def interval_join(left: DataFrame, right: DataFrame, how: str = "inner", keys: tuple[str, ...] = ("chrom",), bin_size: int | None = None) -> DataFrame:
    """Joins left (keys, start, end) with right (keys, start2, end2) on null-safe keys and overlap, in bins: of
    bin_size, or where it is not given of levels by length. A left row's fate in
    ``left_semi``, ``left_anti`` and ``left`` depends on its keys, start and end alone, so those are matched once
    and joined back.
    """
    pairs = binned_pairs(left, right, keys, bin_size) if bin_size else level_pairs(left, right, keys)
    if how == "inner":
        return pairs.select(*left.columns, *[c for c in right.columns if c not in keys])
    place = [*keys, "start", "end"]
    met = pairs.select(*[F.col(c).alias(f"_m_{c}") for c in place]).distinct()
    on = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in place]
    if how in ("left_semi", "left_anti"):
        return left.join(met, on, how)
    alone = left.join(met, on, "left_anti")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in right.dtypes if c not in keys]
    return pairs.select(*left.columns, *[c for c in right.columns if c not in keys]).union(alone.select(*left.columns, *nothing))


def _windowed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """df (keys, _wlevel, _wbin) with _window, a text of them in which nulls are equal."""
    return df.withColumn("_window", F.to_json(F.struct(*keys, "_wlevel", "_wbin"))).drop("_wlevel", "_wbin")


def to_windows(left: DataFrame, keys: tuple[str, ...], width: int, rights: dict[str, DataFrame], spans: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """left (keys, start, end, ...) and each right (keys, start2, end2, ...) with _window: right rows are dealt to every window whose left rows they may overlap.

    A left row belongs to the one window of its start, of width bases or, where it is longer, of eight, 64 ... times as many. A right row is dealt as far back as the longest left row of
    the level reaches. ``spans`` (start, end) has the lengths of left's rows, if those are cheaper to get elsewhere.
    """
    length = F.col("end") - F.col("start") + 1
    level = F.greatest(F.lit(0), F.ceil(F.log2(length / width) / STEP)).cast("int")
    at = lambda c: F.floor(c / (width * F.pow(F.lit(2), STEP * F.col("_wlevel"))))
    levels = (left if spans is None else spans).filter("start <= end").groupBy(level.alias("level")).agg(F.max(length).alias("longest"))
    present = levels.agg(F.collect_list(F.struct("level", "longest"))).scalar()
    a = left.withColumn("_wlevel", F.when(F.col("start") <= F.col("end"), level)).withColumn("_wbin", at(F.col("start")))
    out = {}
    for n, r in rights.items():
        dealt = r.filter("start2 <= end2").withColumn("_w", F.explode(present)).withColumn("_wlevel", F.col("_w.level"))
        dealt = dealt.withColumn("_wbin", F.explode(F.sequence(at(F.col("start2") - F.col("_w.longest") + 1), at(F.col("end2"))))).drop("_w")
        out[n] = _windowed(dealt, keys).drop(*keys)
    return _windowed(a, keys), out


#: Bytes of rows a task gathers before it packs them, overlaps and rows of which the lists are made at a time.
PACK_BYTES, AT_ONCE, ROWS_AT_ONCE = 1 << 25, 1 << 19, 1 << 13


def pack(rows: pa.Table) -> bytes:
    """A table as one compressed text; ``unpack`` reads it."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write_table(rows)
    raw = sink.getvalue()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(pa.decompress(data.slice(8), decompressed_size=int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), codec="zstd")).read_all()


def unpacked(parts: list[pa.Buffer]) -> pa.Table:
    """The right rows of packed parts, their lengths as ends again."""
    rows = pa.concat_tables(map(unpack, parts))
    return rows.set_column(rows.column_names.index("end2"), "end2", pc.add(rows["start2"], rows["end2"]))


def packed(df: DataFrame, kind: int, near: tuple[str, ...], shared: bool = False) -> DataFrame:
    """df (_window, ...) as (_near, _window, _kind, _data): all rows that a task has for a window in one compressed Arrow table.

    So few rows are shuffled and sorted, with a fraction of their bytes. _near is the window by the keys ``near`` alone; what is ``shared`` by all windows near it has no other window.
    """
    kept = (*near, "_wlevel", "_wbin")

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).unify_dictionaries().combine_chunks()
        windows = rows["_window"].chunk(0)
        code = windows.indices.to_numpy(zero_copy_only=False)
        rows, order = rows.drop_columns(["_window"]), np.argsort(code, kind="stable")
        if "start2" in rows.column_names:  # starts in order and lengths are small texts
            order = np.lexsort((rows["end2"].to_numpy(), rows["start2"].to_numpy(), code))
            rows = rows.set_column(rows.column_names.index("end2"), "end2", pc.subtract(rows["end2"], rows["start2"]))
        rows, code = rows.take(pa.array(order)), code[order]
        cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
        names = [windows.dictionary[code[i]].as_py() for i in cuts[:-1]]
        nears = [json.dumps({k: v for k, v in json.loads(n).items() if k in kept}, sort_keys=True) for n in names]
        data = [pack(rows.slice(a, b - a)) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(nears, pa.string()), pa.array([""] * len(names) if shared else names, pa.string()), pa.array([kind] * len(names), pa.int32()), pa.array(data, pa.binary())], names=["_near", "_window", "_kind", "_data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            batch = batch.set_column(batch.schema.names.index("_window"), "_window", batch.column("_window").dictionary_encode())
            held.append(batch)
            size += batch.nbytes
            if size >= PACK_BYTES:
                yield one(held)
                held, size = [], 0
        if held:
            yield one(held)

    return df.mapInArrow(run, "_near string, _window string, _kind int, _data binary")


def slices(weights: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows whose weights come to AT_ONCE at most, a heavier row alone."""
    total, first = np.concatenate([[0], np.cumsum(weights)]), 0
    while first < len(weights):
        last = max(first + 1, min(first + ROWS_AT_ONCE, int(np.searchsorted(total, total[first] + AT_ONCE, "right")) - 1))
        yield first, last
        first = last


def read_windows(
    left: DataFrame, keys: tuple[str, ...], width: int, rights: dict[str, DataFrame], prepare: Callable, read: Callable, schema: str, spans: DataFrame | None = None, shared: dict[str, DataFrame] | None = None, shared_keys: tuple[str, ...] = ()
) -> DataFrame:
    """left, each row once, with columns (``schema``) that read makes of the right rows near it.

    For reports that list every overlap of a row. Rows are packed by window before they are shuffled, once; a window's right rows come first and its left rows are read past them, so neither pairs nor lists are
    shuffled or kept; a task holds one window's right rows. prepare(name, table) is called once a window and kind and returns a dict, with starts and longest if ``near`` can tell how many items
    a left row meets; read(starts, ends, prepared by name) is called with some left rows at a time and returns an array for each column. ``shared`` are right rows that have ``shared_keys`` alone.
    """
    shared, near_keys = shared or {}, shared_keys if shared else keys
    a, bs = to_windows(left, keys, width, rights, spans)
    _, ss = to_windows(left, shared_keys, width, shared, spans) if shared else (None, {})
    names, n_shared = [*ss, *bs], len(ss)
    rows = packed(a.select("_window", *left.columns), len(names), near_keys)
    for i, (n, b) in enumerate({**ss, **bs}.items()):
        rows = rows.union(packed(b.select("_window", *[c for c in {**shared, **rights}[n].columns if c in b.columns]), i, near_keys, n in ss))
    n_parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n_parts, "_near").sortWithinPartitions("_near", "_window", "_kind")
    fields = T.StructType.fromDDL(schema).fields
    kinds = [to_arrow_type(f.dataType) for f in fields]
    made = [*left.columns, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, window, common, held, ready = object(), object(), {}, {}, None
        for batch in batches:
            for at, (this, own, kind) in enumerate(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)):
                data = batch.column(3)[at].as_buffer()
                if this != near:
                    near, window, common, ready_common = this, object(), {}, None
                if own != window:
                    window, held, ready = own, {}, None
                if kind < len(names):
                    (common if kind < n_shared else held).setdefault(names[kind], []).append(data)
                    continue
                if ready is None:
                    ready_common = {n: prepare(n, unpacked(x)) for n, x in common.items()} if ready_common is None else ready_common
                    ready, held = ready_common | {n: prepare(n, unpacked(x)) for n, x in held.items()}, {}
                table = unpack(data).combine_chunks()
                start, end = (np.asarray(pc.fill_null(table[c].cast(pa.int64()), v)) for c, v in (("start", 1), ("end", 0)))
                weights = np.ones(len(start), np.int64)
                for items in ready.values():
                    if "longest" in items:
                        lo, hi = near_items(items, start, end)
                        weights += hi - lo
                for first, last in slices(weights):
                    found = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(read(start[first:last], end[first:last], ready), kinds, strict=True)]
                    part = table.slice(first, last - first).to_batches()[0]
                    yield pa.RecordBatch.from_arrays([*part.columns, *found], names=made)

    return rows.mapInArrow(run, T.StructType([*left.schema.fields, *fields]))


def near_items(items: dict[str, np.ndarray], start: np.ndarray, end: np.ndarray, bases: np.ndarray | int = 1) -> tuple[np.ndarray, np.ndarray]:
    """From and to where items in the order of starts, none longer than longest, may have so many bases in common with [start, end]."""
    lo = np.searchsorted(items["starts"], start - items["longest"] + bases)
    return lo, np.maximum(lo, np.searchsorted(items["starts"], end - bases + 1, "right"))


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, item) for each item of the ranges [lo, hi)."""
    n = hi - lo
    rows = np.repeat(np.arange(len(n)), n)
    return rows, np.arange(len(rows)) + np.repeat(lo - (np.cumsum(n) - n), n)


def overlapping(items: dict[str, np.ndarray], start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, item) for each of the items (starts in order, ends, longest) that overlaps an interval; items in their order."""
    lo, hi = near_items(items, start, end)
    rows, at = spread(lo, hi)
    keep = items["ends"][at] >= np.repeat(start, hi - lo)
    return rows[keep], at[keep]


def covering(items: dict[str, np.ndarray], start: np.ndarray, end: np.ndarray, min_fraction: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, item) for each item that overlaps at least min_fraction of an interval; items in their order."""
    size = end - start + 1
    need = np.maximum(1, np.floor(size * min_fraction).astype(np.int64) - 1)
    for _ in range(3):  # to the fewest bases whose share, as a double, is enough
        need += need / size < min_fraction
    lo, hi = near_items(items, start, end, need)
    rows, at = spread(lo, hi)
    keep = items["ends"][at] >= np.maximum(items["starts"][at], np.repeat(start, hi - lo)) + np.repeat(need - 1, hi - lo)
    return rows[keep], at[keep]


def text_lists(texts: pa.Array, rows: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """The texts of each row's items, joined by commas; null where a row has none. Rows are in order; null texts are left out."""
    if texts.null_count:
        there = np.asarray(texts.is_valid())[at]
        rows, at = rows[there], at[there]
    counts = np.bincount(rows, minlength=n)
    ends = np.cumsum(counts)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), texts.take(pa.array(at)), mask=pa.array(counts == 0))
    return pc.binary_join(lists, ",")


def first_of_each(code: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, at) without the items whose code an earlier item of the row has."""
    keys = rows * (int(code.max(initial=0)) + 1) + code[at]
    if np.count_nonzero(np.diff(code)) + 1 == len(np.unique(code)):  # equal ones lie together
        keep = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    else:
        keep = np.sort(np.unique(keys, return_index=True)[1])
    return rows[keep], at[keep]


def union_of(start2: np.ndarray, end2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of intervals: first and last base of its pieces, and the bases before each piece and in all."""
    order = np.argsort(start2)
    firsts, tops = start2[order], np.maximum.accumulate(end2[order])
    fresh = np.concatenate([[True], firsts[1:] > tops[:-1]])
    firsts, lasts = firsts[fresh], tops[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(tops) - 1]])]
    return firsts, lasts, np.concatenate([[0], np.cumsum(lasts - firsts + 1)])


def covered_bases(union: tuple[np.ndarray, np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bases of [start, end] in a union."""
    firsts, lasts, before = union

    def up_to(x: np.ndarray) -> np.ndarray:
        k = np.searchsorted(firsts, x, "right")
        return before[k] - np.where(k > 0, np.maximum(0, lasts[k - 1] - x), 0)

    return up_to(end) - up_to(start - 1)


def outer_of(start2: np.ndarray, end2: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Intervals that lie in no other one, by start (and so by end), and the longest of each 1, 2, 4 ... in a row."""
    order = np.lexsort((-end2, start2))
    s, e = start2[order], end2[order]
    keep = np.concatenate([[True], e[1:] > np.maximum.accumulate(e)[:-1]])
    s, e = s[keep], e[keep]
    longest = [e - s + 1]
    while (step := 1 << (len(longest) - 1)) * 2 <= len(s):
        longest.append(np.maximum(longest[-1][:-step], longest[-1][step:]))
    return s, e, longest


def best_bases(outer: tuple[np.ndarray, np.ndarray, list[np.ndarray]], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The most bases that one interval has in common with each [start, end]: the last one that starts by its start, the first one that ends from its end on, or the longest between."""
    s, e, longest = outer
    i, j = np.searchsorted(s, start, "right") - 1, np.searchsorted(e, end)
    best = np.where(i >= 0, np.minimum(end, e[np.maximum(i, 0)]) - start + 1, 0)
    best = np.maximum(best, np.where(j < len(s), end - np.maximum(start, s[np.minimum(j, len(s) - 1)]) + 1, 0))
    lo, hi = np.searchsorted(s, start), np.searchsorted(e, end, "right")
    for level, most in enumerate(longest):
        of = np.flatnonzero((hi - lo >= 1 << level) & (hi - lo < 2 << level))
        best[of] = np.maximum(best[of], np.maximum(most[lo[of]], most[hi[of] - (1 << level)]))
    return np.maximum(best, 0)


def outermost(df: DataFrame, keys: list[str], bin_size: int) -> DataFrame:
    """df (keys, start2, end2) without intervals that lie inside another one that starts in the same bin; those never overlap anything by more."""
    order = Window.partitionBy(*keys, F.floor(F.col("start2") / bin_size)).orderBy("start2")
    top = F.max("end2").over(order.rowsBetween(Window.unboundedPreceding, -1))
    longest = df.groupBy(*keys, "start2").agg(F.max("end2").alias("end2"))
    return longest.withColumn("_top", top).filter("_top is null or end2 > _top").drop("_top")


def best_overlaps(left: DataFrame, right: DataFrame, id_column: str, keys: tuple[str, ...], block: int = 32) -> DataFrame:
    """(id, best): the most bases that one right interval has in common with each left one.

    Left intervals meet blocks of outermost right ones that start within ``block`` bases. Only a block in which some start before and some after the left interval's start (or end,
    alike) is read item by item: else the last end, the first start or the longest interval decides.
    """
    top = outermost(right.filter("start2 <= end2"), list(keys), 4096)
    spans = [F.min("start2").alias("_first"), F.max("start2").alias("last"), F.min("end2").alias("least"), F.max("end2").alias("end2"), F.max(F.col("end2") - F.col("start2") + 1).alias("longest")]
    blocks = top.groupBy(*keys, F.floor(F.col("start2") / block).alias("_block")).agg(*spans, F.collect_list(F.struct("start2", "end2")).alias("items")).drop("_block").withColumnRenamed("_first", "start2")
    s, e = F.col("start"), F.col("end")
    read = F.array_max(F.transform("items", lambda x: F.least(e, x["end2"]) - F.greatest(s, x["start2"]) + 1))
    best = F.when(F.col("last") <= s, F.least(e, F.col("end2")) - s + 1).when(F.col("least") >= e, e - F.greatest(s, F.col("start2")) + 1)
    best = best.when((F.col("start2") >= s) & (F.col("end2") <= e), F.col("longest")).otherwise(read)
    return level_pairs(left.select(id_column, *keys, "start", "end"), blocks, keys).groupBy(id_column).agg(F.max(best).alias("best")).filter("best > 0")


def island_ids(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", gap: int = 1) -> DataFrame:
    """Adds ``island``: a new one begins where start > every earlier end + gap."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    top = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(top.isNull() | (F.col(start) > top + gap), 1).otherwise(0)
    return df.withColumn("_fresh", fresh).withColumn("island", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_fresh")


def merge_intervals(df: DataFrame, keys: list[str], names: str | None = None) -> DataFrame:
    """Unions of overlapping or adjacent intervals; ``names`` gives a column whose distinct values are joined in order."""
    aggs = [F.min("start").alias("start"), F.max("end").alias("end")]
    if names:
        aggs.append(F.array_join(F.array_sort(F.collect_set(names)), ",").alias(names))
    return island_ids(df, keys).groupBy(*keys, "island").agg(*aggs).drop("island")


def union_coverage(pairs: DataFrame, key: str) -> DataFrame:
    """pairs (key, start, end, start2, end2) -> (key, covered): bases of [start, end] under any [start2, end2]."""
    clipped = pairs.select(key, F.greatest("start", "start2").alias("start"), F.least("end", "end2").alias("end")).filter("start <= end")
    return merge_intervals(clipped, [key]).groupBy(key).agg(F.sum(F.col("end") - F.col("start") + 1).alias("covered"))


def subtract_intervals(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left (key, start, end) minus the union of right (key, start2, end2): the gaps that stay."""
    pairs = interval_join(left.select(key, "start", "end"), right.select(key, "start2", "end2"), keys=(key,))
    clipped = pairs.select(key, F.col("start").alias("l"), F.col("end").alias("r"), F.greatest("start", "start2").alias("start"), F.least("end", "end2").alias("end"))
    cover = merge_intervals(clipped, [key, "l", "r"])
    order = Window.partitionBy(key, "l", "r").orderBy("start")
    gaps = cover.withColumn("next", F.coalesce(F.lead("start").over(order) - 1, F.col("r"))).withColumn("prev", F.lag("end").over(order))
    inner = gaps.select(key, (F.col("end") + 1).alias("start"), F.col("next").alias("end"))
    head = gaps.filter("prev is null").select(key, F.col("l").alias("start"), (F.col("start") - 1).alias("end"))
    whole = interval_join(left.select(key, "start", "end"), right.select(key, "start2", "end2"), "left_anti", keys=(key,))
    return inner.union(head).filter("start <= end").union(whole)


def with_fraction(pairs: DataFrame) -> DataFrame:
    """Adds overlap (bases) and fraction (of the left interval)."""
    o = overlap_length(F.col("start"), F.col("end"), F.col("start2"), F.col("end2"))
    return pairs.withColumn("overlap", o).withColumn("fraction", o / (F.col("end") - F.col("start") + 1))
