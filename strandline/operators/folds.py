"""The two order-dependent folds: resetting CUSUM and greedy moving-median clusters. Both run over ranges of rows, see chunks."""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.chunks import chunked_fold

PSEUDO = 0.1


class Cusum:
    """Clipped sums of 1 - ratio - k: an event opens where the sum reaches h, at the first bin of the rise that has a ratio of at most ``edge``, and closes
    before ``recover_bins`` bins of ratio ``recover`` or more in a row; the sum then starts anew. An output is an event's bins, summed up."""

    values = ["start", "end", "depth", "_ratio"]
    fields = {"start": "long", "end": "long", "n_bins": "long", "depth": "double", "ratio": "double", "min_ratio": "double", "max_cusum": "double"}
    ddl = f"struct<{', '.join(f'{k}: {t}' for k, t in fields.items())}>"
    arrow = pa.struct([(k, pa.int64() if t == "long" else pa.float64()) for k, t in fields.items()])

    def __init__(self, k: float, h: float, edge: float, recover: float, recover_bins: int):
        self.k, self.h, self.edge, self.recover, self.recover_bins = k, h, edge, recover, recover_bins

    def start(self) -> dict:
        # rise: sums since the sum left zero; low: since the first bin of it at the edge; event: up to the last bin that is not quiet; quiet: those after it
        return {"sum": 0.0, "inside": False, "rise": None, "low": None, "event": None, "quiet": [], "top": 0.0}

    @staticmethod
    def add(sums: list | None, b: tuple) -> list:
        """[start, end, bins, depth, ratio, least ratio] with one bin more."""
        start, end, depth, ratio = b
        if not sums:
            return [start, end, 1, depth, ratio, ratio]
        return [sums[0], end, sums[2] + 1, sums[3] + depth, sums[4] + ratio, min(sums[5], ratio)]

    def step(self, state: dict, *b) -> dict | None:
        ratio = b[3]
        gain = 1 - ratio - self.k
        if not state["inside"]:
            if state["sum"] == 0 and gain > 0:
                state["rise"] = []
            state["sum"] = max(0.0, state["sum"] + gain)
            if state["low"] is None and ratio <= self.edge and state["rise"] is not None:
                state["low"] = []
            if state["sum"] >= self.h:
                event = state["rise"] if state["low"] is None else state["low"]
                state |= {"inside": True, "event": event or [], "quiet": [], "top": state["sum"]}
        else:
            state["sum"] = max(0.0, state["sum"] + gain)
        if state["inside"]:
            state["top"] = max(state["top"], state["sum"])
            if ratio >= self.recover:
                state["quiet"].append(b)
            else:
                for x in (*state["quiet"], b):
                    state["event"] = self.add(state["event"], x)
                state["quiet"] = []
            if len(state["quiet"]) >= self.recover_bins:
                said = self.said(state)
                state |= self.start()
                return said
            return None
        if state["sum"] == 0:
            state |= {"rise": None, "low": None}
        for name in ("rise", "low"):
            if state[name] is not None:
                state[name] = self.add(state[name], b)
        return None

    def said(self, state: dict) -> dict | None:
        return dict(zip(self.fields, [*state["event"], state["top"]], strict=True)) if state["event"] else None

    def finish(self, state: dict) -> dict | None:
        if not state["inside"]:
            return None
        event = state["event"]
        for x in state["quiet"]:
            event = self.add(event, x)
        return self.said(state | {"event": event})

    def same(self, a: dict, b: dict, out_a, out_b) -> bool:
        return not a["inside"] and not b["inside"] and a["sum"] == b["sum"] == 0

    def dump(self, state: dict) -> dict:
        return state

    def load(self, dumped: dict) -> dict:
        return dumped


def cusum_events(bins: DataFrame, keys: list[str], k: float = 0.1, h: float = 5.0, edge: float = 0.8, recover: float = 0.8, recover_bins: int = 3, del_ratio: float = 0.65, min_bins: int = 3, min_len: int = 1, ranges: int | None = None) -> DataFrame:
    """bins (keys, start, end, depth, baseline) -> keys, start, end, length, n_bins, baseline, mean_depth, mean_ratio, min_ratio, max_cusum.

    Adjacency is by order of bins, not by coordinate. Bins without start, depth or baseline are none. A key's bins are folded in ``ranges`` that run apart.
    """
    base = bins.select(*keys, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("depth").cast("double").alias("depth"), F.col("baseline").cast("double").alias("baseline"))
    base = base.withColumn("_ratio", (F.col("depth") + PSEUDO) / (F.col("baseline") + PSEUDO)).dropna(subset=["start", "_ratio"])
    found = chunked_fold(base, keys, ["start", "end"], Cusum(k, h, edge, recover, recover_bins), ranges=ranges).filter("_out is not null")
    n, length = F.col("_out.n_bins"), F.col("_out.end") - F.col("_out.start") + 1
    mean = F.col("_out.ratio") / n
    out = found.filter((n >= min_bins) & (length >= min_len) & (mean <= del_ratio))
    return out.select(*keys, "_out.start", "_out.end", length.alias("length"), n.alias("n_bins"), "baseline", (F.col("_out.depth") / n).alias("mean_depth"), mean.alias("mean_ratio"), "_out.min_ratio", "_out.max_cusum")


class Median:
    """The median, half up, of numbers that come one by one: different values in order with counts, and a pointer to the lower median."""

    def __init__(self, values: list[int] = (), counts: list[int] = ()):
        self.values, self.counts = list(values), dict(zip(values, counts, strict=True))
        self.n = sum(counts)
        self.at, self.below = 0, 0  # place of the lower median among the values, and how many numbers are less than it
        self.settle()

    def settle(self) -> None:
        rank = (self.n - 1) // 2
        while self.n and self.below > rank:
            self.at -= 1
            self.below -= self.counts[self.values[self.at]]
        while self.n and self.below + self.counts[self.values[self.at]] <= rank:
            self.below += self.counts[self.values[self.at]]
            self.at += 1

    def add(self, x: int) -> None:
        less = bool(self.n) and x < self.values[self.at]
        if x not in self.counts:
            self.counts[x] = 0
            bisect.insort(self.values, x)
            self.at += less
        self.counts[x] += 1
        self.below += less
        self.n += 1
        self.settle()

    def value(self) -> int:
        low = self.values[self.at]
        if self.n % 2 or self.below + self.counts[low] > self.n // 2:
            return low
        return (low + self.values[self.at + 1] + 1) // 2

    def dump(self) -> list:
        return [self.values, [self.counts[x] for x in self.values]]


class Greedy:
    """Clusters of intervals: one stays while both of its ends are within ``window`` of the current cluster's medians. An output is 1 where a cluster opens, else 0."""

    values, ddl, arrow = ["_a", "_b"], "int", pa.int32()

    def __init__(self, window: int):
        self.window = window

    def start(self) -> list:
        return [Median(), Median()]

    def step(self, state: list, a: int, b: int) -> int:
        fresh = not state[0].n or abs(a - state[0].value()) > self.window or abs(b - state[1].value()) > self.window
        if fresh:
            state[:] = self.start()
        state[0].add(a)
        state[1].add(b)
        return int(fresh)

    def finish(self, state: list) -> None:
        return None

    def same(self, a: list, b: list, out_a: int, out_b: int) -> bool:
        return out_a == out_b == 1

    def dump(self, state: list) -> list:
        return [x.dump() for x in state]

    def load(self, dumped: list) -> list:
        return [Median(*x) for x in dumped]


def greedy_clusters(events: DataFrame, keys: list[str], order: list[str], window: int, prefix: str, key_order: list[str | Column] | None = None, ranges: int | None = None) -> DataFrame:
    """Adds cluster_id (prefix and six digits, numbered over all keys in ``key_order``) to events (keys, sv_start, sv_end).

    Keys may be null: such events cluster among themselves. Missing coordinates are alike, and far from all others. A key's events are folded in ``ranges`` that run
    apart; numbers are sums of the clusters that opened before, in the range and over the ranges.
    """
    nowhere = F.lit(-(1 << 62))
    rows = events.withColumns({"_a": F.coalesce(F.col("sv_start").cast("long"), nowhere), "_b": F.coalesce(F.col("sv_end").cast("long"), nowhere)})
    out = chunked_fold(rows, keys, ["_a", "_b", *order], Greedy(window), key_order, ranges)
    sums = out.groupBy("_part").agg(F.sum("_out").alias("_n"))
    sums = sums.select(F.col("_part").alias("_p"), F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    inside = F.sum("_out").over(Window.partitionBy("_part").orderBy("_seq"))
    numbered = out.withColumn("_inside", inside).join(sums, F.col("_part") == F.col("_p"))
    return numbered.select(*events.columns, F.format_string(f"{prefix}_%06d", F.coalesce("_before", F.lit(0)) + F.col("_inside")).alias("cluster_id"))
