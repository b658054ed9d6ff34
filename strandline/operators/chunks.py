"""Folds over the rows of each key in order, in parallel also where one key holds most rows.

Rows are dealt to ranges of (keys, order), and each range is folded from a fresh state, as if its first key began there. That is a guess only for
the rows before the first place where the true fold and the guess are in the same state; from there on both agree. So a second pass
takes the state in which the range before ended and folds the first rows of a range again, until it meets the guess. Behind a range that never meets it,
runs of such ranges are folded again one after the other, as nothing in them can be told apart from a fold of one piece.

Memory: the fold's state and a batch. Nothing is collected; the states, one row a range, are ordered in one task. Column names that begin with an underscore are this module's.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources.written import forget, written


class Fold(Protocol):
    """A fold: ``values`` are the columns it reads, ``ddl`` and ``arrow`` the type of its outputs."""

    values: list[str]
    ddl: str
    arrow: pa.DataType

    def start(self) -> Any:
        """A fresh state."""

    def step(self, state: Any, *values: Any) -> Any:
        """The output of a row (None: nothing); changes the state."""

    def finish(self, state: Any) -> Any:
        """What is left to say after a key's last row, said there if the row has no output of its own."""

    def same(self, a: Any, b: Any, out_a: Any, out_b: Any) -> bool:
        """Whether two states are known to be equal after a row with these outputs."""

    def dump(self, state: Any) -> Any:
        """The state as JSON values."""

    def load(self, dumped: Any) -> Any:
        """The state of a dump."""


def _first_pass(rows: DataFrame, fold: Fold) -> DataFrame:
    """rows (_part, _key, ...) in order -> with _seq, _out, and a row at the end of each range with _first (key) and _state."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, key, first, state, kept = 0, None, None, None, None

        def judged(batch: pa.RecordBatch, outs: list, begin: int) -> pa.RecordBatch:
            n = batch.num_rows
            more = [pa.array(range(begin, begin + n), pa.int64()), pa.array(outs, fold.arrow), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
            return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "_seq", "_out", "_first", "_state"])

        for batch in (b for b in batches if b.num_rows):
            outs: list = []
            for k, *values in zip(*[batch.column(c).to_pylist() for c in ("_key", *fold.values)], strict=True):
                if k != key or state is None:
                    if state is not None:  # the row before was its key's last one
                        at = outs if outs else kept[1]
                        at[-1] = fold.finish(state) if at[-1] is None else at[-1]
                    key, state = k, fold.start()
                    first = key if first is None else first
                outs.append(fold.step(state, *values))
            if kept:
                yield judged(*kept)
            kept = (batch, outs, seq)
            seq += batch.num_rows
        if kept:
            yield judged(*kept)
            last = kept[0].slice(kept[0].num_rows - 1)
            own = {"_seq": seq - 1, "_out": fold.finish(state), "_first": first, "_state": json.dumps(fold.dump(state))}
            types = {"_seq": pa.int64(), "_out": fold.arrow, "_first": pa.int64(), "_state": pa.string()}
            yield pa.RecordBatch.from_arrays([*last.columns, *(pa.array([own[c]], types[c]) for c in types)], names=[*last.schema.names, *types])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", _seq long, _out {fold.ddl}, _first long, _state string"
    return rows.mapInArrow(work, schema)


def _second_pass(rows: DataFrame, fold: Fold) -> DataFrame:
    """rows of first keys of ranges, by run and in order (_run, _part, _seq, _inner: the key ends in the range, values; at _seq 0 also _before, the state before the range, and
    _own, the state in which the guess ends) -> _part, _seq, _out, _state: outputs that differ, and at _seq -1 the last state of a range that did not meet its guess (_out: what
    finish says). Ranges of a run hand their states on."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, part, true, guess, met, inner, own, held, out = None, None, None, None, False, False, None, None, []

        def close() -> None:
            if part is None:
                return
            if held is not None:
                seq, now, guessed = held
                if inner:
                    now, guessed = fold.finish(true) if now is None else now, object()
                if now != guessed:
                    out.append((part, seq, now, None))
            if not met and not inner:
                out.append((part, -1, fold.finish(true), json.dumps(fold.dump(true))))

        for batch in batches:
            columns = [batch[c].tolist() for c in ("_run", "_part", "_seq", "_before", "_own", "_inner", *fold.values)]
            for r, p, seq, before, at_end, ends_here, *values in zip(*columns, strict=True):
                if p != part:
                    close()
                    if r != run:
                        true = fold.load(json.loads(before))
                    elif met:
                        true = fold.load(json.loads(own))
                    run, part, guess, met, inner, own, held = r, p, fold.start(), False, ends_here, at_end, None
                if met:
                    continue
                if held is not None and held[1] != held[2]:
                    out.append((part, held[0], held[1], None))
                now, guessed = fold.step(true, *values), fold.step(guess, *values)
                held = (seq, now, guessed)
                met = fold.same(true, guess, now, guessed)
                if met:
                    if now != guessed:
                        out.append((part, seq, now, None))
                    held = None
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["_part", "_seq", "_out", "_state"])
                out.clear()
        close()
        yield pd.DataFrame(out, columns=["_part", "_seq", "_out", "_state"])

    return rows.mapInPandas(work, f"_part int, _seq long, _out {fold.ddl}, _state string")


def chunked_fold(rows: DataFrame, keys: list[str], order: list[str], fold: Fold, key_order: list[str | Column] | None = None, ranges: int | None = None) -> DataFrame:
    """rows with _part, _seq (together the place in the order of key_order, keys and order; nulls first) and _out. Keys may be null."""
    spark = rows.sparkSession
    by = [*(key_order or []), *keys, *order]
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]) if keys else F.lit(0).cast("long")
    rows = written(rows, "fold-rows")  # ranges are found by a sample, which would compute the rows twice
    dealt = rows.withColumn("_key", key).repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    whole = written(_first_pass(dealt, fold), "fold")
    forget(rows)
    guesses = whole.filter("_state is null").drop("_state", "_first")
    ends = written(whole.filter("_state is not null").select("_part", "_seq", "_key", "_first", "_out", "_state"), "fold-ends")
    first_ends, late, fixes, asked = ends, None, None, None
    chain = Window.orderBy("_part")
    while True:
        edges = ends.select("_part", "_first", "_key", "_state", *[F.lag(c).over(chain).alias(n) for c, n in (("_key", "_was"), ("_state", "_before"), ("_part", "_prior"))])
        if late is None:  # every range on its own, as if the one before had guessed right
            edges = edges.filter("_was = _first").withColumn("_run", F.col("_part"))
        else:  # then runs of ranges behind one that did not
            behind = asked.join(late.select(F.col("_part").alias("_prior")), "_prior", "full").select("_prior", F.coalesce("_new", F.lit(False)).alias("_new"))
            edges = edges.join(behind, "_prior", "left").withColumn("_on", F.coalesce(F.col("_new").isNotNull() & (F.col("_was") == F.col("_first")), F.lit(False)))
            run = F.sum(F.when(F.col("_on") & F.lag("_on", 1, False).over(chain), 0).otherwise(1)).over(chain)
            edges = edges.withColumn("_run", run.cast("int")).filter("_on").withColumn("_any", F.max("_new").over(Window.partitionBy("_run"))).filter("_any")
        edges = edges.join(first_ends.select("_part", F.col("_state").alias("_own")), "_part")
        edges = written(edges.select(F.col("_part").alias("_p"), F.col("_first").alias("_f"), (F.col("_key") != F.col("_first")).alias("_inner"), "_before", "_own", "_run"), "fold-edges")
        heads = guesses.join(edges, (F.col("_part") == F.col("_p")) & (F.col("_key") == F.col("_f")))
        head = lambda c: F.when(F.col("_seq") == 0, F.col(c)).alias(c)
        heads = heads.select("_run", "_part", "_seq", head("_before"), head("_own"), "_inner", *fold.values).repartition(ranges, "_run").sortWithinPartitions("_run", "_part", "_seq")
        found = written(_second_pass(heads, fold), "fold-fixes")
        new, unmet = found.filter("_seq >= 0").select("_part", "_seq", "_out"), found.filter("_seq = -1").select("_part", F.col("_out").alias("_o"), F.col("_state").alias("_s"))
        done = edges.select(F.col("_p").alias("_part"))
        fixes = new if fixes is None else fixes.join(done, "_part", "left_anti").union(new)
        late_before, late = late, unmet if late is None else late.join(done, "_part", "left_anti").union(unmet)
        if late_before is None and unmet.isEmpty():
            break
        true_out = F.when(F.col("_s").isNull(), F.col("_out")).otherwise(F.col("_o"))
        now = written(first_ends.join(late, "_part", "left").select("_part", "_seq", "_key", "_first", true_out.alias("_out"), F.coalesce("_s", "_state").alias("_state")), "fold-ends")
        # ranges that end in another state than the range behind them has begun with
        changed = now.select("_part", "_state").join(ends.select("_part", F.col("_state").alias("_old")), "_part").filter("_state <> _old").select("_part")
        if late_before is not None:  # within a run the right state was handed on
            changed = changed.join(edges.select((F.col("_p")).alias("_q"), "_run").withColumn("_part", F.lag("_q").over(Window.partitionBy("_run").orderBy("_q"))).dropna().select("_part"), "_part", "left_anti")
        asked = written(changed.select(F.col("_part").alias("_prior"), F.lit(True).alias("_new")), "fold-asked")
        ends = now
        if asked.isEmpty():
            break
    follow = F.lead("_first").over(Window.orderBy("_part"))
    left = ends.withColumn("_next", follow).filter("(_next is null or _next <> _key) and _out is not null").select("_part", "_seq", "_out")
    said = fixes.join(left.select("_part", "_seq"), ["_part", "_seq"], "left_anti").union(left)  # a last row says at most one thing
    said = written(said.select(F.col("_part").alias("_p"), F.col("_seq").alias("_s"), F.col("_out").alias("_o")), "fold-said")
    forget(ends)
    out = F.when(F.col("_p").isNull(), F.col("_out")).otherwise(F.col("_o"))
    return guesses.join(said, (F.col("_part") == F.col("_p")) & (F.col("_seq") == F.col("_s")), "left").select(*rows.columns, "_part", "_seq", out.alias("_out"))
