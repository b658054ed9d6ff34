"""Language identification by prediction by partial matching.

Per language, a variable-order tree of byte contexts (up to ``order`` bytes) with escape
probabilities (method C: the number of different continuations) is counted on labelled texts and
then frozen. A text's code length under a language is the exact sum over its bytes; the shortest code
names the language. The trees of all languages are compiled into one automaton whose state is the
longest known context, so scoring is two table look-ups a byte, whatever the order, and long texts
are cut into segments that start ``order`` bytes early, which leaves each byte's context exact.

Training sample: at most ``docs_per_lang`` labelled documents a language, those with the smallest
hashes (a documented bound); everything else reads every byte of every text. The model's size depends
on that bound and is broadcast; texts are scored where they are read, with no shuffle.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and so is everything if
no labelled text exists. Ties go to the first language in code point order. Bytes never seen in
training cost the escapes and a uniform byte. Repeated rows get equal results. Input columns named like the results are
replaced by them; other extra columns pass through. ``min_count`` of fit drops contexts of 3 and more bytes that occur once; the README has
what that costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import others, small_batches

UNDETERMINED = "und"


@dataclass
class Model:
    langs: list[str]
    symbol: np.ndarray  # byte -> symbol, 0 for bytes never seen
    step: np.ndarray  # (state * width + symbol) -> next state * width
    cost: np.ndarray  # (state * width + symbol, lang) -> bits, in 1 / unit
    order: int
    unit: int = 1

    def packed(self, unit: int = 1024) -> Model:
        """The same trees with costs frozen as whole numbers of 1 / unit bits, in half the memory; every worker holds one."""
        return replace(self, cost=np.minimum(np.round(self.cost * (unit / self.unit)), 65535).astype(np.uint16), unit=unit)


def fit(texts: dict[str, list[bytes]], order: int = 4, min_count: int = 2) -> Model:
    """Context trees of each language's texts; contexts of 3 and more bytes need ``min_count`` uses."""
    langs = sorted(texts)
    seen = np.unique(np.frombuffer(b"".join(x for xs in texts.values() for x in xs), np.uint8))
    symbol = np.zeros(256, np.int64)
    symbol[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1
    grams: list[list[tuple[np.ndarray, np.ndarray]]] = []  # by order, by language: codes of context and symbol, counts
    for k in range(order + 1):
        grams.append([])
        for lang in langs:
            codes = []
            for x in texts[lang]:
                s = symbol[np.frombuffer(x, np.uint8)]
                if len(s) > k:
                    code = np.zeros(len(s) - k, np.int64)
                    for j in range(k + 1):
                        code = code * width + s[j : len(s) - k + j]
                    codes.append(code)
            grams[k].append(np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    contexts = []
    for k in range(order + 1):
        code = np.concatenate([np.zeros(0, np.int64), *(c // width for c, _ in grams[k])])
        n = np.concatenate([np.zeros(0, np.int64), *(n for _, n in grams[k])])
        found, at = np.unique(code, return_inverse=True)
        contexts.append(found[np.bincount(at, weights=n, minlength=len(found)) >= (min_count if k >= 3 else 1)] if k else np.zeros(1, np.int64))
    base = np.cumsum([0, *map(len, contexts)])
    step = np.zeros((base[-1], width), np.int32)
    cost = np.full((base[-1], width, len(langs)), 8.0, np.float32)
    for k in range(order + 1):
        own = slice(base[k], base[k + 1])
        if k:
            shorter = base[k - 1] + np.searchsorted(contexts[k - 1], contexts[k] % width ** (k - 1))
            step[own], cost[own] = step[shorter], cost[shorter]
        if k < order:
            parent = np.searchsorted(contexts[k], contexts[k + 1] // width)
            step[base[k] + parent, contexts[k + 1] % width] = base[k + 1] + np.arange(len(contexts[k + 1]))
        for i, (code, n) in enumerate(grams[k]):
            at = np.searchsorted(contexts[k], code // width)
            known = contexts[k][np.minimum(at, len(contexts[k]) - 1)] == code // width if len(contexts[k]) else np.zeros(len(code), bool)
            at, s, n = at[known], (code % width)[known], n[known]
            total = np.bincount(at, weights=n, minlength=len(contexts[k]))
            kinds = np.bincount(at, minlength=len(contexts[k]))
            used = total > 0
            cost[own][used, :, i] += np.log2((total + kinds)[used] / kinds[used])[:, None]
            cost[base[k] + at, s, i] = np.log2((total + kinds)[at] / n)
    return Model(langs, symbol.astype(np.uint8), (step * width).reshape(-1), cost.reshape(base[-1] * width, len(langs)), order)


def code_lengths(model: Model, texts: list[bytes], segment: int = 1024) -> np.ndarray:
    """Bits of each text under each language."""
    n = np.array([len(x) for x in texts], np.int64)
    first = np.cumsum(n) - n
    data = model.symbol[np.frombuffer(b"".join(texts), np.uint8)]
    each = -(-n // segment)
    doc = np.repeat(np.arange(len(n)), each)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)) * segment
    size = np.minimum(segment, n[doc] - start)
    by_size = np.argsort(-size, kind="stable")
    doc, start, size = doc[by_size], start[by_size], size[by_size]
    at = first[doc] + start
    bits, state = np.zeros((len(doc), len(model.langs))), np.zeros(len(doc), np.int32)
    for back in range(model.order, 0, -1):  # contexts reach back into the segment before
        row = np.flatnonzero(start >= back)
        state[row] = model.step[state[row] + data[at[row] - back]]
    active = len(doc)
    for t in range(int(size.max(initial=0))):
        while active and size[active - 1] <= t:
            active -= 1
        edge = state[:active] + data[at[:active] + t]
        bits[:active] += model.cost.take(edge, axis=0)
        state[:active] = model.step.take(edge)
    out = np.zeros((len(n), len(model.langs)))
    for i in range(len(model.langs)):
        out[:, i] = np.bincount(doc, weights=bits[:, i], minlength=len(n))
    return out / model.unit


def predict(model: Model, texts: list[str | None], batch_bytes: int = 4 << 20) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits a byte of each text (NaN where nothing was judged). The score is a softmax of code lengths over the root of the length."""
    langs, scores, rates = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
    todo = [i for i, x in enumerate(texts) if x is not None and model.langs and any(map(str.isalpha, x))]
    while todo:
        now, n = [], 0
        while todo and n < batch_bytes:
            now.append((todo[-1], texts[todo.pop()].encode("utf-8", "replace")))
            n += len(now[-1][1])
        bits = code_lengths(model, [x for _, x in now])
        best = bits.argmin(axis=1)
        over = (bits - bits.min(axis=1, keepdims=True)) / np.sqrt([[len(x)] for _, x in now])
        sure = 1 / np.exp2(-over).sum(axis=1)
        for (i, x), b, s, cost in zip(now, best, sure, bits.min(axis=1), strict=True):
            langs[i], scores[i], rates[i] = model.langs[b], s, cost / len(x)
    return langs, scores, rates


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, docs_per_lang: int) -> dict[str, list[bytes]]:
    """At most docs_per_lang texts of each language, by smallest hash, from labelled documents that are not held out."""
    usable = docs.filter("lang is not null and text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    share = (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)).alias("share")
    sample: dict[str, list[bytes]] = {}
    for lang, n in sorted((r["lang"], r["count"]) for r in usable.groupBy("lang").count().collect()):
        enough = min(1.0, (docs_per_lang + 6 * docs_per_lang**0.5) / n)
        rows = usable.filter(F.col("lang") == lang).select("text", "doc_id", share).filter(F.col("share") <= enough)
        sample[lang] = [r["text"].encode("utf-8", "replace") for r in rows.orderBy("share", "doc_id").limit(docs_per_lang).collect()]
    return sample


def identify(docs: DataFrame, docs_per_lang: int = 300, order: int = 4) -> DataFrame:
    """docs (doc_id, text, lang, ...) -> the same columns, held_out, lang_pred, score, bits (a byte, under lang_pred; null where nothing was judged).

    Columns of docs with one of these four names, in any case, are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(fit(training_sample(docs, docs_per_lang), order).packed())

    @F.pandas_udf("lang_pred string, score double, bits double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores, rates = predict(model.value, [None if x is None else x for x in texts.tolist()])
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "bits": rates})

    out = docs.select(F.struct("*").alias("_row"), judge.asNondeterministic()(F.col("text")).alias("_judged"))  # else a filter on it runs it twice
    kept = [F.col(f"_row.`{c}`") for c in others(docs.columns, ("held_out", "lang_pred", "score", "bits"))]
    return out.select(*kept, held_out(F.col("_row.doc_id")).alias("held_out"), "_judged.lang_pred", "_judged.score", F.nanvl("_judged.bits", F.lit(None)).alias("bits"))
