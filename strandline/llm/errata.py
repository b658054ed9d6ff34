"""Spelling variants by merging the light subtrees of an errata trie.

Words are counted over all texts and form a trie whose nodes are prefixes. The child with the most words below a node is its heavy child, all others
are light, so a word passes at most log2(number of words) light edges. Only there errors are made: a light subtree is merged into its heavy sibling's with
the first character replaced by the heavy one, into that one's with the heavy character put before it, into its parent's with the first character
skipped, and light siblings among themselves under a wildcard; where a word ends, the heavy child's character is put behind it. Terminals that coincide are pairs
at one edit, and every such pair coincides at the node where its words part:

* both part by different characters and go on alike: one is light and meets the heavy one's subtree, or both are light and meet under the wildcard;
* one has a character more there: if its edge is light, skipping it gives the other one; if it is heavy, the other one is light or ends, and the heavy character is put into it.

The form of a word is its near word of largest count, if that has at least ``ratio`` times its own; roots are found by pointer doubling.

Scale: a text is one row of a map and gives its different words with counts, which are summed with map-side combine; prefixes are counted the same way. A word of
n characters gives n rows once, for the joins with the light edges, and a number of merged terminals that grows with the logarithm of the vocabulary. A wildcard
group has at most as many members as the alphabet (90 different characters). A light edge has at most half of its node's words; what is still hot is a join
of two written tables, which adaptive execution splits. Nothing is collected but the number of open chains, once a doubling.

Edge cases: null and empty texts have no words, a null doc_id reads as an empty one in the checksum. Very long texts are read whole. Repeated rows count again. Ties of
near words go to the smaller one in code-point order. Columns other than doc_id and text are not carried, so names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import discard, stash

_LETTER = np.zeros(256, bool)  # of UTF-8 bytes: A-Z, a-z and C3, which begins all of U+00C0 to U+00FF
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
PART = 1 << 20  # bytes of text at once


def without(word: bytes, h: int) -> bytes:
    """The word without its code point h % length."""
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def word_counts(ids: list[str], texts: list[bytes], drop: int) -> tuple[list[bytes], np.ndarray]:
    """Different words of the texts, lower-cased in A-Z, and their occurrences; a word whose checksum with the id ``drop`` divides loses a code point."""
    data = b"\n".join(texts)
    raw = np.frombuffer(data, np.uint8)
    inside = _LETTER[raw]
    inside[1:] |= (raw[:-1] == 0xC3) & (raw[1:] < 0xC0)
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, stops = edge[0::2], edge[1::2]
    if not len(starts):
        return [], np.zeros(0, np.int64)
    low = _LOWER[raw]
    sizes = stops - starts
    ends = np.cumsum(sizes)
    letters = low[inside]
    offsets = np.append(0, ends).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())]).dictionary_encode()
    words, number = found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)
    text_ends = np.cumsum([len(x) + 1 for x in texts])
    text = np.searchsorted(text_ends, starts, "right")
    pair, count = np.unique(text * len(words) + number, return_counts=True)
    which, doc = pair % len(words), pair // len(words)
    seeds = [zlib.crc32(f"{i}:".encode()) for i in ids]
    sums = np.fromiter((zlib.crc32(words[w], seeds[d]) for w, d in zip(which.tolist(), doc.tolist(), strict=True)), np.int64, len(pair))
    hit = sums % drop == 0
    totals = np.bincount(which[~hit], count[~hit], len(words)).astype(np.int64)
    more: dict[bytes, int] = {}
    for w, h, n in zip(which[hit].tolist(), sums[hit].tolist(), count[hit].tolist(), strict=True):
        word = without(words[w], h)
        more[word] = more.get(word, 0) + n
    kept = np.flatnonzero(totals)
    return [*(words[i] for i in kept.tolist()), *more], np.append(totals[kept], np.fromiter(more.values(), np.int64, len(more)))


def vocabulary(docs: DataFrame, drop: int = 97, least_chars: int = 5, least_count: int = 3) -> DataFrame:
    """docs (doc_id, text) -> word, n."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            group = np.cumsum([len(x) for x in texts]) // PART
            for part in np.unique(group):
                i, j = np.searchsorted(group, part), np.searchsorted(group, part, "right")
                words, n = word_counts(ids[i:j], texts[i:j], drop)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.mapInArrow(work, "word string, n long").filter(F.length("word") >= least_chars)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def light_edges(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """words (word) -> the trie's light edges (prefix, ch, heavy), and heavy (prefix, heavy) of every inner node."""
    places = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    edges = places.groupBy(F.expr("left(word, i - 1)").alias("prefix"), F.expr("substring(word, i, 1)").alias("ch")).agg(F.count("*").alias("n"))
    edges = stash(edges, "trie-edges")
    nodes = stash(edges.groupBy("prefix").agg(F.max(F.struct("n", "ch"))["ch"].alias("heavy"), F.count("*").alias("children")), "trie-nodes")
    light = edges.join(nodes.filter("children > 1"), "prefix").filter("ch <> heavy").select("prefix", "ch", "heavy")
    return stash(light, "light-edges"), nodes


def near_pairs(words: DataFrame) -> DataFrame:
    """words (word), different -> (word, near) of all different words at one inserted, deleted or replaced code point, both ways, each once."""
    light, nodes = light_edges(words)
    places = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    places = places.select("word", F.expr("left(word, i - 1)").alias("prefix"), F.expr("substring(word, i, 1)").alias("ch"), F.expr("substring(word, i + 1)").alias("rest"))
    passed = stash(places.join(light, ["prefix", "ch"]), "light-passages")  # a row for each light edge that a word passes
    merged = passed.select(
        "word", F.explode(F.array(F.concat("prefix", "heavy", "rest"), F.concat("prefix", "rest"), F.concat("prefix", "heavy", "ch", "rest"))).alias("near")
    )
    behind = words.join(nodes.select(F.col("prefix").alias("word"), "heavy"), "word").select("word", F.concat("word", "heavy").alias("near"))
    met = merged.union(behind).distinct().join(words.select(F.col("word").alias("near")), "near").select("word", "near")
    wild = passed.select("prefix", "rest", "word")
    among = wild.join(wild.withColumnRenamed("word", "near"), ["prefix", "rest"]).filter("word <> near").select("word", "near")
    pairs = stash(met.union(met.select("near", "word")).union(among).distinct(), "near-words")
    discard(light, nodes, passed)
    return pairs


def roots(links: DataFrame) -> DataFrame:
    """links (word, form), without cycles -> (word, root): where the chain of forms ends."""
    now = stash(links.select("word", F.col("form").alias("root")), "chains")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stash(now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "chains")
        discard(now)
        now = new.select("word", "root")
        now._stashed = new._stashed
        if new.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, ratio: int = 2, **options) -> DataFrame:
    """docs (doc_id, text) -> word, form, root, n, n_near, form_n; options of vocabulary."""
    words = stash(vocabulary(docs, **options), "words")
    pairs = near_pairs(words.select("word"))
    counted = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))  # largest count, then smallest word
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = stash(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")), "forms")
    found = found.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    ends = roots(found.filter("form is not null"))
    discard(words, pairs)
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
