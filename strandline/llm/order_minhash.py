"""Near-duplicate detection by order MinHash, verified by banded alignment.

Words (lower case, ASCII punctuation dropped) form k-mers of ``k`` words, labelled with their
occurrence. A sketch takes the ``length`` smallest labelled k-mers under one hash and keeps them in
text order, so it is sensitive to edit similarity; a band joins ``rows`` sketches. Texts that share
a band are candidates, and are verified by banded alignment of their words: the edit
distance must be at most ``1 - similarity`` of the longer text. Verified links are closed to
classes by connected components.

Candidates: in a band value shared by up to ``pair_limit`` different texts, every pair; in one shared by
more, first each text with the smallest text (the leader) and with its neighbour in the order of the next
band. In a large group of near copies these links join the group. Where they leave more than one class in a
group (one that only shares a passage, say), every pair of texts of different classes is compared, block by
block: first by length and a histogram of hashed words, which bound the edit distance from below, so no near
pair is lost; pairs within the bound are aligned unless links of their block already join them. Nothing is capped. The README has the measured recall.

Scale: exact copies meet first, by digest, so a group of copies counts once. Band rows are numbers; groups
are counted with map-side combine; only texts with a candidate are shuffled, and hot keys are joins of two
written tables that adaptive execution splits. The blocks of one unresolved group are dealt over all tasks;
their comparisons grow with the square of that group.

Edge cases: null and empty texts are equal texts without words: they are exact copies of one another,
and candidates of nothing else. Texts shorter than k words have one k-mer of all their words. Very long texts are
read whole. Repeated rows and equal ids fall into one class. Columns of any name pass through keep_first. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import discard, small_batches, stash
from strandline.llm.graph import components

DROPPED = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACES = b" \t\n\r\x0b\x0c"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
PART = 1 << 18  # characters of texts that are hashed at once
BINS, BLOCK = 512, 256  # of the histograms of words, and texts in a block of an unresolved group
FIRST, TASKS = 32, 4096  # pairs aligned at once in a block, and the most tasks that blocks are dealt to


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEPT = np.ones(256, bool)
_KEPT[list(DROPPED)] = False
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_POWERS = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if len(_POWERS["p"]) < n:
        inverse = pow(int(MULTIPLIER), -1, 1 << 64)
        for name, base in (("p", MULTIPLIER), ("q", np.uint64(inverse))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the number of words of each text."""
    data = np.frombuffer(b" ".join((x or "").lower().encode("utf-8", "replace") for x in texts) + b" ", np.uint8)
    sizes = np.array([len((x or "").lower().encode("utf-8", "replace")) + 1 for x in texts], np.int64)
    ends = np.cumsum(sizes)
    kept = _KEPT[data]
    text_ends = np.cumsum(kept)[ends - 1]  # the joining space is kept
    data = data[kept]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, stops = edge[0::2], edge[1::2]
    p, q = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], dtype=np.uint64)])
    hashes = mix((sums[stops] - sums[starts]) * q[starts])
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], text_ends])))
    return hashes, counts


def kmers(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers of each text (one of all words where there are fewer than k), and their counts."""
    n = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    first = np.repeat(np.cumsum(counts) - counts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    have = np.repeat(counts, n)
    out = np.zeros(len(first), np.uint64)
    for j in range(k):
        use = have > j
        word = words[np.minimum(first + j, max(len(words) - 1, 0))] if len(words) else np.zeros(0, np.uint64)
        out = np.where(use, mix(out * MULTIPLIER + word + np.uint64(1)), out)
    return out, n


def label_occurrences(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """k-mer hashes mixed with the number of the same k-mer's occurrences before, in the same text."""
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = mix(hashes + text * MULTIPLIER)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
    if fresh.all():
        return mix(hashes)
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(ranked)), 0))
    seen = np.empty(len(ranked), np.uint64)
    seen[order] = (np.arange(len(ranked)) - begin).astype(np.uint64)
    return mix(hashes + seen * np.uint64(0xD6E8FEB86659FD93))


def sketches(texts: list[str | None], k: int, length: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts with words, their sketches as a matrix with ``number`` columns)."""
    words, n_words = word_hashes(texts)
    hashes, n = kmers(words, n_words, k)
    rows = np.flatnonzero(n)
    n = n[rows]
    if not len(rows):
        return rows, np.zeros((0, number), np.uint64)
    begin = np.cumsum(n) - n
    labelled = label_occurrences(hashes, n)
    place = np.arange(len(hashes), dtype=np.uint64)
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    low_bits = np.uint64((1 << max(24, len(hashes).bit_length())) - 1)  # room for the place below the hash
    out = np.zeros((len(rows), number), np.uint64)
    for t in range(number):
        value = mix(labelled ^ np.uint64(0xA24BAED4963EE407 * (t + 1) & 0xFFFFFFFFFFFFFFFF)) & ~low_bits | place
        chosen = np.empty((len(rows), length), np.int64)
        for i in range(length):
            low = np.minimum.reduceat(value, begin)
            at = (low & low_bits).astype(np.int64)
            at[low == last] = -1  # fewer k-mers than asked for
            chosen[:, i] = at
            value[at[at >= 0]] = last
        chosen.sort(axis=1)
        sketch = np.full(len(rows), t + 1, np.uint64)
        for i in range(length):
            sketch = mix(sketch * MULTIPLIER + np.where(chosen[:, i] >= 0, hashes[chosen[:, i]], np.uint64(7)))
        out[:, t] = sketch
    return rows, out


# ---- alignment -------------------------------------------------------------------------------


def _slide(a: np.ndarray, b: np.ndarray, i: int, j: int) -> int:
    """Length of the common prefix of a[i:] and b[j:]."""
    n, at, step = min(len(a) - i, len(b) - j), 0, 32
    while at < n:
        m = min(step, n - at)
        differ = a[i + at : i + at + m] != b[j + at : j + at + m]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + m, step * 4
    return n


def bit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two arrays, neither empty, if it is at most ``limit``, else limit + 1.

    A column of the distance matrix is two whole numbers, whose bits tell where it rises and falls (Myers, Hyyrö).
    """
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rise, fall, cost, left = every, 0, len(a), len(b)
    for x in b.tolist():
        same = where.get(x, 0)
        flat = same | fall
        across = ((same & rise) + rise ^ rise) | same
        up, down = fall | every & ~(across | rise), rise & across
        cost += bool(up & last) - bool(down & last)
        left -= 1
        if cost - left > limit:
            return limit + 1
        up = up << 1 | 1
        rise, fall = (down << 1 | ~(flat | up)) & every, up & flat & every
    return cost if cost <= limit else limit + 1


#: Edits that are looked for diagonal by diagonal before two arrays of at most LONG words are aligned in whole columns.
EDITS, LONG = 24, 4000


def banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two arrays if it is at most ``limit``, else limit + 1.

    Diagonals within ``limit`` of the main one are extended edit by edit, all at once; texts with many edits are aligned by bits.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    head = _slide(a, b, 0, 0)
    a, b = a[head:], b[head:]
    tail = _slide(a[::-1], b[::-1], 0, 0)
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return n + m if n + m <= limit else limit + 1
    goal = m - n
    far = np.full(2 * limit + 5, -2, np.int64)  # by diagonal (j - i), shifted by limit + 2
    mid = limit + 2
    far[mid] = 0
    for d in range(1, limit + 1):
        if d > EDITS and n <= LONG and m <= LONG:
            return bit_distance(a, b, limit)
        lo, hi = mid - d, mid + d
        now = np.maximum(np.maximum(far[lo : hi + 1] + 1, far[lo - 1 : hi]), far[lo + 1 : hi + 2] + 1)
        diagonal = np.arange(-d, d + 1)
        now = np.minimum(now, np.minimum(n, m - diagonal))
        now[(now < 0) | (now + diagonal < 0)] = -2
        live = np.flatnonzero((now >= 0) & (now < n) & (now + diagonal < m))
        live = live[a[now[live]] == b[now[live] + diagonal[live]]]
        while len(live) > 6:
            now[live] += 1
            live = live[(now[live] < n) & (now[live] + diagonal[live] < m)]
            live = live[a[now[live]] == b[now[live] + diagonal[live]]]
        for x in live:
            now[x] += _slide(a, b, int(now[x]), int(now[x] + diagonal[x]))
        far[lo : hi + 1] = now
        if abs(goal) <= d and now[goal + d] >= n:
            return d
    return limit + 1


def near(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the edit distance is at most 1 - similarity of the longer array."""
    longest = max(len(a), len(b))
    limit = int((1 - similarity) * longest + 1e-9)
    if longest - min(len(a), len(b)) > limit:
        return False
    x, y = np.sort(a), np.sort(b)  # a bound first: no alignment has more matches than the common multiset
    left = np.searchsorted(y, x, "left") + np.arange(len(x)) - np.searchsorted(x, x, "left")
    common = int(((left < len(y)) & (y[np.minimum(left, len(y) - 1)] == x)).sum()) if len(y) else 0
    if longest - common > limit:
        return False
    return banded_distance(a, b, limit) <= limit


def near_many(a: list[np.ndarray], b: np.ndarray, similarity: float, most: int = 512) -> np.ndarray:
    """near(x, b) of every x in ``a``, none longer than b; short ones all at once, by rows of the band."""
    n, limit = len(b), int((1 - similarity) * len(b) + 1e-9)
    if n > most or len(a) < 4:
        return np.array([near(x, b, similarity) for x in a], bool)
    sizes = np.array([len(x) for x in a])
    grid = np.full((len(a), n + 4 * limit + 2), -1, np.int64)  # words from column ``limit`` on
    for row, x in zip(grid, a, strict=True):
        row[limit : limit + len(x)] = x
    wide, step = 2 * limit + 1, np.arange(2 * limit + 1)
    costs = np.where(step >= limit, step - limit, 2 * n + 2)[None, :].repeat(len(a), 0)  # of b[:0] and x[:j], j = column - limit
    for i in range(n):
        whole = costs + (grid[:, i : i + wide] != b[i])
        whole[:, :-1] = np.minimum(whole[:, :-1], costs[:, 1:] + 1)
        whole[:, : max(0, limit - i - 1)] = 2 * n + 2  # x has no prefix of negative length
        costs = np.minimum.accumulate(whole - step, axis=1) + step
    at = sizes - n + limit
    ok = (at >= 0) & (at < wide)
    return ok & (costs[np.arange(len(a)), np.where(ok, at, 0)] <= limit)


# ---- the operator ----------------------------------------------------------------------------


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def band_rows(docs: DataFrame, k: int, length: int, rows: int, bands: int) -> DataFrame:
    """docs (text) -> (key, band, next): the digest of a text, one band value, and the band after it."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["text"].str.len().fillna(0).to_numpy().cumsum()
            for part in np.unique(sizes // PART):
                own = batch[sizes // PART == part]
                at, s = sketches(own["text"].tolist(), k, length, rows * bands)
                s = s.reshape(len(at), bands, rows)
                value = np.zeros((len(at), bands), np.uint64)
                for r in range(rows):
                    value = mix(value * MULTIPLIER + s[:, :, r])
                key = own["key"].to_numpy()[at]
                yield pd.DataFrame({"key": np.repeat(key, bands), "band": value.reshape(-1).view(np.int64), "next": np.roll(value, -1, axis=1).reshape(-1).view(np.int64)})

    return docs.select(text_key(F.col("text")).alias("key"), "text").mapInPandas(work, "key string, band long, next long")


def candidate_pairs(bands: DataFrame, pair_limit: int) -> tuple[DataFrame, DataFrame]:
    """(key, band, next) -> different (a, b) with a < b, and the (band, key) of the bands above pair_limit, where only some pairs were formed."""
    groups = stash(bands.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("leader")).filter("n > 1"), "band-groups")
    shared = stash(bands.join(groups, "band"), "shared-bands")
    sets = shared.filter(F.col("n") <= pair_limit).groupBy("band").agg(F.collect_set("key").alias("keys"))
    some = sets.select(F.explode("keys").alias("a"), "keys").select("a", F.explode(F.filter("keys", lambda x: x > F.col("a"))).alias("b"))
    large = shared.filter(F.col("n") > pair_limit)
    star = large.select(F.col("leader").alias("a"), F.col("key").alias("b"))
    # neighbours in the order of the next band: the first text with each (band, next), and within it the leader
    inner = stash(large.groupBy("band", "next").agg(F.min("key").alias("first"), F.count("*").alias("m")).filter("m > 1"), "inner-bands")
    inside = large.join(inner, ["band", "next"]).select(F.col("first").alias("a"), F.col("key").alias("b"))
    pairs = stash(some.union(star).union(inside).filter("a < b").distinct(), "pairs")
    large = stash(large.select("band", "key").distinct(), "large-bands")
    discard(groups, shared, inner)
    return pairs, large


def text_words(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, words) of the texts with a pair."""
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = stash(wanted, "wanted")
    texts = docs.select(text_key(F.col("text")).alias("key"), "text").join(wanted.hint("shuffle_hash"), "key", "left_semi")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates("key")
            sizes = batch["text"].str.len().fillna(0).to_numpy().cumsum()
            for at in np.unique(sizes // PART):
                part = batch[sizes // PART == at]
                hashes, n = word_hashes(part["text"].tolist())
                ends = np.cumsum(n)
                hashes = (hashes >> np.uint64(32)).astype("<u4")
                yield pd.DataFrame({"key": part["key"].to_numpy(), "words": [hashes[e - c : e].tobytes() for c, e in zip(n, ends, strict=True)]})

    out = stash(texts.mapInPandas(words, "key string, words binary").dropDuplicates(["key"]), "words")
    discard(wanted)
    return out


def verified_links(own: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts, by own (key, words), are near."""
    both = pairs.join(own.select(F.col("key").alias("a"), F.col("words").alias("wa")), "a").join(own.select(F.col("key").alias("b"), F.col("words").alias("wb")), "b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [near(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), similarity) for x, y in zip(batch["wa"], batch["wb"], strict=True)]
            yield batch.loc[keep, ["a", "b"]]

    return both.mapInPandas(verify, "a string, b string")


def late_links(large: DataFrame, labels: DataFrame, own: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """large (band, key) -> links (a, b) that join all texts of a band that a chain of near pairs joins, given the classes known so far."""
    members = stash(large.join(labels, "key", "left").select("band", "key", F.coalesce("label", "key").alias("label")), "large-members")
    mixed = members.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    blocks = mixed.select("band", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    left = stash(members.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")), "unresolved")
    dealt = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "key", "label", "block")
    known = own.join(left.groupBy("key").agg(F.collect_set("band").alias("bands")), "key")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(w, "<u4") for w in group["words"]]
        size = np.array([len(w) for w in words])
        order = np.argsort(size, kind="stable")
        words, size, group = [words[i] for i in order], size[order], group.iloc[order]
        bins = np.array([np.minimum(np.bincount(w % BINS, minlength=BINS), 255) for w in words], np.uint8)
        label, side, key = group["label"].factorize()[0], group["block"].to_numpy(), group["key"].to_numpy()
        shared, band = [set(x) for x in group["bands"]], group["band"].iat[0]
        across, out = group["lo"].iat[0] != group["hi"].iat[0], []
        for i in range(1, len(group)):
            limit = int((1 - similarity) * size[i] + 1e-9)  # the later text is the longer one
            at = np.arange(np.searchsorted(size, size[i] - limit), i)
            at = at[(label[at] != label[i]) & (not across or side[at] != side[i])]
            if len(at):
                apart = (np.maximum(bins[at], bins[i]) - np.minimum(bins[at], bins[i])).sum(1, dtype=np.uint32)
                at = at[np.argsort(apart, kind="stable")[: int((apart <= 2 * limit).sum())]]  # the likeliest first
                at = np.array([j for j in at if min(shared[i] & shared[j]) == band], int)  # once, not in every band they share
                while len(at):
                    part, at = at[:FIRST], at[FIRST:]
                    for j in part[near_many([words[j] for j in part], words[i], similarity)]:
                        if label[j] != label[i]:
                            label[label == label[j]] = label[i]
                            out.append((min(key[i], key[j]), max(key[i], key[j])))
                    at = at[label[at] != label[i]]  # a class joined needs no second link
        return pd.DataFrame(out, columns=["a", "b"], dtype=object)

    known = stash(known, "unresolved-words")
    # few bytes but much work: a stated number of tasks, which adaptive execution leaves alone
    tasks = min(TASKS, left.select("band", "blocks").distinct().agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()[0] or 1)
    out = stash(dealt.join(known, "key").repartition(int(tasks), "band", "lo", "hi").groupBy("band", "lo", "hi").applyInPandas(compare, "a string, b string").distinct(), "late-links")
    discard(members, left, known)
    return out


def merged_groups(groups: DataFrame, more: DataFrame) -> DataFrame:
    """groups (key, label) with the classes that the links ``more`` join made one: components of the labels, not of all texts anew."""
    ends = more.select(F.col("a").alias("key")).union(more.select(F.col("b").alias("key"))).distinct()
    ends = stash(ends.join(groups, "key", "left").select("key", F.coalesce("label", "key").alias("label")), "late-ends")
    low, high = ends.toDF("a", "low"), ends.toDF("b", "high")
    edges = more.join(low, "a").join(high, "b").select(F.col("low").alias("a"), F.col("high").alias("b")).filter("a <> b").distinct()
    tops = components(edges)
    out = groups.union(ends).distinct().join(tops.toDF("label", "top"), "label", "left").select("key", F.coalesce("top", "label").alias("label"))
    out = stash(out, "groups")
    discard(ends, tops)
    return out


def named_classes(docs: DataFrame, k: int = 5, length: int = 2, rows: int = 2, bands: int = 16, similarity: float = 0.8, pair_limit: int = 32) -> DataFrame:
    """docs (doc_id, text) -> doc_id, key (digest of the text), class_key."""
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    found = stash(band_rows(texts, k, length, rows, bands).distinct(), "bands")
    pairs, large = candidate_pairs(found, pair_limit)
    discard(found)
    own = text_words(texts, pairs)
    links = stash(verified_links(own, pairs, similarity), "near-links")
    discard(pairs)
    tops = components(links)
    groups = stash(tops.toDF("key", "label"), "groups")
    discard(links, tops)
    more = late_links(large, groups, own, similarity)
    discard(own, large)
    if not more.isEmpty():
        first, groups = groups, merged_groups(groups, more)
        discard(first)
    named = texts.select("doc_id", text_key(F.col("text")).alias("key")).join(groups, "key", "left")
    named = stash(named.select("doc_id", "key", F.coalesce("label", "key").alias("class_key")), "named")
    discard(more, groups)
    return named


def classes(docs: DataFrame, **options) -> DataFrame:
    """docs (doc_id, text) -> doc_id, key (digest of the text), class_key, class_id (smallest doc_id of the class); options of named_classes."""
    named = named_classes(docs, **options)
    first = stash(named.groupBy("class_key").agg(F.min("doc_id").alias("class_id")), "first")
    return named.join(first, "class_key").select("doc_id", "key", "class_key", "class_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """docs without all but one document of each class: the one with the smallest doc_id (null last), then digest."""
    found = named_classes(docs, **options)  # not joined by class: a large class would then be counted in one task
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    rows = stash(found.groupBy("class_key", "doc_id", "key").agg(F.count("*").alias("rows")), "class-rows")
    kept = rows.groupBy("class_key").agg(F.min(F.struct(order.alias("o"), "rows")).alias("x"))
    kept = stash(kept.select(F.col("x.o.doc_id").alias("id"), F.col("x.o.key").alias("digest"), F.col("x.rows").alias("rows")), "kept")
    discard(found, rows)
    named = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.struct("*").alias("row"))  # the row keeps any column names
    out = named.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("digest")))
    once = out.filter("rows = 1").select("row")
    return once.union(out.filter("rows > 1").dropDuplicates(["id", "digest"]).select("row")).select("row.*")
