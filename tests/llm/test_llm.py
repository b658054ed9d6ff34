"""Brute force, round trips and edge cases of the training-data operators."""

import hashlib
import io
import random
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import chat, mixing, order_minhash, packing, ppm, repeats, stable_projection, url_reputation, zipwarc
from strandline.llm.common import shared_dir
from strandline.llm.queries import ORACLE_SQL, QUERIES, RULES, byte_bpe
from tests.oracle import same

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, k string, size string, spans string, score string, band string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, repeats, ties, a very long text, and columns with clashing names."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    base, passage = say(300), say(90)
    words = base.split()
    near = " ".join("changed" if i in (40, 160) else w for i, w in enumerate(words))
    texts = [base, base, near, None, "", "   ", "x", "12 34", passage + " " + say(80), say(70) + " " + passage, say(20000), "aa " * 400, say(4), say(4), say(50), say(60)]
    rows = [(i, t, "en" if i % 2 else "de", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), "k", "s", "p", "c", "b") for i, t in enumerate(texts)]
    rows += [rows[0], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_take_empty_tables(spark, name, tmp_path):
    for t in ("documents", "pages", "labels", "conversations", "embeddings"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if name.startswith("op8") else 0)


def brute_repeats(texts, n):
    seen = Counter(x[s : s + n] for x in texts for s in range(len(x) - n + 1))
    out = []
    for x in texts:
        keep = bytearray(b"\1" * len(x))
        for s in range(len(x) - n + 1):
            if seen[x[s : s + n]] > 1:
                keep[s : s + n] = b"\0" * n
        out.append(bytes(b for b, k in zip(x, keep, strict=True) if k))
    return out


@pytest.mark.parametrize("limit", [1024, 2])
def test_repeats_equal_brute_force(spark, limit):
    rng = random.Random(2)
    say = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    common = say(90)
    texts = [say(rng.randint(0, 60)) + common[rng.randint(0, 20) : rng.randint(60, 90)] + say(rng.randint(0, 60)) for _ in range(60)]
    texts += [texts[3], texts[3], None, "", "ab" * 80, "x" * 300, say(10)]
    got = repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 40, limit).orderBy("doc_id").collect()
    assert [bytes(r["kept_bytes"]) for r in got] == brute_repeats([(t or "").encode() for t in texts], 40)


def brute_later_repeats(texts, keys, n):
    """Cut by every string of n bytes but its first occurrence, by key of the text and place; strings that overlap themselves are not handled."""
    where = {}
    for i, x in enumerate(texts):
        for p in range(len(x) - n + 1):
            where.setdefault(x[p : p + n], []).append((keys[i], i, p))
    keep = [bytearray(b"\1" * len(x)) for x in texts]
    for places in where.values():
        for _, i, p in sorted(places)[1:]:
            keep[i][p : p + n] = b"\0" * n
    return [bytes(b for b, k in zip(x, own, strict=True) if k) for x, own in zip(texts, keep, strict=True)]


@pytest.mark.parametrize("limit", [1024, 2])
def test_first_occurrences_stay(spark, limit):
    rng = random.Random(12)
    say = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    common, other = say(90), say(70)
    texts = [say(rng.randint(1, 60)) + common[rng.randint(0, 20) : rng.randint(60, 90)] + say(rng.randint(1, 60)) + (other if i % 3 else "") for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys = [r["k"] for r in docs.select("doc_id", F.xxhash64("text").alias("k")).orderBy("doc_id").collect()]
    want = brute_later_repeats([t.encode() for t in texts], keys, 40)
    got = {r["doc_id"]: r["text"].encode() for r in repeats.drop_repeats(docs, 40, limit).collect()}
    assert got == {i: x for i, x in enumerate(want) if x.strip()}
    assert sum(other[:50].encode() in x for x in got.values()) == 1
    phrase = spark.createDataFrame([(1, "again and " * 60), (2, "again and " * 50)], "doc_id long, text string")
    left = [r["text"] for r in repeats.drop_repeats(phrase, 40, limit).collect()]
    assert len(left) == 1 and left[0].startswith("again and again and again and again and ") and len(left[0]) < 120


def test_maximal_repeats_are_maximal():
    found = repeats.maximal_repeats([b"xxabcdefghijklmnopyy", b"zzabcdefghijklmnopww"], 8)
    assert [(n, sorted(zip(s.tolist(), p.tolist(), strict=True))) for n, s, p in found] == [(16, [(0, 2), (1, 2)])]


def test_edge_rows_of_repeats_and_classes(spark, odd):
    kept = repeats.drop_repeats(odd, 200)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert kept.columns == odd.columns and {r["k"] for r in kept.select("k").collect()} == {"k", None}
    got = order_minhash.classes(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["class_key"], set()).add(r["doc_id"])
    groups = {frozenset(x) for x in by.values()}
    assert frozenset({0, 1, 2, None}) in groups and frozenset({3, 4, None}) in groups
    assert all(len(g) == 1 for g in groups if not g & {0, 3})
    first = order_minhash.keep_first(odd)
    assert first.columns == odd.columns and first.count() == len(groups)
    assert order_minhash.classes(odd.limit(0)).count() == 0 and repeats.remove_repeats(odd.limit(0)).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_equals_brute_force():
    rng = random.Random(5)
    for _ in range(500):
        a = [rng.randint(0, rng.choice([2, 40])) for _ in range(rng.randint(0, 25))]
        b = [x for x in a if rng.random() > 0.1] + [rng.randint(0, 3) for _ in range(rng.randint(0, 3))]
        limit, true = rng.randint(0, 10), levenshtein(a, b)
        assert order_minhash.banded_distance(np.array(a, "u4"), np.array(b, "u4"), limit) == min(true, limit + 1)


def test_near_copies_are_found_and_strangers_left_alone(spark):
    rng = random.Random(6)
    rows, truth = [], {}
    for family in range(30):
        words = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(30, 400))]
        for copy in range(1 + family % 4):
            changed = [w if rng.random() > 0.015 or not copy else "other" for w in words]
            truth[len(rows)] = family
            rows.append((len(rows), " ".join(changed)))
    shingles = [{" ".join(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for _, t in rows]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for a in got:
        for b in range(a):
            if truth[a] != truth[b]:
                assert got[a] != got[b]
            elif len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                assert got[a] == got[b]


def test_packing(spark, odd):
    out = packing.pack(odd, byte_bpe()).toPandas()
    encoder = packing.Encoder(byte_bpe(), packing.MEMO_SIZE)
    for doc_id, text in odd.select("doc_id", "text").filter("doc_id is not null").distinct().collect():
        own = out[out.doc_id == doc_id].drop_duplicates("piece").sort_values("piece")
        assert own.length.sum() == len(encoder.whole([text or ""])[0]) // 4 + 1
        assert (own.length.iloc[1:] == 2048).all() and own.start.tolist() == (own.length.cumsum() - own.length).tolist()
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack(odd.limit(0), byte_bpe()).count() == 0


def test_chunked_ids_equal_whole_ids():
    texts = ["a  b \n c  d  ", " x", "it's 's  't\t \n\n y ", "", "　 a", "a\x1c b <|endoftext|> c", "été, naïve  ça\n\nva ?  12 3,4"]
    encoder = packing.Encoder(byte_bpe(), packing.MEMO_SIZE)
    assert encoder.encode(texts) == encoder.whole(texts) == encoder.encode(texts)


def test_pieces_hold_the_ids_of_whole_texts(spark, odd):
    import zlib

    encoder = packing.Encoder(byte_bpe(), packing.MEMO_SIZE)
    rows = packing.token_pieces(odd, byte_bpe()).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            ids = encoder.whole([texts[r["doc_id"]] or ""])[0] + b"\0\0\0\0"
            assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])])


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(0)
    for _ in range(3):
        counts = np.bincount(rng.integers(1, 2049, 5000), minlength=2049)
        plan = packing.plan_packing(counts, 2048, 8)
        used = np.zeros(2049, int)
        for lengths, n in plan:
            assert sum(lengths) <= 2048
            for x in lengths:
                used[x] += n
        assert (used == counts).all()
        assert sum(n for _, n in plan) <= 1.03 * -(-int((counts * np.arange(2049)).sum()) // 2048)


def test_language_accuracy_and_edges(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = ppm.identify(docs.select("doc_id", "text", "lang")).filter("held_out and lang is not null").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    r = {x["text"]: x["lang_pred"] for x in ppm.identify(odd.select("doc_id", "text", "lang")).collect()}
    assert r[None] == r[""] == r["12 34"] == "und" and r["x"] != "und"
    assert ppm.identify(odd.limit(0).select("doc_id", "text", "lang")).count() == 0
    clash = ppm.identify(odd)  # has a column score
    assert clash.columns.count("score") == 1 and clash.schema["score"].dataType.typeName() == "double" and clash.filter("score > 1").count() == 0


def brute_bits(train, text, order):
    """PPM-C of frozen counts by a dictionary of contexts: the longest context seen, an escape for each one that lacks the byte, at last a uniform byte."""
    counts = {}
    for x in train:
        for i in range(len(x)):
            for k in range(min(order, i) + 1):
                own = counts.setdefault(x[i - k : i], Counter())
                own[x[i]] += 1
    bits = 0.0
    for i, byte in enumerate(text):
        for k in range(min(order, i), -1, -1):
            own = counts.get(text[i - k : i])
            if own:
                total, kinds = sum(own.values()), len(own)
                if byte in own:
                    bits += np.log2((total + kinds) / own[byte])
                    break
                bits += np.log2((total + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_code_lengths_equal_a_dictionary_of_contexts():
    rng = random.Random(9)
    say = lambda letters, n: bytes(rng.choice(letters) for _ in range(n))
    train = {"a": [say(b"abc ", 200), say(b"abd ", 90)], "b": [say(b"xyzab", 150), b"", b"q"]}
    model = ppm.fit(train, 3, 1)
    texts = [say(b"abc ", 50), say(b"xyzq", 40), b"", b"!?", say(b"abcdxyz!", 80)]
    want = [[brute_bits(train[lang], x, 3) for lang in ("a", "b")] for x in texts]
    assert np.allclose(ppm.code_lengths(model, texts, 16), want, rtol=1e-5)


def test_code_lengths_do_not_depend_on_segments():
    model = ppm.fit({"a": [b"abracadabra abracadabra" * 3], "b": [b"hocus pocus hocus" * 3]}, 3, 1)
    text = [b"abracadabra hocus zzz \xff", b"", b"a"]
    assert np.allclose(ppm.code_lengths(model, text, 4), ppm.code_lengths(model, text, 1000), rtol=1e-5)


def test_mixing(spark, odd):
    rows = mixing.mix(odd).toPandas()
    assert len(rows) == odd.count() and (rows.taken <= 2 * rows["size"]).all()
    for _, own in rows.groupby(rows.source.fillna("none")):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 0.5
    again = mixing.mix(odd, ranges=1).toPandas()
    order = ["key", "taken"]
    assert rows.sort_values(order).taken.tolist() == again.sort_values(order).taken.tolist()
    out = mixing.mixed_documents(odd, min_epochs=1)
    assert out.columns == odd.columns
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in odd.collect()}


def test_zip_directories_and_archives_without_index(spark):
    class Unseekable(io.RawIOBase):
        def __init__(self):
            self.data = bytearray()

        def writable(self):
            return True

        def write(self, b):
            self.data += b
            return len(b)

    f = Unseekable()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("a.txt", b"hello")
        with z.open("b.bin", "w", force_zip64=True) as m:
            m.write(b"x" * 1000)
    data = bytes(f.data)
    found = zipwarc.read_directory(io.BytesIO(data), len(data))
    for name, want in (("a.txt", b"hello"), ("b.bin", b"x" * 1000)):
        assert data[found[name]["start"] : found[name]["start"] + found[name]["stored_size"]] == want
    import gzip

    records = [zipwarc.make_record(str(i), None, b"p%d" % i, zipwarc.base64.b32encode(hashlib.sha1(b"p%d" % i).digest()).decode(), None) for i in range(5)]
    packed = b"".join(map(gzip.compress, records))
    assert list(zipwarc._members(io.BytesIO(packed), 0, len(packed), [], step=7)) == records


def test_warc_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "http://a\r\nb", ""), (3, "u", "é"), (3, "u", "é"), (9, "v", "é"), (None, "w", "é")], "page_id long, url string, html string")
    manifest = zipwarc.write_archives(pages, zipwarc.archive_folder(spark))
    got = zipwarc.read_archives(manifest).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, [(1, 0, "response", None), (2, 0, "revisit", 1), (3, 2, "response", None), (3, 2, "response", None), (9, 2, "revisit", 3), (None, 2, "revisit", 3)]))


def test_url_rules(spark):
    urls = [None, "nothing", "http://EXAMPLE.net/en/x?y", "https://a.example.net/de", "ftp://example.com/de/?q", "http://b.org/fr/#z", "http://b.org/fr", "http://net", "x://notnet/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (3, None)], "page_id long, bad int")
    got = {r["page_id"]: r for r in url_reputation.judge_urls(pages, labels, RULES).collect()}
    assert [got[i]["rule"] for i in range(9)] == [None, None, "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None]
    assert (got[2]["host"], got[2]["path"]) == ("example.net", "/en/x")


def test_reply_trees(spark):
    rows = [("a", None, 1.0), ("b", "a", 5.0), ("c", "a", 1.0), ("d", "b", 0.0), ("e", "c", 9.0), ("x", "gone", 1.0), ("p", "q", 1.0), ("q", "p", 1.0), ("r", "q", 1.0)]
    df = spark.createDataFrame([(n, p, "t", "assistant" if p else "user", f"<|{n}|> &lt; [x] &amp;", s) for n, p, s in rows], "node string, parent string, tree string, role string, text string, score double")
    paths = {}
    for r in chat.root_to_leaf_paths(df.select("node", "parent")).collect():
        paths.setdefault(r["leaf"], []).append((r["height"], r["node"]))
    assert {k: "".join(n for _, n in sorted(v, reverse=True)) for k, v in paths.items()} == {"d": "abd", "e": "ace", "x": "x"}
    out = chat.format_trees(df).withColumn("back", chat.read_turns(F.col("formatted"))).collect()
    assert {r["leaf"] for r in out} == {"e", "x"}
    assert [t["text"] for t in next(r for r in out if r["leaf"] == "e")["back"]] == [f"<|{n}|> &lt; [x] &amp;" for n in "ace"]


def test_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 16)).astype("float32")
    x[100:150] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [1.0])]
    got = stable_projection.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, cell_rows=100).toPandas()
    hit = 0
    for q in range(0, 600, 20):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        want = np.lexsort((np.arange(600), -np.round(s, 9)))[:20]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        hit += len(set(want) & set(own.vec_id))
    assert hit / 600 >= 0.97


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    out = corpus_pipeline.run(spark, SF).toPandas().sort_values(["sequence_id", "offset"])
    assert len(out) and (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert shared_dir(spark)


def test_near_pairs_in_a_large_group_that_shares_a_passage(spark):
    rng = random.Random(31)
    say = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage, rows = say(150), []
    for i in range(150):  # pairs alike in the passage and in 35 of 50 words around it; strangers share the passage alone
        own = say(50)
        for copy in range(2):
            rows.append((2 * i + copy, " ".join(own[:25] + passage + [w if not copy or j % 2 else f"x{i}-{j}" for j, w in enumerate(own[25:])])))
    rows += [(1000 + i, " ".join(passage[:140] + say(3) + passage[140:] + say(5))) for i in range(3)]  # short ones, near one another
    words = [np.array([hash(w) & 0xFFFFFFFF for w in t.split()], "u4") for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and order_minhash.near(words[a], words[b], 0.8):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {rows[i][0]: rows[x][0] for i, x in enumerate(label)}
    assert len(set(expected.values())) > 100  # the group is not one class
    assert {r["doc_id"]: r["class_id"] for r in order_minhash.classes(docs).collect()} == expected


def test_near_many_equals_near():
    rng = random.Random(8)
    for _ in range(150):
        b = [rng.randint(0, 12) for _ in range(rng.randint(0, 40))]
        many = [([y for y in b if rng.random() > 0.1] + [rng.randint(0, 12) for _ in range(rng.randint(0, 4))])[: len(b)] for _ in range(6)]
        many = [np.array([y if rng.random() > 0.1 else 99 for y in x], "u4") for x in many]
        got = order_minhash.near_many(many, np.array(b, "u4"), 0.7)
        assert got.tolist() == [order_minhash.near(x, np.array(b, "u4"), 0.7) for x in many]
