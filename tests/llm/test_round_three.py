"""Byte-level BPE, spelling variants and hard negatives against brute force, and their edge cases."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import byte_bpe, errata, hard_negatives, order_minhash, ppm, repeats
from strandline.llm.queries import QUERIES, bpe_ranks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def public():
    """The public library with the same vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(bpe_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts_of(alphabet, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 3, 10, 200]))) for _ in range(300)]


@pytest.mark.parametrize("alphabet", ["'stmdrevlLx !1 \n\t", "a1  　é'’ \r\n.", "lver'  \n", "漢字😀 a1½²'ś​\x85\x1c퟿"])
def test_ids_equal_the_public_library(public, alphabet):
    vocab, texts = byte_bpe.vocabulary(bpe_ranks()), texts_of(alphabet, 4)
    ids, at, ends = vocab.encode([x.encode() for x in texts])
    for text, i, j in zip(texts, [0, *ends], ends, strict=False):
        assert ids[i:j].tolist() == public.encode_ordinary(text)
        edges = [*at[i:j].tolist(), len(text.encode())]
        assert [text.encode()[a:b] for a, b in zip(edges, edges[1:], strict=False)] == [public.decode_single_token_bytes(x) for x in ids[i:j].tolist()]
    assert vocab.decode(ids, ends) == [x.encode() for x in texts]


def test_long_slices_and_a_small_memo(public):
    vocab = byte_bpe.Ranks(bpe_ranks(), 5)
    for text in ("a" * 5000 + "ab" * 3000, "x" * 64, "xyzw" * 17, "." * 1000 + " " * 999, "the end of it all, again and again"):
        assert vocab.encode([text.encode()])[0].tolist() == public.encode_ordinary(text)
        assert len(vocab.memo) <= 20


def test_classes_of_all_code_points():
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    raw, kind = {bytes([i]): i for i in range(256)}, byte_bpe.kinds()
    letters = (byte_bpe.LETTER, byte_bpe.SHORT)
    for pattern, want in ((r"\p{L}", letters), (r"\p{N}", (byte_bpe.NUMBER,)), (r"\s", (byte_bpe.WHITE_RUN,))):
        got = bytes(tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=raw, special_tokens={}).encode_ordinary(every)).decode()
        assert got == "".join(c for c in every if kind[ord(c)] in want)


def test_scans_of_any_block_width_agree():
    own, _, then, rows, _ = byte_bpe.machine()
    kinds = np.random.default_rng(2).integers(0, 9, 5000)
    state, states = byte_bpe.BEGIN, []
    for kind in kinds.tolist():
        state = byte_bpe.step(state, kind)[0]
        states.append(state)
    for width in (2, 7, 512, 9999):
        assert rows[:, byte_bpe.BEGIN][byte_bpe.composed(own[kinds], then, width)].tolist() == states


def test_byte_bpe_query_equals_the_public_library(spark, public):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = public.encode_ordinary(texts[r["doc_id"]])
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_byte_bpe_edges(spark, public):
    rows = [(1, None, "i", "I"), (2, "", None, None), (None, "a b", "i", "I"), (3, "a b", "i", "I"), (3, "a b", "i", "I"), (4, "long word " * 60000, "", "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string, Decoded string")
    out = byte_bpe.decode(byte_bpe.encode(docs, bpe_ranks()), bpe_ranks())
    assert out.columns == ["doc_id", "ids", "decoded"] and out.schema["doc_id"].dataType.typeName() == "integer"
    got = [(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(i, public.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows], key=str)
    assert byte_bpe.encode(docs.limit(0), bpe_ranks()).count() == 0
    assert byte_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), bpe_ranks()).collect()[0]["decoded"] == b""


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aéè"])
def test_near_words_equal_brute_force(spark, letters):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(250)})
    got = {(r["word"], r["near"]) for r in errata.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and one_edit(a, b)}


def brute_variants(rows, drop):
    n = Counter()
    for doc, text in rows:
        for run in "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in text or "").split():
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % drop == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if x != w and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


@pytest.mark.parametrize("drop", [97, 2])
def test_variants_equal_brute_force(spark, drop):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(4, 8))) for _ in range(25)]

    def typo(w):
        i, c = rng.randrange(len(w)), rng.choice("abcdéZ")
        return rng.choice([w, w, w, w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])

    rows = [(i, " ".join(typo(rng.choice(base)).upper() if i % 7 == 0 else typo(rng.choice(base)) for _ in range(60)) + "×÷, x-y") for i in range(80)]
    rows += [(100, None), (101, ""), (None, "abcde abcde abcde"), rows[0], rows[0], (102, "kilometre " * 30000 + "kilometer kilometer kilometer")]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = [tuple(r) for r in errata.variants(docs, drop=drop).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert sorted(got, key=str) == brute_variants(rows, drop)
    assert errata.variants(docs.limit(0)).count() == 0


def brute_negatives(rows):
    rows = [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in rows if None not in (i, v, label) and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, label, v in {r[0]: r for r in sorted(rows, reverse=True) if r[0] % 100 == 0}.values():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in rows if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(i, j, r + 1, x, -p, -s) for r, (s, x, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,group_rows", [(8192, 1024), (37, 2)])
def test_hard_negatives_equal_brute_force(spark, block_rows, group_rows):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((700, 6)).round(2)
    x[:200] = x[0] + rng.standard_normal((200, 6)).round(1) / 10  # a crowd with ties
    rows = [(i, v.tolist(), 0 if i < 400 else int(rng.integers(0, 4))) for i, v in enumerate(x)]
    rows += [rows[100], rows[3], rows[3], (800, [0.0] * 6, 1), (900, [1e3] * 6, 1), (1000, [1.0] * 6, 77), (None, [1.0] * 6, 1), (1001, None, 1)]
    rows += [(1002, [1.0] * 6, None), (1003, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1100, [float("nan")] + [1.0] * 5, 1), (1200, [float("inf")] + [1.0] * 5, 1), (1300, [], 1), (1400, [1.0], 1)]
    df = spark.createDataFrame([(*r, "s", 3) for r in rows], "vec_id long, embedding array<double>, label long, score string, place int")
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, group_rows=group_rows).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_discards_leave_every_pair_that_counts():
    rng = np.random.default_rng(9)
    a, b = rng.integers(-300, 300, (40, 48)), rng.integers(-300, 300, (500, 48)) // rng.integers(1, 60, (500, 1))
    basis = np.linalg.qr(rng.standard_normal((48, 48)))[0]
    whole = a @ b.T
    low, high = np.sort(whole, axis=1)[:, -40].astype(float), np.sort(whole, axis=1)[:, -10].astype(float)
    i, j, score = hard_negatives.survivors(hard_negatives.Block(a, basis), hard_negatives.Block(b, basis), np.ones(whole.shape, bool), low, high)
    want = (whole >= low[:, None]) & (whole <= high[:, None])
    assert len(i) == want.sum() and want[i, j].all() and (whole[i, j] == score).all()


def test_columns_of_any_name_pass(spark):
    names = ["_id", "_key", "_rows", "_k", "row", "id", "digest", "rows", "K", "n_bytes", "Removed_Spans", "Score", "_row", "_cut", "Held_Out"]
    text = "one two three four five six seven eight nine ten " * 12
    rows = [(i, t, "en", *(f"{n}{i}" for n in names)) for i, t in enumerate([text, text + "eleven", None, "", "short"])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", *names])
    kept = order_minhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2], rows[4]], key=str)
    out = repeats.remove_repeats(docs, 40)
    assert out.columns == [c for c in docs.columns if c not in ("n_bytes", "Removed_Spans")] + ["n_bytes", "removed_spans", "kept_bytes"]
    assert out.select("n_bytes", "_id").collect() and {r["_k"] for r in out.collect()} == {f"_k{i}" for i in range(5)}
    assert repeats.drop_repeats(docs, 40).columns == docs.columns
    judged = ppm.identify(docs)
    assert judged.columns == [c for c in docs.columns if c not in ("Score", "Held_Out")] + ["held_out", "lang_pred", "score", "bits"]
    assert judged.select("score").count() == 5


def test_code_lengths_of_the_querys_own_model():
    """Order 4, contexts of 3 and 4 bytes used once dropped, costs packed as whole 1/1024 bits."""
    rng = random.Random(13)
    say = lambda words, n: b" ".join(rng.choice(words) for _ in range(n))
    train = {"a": [say([b"abra", b"cad", b"abba", b"dab"], 60), say([b"abra", b"bad"], 30)], "b": [say([b"hocus", b"pocus", b"cab"], 50), b"x"]}
    order, counts, uses = 4, {}, Counter()
    for lang, texts in train.items():
        for x in texts:
            for i in range(len(x)):
                for k in range(min(order, i) + 1):
                    counts.setdefault((lang, x[i - k : i]), Counter())[x[i]] += 1
                    uses[x[i - k : i]] += 1
    kept = {c for c, n in uses.items() if len(c) < 3 or n >= 2}

    def bits(lang, text):
        total = 0.0
        for i, byte in enumerate(text):
            for k in range(min(order, i), -1, -1):
                own = counts.get((lang, text[i - k : i])) if text[i - k : i] in kept else None
                if own:
                    whole = sum(own.values()) + len(own)
                    if byte in own:
                        total += np.log2(whole / own[byte])
                        break
                    total += np.log2(whole / len(own))
            else:
                total += 8
        return total

    assert len(kept) < len(uses)
    model = ppm.fit(train, order, 2).packed()
    texts = [say([b"abra", b"hocus", b"cab"], 40), b"abbahocus xyz", b"zzz", b"a", b""]
    got = ppm.code_lengths(model, texts, 16)
    for text, row in zip(texts, got, strict=True):
        for lang, x in zip(("a", "b"), row, strict=True):
            assert abs(x - bits(lang, text)) <= len(text) / 2048 + 1e-3 * max(1, len(text)) / 10


def test_near_copies_of_stated_documents_share_their_class(spark):
    """Every document whose id is divisible by 20, against all others: those within the edit similarity must be of one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    hashes, counts = order_minhash.word_hashes([r["text"] for r in rows])
    ends = np.cumsum(counts)
    words = [(hashes[e - n : e] >> np.uint64(32)).astype("<u4") for e, n in zip(ends, counts, strict=True)]
    label = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(docs).collect()}
    met = missed = 0
    for i, own in enumerate(rows):
        if own["doc_id"] % 20 == 0 and len(words[i]):
            for j, other in enumerate(rows):
                if i != j and len(words[j]) and order_minhash.near(words[i], words[j], 0.8):
                    met += 1
                    missed += label[own["doc_id"]] != label[other["doc_id"]]
    assert met >= 5 and missed <= 0.02 * met, (met, missed)
