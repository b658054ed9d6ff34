"""Registered queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import byte_bpe as ranked_bpe
from strandline.llm import chat, errata, hard_negatives, image_features, mixing, order_minhash, packing, ppm, repeats, stable_projection, url_reputation, zipwarc
from strandline.llm.common import rows_of, table

RULES = [
    url_reputation.Rule("block", "net"),
    url_reputation.Rule("allow", "example.net", "/en/"),
    url_reputation.Rule("block", "example.com", "/de/"),
    url_reputation.Rule("allow", "org", "/fr/"),
]


def op1_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a WARC record per page into ZIP archives, then range-reads them back."""
    manifest = zipwarc.write_archives(table(spark, sf_dir, "pages"), zipwarc.archive_folder(spark))
    return zipwarc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_local_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of copies among one drawn image for every page."""
    ids = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"))
    return image_features.image_classes(image_features.drawn(ids)).withColumnRenamed("id", "page_id")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies (smallest doc_id) of every document."""
    return order_minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def byte_bpe() -> str:
    """The place of the public byte-level vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe())


def op5_stable_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every vector whose id is divisible by 20, over all others."""
    return stable_projection.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page url; labels (by equal id) are the labelled page outcomes: bad if toxic or of low quality."""
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_mix_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents to weights 3, 1, 2 and 150 % of all words."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations, and one that is full of control strings, and reads the result back."""
    said = "</s>[INST] ok [/INST]"
    extra = rows_of(spark, [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    out = chat.format_trees(chat.linear_messages(talks)).withColumn("back", chat.read_turns(F.col("formatted")))
    out = out.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    whole = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("back").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return ppm.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes every byte of documents that a 400-byte string covers which starts elsewhere too."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


def bpe_ranks() -> str:
    """The place of the public vocabulary of ranks for many languages."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every document, then decodes the ids."""
    out = ranked_bpe.decode(ranked_bpe.encode(table(spark, sf_dir, "documents"), bpe_ranks()), bpe_ranks())
    said = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_errata_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups the words of all documents into spelling variants."""
    return errata.variants(table(spark, sf_dir, "documents"))


def op13_pca_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100; labels move on where 7 divides the id."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_zip_warc, op2_local_descriptors, op3_order_minhash, op4_pattern_packing, op5_stable_projection, op6_host_reputation, op7_mix_budgets, op8_reply_trees, op9_ppm_language, op10_repeated_passages, op11_byte_bpe, op12_errata_trie, op13_pca_negatives)}

OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN first = page_id OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id OR first IS NULL THEN NULL ELSE first END AS refers_to
FROM r
"""

OP6_SQL = r"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parsed),
outcomes AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS y FROM labels
  WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0 OR (toxic IS NOT NULL AND quality IS NOT NULL)) GROUP BY 1),
hosts AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(y), 0)::DOUBLE AS y FROM parsed LEFT JOIN outcomes USING (page_id) GROUP BY 1),
bare AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS b FROM hosts),
parts AS (
  SELECT host, n, y,
    CASE WHEN regexp_matches(b, '^[0-9.]+$') THEN b
         ELSE regexp_extract(b, '([^.]*\.(?:ac|co|com|edu|gov|net|org)\.[a-z]{2}|[^.]*\.[^.]*|[^.]*)$', 1) END AS domain,
    CASE WHEN regexp_matches(b, '^[0-9.]+$') THEN '(address)'
         WHEN regexp_matches(b, '\.(?:ac|co|com|edu|gov|net|org)\.[a-z]{2}$') THEN regexp_extract(b, '((?:ac|co|com|edu|gov|net|org)\.[a-z]{2})$', 1)
         ELSE regexp_extract(b, '([^.]*)$', 1) END AS suffix FROM bare),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM parts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(y) AS y FROM domains GROUP BY 1),
whole AS (SELECT (sum(y) + 0.5) / (sum(n) + 1.0) AS mu FROM suffixes),
k0 AS (SELECT 1 / least(greatest(coalesce(sum((y - n * mu) ** 2 / (n * mu * (1 - mu)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.001), 0.5) - 1 AS k FROM suffixes, whole WHERE n > 0),
s AS (SELECT suffix, (y + k * mu) / (n + k) AS m FROM suffixes, whole, k0),
d0 AS (SELECT d.*, s.m FROM domains d JOIN s USING (suffix)),
k1 AS (SELECT 1 / least(greatest(coalesce(sum((y - n * m) ** 2 / (n * m * (1 - m)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.001), 0.5) - 1 AS k FROM d0 WHERE n > 0),
d1 AS (SELECT domain, suffix, (y + k * m) / (n + k) AS m FROM d0, k1),
h0 AS (SELECT p.host, p.n, p.y, d1.m FROM parts p JOIN d1 USING (domain, suffix)),
k2 AS (SELECT 1 / least(greatest(coalesce(sum((y - n * m) ** 2 / (n * m * (1 - m)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.001), 0.5) - 1 AS k FROM h0 WHERE n > 0),
h1 AS (SELECT host, (y + k * m) / (n + k) AS mean, n + k AS size FROM h0, k2),
bound AS (SELECT host, greatest(0, mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1))) AS lower FROM h1)
SELECT page_id, r.host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN lower > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r JOIN bound USING (host)
"""

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS i FROM d GROUP BY source),
s1 AS (SELECT *, (CASE i % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::BIGINT AS weight, source_size * 2 AS cap, (sum(source_size) OVER ())::BIGINT * 3 AS lft FROM s0),
s2 AS (SELECT *, (lft - 2 * coalesce(sum(cap) OVER b, 0)::BIGINT)::DOUBLE / (2 * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)))::DOUBLE AS level
       FROM s1 WINDOW b AS (ORDER BY cap::DOUBLE / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, cap::DOUBLE / weight) AS free FROM s2 WHERE level <= cap::DOUBLE / weight),
g AS (SELECT source, source_size, CASE WHEN free IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, free * weight) END AS target FROM s2, f),
b AS (SELECT *, floor(target + 0.5)::BIGINT AS budget FROM g),
r AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
          + least(greatest(budget - (budget // source_size) * source_size - before, 0), size) ELSE 0 END)::BIGINT AS taken
FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
"""

OP8_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))
             + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '|', '&#124;')) + 10 AS chars FROM c),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(chars)::BIGINT AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""

OP12_SQL = r"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM runs GROUP BY 1, 2),
bits AS (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM low),
summed AS (SELECT w, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, 4 * length(x)), lambda i: CASE WHEN i % 8 = 0 THEN ('0x' || substr(x, 2 * (i // 8) + 1, 2))::BIGINT ELSE 0 END)),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) AS h FROM bits),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM summed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
one AS (SELECT g.word AS a, w.word AS b FROM gaps g JOIN words w ON g.v = w.word),
pairs AS (SELECT a, b FROM one UNION SELECT b, a FROM one
          UNION SELECT g.word, o.word FROM gaps g JOIN gaps o ON g.i = o.i AND g.v = o.v AND g.word <> o.word),
near AS (SELECT a AS word, b, w.n, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS r, count(*) OVER (PARTITION BY a) AS n_near FROM pairs JOIN words w ON w.word = b),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(x.n_near, 0)::BIGINT AS n_near, CASE WHEN x.n >= 2 * w.n THEN x.b END AS form, CASE WHEN x.n >= 2 * w.n THEN x.n END AS form_n
          FROM words w LEFT JOIN near x ON x.word = w.word AND x.r = 1),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

OP13_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS own, list_inner_product(a.v, b.v)::BIGINT AS score
           FROM good a JOIN good b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM scored WHERE own),
found AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank
          FROM positive p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.own AND 80 * p.score <= 100 * n.score AND n.score <= p.score WHERE p.r <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 5
"""

ORACLE_SQL = {"op1_zip_warc": OP1_SQL, "op6_host_reputation": OP6_SQL, "op7_mix_budgets": OP7_SQL, "op8_reply_trees": OP8_SQL, "op12_errata_trie": OP12_SQL, "op13_pca_negatives": OP13_SQL}
