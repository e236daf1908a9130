"""One query for each operator, over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casona.llm import alignment, filter_audit, language_net, minhash_dedup, mixing, packing, pii_net, quality_net, secrets, topk_search, vector_dedup, warc, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` with the DuckDB SQL that gives the same rows, if there is one."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query("op1_minhash_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
k AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
l AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
r AS (SELECT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS m FROM r GROUP BY x)
SELECT doc_id, n AS n_shingles, coalesce(m, doc_id) AS component_id, coalesce(m, doc_id) = doc_id AS kept
FROM n LEFT JOIN c ON x = doc_id
""")
def op1(spark, root):
    return minhash_dedup.near_copies(table(spark, root, "documents"), minhash_dedup.Sketch(words=3, percent=85))


@query("op2_topk_search", f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings WHERE vec_id IS NOT NULL AND {USABLE}),
s AS (
  SELECT q.vec_id AS query_id, q.n, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.t) + 1), lambda i: q.t[i] * c.t[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.n <> q.n),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
""")
def op2(spark, root):
    return topk_search.top_k(table(spark, root, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


@query("op7_vector_dedup", f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND {USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS m FROM r GROUP BY x),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.m, vec_id) AS component_id,
  coalesce(c.m, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.x = vec_id
""")
def op7(spark, root):
    return vector_dedup.near_copies(table(spark, root, "embeddings"), threshold=0.93)


@query("op9_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS x FROM p),
m AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY x) ELSE page_id END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, x AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM coalesce(first, page_id) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM coalesce(first, page_id) THEN first END AS refers_to
FROM m
""")
def op9(spark, root):
    archives = warc.write(table(spark, root, "pages"))
    return warc.read(archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_secrets")
def op4(spark, root):
    return secrets.digest(secrets.scan(table(spark, root, "documents")))


@query("op6_mixing", r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    1.0e0 / (1.0e0 + 20.0e0 * CAST(len(regexp_extract_all(coalesce(text, ''), '[!-/:-@\[-`{-~]')) AS DOUBLE)
      / CAST(greatest(length(coalesce(text, '')), 1) AS DOUBLE)) AS weight,
    (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17'), 1, 12) AS BIGINT) AS DOUBLE) + 0.5e0) / 281474976710656.0e0 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / weight AS key FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM k GROUP BY source),
w AS (SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS most FROM s),
r AS (
  SELECT *, row_number() OVER o AS place,
    CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_w
  FROM w WINDOW o AS (ORDER BY most / w, rank)),
c AS (SELECT min(place) AS cut, arg_min(rest, place) AS rest, arg_min(rest_w, place) AS rest_w FROM r WHERE most * rest_w >= w * rest),
t AS (
  SELECT source, source_size, CASE WHEN place < c.cut THEN most ELSE w * c.rest / c.rest_w END AS target FROM r CROSS JOIN c),
b AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
e AS (
  SELECT b.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS e
  FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(e * size + greatest(0, least(size, floor(target) - e * source_size - before)) AS BIGINT) AS taken
FROM e
""")
def op6(spark, root):
    return mixing.mix(table(spark, root, "documents")).drop("source", "row_key")


@query("op8_packing")
def op8(spark, root):
    return packing.packed(table(spark, root, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)


@query("op10_wavelet")
def op10(spark, root):
    return wavelet.read(wavelet.write(table(spark, root, "documents"), tokenizer("word_bpe_49k.json"), end_id=1))


@query("op5_quality")
def op5(spark, root):
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    net = quality_net.fit(docs, labels.filter(~quality_net.held_out("doc_id", 5, 0)))
    scored = quality_net.score(docs.select("doc_id", "text"), net)
    return scored.select(
        "doc_id", quality_net.held_out("doc_id", 5, 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


@query("op3_language")
def op3(spark, root):
    docs = table(spark, root, "documents")
    net = language_net.fit(docs.filter(~language_net.held_out("doc_id")))
    return language_net.predict(docs.select("doc_id", "text"), net).select(
        "doc_id", language_net.held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op11_alignment")
def op11(spark, root):
    return alignment.aligned(table(spark, root, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


@query("op12_filter_audit", r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
m AS (
  SELECT doc_id, part, CAST(len(w) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS mask FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS x(f, bit)),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f)
  JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) AS k),
r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & CAST(before AS INTEGER) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
""")
def op12(spark, root):
    failed = filter_audit.failures(table(spark, root, "documents"))
    return filter_audit.audit(failed, table(spark, root, "labels"))


@query("op13_pii")
def op13(spark, root):
    docs = table(spark, root, "documents")
    return pii_net.digest(pii_net.scan(docs, pii_net.fit(docs)))
