"""Queries over entity resolution."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from casona import refdata
from casona.functions import money, vectors
from casona.operators import entity_resolution as er, neighbours, normalize as norm
from casona.operators.clusters import ClusterTable
from casona.plans import sqlparts as p
from casona.plans.catalog import query
from casona.session import shared_folder

TEXT_SQL = f"""coalesce(title, '') || ' | ' || coalesce(locality, '') || ', ' || coalesce(province, '') || ' | ' || coalesce(CAST(bedrooms AS VARCHAR), '')
    || 'br ' || coalesce(CAST(bathrooms AS VARCHAR), '') || 'ba ' || coalesce(CAST(interior_sqm AS VARCHAR), '') || 'm² | $' || coalesce(CAST({p.price_usd()} AS VARCHAR), '')"""


def _priced(t):
    return norm.to_usd(t.v_listings, "price", "price_currency", money.rate_table(t.spark), "price_usd")


@query("embedding_text", f"SELECT id, {TEXT_SQL} AS embedding_text, sha256({TEXT_SQL}) AS text_hash FROM v_listings l")
def embedding_text(t):
    rows = _priced(t).select("id", er.embedding_text().alias("embedding_text"))
    return rows.withColumn("text_hash", er.text_hash("embedding_text"))


@query("skip_unchanged", f"""
    SELECT id, h AS text_hash FROM (SELECT id, sha256({TEXT_SQL}) AS h FROM v_listings l)
    WHERE (id, h) NOT IN (SELECT (x.l_orderkey, sha256({TEXT_SQL})) FROM lineitem x JOIN v_listings l ON l.id = x.l_orderkey WHERE x.l_returnflag = 'A')""")
def skip_unchanged(t):
    hashed = _priced(t).select("id", er.text_hash(er.embedding_text()).alias("text_hash"))
    kept = t.lineitem.select(F.col("l_orderkey").alias("id"), "l_returnflag").join(hashed, "id")
    model = F.when(F.col("l_returnflag") == "A", "m1").otherwise("m2")
    return er.skip_unchanged(hashed, kept.select("id", "text_hash", model.alias("model")), "m1")


DIM = refdata.EMBEDDING_DIM
#: Texts that a task embeds.
EMBEDDED_ROWS = 10_000


@query("hash_embedding", f"""
    WITH h AS (SELECT p_partkey, list_transform(range({-(-DIM // 16)}), lambda i: sha256(CAST(i AS VARCHAR) || '::' || p_name)) AS h FROM part),
    v AS (SELECT p_partkey, list_transform(range({DIM}), lambda i: CAST(('0x' || substr(h[i // 16 + 1], 4 * (i % 16) + 1, 4)) AS INTEGER) / 65535.0e0 * 2 - 1) AS v FROM h),
    n AS (SELECT p_partkey, v, sqrt(list_sum(list_transform(v, lambda y: y * y))) AS n FROM v)
    SELECT p_partkey, sha256(array_to_string(list_transform(v, lambda x: CAST(CAST(round(x / n * 10000) AS BIGINT) AS VARCHAR)), ' ')) AS vector FROM n""")
def hash_embedding(t):
    """All dimensions of each vector, as a digest of their ten-thousandths."""
    # narrow rows, much work each: a file of them is one task unless they are dealt out by number
    rows = t.part.select("p_partkey", "p_name")
    out = rows.repartition(rows.count() // EMBEDDED_ROWS + 1).select("p_partkey", vectors.hash_embedding("p_name").alias("v"))
    scaled = F.transform("v", lambda x: vectors.rounded(x * 10000).cast("string"))
    return out.select("p_partkey", F.sha2(F.array_join(scaled, " "), 256).alias("vector"))


@query("cosine_similarity", """
    SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_similarity(t):
    nxt = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return t.embeddings.join(nxt, "vec_id").select(
        "vec_id", F.round(vectors.cosine_similarity("embedding", "other"), 6).alias("similarity"))


def _topk_sql(block: str, k: int) -> str:
    return f"""
    SELECT query_id, base_id, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
      SELECT a.vec_id AS query_id, b.vec_id AS base_id, s, row_number() OVER (PARTITION BY a.vec_id ORDER BY s DESC, b.vec_id) AS rank
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id {block},
        LATERAL (SELECT list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s))
    WHERE rank <= {k}"""


def _topk(t, **kw):
    e = t.embeddings
    out = er.top_k_similar(e, e, id_col="vec_id", exclude_self=True, **kw)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("topk_similar", _topk_sql("AND a.label = b.label", 3))
def topk_similar(t):
    return _topk(t, k=3, blocking=["label"])


@query("topk_similar_unblocked", _topk_sql("", 5))
def topk_similar_unblocked(t):
    return _topk(t, k=5, rows_per_chunk=128)


@query("lsh_candidates", """
    WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    q AS (SELECT vec_id, list_transform(v, lambda x, i: x + 0.02e0 * ((i + vec_id) % 3)) AS v FROM b)
    SELECT q.vec_id AS query_id, b.vec_id AS base_id, round(list_cosine_similarity(q.v, b.v), 6) AS similarity
    FROM q JOIN b ON list_cosine_similarity(q.v, b.v) >= 0.9""")
def lsh_candidates(t):
    e = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    moved = e.withColumn("embedding", F.transform("embedding", lambda x, i: x + F.lit(0.02) * ((i + 1 + F.col("vec_id")) % 3)))
    return er.lsh_candidates(moved, e, 0.9, id_col="vec_id").withColumn("similarity", F.round("similarity", 6))


@query("lsh_neighbours", """
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    c AS (SELECT v, min(vec_id) AS class_id, count(*) AS class_size FROM e GROUP BY v),
    n AS (SELECT a.vec_id, count(*) AS n_links FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.4 GROUP BY a.vec_id)
    SELECT e.vec_id, class_id, class_size, coalesce(n_links, 0) AS n_links FROM e JOIN c ON e.v = c.v LEFT JOIN n ON n.vec_id = e.vec_id""")
def lsh_neighbours(t):
    found = neighbours.lsh_neighbours(t.embeddings, 0.4, id_col="vec_id", missed=1e-9)
    return found.withColumnRenamed("id", "vec_id")


@query("lsh_links", """
    WITH e AS (SELECT min(vec_id) AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings GROUP BY embedding)
    SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity
    FROM e a JOIN e b ON a.id < b.id AND list_cosine_similarity(a.v, b.v) >= 0.4""")
def lsh_links(t):
    links, _ = neighbours.lsh_links(t.embeddings, 0.4, id_col="vec_id", missed=1e-9)
    return links.withColumn("similarity", F.round("similarity", 6))


SIDES = ["locality", "canton", "bedrooms", "bathrooms", "property_type", "mls_id", "listing_agent_name", "address_line", "price_usd", "lot_sqm", "interior_sqm", "lat", "lng"]
PAIRS_SQL = f"""
    SELECT x.l_orderkey AS query_id, x.l_partkey AS base_id, {', '.join(f'a.{c} AS a_{c}, b.{c} AS b_{c}' for c in SIDES)}
    FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) x JOIN (SELECT l.*, {p.price_usd()} AS price_usd FROM v_listings l) a ON a.id = x.l_orderkey
    JOIN (SELECT l.*, {p.price_usd()} AS price_usd FROM v_listings l) b ON b.id = x.l_partkey"""
GAP = "CASE WHEN greatest(a_{c}, b_{c}) > 0 THEN abs(CAST(a_{c} AS DOUBLE) - CAST(b_{c} AS DOUBLE)) / CAST(greatest(a_{c}, b_{c}) AS DOUBLE) END"
SCORE_SQL = f"""
    SELECT *, CAST(greatest(0.00, least(1.00,
        CASE WHEN a_mls_id = b_mls_id THEN 0.90 ELSE 0 END + CASE WHEN km <= 0.05e0 THEN 0.40 ELSE 0 END
        + CASE WHEN a_address_line = b_address_line AND a_listing_agent_name = b_listing_agent_name THEN 0.40 ELSE 0 END
        + CASE WHEN (coalesce(a_canton = b_canton, false) OR coalesce(a_address_line = b_address_line, false)) AND (coalesce(lot_gap <= 0.2e0, false) OR coalesce(interior_gap <= 0.2e0, false)) THEN 0.25 ELSE 0 END
        + CASE WHEN a_bedrooms = b_bedrooms AND a_bathrooms = b_bathrooms AND price_gap <= 0 AND a_locality = b_locality THEN 0.40 ELSE 0 END
        + CASE WHEN a_locality = b_locality THEN 0.10 ELSE 0 END - CASE WHEN a_bedrooms <> b_bedrooms THEN 0.25 ELSE 0 END
        - CASE WHEN lot_gap > 0.2e0 THEN 0.20 ELSE 0 END - CASE WHEN price_gap > 0.3e0 THEN 0.25 ELSE 0 END - CASE WHEN a_property_type <> b_property_type THEN 0.30 ELSE 0 END)) AS DECIMAL(3,2)) AS confidence
    FROM (SELECT *, {GAP.format(c='price_usd')} AS price_gap, {GAP.format(c='lot_sqm')} AS lot_gap, {GAP.format(c='interior_sqm')} AS interior_gap,
      {p.haversine('a_lat', 'a_lng', 'b_lat', 'b_lng')} AS km FROM ({PAIRS_SQL}))"""


def _pairs(t, ids=None):
    ids = ids if ids is not None else t.lineitem.select(F.col("l_orderkey").alias("query_id"), F.col("l_partkey").alias("base_id")).distinct()
    side = lambda x, key: _priced(t).select(F.col("id").alias(key), *(F.col(c).alias(f"{x}_{c}") for c in SIDES))
    return ids.join(side("a", "query_id"), "query_id").join(side("b", "base_id"), "base_id")


@query("score_pairs", f"""
    SELECT query_id, base_id, a_canton = b_canton AS same_canton, round(price_gap, 6) AS price_gap, round(km, 3) AS distance_km, confidence FROM ({SCORE_SQL})""")
def score_pairs(t):
    out = er.score_pairs(er.pair_features(_pairs(t)))
    return out.select("query_id", "base_id", "same_canton", F.round("price_gap", 6).alias("price_gap"), F.round("distance_km", 3).alias("distance_km"), "confidence")


SCORED = """
    SELECT DISTINCT l_orderkey AS query_id, l_partkey AS base_id, CAST((l_partkey * 7 + l_orderkey) % 101 AS DECIMAL(5,2)) / 100 AS c,
      l_partkey AS rank FROM {lineitem}"""
BEST_SQL = f"""
    WITH s AS (SELECT query_id, base_id, rank, CAST(c AS DECIMAL(3,2)) AS confidence FROM ({SCORED.format(lineitem='lineitem')})),
    b AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN confidence >= 0.85 THEN 0 ELSE 1 END,
        CASE WHEN confidence >= 0.85 THEN 0 ELSE -confidence END, rank) AS n FROM s) WHERE n = 1)"""


def _best(t):
    scored = t.sql(SCORED).select("query_id", "base_id", "rank", F.col("c").cast("decimal(3,2)").alias("confidence"))
    return er.best_candidate(scored)


@query("best_candidate", BEST_SQL + " SELECT query_id, base_id, rank, confidence FROM b")
def best_candidate(t):
    return _best(t)


@query("decide", BEST_SQL + """
    SELECT l.id, CASE WHEN b.confidence >= 0.85 THEN 'merge' WHEN b.confidence >= 0.60 THEN 'review' ELSE 'create' END AS action,
      coalesce(b.confidence, CAST(0 AS DECIMAL(3,2))) AS confidence, CASE WHEN b.query_id IS NULL THEN 'no_match' ELSE 'embedding' END AS method,
      b.base_id AS candidate_id, CASE WHEN b.confidence >= 0.60 THEN b.base_id END AS canonical_id
    FROM v_listings l LEFT JOIN b ON b.query_id = l.id""")
def decide(t):
    return er.decide(t.v_listings.select("id"), _best(t)).select("id", "action", "confidence", "method", "candidate_id", "canonical_id")


@query("exact_key_matches", """
    WITH c AS (SELECT c_custkey AS id, 'MLS' || c_custkey AS mls_id, 'Calle ' || c_custkey % 40 AS address_line, c_nationkey AS price FROM customer),
    m AS (SELECT l.id, c.id AS canonical_id, 'exact_id' AS method, 1 AS r FROM v_listings l JOIN c ON c.mls_id = l.mls_id
      UNION ALL SELECT l.id, min(c.id), 'address_price', 2 FROM v_listings l JOIN c ON c.address_line = l.address_line AND c.price = l.bathrooms GROUP BY l.id)
    SELECT id, arg_min(canonical_id, (r, canonical_id)) AS canonical_id, arg_min(method, (r, canonical_id)) AS method FROM m GROUP BY id""")
def exact_key_matches(t):
    canon = t.customer.select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("MLS"), "c_custkey").alias("mls_id"),
        F.concat(F.lit("Calle "), F.col("c_custkey") % 40).alias("address_line"), F.col("c_nationkey").alias("price_usd"))
    new = t.v_listings.select("id", "mls_id", "address_line", F.col("bathrooms").alias("price_usd"))
    return er.exact_key_matches(new, canon)


@query("resolve_batch", f"""
    WITH k AS ({_topk_sql('AND a.label = b.label', 3)}), x AS (SELECT k.query_id, k.base_id, k.rank, s.confidence FROM k JOIN (
      {SCORE_SQL.replace('(SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)', '(SELECT query_id AS l_orderkey, base_id AS l_partkey FROM k)')}) s USING (query_id, base_id)),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN confidence >= 0.85 THEN 0 ELSE 1 END,
      CASE WHEN confidence >= 0.85 THEN 0 ELSE -confidence END, rank) AS n FROM x) WHERE n = 1)
    SELECT e.vec_id AS id, CASE WHEN b.confidence >= 0.85 THEN 'merge' WHEN b.confidence >= 0.60 THEN 'review' ELSE 'create' END AS action,
      coalesce(b.confidence, CAST(0 AS DECIMAL(3,2))) AS confidence, b.base_id AS candidate_id FROM embeddings e LEFT JOIN b ON b.query_id = e.vec_id""")
def resolve_batch(t):
    def candidates(new):
        found = er.top_k_similar(new, new, k=3, blocking=["label"], exclude_self=True)
        ranks = found.select("query_id", "base_id", "rank")
        return _pairs(t, ranks)

    judge = lambda pairs: er.score_pairs(er.pair_features(pairs))
    new = t.embeddings.withColumnRenamed("vec_id", "id")
    return er.resolve(new, candidates, judge).select("id", "action", "confidence", "candidate_id")


@query("cluster_same_text", """
    SELECT doc_id AS id, m AS cluster_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY lower(text)) AS m, count(*) OVER (PARTITION BY lower(text)) AS n FROM documents) WHERE n > 1""")
def cluster_same_text(t):
    docs = t.documents.select("doc_id", F.sha2(F.lower("text"), 256).alias("h"))
    return er.cluster_batch(er.same_key_edges(docs, "doc_id", ["h"]))


@query("cluster_batch", """
    WITH RECURSIVE d AS (SELECT doc_id, sha256(lower(text)) AS h, n_chars // 40 AS z, source FROM documents),
    e AS (SELECT a.doc_id AS a, b.b FROM d a JOIN (SELECT h, min(doc_id) AS b FROM d GROUP BY h) b USING (h) WHERE a.doc_id <> b.b
      UNION SELECT a.doc_id, b.b FROM d a JOIN (SELECT z, source, min(doc_id) AS b FROM d GROUP BY z, source) b USING (z, source) WHERE a.doc_id <> b.b),
    u AS (SELECT a AS s, b AS t FROM e UNION SELECT b, a FROM e),
    r(id, seen) AS (SELECT s, s FROM u UNION SELECT u.t, r.seen FROM r JOIN u ON u.s = r.id)
    SELECT id, min(seen) AS cluster_id FROM r GROUP BY id""")
def cluster_batch(t):
    docs = t.documents.select("doc_id", F.sha2(F.lower("text"), 256).alias("h"), F.floor(F.col("n_chars") / 40).alias("z"), "source")
    edges = er.same_key_edges(docs, "doc_id", ["h"]).unionByName(er.same_key_edges(docs, "doc_id", ["z", "source"]))
    return er.cluster_batch(edges)




@query("cluster_batches", """
    WITH RECURSIVE d AS (SELECT doc_id, sha256(lower(text)) AS h, n_chars // 40 AS z, source FROM documents),
    e AS (SELECT a.doc_id AS a, b.b FROM d a JOIN (SELECT h, min(doc_id) AS b FROM d GROUP BY h) b USING (h) WHERE a.doc_id <> b.b
      UNION SELECT a.doc_id, b.b FROM d a JOIN (SELECT z, source, min(doc_id) AS b FROM d GROUP BY z, source) b USING (z, source) WHERE a.doc_id <> b.b),
    u AS (SELECT a AS s, b AS t FROM e UNION SELECT b, a FROM e),
    r(id, seen) AS (SELECT s, s FROM u UNION SELECT u.t, r.seen FROM r JOIN u ON u.s = r.id)
    SELECT id, min(seen) AS cluster_id FROM r GROUP BY id""")
def cluster_batches(t):
    """The edges of cluster_batch in three batches, by kind and then by source."""
    docs = t.documents.select("doc_id", F.sha2(F.lower("text"), 256).alias("h"), F.floor(F.col("n_chars") / 40).alias("z"), "source")
    sized = er.same_key_edges(docs, "doc_id", ["z", "source"])
    late = sized.join(docs.filter(F.col("source") > "src15").select(F.col("doc_id").alias("a")), "a", "left_semi")
    clusters = ClusterTable(t.spark, f"{shared_folder(t.spark)}/clusters-{uuid.uuid4().hex}", T.LongType(), 16)
    for number, edges in enumerate((sized.join(late.select("a"), "a", "left_anti"), er.same_key_edges(docs, "doc_id", ["h"]), late)):
        clusters.add(number, edges)
    return clusters.read()


@query("review_queue", """
    SELECT q.link_id, q.confidence, c.title AS canon_title, c.price AS canon_price, r.locality AS raw_locality FROM (
      SELECT * FROM v_links WHERE reviewed_at IS NULL AND confidence BETWEEN 0.60 AND 0.85 ORDER BY confidence DESC, link_id LIMIT 50) q
    LEFT JOIN v_listings c ON c.id = q.candidate_id LEFT JOIN v_listings r ON r.id = q.raw_id""")
def review_queue(t):
    out = er.review_queue(t.v_links, t.v_listings.select("id", "title", "price"), t.v_listings.select("id", "locality"), n=50)
    return out.select("link_id", "confidence", "canon_title", "canon_price", "raw_locality")


DECISIONS = """
    SELECT link_id, CASE WHEN max(quality) = 1 THEN 'accept' ELSE 'reject' END AS decision, 'customer.' || lpad(CAST(max(doc_id) % 90000 AS STRING), 9, '0') || '@example.com' AS email
    FROM {v_links} JOIN {labels} ON doc_id = raw_id GROUP BY link_id"""


@query("apply_review", f"""
    SELECT l.link_id, CASE d.decision WHEN 'accept' THEN 'human' WHEN 'reject' THEN 'human_rejected' ELSE l.method END AS method,
      CAST(CASE d.decision WHEN 'accept' THEN 1 WHEN 'reject' THEN 0 ELSE l.confidence END AS DECIMAL(3,2)) AS confidence, a.id AS reviewed_by,
      d.decision IS NOT NULL OR l.reviewed_at IS NOT NULL AS reviewed
    FROM v_links l LEFT JOIN ({DECISIONS.format(v_links='v_links', labels='labels')}) d USING (link_id) LEFT JOIN v_agents a ON a.email = d.email""")
def apply_review(t):
    out = er.apply_review(t.v_links, t.sql(DECISIONS), t.v_agents, F.lit("2024-06-01").cast("timestamp"))
    return out.select("link_id", "method", "confidence", "reviewed_by", F.col("reviewed_at").isNotNull().alias("reviewed"))


@query("similar_listings", """
    SELECT b.vec_id AS id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.label = a.label AND b.vec_id <> a.vec_id WHERE a.vec_id = 42 ORDER BY 2 DESC, 1 LIMIT 6""")
def similar_listings(t):
    rows = t.embeddings.select(F.col("vec_id").alias("id"), F.col("label").alias("region_slug"), F.lit("active").alias("status"), "embedding")
    return er.similar_listings(rows, 42).select("id", F.round("similarity", 6).alias("similarity"))


@query("ordered_reviews", """
    WITH d AS (SELECT l.link_id, arg_max(CASE WHEN o_orderstatus = 'F' THEN 'reject' ELSE 'accept' END, o_orderkey) AS decision
      FROM v_links l JOIN orders ON o_custkey = l.raw_id GROUP BY 1)
    SELECT l.link_id, CASE d.decision WHEN 'accept' THEN 'human' WHEN 'reject' THEN 'human_rejected' ELSE l.method END AS method
    FROM v_links l LEFT JOIN d USING (link_id)""")
def ordered_reviews(t):
    """Several decisions on a link: the newest counts, be it accept or reject."""
    decisions = t.v_links.select("link_id", "raw_id").join(t.orders, F.col("o_custkey") == F.col("raw_id")).select(
        "link_id", F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderstatus") == "F", "reject").otherwise("accept").alias("decision"),
        F.lit("nobody@example.com").alias("email"))
    return er.apply_review(t.v_links, decisions, t.v_agents, F.lit("2024-06-01").cast("timestamp")).select("link_id", "method")
