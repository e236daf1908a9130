"""Queries over diff-based publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from casona.operators import sync
from casona.plans import sqlparts as p
from casona.plans.catalog import query
from casona.plans.queries_search import CANON_SQL, canon
from casona.plans.sqlparts import stamp

AT = "2024-06-01 12:00:00"

# what a listing showed when it was last sent: some have a new title since
SENT_TITLE = "CASE WHEN id % 5 = 2 THEN 'old title' ELSE title_en END"


def _with_state(t):
    """Canonical rows whose stored hash is that of what was sent before."""
    rows = canon(t).withColumn("year_built", F.lit(None).cast("int"))
    before = rows.withColumn("title_en", F.expr(SENT_TITLE)).select(F.col("id").alias("_id"), sync.content_hash().alias("wp_content_hash"))
    return rows.join(before, rows["id"] == F.col("_id")).drop("_id")


DUE = "status IN ('active', 'pending_review') AND (wp_synced_at IS NULL OR updated_at > wp_synced_at)"


@query("pending_sync", f"SELECT id, source_listing_id FROM v_listings WHERE {DUE} ORDER BY updated_at DESC, id LIMIT 200")
def pending_sync(t):
    return sync.pending_sync(t.v_listings, n=200).select("id", "source_listing_id")


@query("all_pending_sync", f"SELECT id, source_listing_id FROM v_listings WHERE {DUE}")
def all_pending_sync(t):
    return sync.pending_sync(t.v_listings).select("id", "source_listing_id")


PLAN_SQL = f"""
    WITH c AS ({CANON_SQL}), p AS (SELECT *, CASE WHEN wp_post_id IS NULL THEN 'create' WHEN {SENT_TITLE} IS NOT DISTINCT FROM title_en THEN 'skip' ELSE 'update' END AS sync_action
      FROM c WHERE {DUE})"""


def _plan(t):
    return sync.plan_sync(sync.pending_sync(_with_state(t)))


@query("plan_sync", PLAN_SQL + " SELECT id, sync_action FROM p")
def plan_sync(t):
    return _plan(t).select("id", "sync_action")


@query("content_hash", """
    SELECT count(*) AS listings, count(DISTINCT (title, description, price, price_currency, bedrooms, bathrooms, interior_sqm, lot_sqm, lat, lng, address_line, locality, canton, province,
      list_sort(coalesce(features, [])), list_sort(coalesce(tags_ai, [])), list_sort(coalesce(tags_human, [])), status)) AS contents FROM v_listings""")
def content_hash(t):
    # price and currency stand in for two hashed text fields, so that distinct contents can be counted in SQL
    rows = t.v_listings.withColumns({
        "title_en": F.col("title"), "description_en": F.col("description"), "price_usd": F.col("price"), "year_built": F.lit(None).cast("int"),
        "region_slug": F.col("price_currency")})
    return rows.select(sync.content_hash().alias("h")).agg(F.count("*").alias("listings"), F.count_distinct("h").alias("contents"))


HUMAN = "array_to_string(list_transform(string_split(x, '_'), lambda w: upper(w[1]) || w[2:]), ' ')"


@query("publish_documents", f"""
    WITH c AS ({CANON_SQL}), d AS (SELECT *, lat IS NOT NULL AND lng IS NOT NULL AS placed FROM c)
    SELECT id, coalesce(nullif(title_en, ''), nullif(title_es, ''), '(untitled listing)') AS title, coalesce(description_en, '') AS content,
      CASE status WHEN 'active' THEN 'publish' ELSE 'draft' END AS post_status,
      CAST(price_usd AS VARCHAR) AS price, CAST(bedrooms AS VARCHAR) AS beds, CASE WHEN interior_sqm IS NOT NULL THEN 'm²' END AS size_prefix,
      CASE WHEN placed THEN array_to_string(list_filter([nullif(address_line, ''), nullif(locality, ''), nullif(canton, ''), nullif(province, ''), 'Costa Rica'], lambda x: x IS NOT NULL), ', ') END AS map_address,
      CASE WHEN placed THEN 'enable' END AS map, mls_id AS ref,
      CAST(1 + (price_usd IS NOT NULL)::INT + (bedrooms IS NOT NULL)::INT + (bathrooms IS NOT NULL)::INT + 2 * (interior_sqm IS NOT NULL)::INT + (lot_sqm IS NOT NULL)::INT
        + 4 * placed::INT + (hoa_fee IS NOT NULL)::INT + (mls_id IS NOT NULL)::INT AS INTEGER) AS n_meta,
      CASE property_type WHEN 'lot' THEN 'Lot / Land' ELSE upper(property_type[1]) || property_type[2:] END AS type_name,
      CASE region_slug WHEN 'nicoya' THEN 'Nicoya Peninsula' WHEN 'caribbean' THEN 'Caribbean Coast' WHEN 'central-pacific' THEN 'Central Pacific' WHEN 'guanacaste' THEN 'Guanacaste'
        WHEN 'central-valley' THEN 'Central Valley' WHEN 'south-pacific' THEN 'South Pacific' END AS city,
      array_to_string(list_transform(features, lambda x: {HUMAN}), '|') AS features,
      array_to_string(list_transform(list_concat(coalesce(tags_ai, []), list_filter(coalesce(tags_human, []), lambda y: NOT list_contains(coalesce(tags_ai, []), y))), lambda x: {HUMAN}), '|') AS labels
    FROM d""")
def publish_documents(t):
    rows = canon(t).withColumns({"year_built": F.lit(None).cast("int"), "hoa_fee_usd": F.col("hoa_fee")})
    d = sync.publish_documents(rows)
    meta = lambda k: F.try_element_at("meta", F.lit(k))
    terms = lambda k: F.array_join(F.try_element_at("taxonomies", F.lit(k)), "|")
    none_to_empty = F.coalesce(terms("property_label"), F.lit(""))
    return d.select(
        "id", F.col("post.title").alias("title"), F.col("post.content").alias("content"), F.col("post.status").alias("post_status"),
        meta("fave_property_price").alias("price"), meta("fave_property_bedrooms").alias("beds"), meta("fave_property_size_prefix").alias("size_prefix"),
        meta("fave_property_map_address").alias("map_address"), meta("fave_property_map").alias("map"), meta("fave_property_id").alias("ref"),
        F.size("meta").alias("n_meta"), terms("property_type").alias("type_name"), terms("property_city").alias("city"),
        terms("property_feature").alias("features"), none_to_empty.alias("labels"))


@query("assign_batches", f"""
    SELECT id, CAST((row_number() OVER (ORDER BY updated_at DESC, id) - 1) // 25 + 1 AS INTEGER) AS batch
    FROM v_listings WHERE {DUE}""")
def assign_batches(t):
    return sync.assign_batches(sync.pending_sync(t.v_listings)).select("id", "batch")


RESULTS = """
    SELECT l_orderkey AS id, CAST(max(l_partkey) AS INTEGER) AS post_id, CASE WHEN max(l_linenumber) >= 6 THEN 503 ELSE 200 END AS http_status,
      CASE WHEN max(l_linenumber) >= 6 THEN 'timeout' END AS error FROM {lineitem} GROUP BY l_orderkey HAVING count(*) > 1"""
LOG_SQL = PLAN_SQL + f""", r AS ({RESULTS.format(lineitem='lineitem')}), g AS (
    SELECT p.id AS canonical_id, coalesce(r.post_id, p.wp_post_id) AS post_id, p.sync_action AS action, CASE WHEN r.id IS NOT NULL AND r.error IS NULL THEN 'success' ELSE 'failed' END AS status,
      r.http_status, CASE WHEN r.id IS NULL THEN 'no answer' ELSE r.error END AS error FROM p LEFT JOIN r ON r.id = p.id WHERE p.sync_action <> 'skip')"""


def _log(t, plan):
    return sync.sync_log_rows(plan, t.sql(RESULTS), F.lit(AT).cast("timestamp"))


@query("sync_log_rows", LOG_SQL + " SELECT * FROM g")
def sync_log_rows(t):
    return _log(t, _plan(t)).drop("logged_at")


@query("sync_dry_run", PLAN_SQL + " SELECT id AS canonical_id, wp_post_id AS post_id, sync_action AS action, 'dry_run' AS status FROM p WHERE sync_action <> 'skip'")
def sync_dry_run(t):
    return sync.sync_log_rows(_plan(t), None, F.lit(AT).cast("timestamp"), dry_run=True).select("canonical_id", "post_id", "action", "status")


@query("sync_summary", LOG_SQL + """
    SELECT (SELECT count(*) FROM g WHERE status = 'success') AS ok, (SELECT count(*) FROM p WHERE sync_action = 'skip') AS skipped,
      (SELECT count(*) FROM g WHERE status = 'failed') AS failed""")
def sync_summary(t):
    plan = _plan(t)
    return sync.sync_summary(plan, _log(t, plan))


@query("term_dictionary", f"""
    WITH c AS ({CANON_SQL}), u AS (SELECT DISTINCT taxonomy, name FROM (
      SELECT 'property_state' AS taxonomy, canton AS name FROM c WHERE canton IS NOT NULL
      UNION ALL SELECT 'property_type', CASE property_type WHEN 'lot' THEN 'Lot / Land' ELSE upper(property_type[1]) || property_type[2:] END FROM c
      UNION ALL SELECT 'property_feature', {HUMAN} FROM (SELECT unnest(features) AS x FROM c))),
    k AS (SELECT DISTINCT 'property_state' AS taxonomy, CASE n_regionkey WHEN 0 THEN 'Garabito' WHEN 1 THEN 'Talamanca' ELSE n_name END AS name, CAST(n_nationkey AS BIGINT) AS term_id FROM nation)
    SELECT taxonomy, name, min(term_id) AS term_id, false AS is_new FROM k GROUP BY taxonomy, name
    UNION ALL SELECT taxonomy, name, (SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY taxonomy, name), true FROM u WHERE (taxonomy, name) NOT IN (SELECT (taxonomy, name) FROM k)""")
def term_dictionary(t):
    rows = canon(t).withColumns({"year_built": F.lit(None).cast("int"), "hoa_fee_usd": F.col("hoa_fee")})
    docs = sync.publish_documents(rows).withColumn(
        "taxonomies", F.map_filter("taxonomies", lambda k, v: k.isin("property_state", "property_type", "property_feature")))
    name = F.when(F.col("n_regionkey") == 0, "Garabito").when(F.col("n_regionkey") == 1, "Talamanca").otherwise(F.col("n_name"))
    known = t.nation.select(F.lit("property_state").alias("taxonomy"), name.alias("name"), F.col("n_nationkey").cast("bigint").alias("term_id"))
    return sync.term_dictionary(docs, known).select("taxonomy", "name", "term_id", "is_new")


@query("mark_synced", LOG_SQL + f"""
    SELECT c.id, coalesce(CASE WHEN r.error IS NULL THEN r.post_id END, c.wp_post_id) AS wp_post_id, CASE WHEN p.sync_action = 'skip' OR (p.id IS NOT NULL AND r.id IS NOT NULL AND r.error IS NULL)
      THEN '{AT}.000000' ELSE {stamp('c.wp_synced_at')} END AS wp_synced_at
    FROM c LEFT JOIN p ON p.id = c.id LEFT JOIN r ON r.id = p.id""")
def mark_synced(t):
    rows = _with_state(t)
    plan = sync.plan_sync(sync.pending_sync(rows))
    out = sync.mark_synced(rows, plan, t.sql(RESULTS), F.lit(AT).cast("timestamp"))
    return out.select("id", "wp_post_id", F.date_format("wp_synced_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("wp_synced_at"))


@query("humanize", f"SELECT DISTINCT x AS tag, {HUMAN} AS label FROM (SELECT unnest(features) AS x FROM v_listings)")
def humanize(t):
    from casona.functions.text import humanize as label

    return t.v_listings.select(F.explode("features").alias("tag")).distinct().select("tag", label("tag").alias("label"))
