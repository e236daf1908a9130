"""Queries over upserts, edits, lineage and checks.

``current`` is the whole of one table and ``changes`` the whole of another, so updates, inserts and
untouched rows all occur.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casona.operators import upsert as up
from casona.operators.keyed import CanonicalTable, RawTable
from casona.plans import sqlparts as p
from casona.plans.catalog import query
from casona.plans.sqlparts import stamp
from casona.session import shared_folder

AT = "2024-06-01 12:00:00"


def at():
    return F.lit(AT).cast("timestamp")


def _stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


RAW_CURRENT = """
    SELECT 's' || CAST(o_custkey % 14 AS STRING) AS source, CAST(o_orderkey AS STRING) AS source_listing_id, o_orderpriority AS source_url,
      CAST(0 AS BIGINT) AS run_id, CAST(o_orderdate AS TIMESTAMP) AS scraped_at, 'done' AS extract_status, 'done' AS normalize_status,
      CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'done' END AS dedupe_status, 'done' AS enrich_status, 'done' AS publish_status,
      CASE o_orderstatus WHEN 'F' THEN 'broken' END AS error, o_orderkey
    FROM {orders}"""
RAW_PAYLOADS = """
    SELECT 's' || CAST(l_suppkey % 14 AS STRING) AS source, CAST(l_orderkey AS STRING) AS source_listing_id, CAST(l_extendedprice AS STRING) AS source_url,
      l_partkey AS run_id, CAST(l_shipdate AS TIMESTAMP) AS scraped_at, l_linenumber * 100000000 + l_partkey * 10000 + l_suppkey AS seq
    FROM {lineitem}"""


@query("upsert_raw", f"""
    WITH c AS ({RAW_CURRENT.format(orders='orders')}), b AS (
      SELECT source, source_listing_id, arg_max(run_id, (scraped_at, seq)) AS run_id, max(scraped_at) AS scraped_at
      FROM ({RAW_PAYLOADS.format(lineitem='lineitem')}) GROUP BY 1, 2)
    SELECT source, source_listing_id, coalesce(b.run_id, c.run_id) AS run_id, {stamp('coalesce(b.scraped_at, c.scraped_at)')} AS scraped_at,
      CASE WHEN b.source IS NOT NULL THEN 'pending' ELSE c.dedupe_status END AS dedupe_status,
      CASE WHEN b.source IS NULL THEN c.error END AS error, CASE WHEN b.source IS NOT NULL THEN c.source IS NULL END AS was_new
    FROM c FULL JOIN b USING (source, source_listing_id)""")
def upsert_raw(t):
    current = t.sql(RAW_CURRENT).drop("o_orderkey")
    out = up.upsert_raw(current, t.sql(RAW_PAYLOADS), order=("scraped_at", "seq"))
    return out.select("source", "source_listing_id", "run_id", _stamp("scraped_at").alias("scraped_at"), "dedupe_status", "error", "was_new")


def _table(t, kind, name: str, rows, buckets: int = 16):
    """A bucket table in the shared folder that holds some rows."""
    table = kind(t.spark, f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}", rows.schema, buckets)
    table.merge("start", 0, rows, lambda now, new: new)
    return table


@query("bucketed_upsert_raw", f"""
    WITH c AS ({RAW_CURRENT.format(orders='orders')}), p AS ({RAW_PAYLOADS.format(lineitem='lineitem').replace('FROM lineitem', ", l_linestatus = 'O' AS late FROM lineitem")}),
    b AS (SELECT source, source_listing_id, arg_max(run_id, (late, scraped_at, seq)) AS run_id, arg_max(scraped_at, (late, scraped_at, seq)) AS scraped_at, bool_or(late) AS late, bool_or(NOT late) AS early
      FROM p GROUP BY 1, 2)
    SELECT source, source_listing_id, coalesce(b.run_id, c.run_id) AS run_id, {stamp('coalesce(b.scraped_at, c.scraped_at)')} AS scraped_at,
      CASE WHEN b.source IS NOT NULL THEN 'pending' ELSE c.dedupe_status END AS dedupe_status, CASE WHEN b.source IS NULL THEN c.error END AS error,
      CASE WHEN b.late THEN c.source IS NULL AND NOT b.early END AS was_new
    FROM c FULL JOIN b USING (source, source_listing_id)""")
def bucketed_upsert_raw(t):
    """Two runs on a bucketed raw table; new records of the second are told by the snapshot before it."""
    table = _table(t, RawTable, "raw", t.sql(RAW_CURRENT).drop("o_orderkey"))
    payloads = t.sql(RAW_PAYLOADS.replace("FROM {lineitem}", ", l_linestatus = 'O' AS late FROM {lineitem}"))
    early, late = payloads.filter("NOT late").drop("late"), payloads.filter("late").drop("late")
    table.upsert(1, early, ("scraped_at", "seq"))
    before = table.snapshot()
    table.upsert(2, late, ("scraped_at", "seq"))
    table.upsert(2, early, ("scraped_at", "seq"))  # a run that is there already
    new = table.known_before(late, before)
    return table.read().drop("was_new").join(new, ["source_listing_id", "source"], "left").select(
        "source", "source_listing_id", "run_id", _stamp("scraped_at").alias("scraped_at"), "dedupe_status", "error", "was_new")


CHANGES = """
    SELECT l_orderkey AS id, CAST(l_shipdate AS TIMESTAMP) AS seen_at, ((l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey AS seq,
      CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'House ' || CAST(l_partkey AS STRING) END AS title_en,
      CASE WHEN l_linenumber > 5 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END AS price,
      CASE WHEN l_linestatus = 'F' THEN 'Street ' || CAST(l_suppkey AS STRING) END AS address_line,
      CASE WHEN l_linenumber = 3 THEN split('pool,jacuzzi', ',') WHEN l_linenumber = 4 THEN split('hoa', ',') END AS features,
      'condo' AS property_type, CAST(l_quantity AS INTEGER) AS year_built
    FROM {lineitem}"""
CANON = """
    SELECT id, 'slug-' || CAST(id AS STRING) AS slug, title AS title_en, price, address_line, features, property_type,
      CASE WHEN bedrooms = 2 THEN NULL ELSE 1990 + bedrooms END AS year_built, last_seen_at, updated_at FROM {v_listings}"""


@query("merge_canonical", f"""
    WITH ch AS (SELECT id, arg_max(title_en, (seen_at, seq)) FILTER (title_en IS NOT NULL) AS title_en, arg_max(price, (seen_at, seq)) FILTER (price IS NOT NULL) AS price,
        arg_min(address_line, (seen_at, seq)) FILTER (address_line IS NOT NULL) AS address_line, arg_max(features, (seen_at, seq)) FILTER (len(features) > 0) AS features,
        arg_min(year_built, (seen_at, seq)) FILTER (year_built IS NOT NULL) AS year_built
      FROM ({CHANGES.format(lineitem='lineitem')}) GROUP BY id)
    SELECT c.id, c.slug, coalesce(ch.title_en, c.title_en) AS title_en, coalesce(ch.price, c.price) AS price, coalesce(c.address_line, ch.address_line) AS address_line,
      array_to_string(coalesce(ch.features, c.features), '|') AS features, c.property_type, CAST(coalesce(c.year_built, ch.year_built) AS INTEGER) AS year_built,
      CASE WHEN ch.id IS NOT NULL THEN '{AT}.000000' ELSE {stamp('c.updated_at')} END AS updated_at
    FROM ({CANON.format(v_listings='v_listings')}) c LEFT JOIN ch ON ch.id = c.id""")
def merge_canonical(t):
    changes = up.fold_changes(t.sql(CHANGES), ["seen_at", "seq"])
    out = up.merge_canonical(t.sql(CANON), changes, at())
    return out.select(
        "id", "slug", "title_en", "price", "address_line", F.array_join("features", "|").alias("features"), "property_type",
        F.col("year_built").cast("int").alias("year_built"), _stamp("updated_at").alias("updated_at"))


FOLDED = """SELECT id, arg_max(title_en, (seen_at, seq)) FILTER (title_en IS NOT NULL) AS title_en, arg_max(price, (seen_at, seq)) FILTER (price IS NOT NULL) AS price,
    arg_min(address_line, (seen_at, seq)) FILTER (address_line IS NOT NULL) AS address_line, arg_max(features, (seen_at, seq)) FILTER (len(features) > 0) AS features,
    arg_min(year_built, (seen_at, seq)) FILTER (year_built IS NOT NULL) AS year_built"""


@query("bucketed_merge_canonical", f"""
    WITH e AS ({FOLDED} FROM ({CHANGES.format(lineitem='lineitem')}) WHERE seq % 2 = 0 GROUP BY id), l AS ({FOLDED} FROM ({CHANGES.format(lineitem='lineitem')}) WHERE seq % 2 = 1 GROUP BY id)
    SELECT c.id, c.slug, coalesce(l.title_en, e.title_en, c.title_en) AS title_en, coalesce(l.price, e.price, c.price) AS price, coalesce(c.address_line, e.address_line, l.address_line) AS address_line,
      array_to_string(coalesce(l.features, e.features, c.features), '|') AS features, CAST(coalesce(c.year_built, e.year_built, l.year_built) AS INTEGER) AS year_built,
      CASE WHEN e.id IS NOT NULL OR l.id IS NOT NULL THEN '{AT}.000000' ELSE {stamp('c.updated_at')} END AS updated_at
    FROM ({CANON.format(v_listings='v_listings')}) c LEFT JOIN e ON e.id = c.id LEFT JOIN l ON l.id = c.id""")
def bucketed_merge_canonical(t):
    """Two runs of changes on a bucketed canonical table."""
    table = _table(t, CanonicalTable, "canonical", t.sql(CANON))
    for run, odd in enumerate((0, 1)):
        table.update(run, t.sql(CHANGES).filter(F.col("seq") % 2 == odd), ["seen_at", "seq"], at())
    return table.read().select(
        "id", "slug", "title_en", "price", "address_line", F.array_join("features", "|").alias("features"),
        F.col("year_built").cast("int").alias("year_built"), _stamp("updated_at").alias("updated_at"))


@query("insert_canonical", f"""
    SELECT sha256('C|' || c_custkey) AS id, 'customer' AS slug, 'customer' AS origin, CASE WHEN trim(coalesce(c_mktsegment, '')) = 'HOUSEHOLD' OR c_nationkey = 5 OR c_acctbal < 0 THEN 'pending_review' ELSE 'active' END AS status,
      CASE WHEN c_nationkey = 7 THEN 'other' ELSE 'house' END AS property_type, 'CR' AS country
    FROM customer WHERE c_nationkey <> 9
    UNION ALL SELECT CAST(id AS VARCHAR), source_listing_id, 'listing', status, property_type, NULL FROM v_listings""")
def insert_canonical(t):
    current = t.v_listings.select(
        F.col("id").cast("string").alias("id"), F.col("source_listing_id").alias("slug"), F.lit("listing").alias("origin"), "status",
        "property_type", F.lit(None).cast("string").alias("country"))
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal").cast("decimal(14,2)")
    new = t.customer.select(
        F.lit("C").alias("kind"), "c_custkey", F.lit("customer").alias("slug"), F.lit("customer").alias("origin"),
        F.when(nation == 7, F.lit(None)).otherwise("house").alias("property_type"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name")).alias("title_en"), F.lit("  ").alias("title_es"),
        F.lit(None).cast("string").alias("title"),
        F.when(nation != 5, balance).alias("price_usd"), *(F.lit(None).cast("int").alias(c) for c in ("bedrooms", "interior_sqm", "lot_sqm")),
        F.when(nation == 9, "merge").when(balance < 0, "review").otherwise("create").alias("action"))
    return up.insert_canonical(current, new, at(), ["kind", "c_custkey"])


@query("quality_gate", f"""
    SELECT id, CASE WHEN ({p.strip("coalesce(title, '')")} = '' AND {p.strip("coalesce(locality, '')")} = '') OR status = 'sold'
      OR (bedrooms IS NULL AND nullif(interior_sqm, 0) IS NULL) THEN 'pending_review' ELSE 'active' END AS status FROM v_listings""")
def quality_gate(t):
    rows = t.v_listings.select(
        "id", F.col("title").alias("title_en"), F.col("locality").alias("title_es"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("int").alias("price_usd"), "bedrooms", F.nullif("interior_sqm", F.lit(0)).alias("interior_sqm"),
        F.lit(None).cast("int").alias("lot_sqm"), F.when(F.col("status") == "sold", "review").otherwise("create").alias("action"))
    return rows.select("id", up.quality_gate().alias("status"))


OLD_LINKS = "SELECT o_orderkey AS raw_id, o_custkey AS canonical_id, CAST(0.50 AS DECIMAL(3,2)) AS confidence, 'embedding' AS method, o_orderpriority AS note FROM {orders}"
NEW_LINKS = """
    SELECT l_orderkey AS raw_id, l_partkey AS canonical_id, CAST(max(l_discount) AS DECIMAL(3,2)) AS confidence, 'exact_id' AS method FROM {lineitem} GROUP BY l_orderkey, l_partkey"""


@query("upsert_links", f"""
    SELECT raw_id, canonical_id, coalesce(n.confidence, o.confidence) AS confidence, coalesce(n.method, o.method) AS method, o.note
    FROM ({OLD_LINKS.format(orders='orders')}) o FULL JOIN ({NEW_LINKS.format(lineitem='lineitem')}) n USING (raw_id, canonical_id)""")
def upsert_links(t):
    return up.upsert_links(t.sql(OLD_LINKS), t.sql(NEW_LINKS))


@query("upsert_embeddings", """
    SELECT canonical_id, model, coalesce(n.text_hash, o.text_hash) AS text_hash, round(coalesce(n.x, o.x), 6) AS x FROM
      (SELECT vec_id AS canonical_id, 'm1' AS model, 'old' AS text_hash, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings) o
      FULL JOIN (SELECT p_partkey AS canonical_id, 'm1' AS model, p_name AS text_hash, 0.0e0 AS x FROM part) n USING (canonical_id, model)""")
def upsert_embeddings(t):
    current = t.embeddings.select(
        F.col("vec_id").alias("canonical_id"), F.lit("m1").alias("model"), F.lit("old").alias("text_hash"), "embedding")
    changes = t.part.select(
        F.col("p_partkey").alias("canonical_id"), F.lit("m1").alias("model"), F.col("p_name").alias("text_hash"),
        F.array(F.lit(0.0).cast("float")).alias("embedding"))
    return up.upsert_embeddings(current, changes).select(
        "canonical_id", "model", "text_hash", F.round(F.col("embedding")[0].cast("double"), 6).alias("x"))


SYNC_LOG = """
    SELECT c_custkey AS canonical_id, c_nationkey AS post_id, 'success' AS status, TIMESTAMP '2024-01-01 00:00:00' AS logged_at FROM {customer}"""
TRACE_LINKS = "SELECT o_orderkey AS raw_id, o_custkey AS canonical_id, 'embedding' AS method, CAST(0.90 AS DECIMAL(3,2)) AS confidence FROM {orders}"


@query("lineage", f"""
    SELECT e.event_id AS raw_id, e.event_type AS source, o.canonical_id, o.method, l.source_listing_id AS slug, s.post_id
    FROM events e LEFT JOIN ({TRACE_LINKS.format(orders='orders')}) o ON o.raw_id = e.event_id LEFT JOIN v_listings l ON l.id = o.canonical_id
    LEFT JOIN ({SYNC_LOG.format(customer='customer')}) s ON s.canonical_id = o.canonical_id""")
def lineage(t):
    raw = t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.lit("u").alias("source_url"))
    canon = t.v_listings.withColumn("slug", F.col("source_listing_id"))
    out = up.lineage(raw, t.sql(TRACE_LINKS), canon, t.sql(SYNC_LOG))
    return out.select("raw_id", "source", "canonical_id", "method", "slug", "post_id")


@query("source_urls", """
    SELECT DISTINCT l_partkey AS canonical_id, o_orderpriority || '/' || o_custkey AS source_url FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def source_urls(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias("id"), F.concat_ws("/", "o_orderpriority", F.col("o_custkey").cast("string")).alias("source_url"))
    return up.source_urls(raw, t.v_links)


PATCH_SQL = """
    SELECT c_custkey AS id, c_name AS title_en, c_mktsegment AS seg, c_acctbal AS bal, c_nationkey AS nk FROM customer"""


@query("apply_patches", f"""
    SELECT l.id, CASE WHEN nk % 5 <> 0 AND bal IS NOT NULL THEN p.title_en ELSE l.title END AS title_en,
      CASE WHEN nk % 5 <> 0 THEN CASE WHEN seg = 'BUILDING' THEN NULL ELSE CAST(CAST(bal AS DECIMAL(14,2)) AS DECIMAL(14,2)) END ELSE l.price END AS price,
      CASE WHEN nk % 5 <> 0 THEN 'pool|view' ELSE array_to_string(l.features, '|') END AS features,
      CASE WHEN nk % 5 <> 0 THEN '{AT}.000000' ELSE {stamp('l.updated_at')} END AS updated_at, l.source_listing_id AS slug
    FROM v_listings l LEFT JOIN ({PATCH_SQL}) p ON p.id = l.id""")
def apply_patches(t):
    canon = t.v_listings.select("id", F.col("title").alias("title_en"), "price", "features", "updated_at", F.col("source_listing_id").alias("slug"))
    nxt, _ = up.apply_patches(canon, _patches(t), at())
    return nxt.withColumns({"features": F.array_join("features", "|"), "updated_at": _stamp("updated_at")})


def _patches(t):
    """A patch per customer; those of some nations touch only a protected column."""
    price = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_acctbal").cast("decimal(14,2)").cast("string"))
    good = F.create_map(
        F.lit("title_en"), F.col("c_name"), F.lit("price"), price, F.lit("features"), F.lit('["pool","view"]'), F.lit("slug"), F.lit("no"))
    bad = F.create_map(F.lit("slug"), F.lit("stolen"))
    return t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") % 5 != 0, good).otherwise(bad).alias("fields"))


@query("rejected_patches", "SELECT c_custkey AS id, 'no editable fields in body' AS error FROM customer WHERE c_nationkey % 5 = 0")
def rejected_patches(t):
    canon = t.v_listings.select("id", F.col("title").alias("title_en"), "price", "features", "updated_at")
    return up.apply_patches(canon, _patches(t), at())[1].select("id", "error")


@query("parse_form_values", """
    SELECT l_orderkey AS id, TRY_CAST(CASE WHEN l_linenumber = 1 THEN 'n/a' ELSE ' ' || l_partkey || ' ' END AS DOUBLE) AS beds,
      CASE l_linestatus WHEN 'O' THEN true END AS pool, CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'a|' || l_suppkey END AS tags,
      CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS note FROM lineitem""")
def parse_form_values(t):
    n = F.col("l_linenumber")
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("id"), F.when(n == 1, "n/a").otherwise(F.concat(F.lit(" "), F.col("l_partkey"), F.lit(" "))).alias("beds"),
        F.when(F.col("l_linestatus") == "O", "true").otherwise("maybe").alias("pool"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("a, ,"), F.col("l_suppkey"), F.lit(" ,"))).alias("tags"),
        F.when(n == 2, "").otherwise(F.col("l_returnflag")).alias("note"))
    out = up.parse_form_values(rows, {"beds": "number", "pool": "boolean", "tags": "array", "note": "text"})
    return out.withColumn("tags", F.array_join("tags", "|"))


@query("create_manual", """
    SELECT sha256('manual|' || c_custkey) AS id, coalesce(CASE WHEN c_nationkey = 1 THEN 'own-' || c_custkey END, 'manual-' || substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 8)) AS slug,
      CASE WHEN c_nationkey = 2 THEN 'active' ELSE 'draft' END AS status, 'other' AS property_type, 'USD' AS price_currency, 'reviewed' AS realtor_review_status FROM customer
    UNION ALL SELECT CAST(id AS VARCHAR), source_listing_id, status, property_type, price_currency, NULL FROM v_listings""")
def create_manual(t):
    canon = t.v_listings.select(
        F.col("id").cast("string").alias("id"), F.col("source_listing_id").alias("slug"), "status", "property_type", "price_currency",
        F.lit(None).cast("string").alias("realtor_review_status"))
    entries = t.customer.select(
        F.col("c_custkey").alias("entry_id"), F.when(F.col("c_nationkey") == 1, F.concat(F.lit("own-"), "c_custkey")).alias("slug"),
        F.when(F.col("c_nationkey") == 2, "active").alias("status"))
    return up.create_manual(canon, entries, at())


@query("apply_human_fields", """
    SELECT l.id, array_to_string(CASE WHEN c_nationkey % 2 = 0 THEN ['hot', c_mktsegment] ELSE l.tags_human END, '|') AS tags_human,
      CASE WHEN c_nationkey % 3 = 0 THEN 'agent' || c_custkey END AS agent_id FROM v_listings l LEFT JOIN customer ON 'L-' || c_custkey = l.source_listing_id""")
def apply_human_fields(t):
    canon = t.v_listings.withColumns({"slug": F.col("source_listing_id"), "agent_id": F.lit(None).cast("string")})
    nation = F.col("c_nationkey")
    edits = t.customer.select(
        F.concat(F.lit("L-"), "c_custkey").alias("slug"), F.when(nation % 2 == 0, F.array(F.lit("hot"), F.col("c_mktsegment"))).alias("tags_human"),
        F.when(nation % 3 == 0, F.concat(F.lit("agent"), "c_custkey")).alias("agent_id"))
    return up.apply_human_fields(canon, edits, at()).select("id", F.array_join("tags_human", "|").alias("tags_human"), "agent_id")


@query("delete_cascade", """
    SELECT 'listings' AS part, count(*) AS n, CAST(sum(id) AS BIGINT) AS keys FROM v_listings WHERE id NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'photos', count(*), CAST(sum(position) AS BIGINT) FROM v_photos WHERE listing_id NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'links', count(*), CAST(sum(raw_id) AS BIGINT) FROM v_links WHERE canonical_id NOT IN (SELECT p_partkey FROM part)""")
def delete_cascade(t):
    out = up.delete_cascade(
        t.part.select(F.col("p_partkey").alias("id")), t.v_listings,
        {"photos": (t.v_photos, "listing_id"), "links": (t.v_links, "canonical_id")})
    row = lambda name, key: out[name].agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(F.lit(name).alias("part"), "n", "keys")
    return row("listings", "id").unionByName(row("photos", "position")).unionByName(row("links", "raw_id"))


@query("ensure_columns", """
    SELECT id, price, 0 AS n_labels, CAST(NULL AS INTEGER) AS year_renovated, 'CR' AS country FROM v_listings""")
def ensure_columns(t):
    out = up.ensure_columns(
        t.v_listings.select("id", "price"),
        {"price": "decimal(14,2)", "property_labels": "array<string>", "year_renovated": "int", "country": "string"},
        {"country": F.lit("CR")})
    return out.select("id", "price", F.size("property_labels").alias("n_labels"), "year_renovated", "country")


@query("touch_updated_at", f"""
    SELECT l.id, CASE WHEN c.c_nationkey % 2 = 0 AND coalesce(l.title, '') <> c.c_name THEN '{AT}.000000' ELSE {stamp('l.updated_at')} END AS updated_at
    FROM v_listings l LEFT JOIN customer c ON c.c_custkey = l.id""")
def touch_updated_at(t):
    current = t.v_listings.select("id", "title", "features", "updated_at")
    names = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).alias("_n"))
    nxt = current.join(names, "id", "left").withColumn("title", F.coalesce("_n", "title")).drop("_n")
    return up.touch_updated_at(current, nxt, at()).select("id", _stamp("updated_at").alias("updated_at"))


@query("referential_check", """
    SELECT l_partkey AS missing_key, count(*) AS rows FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1""")
def referential_check(t):
    return up.referential_check(t.lineitem, "l_partkey", t.customer, "c_custkey")


@query("unique_check", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_check(t):
    return up.unique_check(t.lineitem, ["l_orderkey", "l_linenumber"])



EDITS = "SELECT o_custkey AS id, o_orderkey AS seq, o_orderstatus, o_orderpriority, o_totalprice FROM {orders}"


@query("ordered_patches", """
    WITH e AS (SELECT * FROM orders),
    p AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS title, arg_max(o_totalprice, o_orderkey) FILTER (o_orderstatus <> 'F') AS price,
      bool_or(o_orderstatus <> 'F') AS priced FROM e GROUP BY 1)
    SELECT l.id, coalesce(p.title, l.title) AS title_en,
      CASE WHEN p.priced THEN CAST(p.price AS DECIMAL(14,2)) ELSE l.price END AS price
    FROM v_listings l LEFT JOIN p ON p.id = l.id""")
def ordered_patches(t):
    """Several patches of a listing: each field takes its newest value, and failed orders patch only the title."""
    title = F.create_map(F.lit("title_en"), F.col("o_orderpriority"))
    both = F.map_concat(title, F.create_map(F.lit("price"), F.col("o_totalprice").cast("decimal(14,2)").cast("string")))
    patches = t.sql(EDITS).select("id", "seq", F.when(F.col("o_orderstatus") == "F", title).otherwise(both).alias("fields"))
    canon = t.v_listings.select("id", F.col("title").alias("title_en"), "price", "updated_at")
    return up.apply_patches(canon, patches, at())[0].select("id", "title_en", "price")


@query("ordered_human_fields", """
    SELECT l.id, array_to_string(coalesce(e.tags, l.tags_human), '|') AS tags_human, e.agent AS agent_id FROM v_listings l LEFT JOIN (
      SELECT o_custkey AS id, arg_max([o_orderpriority], o_orderkey) FILTER (o_orderstatus = 'O') AS tags,
        arg_max('agent' || o_orderkey, o_orderkey) FILTER (o_orderstatus = 'F') AS agent FROM orders GROUP BY 1) e ON 'L-' || e.id = l.source_listing_id""")
def ordered_human_fields(t):
    canon = t.v_listings.withColumns({"slug": F.col("source_listing_id"), "agent_id": F.lit(None).cast("string")})
    edits = t.sql(EDITS).select(
        F.concat(F.lit("L-"), "id").alias("slug"), "seq", F.when(F.col("o_orderstatus") == "O", F.array("o_orderpriority")).alias("tags_human"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("agent"), "seq")).alias("agent_id"))
    return up.apply_human_fields(canon, edits, at()).select("id", F.array_join("tags_human", "|").alias("tags_human"), "agent_id")


@query("repeated_links", """
    WITH n AS (SELECT o_custkey % 50 AS canonical_id, o_custkey AS raw_id, o_orderpriority AS method, o_orderkey AS seq FROM orders),
    w AS (SELECT canonical_id, raw_id, arg_max(method, seq) AS method FROM n GROUP BY ALL),
    o AS (SELECT c_custkey % 50 AS canonical_id, c_custkey AS raw_id, 'old' AS method FROM customer)
    SELECT canonical_id, raw_id, coalesce(w.method, o.method) AS method FROM o FULL JOIN w USING (canonical_id, raw_id)""")
def repeated_links(t):
    """A batch that holds an edge several times gives it once, as its newest row says."""
    batch = t.orders.select(
        (F.col("o_custkey") % 50).alias("canonical_id"), F.col("o_custkey").alias("raw_id"), F.col("o_orderpriority").alias("method"),
        F.col("o_orderkey").alias("seq"))
    current = t.customer.select((F.col("c_custkey") % 50).alias("canonical_id"), F.col("c_custkey").alias("raw_id"), F.lit("old").alias("method"))
    return up.upsert_links(current, batch)
