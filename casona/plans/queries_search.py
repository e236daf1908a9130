"""Queries over the search and read views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from casona.functions import geo, money
from casona.operators import enrich, listings as ls, normalize as norm
from casona.operators.textindex import TextIndex
from casona.plans import sqlparts as p
from casona.plans.catalog import query
from casona.session import shared_folder

CANON_SQL = f"""
    SELECT l.*, l.source_listing_id AS slug, l.title AS title_en, l.locality AS title_es, l.description AS description_en,
      {p.price_usd()} AS price_usd, (SELECT arg_min(region, ord) FROM f_boxes b WHERE l.lat BETWEEN b.lat1 AND b.lat2 AND l.lng BETWEEN b.lng1 AND b.lng2) AS region_slug
    FROM v_listings l"""


def canon(t):
    """Listings as a canonical table: USD price, region, titles and categories."""
    rows = norm.to_usd(t.v_listings, "price", "price_currency", money.rate_table(t.spark), "price_usd")
    return rows.withColumns({
        "slug": F.col("source_listing_id"), "title_en": F.col("title"), "title_es": F.col("locality"),
        "description_en": F.col("description"), "description_es": F.lit(None).cast("string"), "region_slug": geo.region_by_bbox("lat", "lng"),
        "categories": enrich.derive_categories("property_type", "price_usd", F.lit(None).cast("double"), "features", "tags_ai"),
    })


def photos(t):
    return t.v_photos.withColumn("url_source", F.col("url"))


CARDS = f"""
    WITH c AS ({CANON_SQL}),
    h AS (SELECT listing_id, arg_min(coalesce(url_cached, url), (position, coalesce(url_cached, url))) AS hero_url
          FROM v_photos WHERE is_hero AND NOT is_rejected GROUP BY 1),
    f AS (SELECT listing_id, arg_min(coalesce(url_cached, url), (position, coalesce(url_cached, url))) AS fallback_url
          FROM v_photos WHERE NOT is_rejected GROUP BY 1)
    SELECT c.id, c.slug, c.status, c.price_usd, c.region_slug, h.hero_url, f.fallback_url
    FROM c LEFT JOIN h ON h.listing_id = c.id LEFT JOIN f ON f.listing_id = c.id"""


@query("listing_cards", CARDS)
def listing_cards(t):
    return ls.listing_cards(canon(t), photos(t)).select(
        "id", "slug", "status", "price_usd", "region_slug", "hero_url", "fallback_url")


FILTERS = ls.SearchFilters(
    regions=("guanacaste", "nicoya", "central-valley", "central-pacific"), types=("house", "condo", "farm", "lot"),
    categories=("beach-properties", "luxury-properties", "lots"), features=("beachfront", "pool"),
    min_price=50_000, max_price=2_500_000, beds=1, baths=1, q="a")

FILTER_SQL = f"""status = 'active' AND region_slug IN ('guanacaste', 'nicoya', 'central-valley', 'central-pacific')
    AND property_type IN ('house', 'condo', 'farm', 'lot') AND price_usd BETWEEN 50000 AND 2500000 AND bedrooms >= 1 AND bathrooms >= 1
    AND list_has_any({p.category_list('property_type', 'price_usd', 'CAST(NULL AS DOUBLE)', 'features', 'tags_ai')}, ['beach-properties', 'luxury-properties', 'lots'])
    AND list_has_all(coalesce(features, []), ['beachfront', 'pool'])
    AND (title_en ILIKE '%a%' OR title_es ILIKE '%a%' OR locality ILIKE '%a%')"""


def _cards(t):
    return ls.listing_cards(canon(t), photos(t))


@query("search_page", f"""
    WITH c AS ({CANON_SQL}) SELECT id, price_usd, property_type FROM c WHERE {FILTER_SQL}
    ORDER BY last_seen_at DESC NULLS LAST, id LIMIT 24 OFFSET 24""")
def search_page(t):
    rows, _ = ls.search(_cards(t), FILTERS, page=2)
    return rows.select("id", "price_usd", "property_type")


@query("search_after", """
    SELECT id, strftime(last_seen_at, '%Y-%m-%d') AS day FROM v_listings WHERE status = 'active' AND locality IN ('Nosara', 'Puerto Viejo', 'Uvita de Osa') ORDER BY last_seen_at DESC NULLS LAST, id LIMIT 100 OFFSET 200""")
def search_after(t):
    """The third page by cursors, over a table laid out for paging."""
    path = f"{shared_folder(t.spark)}/by-recency-{uuid.uuid4().hex}"
    ls.by_recency(t.v_listings.withColumn("region_slug", F.col("locality")), 8).write.parquet(path)
    cards, cursor = t.spark.read.parquet(path), None
    filters = ls.SearchFilters(regions=("Nosara", "Puerto Viejo", "Uvita de Osa"))
    for _ in range(2):
        shown = ls.search_after(cards, filters, cursor, 100).select("last_seen_at", "id").tail(1)
        cursor = tuple(shown[0]) if shown else cursor
    return ls.search_after(cards, filters, cursor, 100).select("id", F.date_format("last_seen_at", "yyyy-MM-dd").alias("day"))


@query("search_total", f"WITH c AS ({CANON_SQL}) SELECT count(*) AS total FROM c WHERE {FILTER_SQL}")
def search_total(t):
    return ls.search(canon(t), FILTERS)[1]


@query("text_match", """
    SELECT id FROM v_listings WHERE contains(lower(title), '100% plano') OR contains(lower(locality), '100% plano')""")
def text_match(t):
    rows = t.v_listings.withColumns({"title_en": F.col("title"), "title_es": F.col("locality")})
    return rows.filter(ls.text_match("100% PLANO")).select("id")


TOKENS_SQL = """
    SELECT token, id, CAST(sum(w) AS DECIMAL(14,2)) AS weight FROM (
      SELECT id, w, unnest(regexp_split_to_array(lower(x), '[^\\p{L}\\p{N}]+')) AS token FROM (
        SELECT id, title AS x, 1.0 AS w FROM v_listings UNION ALL SELECT id, locality, 0.4 FROM v_listings
        UNION ALL SELECT id, canton, 0.4 FROM v_listings UNION ALL SELECT id, province, 0.2 FROM v_listings
        UNION ALL SELECT id, description, 0.1 FROM v_listings) WHERE x IS NOT NULL)
    WHERE token <> '' GROUP BY token, id"""


def _tokens(t):
    rows = t.v_listings.withColumns({"title_en": F.col("title"), "description_en": F.col("description")})
    return ls.token_index(rows)


@query("token_index", TOKENS_SQL)
def token_index(t):
    return _tokens(t)


@query("fulltext_rank", f"""
    SELECT id, CAST(sum(weight) AS DECIMAL(14,2)) AS score FROM ({TOKENS_SQL}) WHERE token IN ('casa', 'beach', 'house')
    GROUP BY id HAVING count(*) = 3""")
def fulltext_rank(t):
    return ls.fulltext_rank(_tokens(t), "Casa, BEACH house")


CHANGED = """SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN 'Renovated beach casa' ELSE title END AS title, CASE WHEN id % 3 = 0 THEN NULL ELSE description END AS description) FROM v_listings WHERE id % 11 <> 0"""


@query("text_index", f"""
    SELECT id, CAST(sum(weight) AS DECIMAL(14,2)) AS score FROM ({TOKENS_SQL.replace('FROM v_listings', f'FROM ({CHANGED})')}) WHERE token IN ('casa', 'beach')
    GROUP BY id HAVING count(*) = 2""")
def text_index(t):
    """A stored index after two updates: listings that changed and listings that went."""
    rows = t.v_listings.select("id", F.col("title").alias("title_en"), "locality", "canton", "province", F.col("description").alias("description_en"))
    index = TextIndex(t.spark, f"{shared_folder(t.spark)}/text-{uuid.uuid4().hex}", T.LongType(), 16)
    index.update(0, rows)
    third = F.col("id") % 3 == 0
    changed = rows.filter(third).withColumns({"title_en": F.lit("Renovated beach casa"), "description_en": F.lit(None).cast("string")})
    index.update(1, changed)
    index.compact(most=8)
    index.update(2, rows.limit(0), rows.filter("id % 11 = 0").select("id"))
    return index.search("Beach, CASA")


DOC_TOKENS = """
    SELECT token, id, CAST(count(*) AS DECIMAL(14,2)) AS weight FROM (
      SELECT doc_id AS id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS token FROM documents)
    WHERE token <> '' GROUP BY token, id"""


@query("fulltext_documents", f"""
    SELECT id, CAST(sum(weight) AS DECIMAL(14,2)) AS score FROM ({DOC_TOKENS}) WHERE token IN ('the', 'of', 'with')
    GROUP BY id HAVING count(*) = 3""")
def fulltext_documents(t):
    index = ls.token_index(t.documents.withColumn("body", F.col("text")), weights=(("body", "1.0"),), id_col="doc_id")
    return ls.fulltext_rank(index, "the of with")


SLUG = "L-77"


@query("listing_detail", f"""
    SELECT 'photo' AS part, photo_id AS key, url AS value FROM v_photos WHERE listing_id = (SELECT id FROM v_listings WHERE source_listing_id = '{SLUG}')
    UNION ALL SELECT 'agent', id, name FROM v_agents WHERE enabled
    UNION ALL SELECT 'listing', id, title FROM v_listings WHERE source_listing_id = '{SLUG}'""")
def listing_detail(t):
    rows = t.v_listings.withColumn("slug", F.col("source_listing_id"))
    d = ls.listing_detail(rows, t.v_photos, t.v_agents, SLUG)
    part = lambda df, name, key, value: df.select(F.lit(name).alias("part"), F.col(key).alias("key"), F.col(value).alias("value"))
    return part(d.photos, "photo", "photo_id", "url").unionByName(part(d.agents, "agent", "id", "name")).unionByName(
        part(d.listing, "listing", "id", "title"))


@query("visible_rows", """
    SELECT 'anon listings' AS view, count(*) AS n FROM v_listings WHERE status = 'active'
    UNION ALL SELECT 'anon photos', count(*) FROM v_photos WHERE listing_id IN (SELECT id FROM v_listings WHERE status = 'active')
    UNION ALL SELECT 'anon runs', 0
    UNION ALL SELECT 'realtor listings', count(*) FROM v_listings UNION ALL SELECT 'realtor runs', 0
    UNION ALL SELECT 'admin runs', count(*) FROM v_runs""")
def visible_rows(t):
    views = {
        "anon listings": ls.visible_rows(t.v_listings, "listings", "anon"),
        "anon photos": ls.visible_rows(t.v_photos, "photos", "anon", listings=t.v_listings),
        "anon runs": ls.visible_rows(t.v_runs, "runs", "anon"),
        "realtor listings": ls.visible_rows(t.v_listings, "listings", "realtor"),
        "realtor runs": ls.visible_rows(t.v_runs, "runs", "realtor"),
        "admin runs": ls.visible_rows(t.v_runs, "runs", "admin"),
    }
    out = None
    for name, df in views.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("view"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("visible_rows_by_region", f"WITH c AS ({CANON_SQL}) SELECT id, region_slug FROM c WHERE region_slug IN ('nicoya', 'caribbean')")
def visible_rows_by_region(t):
    return ls.visible_rows(canon(t), "listings", "realtor", regions=("nicoya", "caribbean")).select("id", "region_slug")


@query("data_grid", f"""
    WITH c AS ({CANON_SQL}) SELECT id, slug, price, price_currency, price_usd FROM c ORDER BY last_seen_at DESC NULLS LAST, id LIMIT 500""")
def data_grid(t):
    rows = canon(t).withColumn("created_at", F.col("last_seen_at"))
    return ls.data_grid(rows, "Pricing", n=500).select("id", "slug", "price", "price_currency", "price_usd")


@query("display_values", f"""
    WITH c AS ({CANON_SQL}) SELECT id, CASE region_slug WHEN 'central-pacific' THEN 'Central Pacific' WHEN 'guanacaste' THEN 'Guanacaste'
        WHEN 'central-valley' THEN 'Central Valley' WHEN 'nicoya' THEN 'Nicoya' WHEN 'caribbean' THEN 'Caribbean'
        WHEN 'south-pacific' THEN 'South Pacific' ELSE '—' END AS region_label,
      coalesce(title_en, title_es, 'Listing ' || slug) AS display_title FROM c""")
def display_values(t):
    return ls.display_values(canon(t)).select("id", "region_label", "display_title")
