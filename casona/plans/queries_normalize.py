"""Queries over normalization and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from casona import refdata
from casona.functions import geo, money, text
from casona.operators import enrich, normalize as norm
from casona.plans import ingest, sqlparts as p
from casona.plans.catalog import query, values
from casona.session import small_table
from casona.sources.tables import reference_tables as seed_tables


def _priced(t):
    return norm.fees_to_usd(
        t.v_listings, {"price": "price_usd", "hoa_fee": "hoa_fee_usd"}, "price_currency", money.rate_table(t.spark))


@query("fx_normalize", f"""
    SELECT l.id, {p.price_usd()} AS price_usd, {p.usd('l.hoa_fee', 'l.price_currency')} AS hoa_fee_usd FROM v_listings l""")
def fx_normalize(t):
    return _priced(t).select("id", "price_usd", "hoa_fee_usd")


@query("price_per_sqm", f"""
    SELECT id, {p.per_sqm('price_usd', 'interior_sqm')} AS price_per_sqm
    FROM (SELECT l.id, l.interior_sqm, {p.price_usd()} AS price_usd FROM v_listings l)""")
def price_per_sqm(t):
    return _priced(t).select("id", money.price_per_sqm("price_usd", "interior_sqm").alias("price_per_sqm"))


@query("unit_to_sqm", """
    SELECT id, CAST(CASE WHEN property_type IN ('lot', 'farm') THEN round(CAST(lot_sqm AS DECIMAL(14,4)) * 4046.86, 2)
      WHEN property_type = 'condo' THEN lot_sqm
      WHEN property_type IN ('house', 'hotel') THEN round(CAST(lot_sqm AS DECIMAL(14,4)) * 0.092903, 2) END AS DECIMAL(14,2)) AS sqm
    FROM v_listings""")
def unit_to_sqm(t):
    kind = F.col("property_type")
    unit = F.when(kind.isin("lot", "farm"), "acres").when(kind == "condo", "m²").when(kind == "house", "sqft").when(
        kind == "hotel", "Square Feet").otherwise("manzanas")
    return t.v_listings.select("id", text.unit_to_sqm("lot_sqm", unit).alias("sqm"))


@query("fold_text", f"SELECT doc_id, length({p.fold('text')}) AS n, md5({p.fold('text')}) AS folded FROM documents")
def fold_text(t):
    folded = t.documents.select("doc_id", text.fold_text("text").alias("f"))
    return folded.select("doc_id", F.length("f").cast("bigint").alias("n"), F.md5("f").alias("folded"))


@query("gazetteer_region", f"""
    WITH g AS (SELECT c_custkey * 7919 % 100003 AS ord, CASE WHEN c_custkey % 20 = 0 THEN {p.fold("c_mktsegment")} || ' ' ELSE '' END || CAST(c_custkey AS VARCHAR) AS key, 'r' || c_nationkey AS region FROM customer
      UNION ALL SELECT 200000 + ord, key, region FROM f_localities)
    SELECT id, (SELECT arg_min(region, ord) FROM g WHERE contains({p.fold("coalesce(title, locality)")}, g.key)) AS region_slug FROM v_listings""")
def gazetteer_region(t):
    """A gazetteer as long as the customer table, of numbers, words with numbers and place names, in titles."""
    number = F.col("c_custkey").cast("string")
    long = t.customer.select(
        (F.col("c_custkey") * 7919 % 100003).alias("ord"),
        F.when(F.col("c_custkey") % 20 == 0, F.concat(text.fold_text("c_mktsegment"), F.lit(" "), number)).otherwise(number).alias("key"),
        F.concat(F.lit("r"), "c_nationkey").alias("region"))
    fixed = small_table(t.spark, [(200000 + i, k, r) for i, (k, r) in enumerate(refdata.GAZETTEER)], "ord bigint, key string, region string")
    rows = t.v_listings.select("id", F.coalesce("title", "locality").alias("place"))
    return norm.region_by_gazetteer(rows, long.unionByName(fixed), "place").select("id", "region_slug")


@query("region_locality", f"""
    SELECT id, (SELECT arg_min(region, ord) FROM f_localities g WHERE g.key = {p.fold('locality')}) AS by_key,
      (SELECT arg_min(region, ord) FROM f_localities g WHERE contains({p.fold('locality')}, g.key)) AS by_part,
      coalesce({p.region_of('locality')}, {p.region_of('canton')}, {p.region_of('province')}) AS by_levels
    FROM v_listings""")
def region_locality(t):
    return t.v_listings.select(
        "id", norm.region_by_locality_exact("locality").alias("by_key"),
        norm.region_by_locality_contains("locality").alias("by_part"),
        norm.region_from_levels("locality", "canton", "district", "province").alias("by_levels"))


@query("region_bbox", f"SELECT id, {p.BOX_OF} AS region_slug FROM v_listings")
def region_bbox(t):
    return t.v_listings.select("id", geo.region_by_bbox("lat", "lng").alias("region_slug"))


@query("assign_region", f"""
    SELECT id, coalesce({p.region_of('locality')}, {p.region_of('canton')}, {p.region_of('province')}, {p.BOX_OF}) AS region_slug
    FROM v_listings""")
def assign_region(t):
    return norm.assign_region(t.v_listings).select("id", "region_slug")


@query("haversine", f"SELECT id, round({p.haversine('lat', 'lng', '9.99386e0', '(-84.20882e0)')}, 3) AS km FROM v_listings")
def haversine(t):
    return t.v_listings.select(
        "id", F.round(geo.haversine_km("lat", "lng", F.lit(9.99386), F.lit(-84.20882)), 3).alias("km"))


POI_COLUMNS = [
    "distance_to_beach_km", "distance_to_airport_km", "nearest_airport_code", "distance_to_hospital_km",
    "nearest_hospital_name", "distance_to_school_km", "nearest_school_name",
]


@query("nearest_poi", f"SELECT l.id, n.* EXCLUDE (id) FROM v_listings l LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id")
def nearest_poi(t):
    return norm.nearest_pois_all(t.v_listings).select("id", *POI_COLUMNS)


CUSTOMER_SPOTS = """
    SELECT c_name AS name, CAST(c_custkey * 41 % 3000 AS DOUBLE) / 1000 + 8.2e0 AS lat,
      CAST(c_custkey * 59 % 3600 AS DOUBLE) / 1000 - 86.1e0 AS lng FROM {customer}"""


@query("nearest_poi_grid", f"""
    WITH spots AS (SELECT name, lat AS p_lat, lng AS p_lng FROM ({CUSTOMER_SPOTS.format(customer='customer')})),
    near AS (SELECT l.id, s.name, {p.haversine('l.lat', 'l.lng', 's.p_lat', 's.p_lng')} AS km
      FROM v_listings l JOIN spots s ON abs(l.lat - s.p_lat) <= 0.5e0 AND abs(l.lng - s.p_lng) <= 0.5e0 WHERE {p.IN_COUNTRY})
    SELECT id, arg_min(name, (km, name)) AS name, round(min(km), 3) AS km FROM near WHERE km <= 50 GROUP BY id""")
def nearest_poi_grid(t):
    found = norm.nearest_poi_table(t.v_listings, "id", t.sql(CUSTOMER_SPOTS), max_km=50.0)
    return found.select("id", "name", F.round("km", 3).alias("km"))


PLACES = """
    SELECT c_custkey AS customer_key, 'x' AS x,
      CASE WHEN c_custkey % 8 = 0 THEN 'Calle ' || CAST(c_custkey % 40 AS STRING) || ', ' ELSE '' END
      || CASE c_custkey % 12 WHEN 0 THEN 'Nosara, ' WHEN 1 THEN 'Tamarindo, Guanacaste, ' WHEN 2 THEN ' Jacó, ' WHEN 3 THEN 'Puerto Viejo, '
           WHEN 4 THEN 'San José, ' WHEN 5 THEN 'Atlantis, ' WHEN 6 THEN 'Playa Hermosa, Jaco, ' WHEN 7 THEN 'Sámara, '
           WHEN 9 THEN 'Uvita de Osa, ' WHEN 10 THEN 'Escazú, ' ELSE '' END
      || CASE c_custkey % 5 WHEN 0 THEN 'Santa Cruz, ' WHEN 1 THEN 'Garabito, ' WHEN 2 THEN 'Talamanca, ' ELSE '' END
      || CASE c_custkey % 3 WHEN 0 THEN 'Limón, ' WHEN 1 THEN 'Puntarenas, ' ELSE '' END || 'Costa Rica' AS query,
      CAST(c_custkey * 31 % 6000 AS DOUBLE) / 1000 + 7.0e0 AS lat, CAST(c_custkey * 17 % 6000 AS DOUBLE) / 1000 - 87.0e0 AS lng,
      CASE c_custkey % 5 WHEN 0 THEN 'address' WHEN 1 THEN 'place' WHEN 2 THEN 'neighborhood' WHEN 3 THEN 'locality' ELSE 'poi' END AS place_type
    FROM {customer}"""


@query("geocode_lookup", f"""
    WITH g AS (SELECT query, min((lat, lng, place_type)) AS hit FROM ({PLACES.format(customer='customer')}) WHERE {p.IN_COUNTRY} GROUP BY query),
    l AS (SELECT id, lat, lng, array_to_string(list_filter([nullif(address_line, ''), nullif(locality, ''), nullif(canton, ''), nullif(province, '')],
        lambda x: x IS NOT NULL), ', ') AS parts FROM v_listings)
    SELECT l.id, CASE WHEN l.lat IS NULL THEN round(g.hit[1], 6) ELSE round(l.lat, 6) END AS lat,
      CASE WHEN l.lat IS NULL THEN round(g.hit[2], 6) ELSE round(l.lng, 6) END AS lng,
      CASE WHEN l.lat IS NOT NULL THEN 'exact' WHEN g.hit IS NULL THEN NULL ELSE
        CASE g.hit[3] WHEN 'address' THEN 'exact' WHEN 'neighborhood' THEN 'neighborhood' WHEN 'place' THEN 'block'
          WHEN 'locality' THEN 'block' ELSE 'region' END END AS geocode_confidence
    FROM l LEFT JOIN g ON l.parts <> '' AND g.query = l.parts || ', Costa Rica'""")
def geocode_lookup(t):
    out = norm.geocode_lookup(t.v_listings, t.sql(PLACES))
    return out.select("id", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "geocode_confidence")


@query("build_slug", f"SELECT id, {p.slug('title', 'locality', 'id')} AS slug FROM v_listings")
def build_slug(t):
    return t.v_listings.select("id", text.build_slug("title", "locality", "id").alias("slug"))


@query("clean_title", p.title_sql("v_listings", "title", "id"))
def clean_title(t):
    return t.v_listings.select("id", text.clean_title("title").alias("clean_title"))


@query("primary_title", f"""
    WITH en AS ({p.title_sql("(SELECT id, CASE WHEN language = 'en' THEN title END AS x FROM v_listings)", 'x', 'id')}),
    es AS ({p.title_sql("(SELECT id, CASE WHEN language <> 'en' THEN title END AS x FROM v_listings)", 'x', 'id')})
    SELECT id, coalesce(en.clean_title, es.clean_title) AS title FROM en JOIN es USING (id)""")
def primary_title(t):
    en = F.when(F.col("language") == "en", F.col("title"))
    es = F.when(F.col("language") != "en", F.col("title"))
    return t.v_listings.select("id", text.pick_primary_title(en, es).alias("title"))


@query("clean_description", f"""
    SELECT doc_id, CASE WHEN length(d) >= 10 THEN md5(d) END AS clean FROM (SELECT doc_id, {p.strip(p.squeeze(p.decode('text')))} AS d FROM documents)""")
def clean_description(t):
    return t.documents.select("doc_id", F.md5(text.clean_description("text")).alias("clean"))


@query("decode_entities", f"SELECT page_id, length({p.decode('html')}) AS n, md5({p.decode('html')}) AS decoded FROM pages")
def decode_entities(t):
    out = t.pages.select("page_id", text.decode_entities("html").alias("d"))
    return out.select("page_id", F.length("d").cast("bigint").alias("n"), F.md5("d").alias("decoded"))


NORMALIZED = f"""
    WITH t AS ({p.title_sql('v_listings', 'title', 'id')})
    SELECT l.id, {p.price_usd()} AS price_usd, {p.usd('l.hoa_fee', 'l.price_currency')} AS hoa_fee_usd,
      {p.per_sqm('(' + p.price_usd() + ')', 'l.interior_sqm')} AS price_per_sqm,
      coalesce({p.region_of('l.locality')}, {p.region_of('l.canton')}, {p.region_of('l.province')}, {p.BOX_OF}) AS region_slug,
      CASE WHEN l.lat IS NOT NULL THEN 'exact' END AS geocode_confidence,
      {p.slug('l.title', 'l.locality', 'l.id')} AS slug, t.clean_title AS title,
      n.distance_to_beach_km, n.nearest_airport_code
    FROM v_listings l JOIN t ON t.id = l.id LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id"""


@query("normalize_stage", NORMALIZED)
def normalize_stage(t):
    rows = t.v_listings.withColumns(
        {c: F.lit(None).cast("decimal(14,2)") for c in ("taxes_annual", "list_price_original")})
    return norm.normalize(rows, money.rate_table(t.spark), key="id").select(
        "id", "price_usd", "hoa_fee_usd", "price_per_sqm", "region_slug", "geocode_confidence", "slug", "title",
        "distance_to_beach_km", "nearest_airport_code")


@query("market_report", f"""
    WITH a AS (
      SELECT l.property_type, l.features, l.tags_ai, {p.price_usd()} AS price_usd, n.distance_to_beach_km AS beach,
        coalesce({p.region_of('l.locality')}, {p.region_of('l.canton')}, {p.region_of('l.province')}, {p.BOX_OF}, 'none') AS region_slug
      FROM v_listings l LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id WHERE l.status = 'active'),
    c AS (SELECT region_slug, price_usd, beach, unnest({p.category_list('property_type', 'price_usd', 'beach', 'features', 'tags_ai')}) AS category FROM a)
    SELECT region_slug, category, count(*) AS listings, min(price_usd) AS min_price_usd, max(price_usd) AS max_price_usd,
      CAST(sum(price_usd) AS DECIMAL(20,2)) AS total_price_usd, CAST(sum(beach) AS DECIMAL(14,1)) AS beach_km
    FROM c GROUP BY ALL""")
def market_report(t):
    return ingest.market_report(t.v_listings, money.rate_table(t.spark))


# ---------------------------------------------------------------- enrichment

def _categorised(t):
    """Listings with beach distance, and stored categories for those whose photos were counted."""
    rows = norm.to_usd(t.v_listings, "price", "price_currency", money.rate_table(t.spark), "price_usd")
    return norm.nearest_pois_all(rows)


@query("derive_categories", f"""
    SELECT l.id, array_to_string({p.category_list('l.property_type', p.price_usd(), 'n.distance_to_beach_km', 'l.features', 'l.tags_ai')}, '|') AS categories
    FROM v_listings l LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id""")
def derive_categories(t):
    cats = enrich.derive_categories("property_type", "price_usd", "distance_to_beach_km", "features", "tags_ai")
    return _categorised(t).select("id", F.array_join(cats, "|").alias("categories"))


@query("derive_categories_sql_function", f"""
    SELECT l.id, array_to_string({p.category_list('l.property_type', p.price_usd(), 'n.distance_to_beach_km', 'l.features', 'l.tags_ai')}, '|') AS categories
    FROM v_listings l LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id""")
def derive_categories_sql_function(t):
    enrich.register_sql_functions(t.spark)
    call = "array_join(derive_listing_categories(property_type, price_usd, distance_to_beach_km, features, tags_ai), '|') AS categories"
    return _categorised(t).selectExpr("id", call)


@query("backfill_categories", f"""
    SELECT l.id, CASE WHEN l.parking_spaces > 0 THEN 'lots' ELSE
      array_to_string({p.category_list('l.property_type', p.price_usd(), 'n.distance_to_beach_km', 'l.features', 'l.tags_ai')}, '|') END AS categories
    FROM v_listings l LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id""")
def backfill_categories(t):
    stored = F.when(F.col("parking_spaces") > 0, F.array(F.lit("lots"))).when(
        F.col("parking_spaces") == 0, F.array().cast("array<string>"))
    out = enrich.backfill_categories(_categorised(t).withColumn("categories", stored))
    return out.select("id", F.array_join("categories", "|").alias("categories"))


@query("backfill_flags", """
    SELECT id, CASE WHEN status = 'sold' THEN false WHEN len(features) > 0 THEN true END AS pool_yn,
      CASE WHEN parking_spaces > 0 OR bathrooms_full = 3 THEN true END AS parking_yn FROM v_listings""")
def backfill_flags(t):
    rows = t.v_listings.withColumns({
        "pool_yn": F.when(F.col("status") == "sold", F.lit(False)), "parking_yn": F.lit(None).cast("boolean"),
        "pool_features": F.col("features"), "garage_spaces": F.when(F.col("bathrooms_full") == 3, 1)})
    return enrich.backfill_flags(rows).select("id", "pool_yn", "parking_yn")


@query("bathrooms_total", """
    SELECT id, CAST(coalesce(bathrooms_full, 0) + coalesce(bathrooms_half, 0) * 0.5 AS DECIMAL(4,1)) AS bathrooms_total FROM v_listings""")
def bathrooms_total(t):
    return t.v_listings.select("id", enrich.bathrooms_total().alias("bathrooms_total"))


def _vocabulary(words):
    return "[" + ", ".join(p.lit(w) for w in words) + "]"


@query("vocab_filter", f"""
    SELECT id, array_to_string(f, '|') AS tagged, array_to_string(CASE WHEN len(f) > 0 THEN f ELSE coalesce(tags_human, []) END, '|') AS features FROM (
      SELECT id, tags_human, coalesce(list_filter(features, lambda x: list_contains({_vocabulary(refdata.FEATURE_VOCAB)}, x)), []) AS f FROM v_listings)""")
def vocab_filter(t):
    tagged = enrich.vocab_filter("features", refdata.FEATURE_VOCAB)
    return t.v_listings.select(
        "id", F.array_join(tagged, "|").alias("tagged"),
        F.array_join(enrich.feature_fallback(tagged, "tags_human"), "|").alias("features"))


REPLIES = """
    SELECT 'L-' || CAST(p_partkey AS STRING) AS source_listing_id,
      CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_name || ' EN' END AS title_en, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name || ' ES' END AS title_es,
      p_brand || ' en' AS description_en, CASE WHEN p_size % 2 = 0 THEN p_brand || ' es' END AS description_es,
      CASE WHEN p_size % 3 = 0 THEN p_type || ' voice' END AS rewritten_en, CASE WHEN p_size % 7 = 0 THEN p_type || ' voz' END AS rewritten_es
    FROM {part}"""


@query("bilingual_copy", f"""
    SELECT l.id, coalesce(r.title_en, CASE WHEN l.language = 'en' THEN l.title END) AS title_en,
      coalesce(r.title_es, CASE WHEN l.language = 'es' THEN l.title END) AS title_es,
      coalesce(r.rewritten_en, r.description_en) AS description_en, coalesce(r.rewritten_es, r.description_es) AS description_es,
      l.description AS description_raw
    FROM v_listings l LEFT JOIN ({REPLIES.format(part='part')}) r USING (source_listing_id)""")
def bilingual_copy(t):
    return enrich.bilingual_copy(t.v_listings, t.sql(REPLIES)).select(
        "id", "title_en", "title_es", "description_en", "description_es", "description_raw")


@query("enrich_stage", f"""
    WITH g AS (SELECT 'L-' || CAST(s_suppkey AS VARCHAR) AS source_listing_id, CASE WHEN s_suppkey % 2 = 0 THEN ['pool', 'moat', 'hoa'] ELSE [] END AS f,
        CASE WHEN s_suppkey % 3 = 0 THEN ['luxury', 'vast'] ELSE [] END AS g FROM supplier),
    e AS (SELECT l.id, l.property_type, {p.price_usd()} AS price_usd, n.distance_to_beach_km AS beach, l.bathrooms_full, l.bathrooms_half,
        coalesce(r.title_en, CASE WHEN l.language = 'en' THEN l.title END) AS title_en,
        CASE WHEN len(list_filter(g.f, lambda x: x <> 'moat')) > 0 THEN list_filter(g.f, lambda x: x <> 'moat') ELSE coalesce(l.features, []) END AS features,
        coalesce(list_filter(g.g, lambda x: x <> 'vast'), []) AS tags
      FROM v_listings l LEFT JOIN ({REPLIES.format(part='part')}) r USING (source_listing_id) LEFT JOIN g USING (source_listing_id)
      LEFT JOIN ({p.NEAREST_WIDE}) n ON n.id = l.id)
    SELECT id, title_en, array_to_string(features, '|') AS features, array_to_string(tags, '|') AS tags_ai,
      array_to_string({p.category_list('property_type', 'price_usd', 'beach', 'features', 'tags')}, '|') AS categories,
      CAST(coalesce(bathrooms_full, 0) + coalesce(bathrooms_half, 0) * 0.5 AS DECIMAL(4,1)) AS bathrooms_total FROM e""")
def enrich_stage(t):
    none = F.array().cast("array<string>")
    key = F.col("s_suppkey")
    tagged = t.supplier.select(
        F.concat(F.lit("L-"), key.cast("string")).alias("source_listing_id"),
        F.when(key % 2 == 0, F.array(*map(F.lit, ("pool", "moat", "hoa")))).otherwise(none).alias("features"),
        F.when(key % 3 == 0, F.array(F.lit("luxury"), F.lit("vast"))).otherwise(none).alias("tags"))
    rows = _categorised(t).withColumns({
        "pool_yn": F.lit(None).cast("boolean"), "parking_yn": F.lit(None).cast("boolean"), "pool_features": none,
        "garage_spaces": F.lit(None).cast("int")})
    out = enrich.enrich(rows, t.sql(REPLIES), tagged)
    return out.select(
        "id", "title_en", F.array_join("features", "|").alias("features"), F.array_join("tags_ai", "|").alias("tags_ai"),
        F.array_join("categories", "|").alias("categories"), "bathrooms_total")


@query("hero_and_alt", """
    SELECT photo_id, position = CASE WHEN p_size % 9 BETWEEN 0 AND 5 THEN p_size % 9 ELSE 0 END AS is_hero,
      coalesce(CASE WHEN p_partkey IS NOT NULL AND position = 0 THEN 'front of ' || p_name WHEN p_partkey IS NOT NULL AND position = 2 THEN p_brand END, 'photo ' || CAST(width AS VARCHAR)) AS alt_text
    FROM v_photos LEFT JOIN part ON p_partkey = listing_id""")
def hero_and_alt(t):
    choices = t.part.select(
        F.col("p_partkey").alias("listing_id"), (F.col("p_size") % 9).alias("hero_index"),
        F.create_map(F.lit("0"), F.concat(F.lit("front of "), "p_name"), F.lit("2"), F.col("p_brand")).alias("alt_texts"))
    photos = t.v_photos.withColumn("alt", F.concat(F.lit("photo "), F.col("width").cast("string")))
    return enrich.hero_and_alt(photos, choices, candidates=6).select("photo_id", "is_hero", "alt_text")


REGION_NAMES = values([(s, n) for s, n, _ in refdata.REGIONS], "slug, name")


@query("reference_tables", f"""
    SELECT r.slug, r.name, count(l.id) AS listings FROM ({REGION_NAMES}) r
    LEFT JOIN (SELECT id, {p.BOX_OF} AS region_slug FROM v_listings) l ON l.region_slug = r.slug GROUP BY ALL""")
def reference_tables(t):
    regions = seed_tables(t.spark)["regions"].select("slug", "name")
    counts = t.v_listings.groupBy(geo.region_by_bbox("lat", "lng").alias("slug")).agg(F.count("*").alias("listings"))
    return regions.join(counts, "slug", "left").fillna(0, ["listings"])
