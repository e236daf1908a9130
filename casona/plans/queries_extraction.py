"""Queries over page and reply extraction.

``v_details`` wraps every crawled page into a detail page with structured data, so what each
operator must find is known from the page number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casona.functions import dom, html, money, text, urls
from casona.operators import entity_resolution as er, extraction as ex
from casona.plans import sqlparts as p
from casona.plans.catalog import query
from casona.plans.warehouse import Warehouse, record_id
from casona.session import shared_folder, small_table, stored
from casona.sources import discovery, rules

PID = "CAST(page_id AS VARCHAR)"


@query("json_ld", "SELECT page_id, CAST(4 AS INTEGER) AS n, 'Organization|BreadcrumbList|Thing,residence|' AS types FROM pages")
def json_ld(t):
    rows = t.v_details.select("page_id", html.extract_json_ld("html").alias("ld"))
    names = F.transform("ld", lambda v: F.array_join(html.entity_types(v), ","))
    return rows.select("page_id", F.size("ld").alias("n"), F.array_join(names, "|").alias("types"))


@query("open_graph", f"""
    SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'Casa & Mar ' || {PID} END AS og_title, CASE WHEN page_id % 4 <> 0 THEN '/img/og' || {PID} || '.jpg?w=800' END AS og_image,
      CAST(1 + (page_id % 3 <> 0)::INT + (page_id % 4 <> 0)::INT AS INTEGER) AS n FROM pages""")
def open_graph(t):
    rows = t.v_details.select("page_id", html.extract_open_graph("html").alias("og"))
    get = lambda k: F.try_element_at("og", F.lit(k))
    return rows.select("page_id", get("og:title").alias("og_title"), get("og:image").alias("og_image"), F.size("og").alias("n"))


@query("main_entity", f"SELECT page_id, 'Casa ' || {PID} AS typed, 'Org' AS fallback FROM pages")
def main_entity(t):
    rows = t.v_details.select("page_id", html.extract_json_ld("html").alias("ld"))
    name = lambda types: html.text_field(html.main_entity("ld", types), "$.name")
    return rows.select("page_id", name(["House", "RESIDENCE"]).alias("typed"), name(["Nothing"]).alias("fallback"))


def payloads(t):
    return ex.assemble_payload(t.v_details.select("source", "url", "html"), rules.rule_table(t.spark))


IDS = f"""CASE page_id % 5 WHEN 0 THEN CAST(1000000 + page_id AS VARCHAR) WHEN 2 THEN CAST(10000000 + page_id AS VARCHAR) WHEN 4 THEN 'proyecto' || {PID} || '.example.com-villas-fase-2' ELSE 'casa-' || {PID} END"""
ORIGIN = "regexp_extract(url, '^(https://[^/]+)', 1)"
A_B = f"{ORIGIN} || '/img/a' || {PID} || '.jpg?w=100 https://cdn.example.com/500x500/b.jpg'"
OG = f"CASE WHEN page_id % 4 <> 0 THEN {ORIGIN} || '/img/og' || {PID} || '.jpg?w=800' END"
PHOTOS = f"""CASE page_id % 5 WHEN 4 THEN concat_ws(' ', {OG}, {A_B}) WHEN 3 THEN concat_ws(' ', {A_B}, {ORIGIN} || '/logo.png', {OG}) ELSE concat_ws(' ', {A_B}, {OG}) END"""
H1 = p.strip(p.decode("regexp_replace(regexp_extract(page_html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"))
TITLE = f"CASE WHEN page_id % 3 <> 0 THEN 'Casa & Mar ' || {PID} ELSE {H1} END"
CRUMBS = "CASE WHEN page_id % 5 IN (0, 3) THEN 'Guanacaste|Santa Cruz|Tamarindo' END"


@query("assemble_payload", f"""
    SELECT source, {IDS} AS source_listing_id, url AS source_url, length(html) AS html_chars, {PHOTOS} AS photos, {CRUMBS} AS breadcrumbs, {TITLE} AS title,
      CASE WHEN page_id % 5 = 0 THEN '+506 8' || CAST(100 + page_id % 900 AS VARCHAR) || '-1234' END AS phone, CASE WHEN page_id % 5 = 0 THEN 'ventas' || {PID} || '@example.com' END AS email,
      CASE WHEN page_id % 5 IN (0, 3) THEN 'Casa en Tamarindo ' || {PID} || ' tel +506 8' || CAST(100 + page_id % 900 AS VARCHAR) || '-1234 ventas' || {PID} || '@example.com' END AS detail_text,
      CASE WHEN page_id % 5 = 4 THEN 'proyecto' || {PID} || '.example.com' END AS site_name
    FROM v_details""")
def assemble_payload(t):
    at = lambda path: F.get_json_object("raw_extracted", path)
    return payloads(t).select(
        "source", "source_listing_id", "source_url", F.length("raw_html").cast("bigint").alias("html_chars"),
        F.array_join(F.transform("photos", lambda x: x["url"]), " ").alias("photos"), F.array_join("breadcrumbs", "|").alias("breadcrumbs"),
        at("$.title").alias("title"), at("$.agent.phone").alias("phone"), at("$.agent.email").alias("email"),
        at("$.detail_text").alias("detail_text"), at("$.site_name").alias("site_name"))


@query("source_coverage_report", f"""
    SELECT source, count(*) AS urls, CAST(sum(length(html)) AS BIGINT) AS html_chars,
      CAST(sum(2 + (page_id % 5 = 3)::INT + (page_id % 4 <> 0)::INT) AS BIGINT) AS photos, CAST(sum(CASE WHEN page_id % 5 IN (0, 3) THEN 3 ELSE 0 END) AS BIGINT) AS breadcrumbs,
      CAST(sum(CASE page_id % 5 WHEN 0 THEN 7 WHEN 3 THEN 6 WHEN 4 THEN 5 ELSE 4 END) AS BIGINT) AS fields, count(*) FILTER (length(html) > 5000) AS usable FROM v_details GROUP BY source""")
def source_coverage_report(t):
    return ex.source_coverage_report(payloads(t))


@query("source_listing_id", f"SELECT page_id, {IDS} AS listing_id FROM pages")
def source_listing_id(t):
    r = rules.rule_table(t.spark).select("source", "id_rule")
    return t.v_details.join(r, "source").select("page_id", urls.source_listing_id("url", "id_rule").alias("listing_id"))


PAGE_TITLE = p.strip(p.decode("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))


@query("title_description", f"SELECT page_id, {TITLE} AS title, 'Desc ' || {PID} AS description FROM v_details")
def title_description(t):
    rows = t.v_details.select("page_id", "html", html.extract_open_graph("html").alias("og"))
    return rows.select("page_id", html.page_title("html", "og").alias("title"), html.page_description("html", "og").alias("description"))


@query("crawled_titles", f"SELECT page_id, {PAGE_TITLE} AS title, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang FROM pages")
def crawled_titles(t):
    rows = t.pages.select("page_id", "html", html.extract_open_graph("html").alias("og"))
    return rows.select("page_id", html.page_title("html", "og").alias("title"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"))


@query("contact", f"""
    SELECT doc_id, nullif(regexp_extract(text, '{ex.PHONE}', 1), '') AS phone, nullif(regexp_extract(text, '{ex.EMAIL}', 1), '') AS email FROM documents""")
def contact(t):
    return t.documents.select("doc_id", ex.extract_contact("text").alias("c")).select("doc_id", "c.*")


def _noise_sql():
    out = "html"
    for tag in ("script", "style", "noscript", "template"):
        out = rf"regexp_replace({out}, '<{tag}\b[^>]*>.*?</{tag}>', '', 'gis')"
    out = f"regexp_replace({out}, '<!--.*?-->', '', 'gs')"
    for tag in ("header", "footer", "nav", "svg"):
        out = rf"regexp_replace({out}, '<{tag}\b[^>]*>.*?</{tag}>', '', 'gis')"
    attrs = r"""\s(style|onclick|onload|onerror|data-[\w-]+|aria-[\w-]+|class)=("[^"]*"|''[^'']*''|[^\s>]+)"""
    return p.strip(p.squeeze(f"regexp_replace({out}, '{attrs}', '', 'gi')"))


@query("strip_noise", f"SELECT page_id, length(h) AS n, md5(h) AS stripped FROM (SELECT page_id, {_noise_sql()} AS h FROM v_details)")
def strip_noise(t):
    rows = t.v_details.select("page_id", text.strip_noise("html").alias("h"))
    return rows.select("page_id", F.length("h").cast("bigint").alias("n"), F.md5("h").alias("stripped"))


@query("truncate_text", r"""
    SELECT doc_id, md5(CASE WHEN length(text) > 1000 THEN substr(text, 1, 1000) || chr(10) || '... [truncated]' ELSE text END) AS cut FROM documents""")
def truncate_text(t):
    return t.documents.select("doc_id", F.md5(text.truncate_text("text", 1000)).alias("cut"))


ARTICLE = p.strip(p.decode("regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<[^>]*>', '', 'g')"))


@query("detail_text", f"SELECT page_id, {ARTICLE} AS detail_text FROM pages")
def detail_text(t):
    return dom.dom_fields(t.pages, ["page_id"]).select("page_id", "detail_text")


HREFS = """
    SELECT * FROM (VALUES (1, '/x?a=1'), (2, '//cdn.example.com/y.jpg'), (3, ' img.png '), (4, '../up.png'), (5, '?p=2'), (6, '#f'), (7, 'HTTPS://z.example.com/q'), (8, '')) AS h(k, href)"""
PO = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"
PP = "regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"
PQ = "regexp_extract(url, '^[^?#]*(\\?[^#]*)', 1)"


@query("absolutize_url", f"""
    SELECT page_id, k, CASE k WHEN 1 THEN {PO} || '/x?a=1' WHEN 2 THEN regexp_extract(url, '^([a-z]+:)', 1) || '//cdn.example.com/y.jpg' WHEN 3 THEN {PO} || regexp_extract({PP}, '^(.*/)', 1) || 'img.png'
      WHEN 4 THEN {PO} || regexp_replace(regexp_extract({PP}, '^(.*/)', 1), '[^/]+/$', '') || 'up.png' WHEN 5 THEN {PO} || {PP} || '?p=2' WHEN 6 THEN {PO} || {PP} || {PQ} || '#f'
      WHEN 7 THEN 'HTTPS://z.example.com/q' ELSE '' END AS url FROM pages, ({HREFS})""")
def absolutize_url(t):
    hrefs = ["/x?a=1", "//cdn.example.com/y.jpg", " img.png ", "../up.png", "?p=2", "#f", "HTTPS://z.example.com/q", ""]
    cases = F.array(*(F.struct(F.lit(i + 1).alias("k"), F.lit(h).alias("href")) for i, h in enumerate(hrefs)))
    rows = t.pages.select("page_id", "url", F.explode(cases).alias("c"))
    return rows.select("page_id", "c.k", urls.absolutize_url("c.href", "url").alias("url"))


HOST = "regexp_extract(url, '^https?://([^/?#]*)', 1)"
LINKS_SQL = f"""
    SELECT source, page, pos, 'https://' || source || href AS url FROM (
      SELECT {HOST} AS source, page_id AS page, CAST(unnest(range(len(h))) AS INTEGER) AS pos, unnest(h) AS href FROM (
        SELECT url, page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS h FROM pages))
    WHERE regexp_matches(href, '^/[a-z]+$') AND href <> '/the'"""


def _search_pages(t):
    pages = t.pages.select(urls.url_host("url").alias("source"), F.col("page_id").alias("page"), "html")
    rule = pages.select("source").distinct().select(
        "source", F.concat(F.lit("https://"), "source").alias("base_url"), F.lit("^/[a-z]+$").alias("href_pattern"),
        F.lit("path").alias("match_on"), F.lit("/the$").alias("exclude_pattern"))
    return pages, rule


@query("page_links", f"SELECT source, page, pos, url FROM ({LINKS_SQL})")
def page_links(t):
    return discovery.page_links(*_search_pages(t))


@query("discover_listing_urls", f"""
    SELECT source, url, CAST(r AS INTEGER) AS rank FROM (SELECT source, url, row_number() OVER (PARTITION BY source ORDER BY first_at, url) AS r FROM (
      SELECT source, url, min((page, pos)) AS first_at FROM ({LINKS_SQL}) GROUP BY 1, 2))""")
def discover_listing_urls(t):
    return discovery.discover_listing_urls(*_search_pages(t))


@query("discover_capped", f"""
    SELECT source, url, CAST(r AS INTEGER) AS rank FROM (SELECT source, url, row_number() OVER (PARTITION BY source ORDER BY first_at, url) AS r FROM (
      SELECT source, url, min((page, pos)) AS first_at FROM ({LINKS_SQL}) GROUP BY 1, 2)) WHERE r <= 7""")
def discover_capped(t):
    return discovery.discover_listing_urls(*_search_pages(t), requested=7)


REST = """
    SELECT o_custkey AS page, 's' || CAST(o_custkey % 14 AS STRING) AS source, '[{{"id": 1, "link": "https://x.example.com/' || CAST(o_orderkey AS STRING)
      || '"}}, {{"title": "no link"}}, {{"link": "https://y.example.com/' || CAST(o_orderkey AS STRING) || '"}}]' AS body FROM {orders}"""


@query("discover_from_rest", """
    SELECT 's' || o_custkey % 14 AS source, o_custkey AS page, CAST(k AS INTEGER) AS pos, CASE k WHEN 0 THEN 'https://x.example.com/' ELSE 'https://y.example.com/' END || o_orderkey AS url
    FROM orders, (VALUES (0), (2)) AS v(k)""")
def discover_from_rest(t):
    return discovery.discover_from_rest(t.sql(REST))


CRAWL = "SELECT l_suppkey AS source, CAST(l_quantity AS INTEGER) AS page, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'u' || CAST(l_partkey % 40 AS STRING) END AS url FROM {lineitem}"


@query("crawl_frontier_stop", f"""
    WITH c AS ({CRAWL.format(lineitem='lineitem')}), p AS (SELECT DISTINCT source, page FROM c), f AS (SELECT source, url, min(page) AS page FROM c WHERE url IS NOT NULL GROUP BY 1, 2),
    n AS (SELECT p.source, p.page, count(f.url) AS new_urls FROM p LEFT JOIN f ON f.source = p.source AND f.page = p.page GROUP BY 1, 2),
    s AS (SELECT *, new_urls = 0 AND lag(new_urls) OVER (PARTITION BY source ORDER BY page) = 0 AS stop FROM n)
    SELECT source, page, new_urls FROM s WHERE page <= coalesce((SELECT min(page) FROM s x WHERE x.source = s.source AND x.stop), 1000000)""")
def crawl_frontier_stop(t):
    return discovery.crawl_frontier_stop(t.sql(CRAWL))


@query("extract_facts", """
    SELECT id, CAST(b AS INTEGER) AS bedrooms, CAST(CASE WHEN full_baths > 0 THEN full_baths + half ELSE NULL END AS DECIMAL(4,1)) AS bathrooms, CAST(nullif(full_baths, 0) AS INTEGER) AS bathrooms_full,
      CASE WHEN half > 0 AND full_baths > 0 THEN CAST(1 AS INTEGER) END AS bathrooms_half, CAST(round(CAST(sqm AS DECIMAL(14,4)) * CASE WHEN unit = 'sqft' THEN 0.092903 ELSE 1.000000 END, 2) AS DECIMAL(14,2)) AS interior_sqm,
      CAST(CASE WHEN lot THEN round(CAST(lot_sqm AS DECIMAL(14,4)), 2) END AS DECIMAL(14,2)) AS lot_sqm, price, CASE WHEN crc THEN 'CRC' ELSE 'USD' END AS price_currency, CASE WHEN es THEN 'es' ELSE 'en' END AS language
    FROM (SELECT id, bedrooms AS b, coalesce(bathrooms_full, 0) AS full_baths, CASE WHEN id % 2 = 0 THEN 0.5 ELSE 0.0 END AS half, 40 + id % 400 AS sqm, CASE WHEN id % 5 = 0 THEN 'sqft' ELSE 'm2' END AS unit,
      lot_sqm, status = 'active' AS lot, price, price_currency = 'CRC' AND price_currency IS NOT NULL AS crc, id % 3 = 0 AS es FROM v_listings)""")
def extract_facts(t):
    c = F.col
    es = c("id") % 3 == 0
    beds = F.when(c("bedrooms").isNotNull(), F.concat("bedrooms", F.when(es, " habitaciones, ").otherwise(" bedrooms, "))).otherwise("")
    half = F.when(c("id") % 2 == 0, ".5").otherwise("")
    baths = F.when(c("bathrooms_full") > 0, F.concat("bathrooms_full", half, F.when(es, " baños, ").otherwise(" baths, "))).otherwise("")
    area = F.concat((40 + c("id") % 400), F.when(c("id") % 5 == 0, " sqft. ").otherwise(" m2. "))
    lot = F.when(c("status") == "active", F.concat("lot_sqm", F.when(es, " m² de terreno. ").otherwise(" m² lot. "))).otherwise("")
    price = F.concat(F.when(c("price_currency") == "CRC", "₡").otherwise("USD "), F.format_number("price", 2))
    intro = F.when(es, "La casa en venta para la familia con ").otherwise("The house for sale with ")
    prose = F.concat(intro, beds, baths, area, lot, price)
    return t.v_listings.select("id", text.extract_facts(prose).alias("f")).select("id", "f.*")


# ---------------------------------------------------------------- replies

REPLY = """
    SELECT o_orderkey AS id, CASE o_orderkey % 9
      WHEN 0 THEN '```json' || chr(10) || j || chr(10) || '```' WHEN 1 THEN 'Here it is: ' || j WHEN 2 THEN j || ' Hope this helps!' WHEN 3 THEN 'no json here'
      WHEN 4 THEN '{{"title": ' WHEN 5 THEN replace(j, '"bedrooms": 3', '"bedrooms": "three"') WHEN 6 THEN replace(j, '"house"', '"castle"')
      WHEN 7 THEN replace(j, '["pool"]', '"pool"') ELSE j END AS text
    FROM (SELECT o_orderkey, '{{"title": "Casa ' || CAST(o_orderkey AS STRING) || '", "property_type": "house", "language": "en", "price": ' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING)
      || ', "price_currency": "USD", "bedrooms": 3, "bathrooms": 2.5, "year_built": 1999.0, "features": ["pool"], "pool_yn": true, "lat": null, "extra_data": {{"septic": 5}}, "notes": 7}}' AS j0,
      '{{"title": "Casa ' || CAST(o_orderkey AS STRING) || '", "property_type": "house", "language": "en", "price": ' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING)
      || ', "price_currency": "USD", "bedrooms": 3, "bathrooms": 2.5, "year_built": 1999.0, "features": ["pool"], "pool_yn": true, "lat": null, "extra_data": {{"septic": 5}}}}' AS j FROM {orders})"""


@query("parse_tolerant_json", """
    SELECT o_orderkey AS id, ok AS parsed, CASE WHEN ok THEN 'Casa ' || o_orderkey END AS title, CASE WHEN ok THEN CAST(o_totalprice AS DECIMAL(14,2)) END AS price,
      CASE WHEN ok THEN 'USD' END AS currency, CASE WHEN ok THEN 5 END AS septic FROM (SELECT *, o_orderkey % 9 NOT IN (2, 3, 4) AS ok FROM orders)""")
def parse_tolerant_json(t):
    at = lambda path, kind: F.try_variant_get("v", path, kind)
    return t.sql(REPLY).select("id", ex.parse_tolerant_json("text").alias("v")).select(
        "id", F.col("v").isNotNull().alias("parsed"), at("$.title", "string").alias("title"), at("$.price", "decimal(14,2)").alias("price"),
        at("$.price_currency", "string").alias("currency"), at("$.extra_data.septic", "int").alias("septic"))


@query("validate_extracted", """
    SELECT o_orderkey AS id, o_orderkey % 9 IN (0, 1, 7, 8) AS valid, CASE WHEN o_orderkey % 9 NOT IN (2, 3, 4) THEN 'Casa ' || o_orderkey END AS title,
      CASE WHEN o_orderkey % 9 NOT IN (2, 3, 4) THEN CAST(o_totalprice AS DECIMAL(14,2)) END AS price, CASE WHEN o_orderkey % 9 NOT IN (2, 3, 4) THEN CAST(2.5 AS DECIMAL(4,1)) END AS bathrooms,
      CASE WHEN o_orderkey % 9 NOT IN (2, 3, 4) THEN 1999 END AS year_built, CASE WHEN o_orderkey % 9 NOT IN (2, 3, 4, 7) THEN 'pool' ELSE '' END AS features,
      CASE WHEN o_orderkey % 9 NOT IN (2, 3, 4) THEN '{"septic":5}' ELSE '{}' END AS extra_data FROM orders""")
def validate_extracted(t):
    rows = t.sql(REPLY).select("id", ex.parse_tolerant_json("text").alias("reply"))
    out = ex.validate_extracted(rows)
    return out.select("id", "valid", "title", "price", "bathrooms", "year_built", F.array_join("features", "|").alias("features"), "extra_data")


@query("breadcrumb_fallback", """
    SELECT id, coalesce(province, CASE WHEN id % 3 > 0 THEN 'Prov ' || id % 7 END) AS province, coalesce(canton, CASE WHEN id % 3 = 2 THEN 'Cant' END) AS canton,
      CASE WHEN id % 3 = 2 THEN 'Dist' END AS district, coalesce(nullif(locality, ''), locality) AS locality FROM v_listings""")
def breadcrumb_fallback(t):
    names = F.when(F.col("id") % 3 == 2, F.array(
        F.lit("Home"), F.concat(F.lit("Prov "), F.col("id") % 7), F.lit(" Costa Rica "), F.lit("Cant"), F.lit(""), F.lit("Dist"))).when(
        F.col("id") % 3 == 1, F.array(F.concat(F.lit("Prov "), F.col("id") % 7)))
    return ex.breadcrumb_fallback(t.v_listings.withColumn("breadcrumbs", names)).select("id", "province", "canton", "district", "locality")


@query("title_backstop", f"""
    SELECT id, CASE WHEN {p.strip("coalesce(title, '')")} <> '' AND id % 3 <> 0 THEN title WHEN id % 2 = 0 THEN 'Page ' || id ELSE 'OG ' || id END AS title FROM v_listings""")
def title_backstop(t):
    c = F.col("id")
    raw = F.when(c % 2 == 0, F.concat(F.lit('{"title": " Page '), c, F.lit('", "og": {"og:title": "no"}}'))).otherwise(
        F.concat(F.lit('{"title": "  ", "og": {"og:title": "OG '), c, F.lit('"}}')))
    rows = t.v_listings.select("id", F.when(c % 3 == 0, "  ").otherwise(F.col("title")).alias("title"), raw.alias("raw_extracted"))
    return ex.title_backstop(rows).select("id", "title")


RAW = """
    SELECT id, '{{"' || CASE WHEN id % 2 = 0 THEN 'name' ELSE 'title' END || '": "Casa ' || CAST(id AS STRING) || '", "description": " ", "offers": {{"price": "' || CAST(price AS STRING)
      || '", "priceCurrency": "' || coalesce(price_currency, 'GBP') || '"}}, "numberOfRooms": 3, "bathrooms": "' || CAST(bathrooms AS STRING) || '", "floorSize": "n/a", "lotSize": ' || CAST(lot_sqm AS STRING)
      || ', "address": {{"addressLocality": "Nosara", "streetAddress": "Calle 1"}}, "geo": {{"latitude": 9.5, "longitude": "-84.25"}}}}' AS raw_extracted
    FROM {v_listings}"""


@query("salvage_record", """
    SELECT id, 'Casa ' || id AS title, CAST(NULL AS VARCHAR) AS description, 'unknown' AS language, price, CASE WHEN price_currency IN ('USD', 'CRC') THEN price_currency END AS price_currency,
      CAST(3 AS DECIMAL(4,1)) AS bedrooms, CAST(bathrooms AS DECIMAL(4,1)) AS bathrooms, CAST(NULL AS DECIMAL(10,2)) AS interior_sqm, CAST(lot_sqm AS DECIMAL(12,2)) AS lot_sqm,
      CASE WHEN id % 4 = 0 THEN 'Guanacaste' END AS province, CASE WHEN id % 4 = 0 THEN 'Playa' ELSE 'Nosara' END AS locality, 'Calle 1' AS address_line, CAST(9.5 AS DECIMAL(9,6)) AS lat, CAST(-84.25 AS DECIMAL(9,6)) AS lng,
      'salvaged from raw_extracted after AI parse failure' AS notes FROM v_listings""")
def salvage_record(t):
    crumbs = F.when(F.col("id") % 4 == 0, F.array(*map(F.lit, ("Home", "Guanacaste", "Santa Cruz", "Cabo Velas", "Playa"))))
    out = ex.salvage_record(t.sql(RAW).withColumn("breadcrumbs", crumbs))
    return out.select(
        "id", "title", "description", "language", "price", "price_currency", "bedrooms", "bathrooms", "interior_sqm", "lot_sqm", "province",
        "locality", "address_line", "lat", "lng", "notes")


@query("apply_extraction", f"""
    SELECT {IDS} AS source_listing_id, CASE WHEN length(html) % 2 = 0 THEN 'Reply ' || url ELSE {TITLE} END AS title, CASE WHEN length(html) % 2 = 0 THEN CAST(99000.5 AS DECIMAL(14,2)) END AS price,
      CASE WHEN page_id % 5 IN (0, 3) THEN 'Guanacaste' END AS province, length(html) % 2 = 1 AS salvaged FROM v_details""")
def apply_extraction(t):
    rows = payloads(t)
    even = F.length("raw_html") % 2 == 0
    reply = F.concat(F.lit('{"title": "Reply '), "source_url", F.lit('", "price": 99000.5}'))
    stored = rows.select(
        ex.prompt_key("raw_html", "raw_extracted", "breadcrumbs", "source_url").alias("prompt_key"), F.when(even, reply).otherwise("sorry").alias("reply"))
    return ex.apply_extraction(rows, stored).select("source_listing_id", "title", "price", "province", "salvaged")


@query("run_stages", f"""
    SELECT {IDS} AS source_listing_id, CASE WHEN page_id % 5 IN (0, 3) THEN 'guanacaste' END AS region_slug, 'create' AS action,
      'pending_review' AS status FROM v_details""")
def run_stages(t):
    from casona.functions import money
    from casona.plans import ingest

    none = small_table(t.spark, [], "prompt_key string, reply string")
    copy = t.part.select(F.col("p_partkey").cast("string").alias("id"), *(F.lit(None).cast("string").alias(c) for c in (
        "title_en", "title_es", "description_en", "description_es", "rewritten_en", "rewritten_es")))
    tags = t.part.select(F.col("p_partkey").cast("string").alias("id"), F.array(F.lit("pool")).alias("features"), F.array(F.lit("eco")).alias("tags"))
    out = ingest.run_stages(payloads(t), responses=none, rates=money.rate_table(t.spark), copy=copy, tags=tags)
    return out.select("source_listing_id", "region_slug", "action", "status")


FOUND = ["title", "price_usd", "bedrooms", "bathrooms", "lot_sqm", "interior_sqm", "locality", "canton", "property_type", "mls_id", "listing_agent_name", "address_line", "lat", "lng"]


def _same_address(new, canonical):
    """Pairs of records and published listings at one address, by the listing's id."""
    side = lambda df, x, key: df.withColumn("title", F.col("title_en") if "title_en" in df.columns else F.col("title")).select(
        F.col("id").alias(key), F.col("address_line").alias(f"_{x}"), *(F.col(c).alias(f"{x}_{c}") for c in FOUND))
    pairs = side(new, "a", "query_id").join(side(canonical, "b", "base_id"), F.col("_a") == F.col("_b"))
    return pairs.withColumn("rank", F.lit(1))


SIZE = "length(page_html)"
RECORD_SQL = f"""sha256('["' || source || '","' || {IDS} || '"]')"""


@query("joined_run", f"""
    WITH d AS (SELECT page_id, {RECORD_SQL} AS rid, {IDS} AS source_listing_id, source, CASE WHEN {SIZE} % 3 <> 0 THEN 1 ELSE 2 END AS run, page_id % 15 = 7 AS broken,
      page_id % 4 = 1 AND page_id % 15 <> 7 AS twin, page_id % 5 IN (0, 3) AS placed FROM v_details),
    g AS (SELECT page_id // 8 AS k, placed, arg_min(rid, (run, rid)) AS head FROM d WHERE twin GROUP BY 1, 2),
    x AS (SELECT d.*, g.head, CASE WHEN broken THEN 'create' WHEN page_id % 8 = 0 THEN 'merge' WHEN page_id % 8 = 4 THEN 'review' WHEN twin AND head <> rid THEN 'merge' ELSE 'create' END AS action
      FROM d LEFT JOIN g ON d.twin AND g.k = d.page_id // 8 AND g.placed = d.placed)
    SELECT source, source_listing_id, 'done' AS publish_status, CAST(run AS VARCHAR) AS run_id, action,
      CASE WHEN broken THEN 'no_match' WHEN page_id % 4 = 0 THEN 'embedding' WHEN action = 'merge' THEN 'same_text' ELSE 'no_match' END AS method,
      CAST(CASE WHEN broken THEN 0 WHEN page_id % 8 = 0 THEN 1 WHEN page_id % 8 = 4 THEN 0.75 WHEN action = 'merge' THEN 1 ELSE 0 END AS DECIMAL(3,2)) AS confidence,
      CASE WHEN action = 'merge' AND page_id % 8 = 0 THEN 'old-' || page_id WHEN action = 'merge' THEN sha256(head) ELSE sha256(rid) END AS canonical_id,
      CASE WHEN action = 'review' OR broken THEN 'pending_review' ELSE 'active' END AS status,
      CASE WHEN broken THEN NULL WHEN page_id % 4 = 1 THEN 'Twin ' || (page_id // 8) ELSE 'Casa ' || page_id END AS title
    FROM x""")
def joined_run(t):
    """All stages over two runs: replies that hit, miss and break; merges, reviews, twins; the second run takes up what failed."""
    size, page = F.length("page_html"), F.col("page_id")
    details = t.v_details
    rows = ex.assemble_payload(details.select("source", "url", "html"), rules.rule_table(t.spark)).withColumn("scraped_at", F.lit("2024-06-01").cast("timestamp"))
    rows = stored(rows, "payloads")  # read by the replies and by the run
    pages = details.select(page, F.col("url").alias("source_url"), size.alias("size"))
    title = F.when(page % 4 == 1, F.concat(F.lit("Twin "), F.floor(page / 8))).otherwise(F.concat(F.lit("Casa "), page))
    reply = F.to_json(F.struct(
        title.alias("title"), F.lit("en").alias("language"), F.lit(250000).alias("price"), F.lit("USD").alias("price_currency"), F.lit(3).alias("bedrooms"), F.lit(1000).alias("lot_sqm"),
        F.concat(F.lit("Calle "), page).alias("address_line"), F.lit("Nosara").alias("locality"), F.lit("house").alias("property_type"),
        F.lit("Ann").alias("listing_agent_name"), F.when(page % 8 == 0, F.concat(F.lit("M"), page)).alias("mls_id")))
    replies = rows.join(pages, "source_url").select(
        ex.prompt_key("raw_html", "raw_extracted", "breadcrumbs", "source_url").alias("prompt_key"), F.when(page % 15 == 7, "sorry").otherwise(reply).alias("reply"), "size")
    replies = stored(replies, "replies")
    old = details.filter(page % 4 == 0).select(
        F.concat(F.lit("old-"), page).alias("id"), F.concat(F.lit("Kept "), page).alias("title_en"), F.lit("active").alias("status"), F.lit(250000).cast("decimal(14,2)").alias("price_usd"),
        F.lit(3).cast("decimal(4,1)").alias("bedrooms"), F.lit(1000).cast("decimal(12,2)").alias("lot_sqm"), F.concat(F.lit("Calle "), page).alias("address_line"), F.lit("Nosara").alias("locality"),
        F.lit("house").alias("property_type"), F.lit("Ann").alias("listing_agent_name"), F.concat(F.lit("M"), page).alias("mls_id"))
    none = lambda ddl: small_table(t.spark, [], ddl)
    copy = none("id string, title_en string, title_es string, description_en string, description_es string, rewritten_en string, rewritten_es string")
    tags = details.select(F.sha2(F.lit("nothing"), 256).alias("id"), F.array(F.lit("pool")).alias("features"), F.array(F.lit("eco")).alias("tags")).limit(0)
    house = Warehouse(
        t.spark, f"{shared_folder(t.spark)}/warehouse-{uuid.uuid4().hex}", rates=money.rate_table(t.spark), finder=_same_address,
        judge=lambda pairs: er.score_pairs(er.pair_features(pairs)), buckets=8)
    house.canonical.insert("start", old)
    at = F.lit("2024-06-01").cast("timestamp")
    house.run(1, at, rows, responses=replies.filter("size % 3 <> 0"), copy=copy, tags=tags)
    house.run(2, at, responses=replies, copy=copy, tags=tags, stages=("extract", "normalize", "dedupe"))
    house.run(3, at, copy=copy, tags=tags, stages=("enrich", "publish"))
    house.run(1, at, rows.limit(0), responses=replies.limit(0), copy=copy, tags=tags)  # a run that is there already
    links = house.links.read().select("raw_id", "canonical_id", "action", "method", "confidence", F.when(F.col("run_id") == "1", "1").otherwise("2").alias("run_id"))
    listings = house.canonical.read().select(F.col("id").alias("canonical_id"), "status", F.col("title_en").alias("title"))
    return house.raw.read().select("source", "source_listing_id", "publish_status", record_id().alias("raw_id")).join(links, "raw_id", "left").join(
        listings, "canonical_id", "left").drop("raw_id")
