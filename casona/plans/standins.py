"""Listing-shaped views over the benchmark tables, for the registered queries.

The tables hold no listings, so each view derives them from whole tables with plain arithmetic.
The SQL is shared by Spark and DuckDB, hence only functions both have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LISTINGS = """
SELECT
  o_orderkey AS id,
  CAST(o_custkey % 14 AS INTEGER) AS source_id,
  'L-' || CAST(o_orderkey AS STRING) AS source_listing_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'CRC' WHEN o_orderkey % 7 = 0 THEN NULL
       WHEN o_orderkey % 31 = 0 THEN 'EUR' ELSE 'USD' END AS price_currency,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) * 540
            WHEN o_orderkey % 9 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) * 5
            ELSE CAST(o_totalprice AS DECIMAL(14,2)) END AS DECIMAL(14,2)) AS price,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 54000 + o_orderkey % 900 * 540 END AS DECIMAL(14,2)) AS hoa_fee,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey * 37 % 2900 AS DOUBLE) / 1000 + 8.3e0 END AS lat,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey * 53 % 3500 AS DOUBLE) / 1000 - 86.0e0 END AS lng,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 6 END AS INTEGER) AS bedrooms,
  CAST(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 4 END AS INTEGER) AS bathrooms_full,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 2 END AS INTEGER) AS bathrooms_half,
  CAST(o_orderkey % 4 + 1 AS INTEGER) AS bathrooms,
  CAST(CASE WHEN o_orderkey % 17 = 0 THEN 0 WHEN o_orderkey % 19 = 0 THEN NULL ELSE 40 + o_orderkey % 400 END AS INTEGER) AS interior_sqm,
  CAST(200 + o_custkey * 7 % 5000 AS INTEGER) AS lot_sqm,
  CASE o_orderkey % 7 WHEN 0 THEN 'house' WHEN 1 THEN 'condo' WHEN 2 THEN 'lot' WHEN 3 THEN 'farm'
       WHEN 4 THEN 'commercial' WHEN 5 THEN 'hotel' ELSE 'other' END AS property_type,
  CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'pending_review' ELSE 'sold' END AS status,
  CASE o_custkey % 12 WHEN 0 THEN 'Nosara' WHEN 1 THEN 'Tamarindo, Guanacaste' WHEN 2 THEN ' Jacó' WHEN 3 THEN 'Puerto Viejo'
       WHEN 4 THEN 'San José' WHEN 5 THEN 'Atlantis' WHEN 6 THEN 'Playa Hermosa, Jaco' WHEN 7 THEN 'Sámara'
       WHEN 8 THEN '' WHEN 9 THEN 'Uvita de Osa' WHEN 10 THEN 'Escazú' END AS locality,
  CASE o_custkey % 5 WHEN 0 THEN 'Santa Cruz' WHEN 1 THEN 'Garabito' WHEN 2 THEN 'Talamanca' END AS canton,
  CAST(NULL AS STRING) AS district,
  CASE o_custkey % 3 WHEN 0 THEN 'Limón' WHEN 1 THEN 'Puntarenas' END AS province,
  CASE WHEN o_custkey % 8 = 0 THEN 'Calle ' || CAST(o_custkey % 40 AS STRING) END AS address_line,
  CASE WHEN o_orderkey % 6 = 0 THEN 'MLS' || CAST(o_custkey AS STRING) END AS mls_id,
  'Agent ' || CAST(o_custkey % 50 AS STRING) AS listing_agent_name,
  CASE o_orderkey % 10
       WHEN 0 THEN 'Ocean View Villa ' || CAST(o_orderkey AS STRING) || ' - RPM Real Estate, Costa Rica'
       WHEN 1 THEN 'Houses in Lindora | For Sale | Casa ' || CAST(o_orderkey AS STRING) || ' - $329,000'
       WHEN 2 THEN 'Beach &amp; Jungle Lot #' || CAST(o_orderkey AS STRING) || ' &#8211; Nosara | Costa Rica'
       WHEN 3 THEN 'For Sale - Finca San Juan ' || CAST(o_orderkey AS STRING) || ' - Tamarindo, Costa Rica'
       WHEN 4 THEN '  Casa   Ñandú ' || CAST(o_orderkey AS STRING) || ' : 3'
       WHEN 5 THEN 'Condo ' || CAST(o_orderkey AS STRING) || ' in Costa Rica - USD 350,000 - reduced'
       WHEN 6 THEN 'A' WHEN 7 THEN NULL
       WHEN 8 THEN 'Hotel &quot;El Sue&#241;o&quot; ' || CAST(o_orderkey AS STRING) || ' · Encuentra24 Casas'
       ELSE 'Lote ' || CAST(o_orderkey AS STRING) || ' & río, 100% plano | Coldwell Banker | Costa Rica' END AS title,
  CASE WHEN o_orderkey % 10 = 7 THEN NULL ELSE o_orderpriority || ' house near the beach, lot ' || CAST(o_orderkey AS STRING) END AS description,
  CASE WHEN o_orderkey % 3 = 0 THEN 'en' WHEN o_orderkey % 3 = 1 THEN 'es' ELSE 'unknown' END AS language,
  CASE WHEN o_orderkey % 8 = 0 THEN split('pool,beachfront,pool,granite', ',') WHEN o_orderkey % 8 = 1 THEN split('ocean_view,walk_to_beach', ',')
       WHEN o_orderkey % 8 = 2 THEN split('garage,4x4_required', ',') WHEN o_orderkey % 8 = 3 THEN NULL ELSE split('hoa', ',') END AS features,
  CASE WHEN o_orderkey % 9 = 0 THEN split('luxury,beachfront,shiny', ',') WHEN o_orderkey % 9 = 1 THEN split('eco', ',') END AS tags_ai,
  CASE WHEN o_orderkey % 12 = 0 THEN split('gated,eco', ',') END AS tags_human,
  CAST(o_orderdate AS TIMESTAMP) AS last_seen_at,
  CAST(o_orderdate AS TIMESTAMP) + INTERVAL '3' DAY AS updated_at,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL '5' DAY
       ELSE CAST(o_orderdate AS TIMESTAMP) END AS wp_synced_at,
  CAST(CASE WHEN o_orderkey % 3 <> 0 THEN 10000 + o_orderkey END AS INTEGER) AS wp_post_id,
  CAST(CASE WHEN o_orderkey % 16 = 0 THEN 2 WHEN o_orderkey % 15 = 0 THEN 0 END AS INTEGER) AS parking_spaces,
  o_custkey AS customer_key
FROM {orders}
"""

PHOTOS = """
SELECT l_orderkey AS listing_id,
 (((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS photo_id,
 l_linenumber - 1 AS position,
 'https://img.example.com/' || CASE l_partkey % 9 WHEN 0 THEN 'logo/' WHEN 1 THEN 'icon/' ELSE 'p/' END
   || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || CASE WHEN l_partkey % 4 = 0 THEN '-525x328' ELSE '' END
   || CASE WHEN l_partkey % 13 = 0 THEN '.svg' ELSE '.jpg' END AS url,
 CASE WHEN l_partkey % 3 = 0 THEN 'https://cdn.example.com/' || CAST(l_partkey AS STRING) || '.webp' END AS url_cached,
 CAST(200 + l_partkey % 1800 AS INTEGER) AS width,
 CAST(CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE 150 + l_suppkey % 1200 END AS INTEGER) AS height,
 l_linenumber = 2 AS is_hero,
 l_returnflag = 'R' AS is_rejected,
 CASE WHEN l_partkey % 5 = 0 THEN 'ph' || CAST(l_partkey % 400 AS STRING) END AS phash,
 CAST(l_extendedprice AS DECIMAL(14,2)) AS amount,
 CAST(l_shipdate AS TIMESTAMP) AS seen_at
FROM {lineitem}
"""

STAGES = """
SELECT event_id AS id, CAST(user_id % 14 AS INTEGER) AS source_id,
 CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 41 = 0 THEN 'running' ELSE 'done' END AS extract_status,
 CASE WHEN event_id % 10 = 0 THEN 'pending' WHEN event_id % 17 = 0 THEN 'failed' ELSE 'done' END AS normalize_status,
 CASE WHEN event_id % 10 = 0 OR event_id % 17 = 0 THEN 'pending' ELSE 'done' END AS dedupe_status,
 CASE WHEN event_id % 10 = 0 OR event_id % 17 = 0 THEN 'pending' WHEN event_id % 23 = 0 THEN 'failed' ELSE 'done' END AS enrich_status,
 CASE WHEN event_id % 10 = 0 OR event_id % 17 = 0 OR event_id % 23 = 0 THEN 'pending'
      WHEN event_id % 37 = 0 THEN 'skipped' ELSE 'done' END AS publish_status,
 CASE WHEN event_id % 10 = 0 THEN 'fetch broke' END AS error
FROM {events}
"""

LOGS = """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id AS run_id, CAST(user_id % 14 AS INTEGER) AS source_id,
 CASE event_type WHEN 'view' THEN 'fetch' WHEN 'click' THEN 'extract' WHEN 'signup' THEN 'normalize'
      WHEN 'purchase' THEN 'publish' ELSE 'cleanup' END AS stage,
 CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 12 = 0 THEN 'warn' ELSE 'info' END AS level,
 CASE WHEN event_id % 29 = 0 THEN 503 WHEN event_type = 'error' THEN 404 ELSE 200 END AS http_status,
 CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'new' WHEN 'signup' THEN 'updated' WHEN 'error' THEN 'failed' ELSE 'other' END AS kind,
 CASE WHEN event_id % 3 = 0 THEN 'sonnet' ELSE 'haiku' END AS model,
 event_id * 7 % 5000 AS input_tokens, event_id * 3 % 700 AS output_tokens
FROM {events}
"""

SOURCES = """
SELECT CAST(c_custkey AS INTEGER) AS id, 'source-' || CAST(c_custkey AS STRING) AS slug, c_name AS name,
 CASE WHEN c_nationkey = 3 THEN '' ELSE 'https://s' || CAST(c_custkey AS STRING) || '.example.com' END AS base_url, c_acctbal > 0 AS enabled
FROM {customer}
"""

CONFIGS = """
SELECT CAST(s_suppkey AS INTEGER) AS source_id, s_acctbal > 2000 AS enabled, '0 2 * * *' AS cron_expression,
 CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN split('guanacaste,nicoya', ',') ELSE split('caribbean', ',') END AS regions,
 CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '{{"max_pages": 5, "pagination_param": "p"}}'
      ELSE '{{"start_urls": ["https://a.example.com/x", "https://b.example.com/y"], "listing_url_regex": "/property/"}}' END AS metadata,
 CAST(NULL AS TIMESTAMP) AS last_run_at
FROM {supplier}
"""

RUNS = """
SELECT o_orderkey AS id, CAST(o_custkey % 14 AS INTEGER) AS source_id,
 CASE o_orderstatus WHEN 'O' THEN 'succeeded' WHEN 'F' THEN 'failed' ELSE 'running' END AS status,
 CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' HOUR AS started_at,
 CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL '2' HOUR
      ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL '3700700' MILLISECOND + INTERVAL '1' MINUTE END AS ended_at
FROM {orders}
"""

AGENTS = """
SELECT c_custkey AS id, lower(replace(c_name, '#', '.')) || '@example.com' AS email, c_name AS name,
 c_acctbal > 0 AS enabled
FROM {customer}
"""

LINKS = """
SELECT (((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS link_id,
 l_orderkey AS raw_id, l_partkey AS candidate_id, l_partkey AS canonical_id,
 CAST(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 100 AS DOUBLE) / 100 AS DECIMAL(3,2)) AS confidence,
 CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS TIMESTAMP) END AS reviewed_at,
 CASE l_linenumber WHEN 1 THEN 'exact_id' WHEN 2 THEN 'address_price' ELSE 'embedding' END AS method,
 CAST(NULL AS BIGINT) AS reviewed_by
FROM {lineitem}
"""

# Pages with structured data added around the crawled page: one detail page per row of ``pages``.
DETAIL_PAGES = """
SELECT page_id, page_id % 5 AS kind,
 CASE page_id % 5 WHEN 0 THEN 'encuentra24' WHEN 1 THEN 'mlscr' WHEN 2 THEN 'point2homes-cr' WHEN 3 THEN 're-cr' ELSE 'developers-generic' END AS source,
 CASE page_id % 5
  WHEN 0 THEN 'https://www.encuentra24.com/costa-rica-en/real-estate-for-sale-houses-homes/casa/' || CAST(1000000 + page_id AS STRING)
  WHEN 1 THEN 'https://www.mls.cr/properties/casa-' || CAST(page_id AS STRING) || '.html'
  WHEN 2 THEN 'https://www.point2homes.com/CR/Homes-For-Sale/tamarindo/casa/' || CAST(10000000 + page_id AS STRING) || '.html'
  WHEN 3 THEN 'https://www.re.cr/property/casa-' || CAST(page_id AS STRING) || '/'
  ELSE 'https://proyecto' || CAST(page_id AS STRING) || '.example.com/villas/fase-2/' END AS url,
 '<html><head>'
 || CASE WHEN page_id % 3 = 0 THEN '' ELSE '<meta property="og:title" content="first"/><meta content="Casa &amp; Mar ' || CAST(page_id AS STRING) || '" property="og:title"/>' END
 || '<meta name="description" content="Desc ' || CAST(page_id AS STRING) || '"><meta name="twitter:card" content="summary">'
 || CASE WHEN page_id % 4 = 0 THEN '' ELSE '<meta property="og:image" content="/img/og' || CAST(page_id AS STRING) || '.jpg?w=800">' END
 || '<script type="application/ld+json">not json</script>'
 || '<script type="application/ld+json">[{{"@type":"Organization","name":"Org"}},{{"@type":["BreadcrumbList"],"itemListElement":[{{"name":"Home"}},{{"item":{{"name":"Guanacaste"}}}},{{"name":"Santa Cruz"}},"Tamarindo"]}}]</script>'
 || '<script type="application/ld+json">{{"@context":"https://schema.org","@graph":[{{"@type":["Thing","residence"],"name":"Casa ' || CAST(page_id AS STRING)
 || '","sku":"SKU' || CAST(page_id AS STRING) || '","image":["/img/a' || CAST(page_id AS STRING) || '.jpg?w=100",{{"url":"https://cdn.example.com/500x500/b.jpg"}}]}}]}}</script>'
 || '</head><body><div class="photo-gallery"><img src="/img/a' || CAST(page_id AS STRING) || '.jpg?w=900"><img data-src="//cdn.example.com/w_640/b.jpg"><img src="/logo.png"></div>'
 || '<main class="listing-detail"><p>Casa en Tamarindo ' || CAST(page_id AS STRING) || ' tel +506 8' || CAST(100 + page_id % 900 AS STRING) || '-1234 ventas' || CAST(page_id AS STRING) || '@example.com </p></main>'
 || html || '</body></html>' AS html,
 html AS page_html
FROM {pages}
"""


VIEWS = {
    "v_listings": LISTINGS, "v_photos": PHOTOS, "v_stages": STAGES, "v_logs": LOGS, "v_sources": SOURCES,
    "v_configs": CONFIGS, "v_runs": RUNS, "v_agents": AGENTS, "v_links": LINKS, "v_details": DETAIL_PAGES,
}

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


class Tables:
    """The parquet tables of one folder, and the stand-in views over them, as attributes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name in ALL_TABLES:
            return self.spark.read.parquet(f"{self.root}/{name}.parquet")
        if name in VIEWS:
            return self.sql(VIEWS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """Spark SQL whose {table} names are the parquet tables or stand-in views."""
        names = [n for n in (*ALL_TABLES, *VIEWS) if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def duck(sql: str) -> str:
    """The same view as DuckDB text over tables of the plain names."""
    return sql.format(**{n: n for n in (*ALL_TABLES, *VIEWS)})
