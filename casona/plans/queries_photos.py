"""Queries over photos."""

from __future__ import annotations

from pyspark.sql import functions as F

from casona import refdata
from casona.functions import urls
from casona.operators import photos as ph
from casona.plans import sqlparts as p
from casona.plans.catalog import query

RULES_SQL = " ".join(
    f"WHEN regexp_matches({'lower(url)' if subject == 'url' else 'f'}, {p.lit(pattern)}) THEN {p.lit(why)}"
    for subject, pattern, why in refdata.PHOTO_RULES)
REASON_SQL = f"""CASE {RULES_SQL} WHEN width IS NULL OR height IS NULL THEN NULL WHEN width < 300 OR height < 200 THEN 'tiny'
    WHEN CAST(width AS DOUBLE) / height < 0.4e0 OR CAST(width AS DOUBLE) / height > 4 THEN 'unusual_aspect_ratio' END"""
THUMB = r"regexp_replace(url, '-(\d+)x(\d+)(\.[a-z]+)(\?[^\"'']*)?$', '\3\4', 'i')"
FILE = r"regexp_extract(regexp_replace(lower(url), '\?.*$', ''), '([^/]*)$', 1)"
CLASSIFIED = f"SELECT * EXCLUDE (f), {REASON_SQL} AS reject_reason FROM (SELECT *, {FILE} AS f FROM (SELECT * REPLACE ({THUMB} AS url) FROM v_photos))"

MORE_URLS = """
    SELECT l_orderkey AS listing_id, l_partkey AS photo_id, CAST(400 + l_partkey % 1800 AS INTEGER) AS width, CAST(150 + l_suppkey % 1200 AS INTEGER) AS height,
      CASE l_partkey % 12 WHEN 0 THEN 'https://x.com/site_logo.png' WHEN 1 THEN 'https://x.com/Google-Play.png' WHEN 2 THEN 'https://x.com/mls-cr.PNG?x=1'
        WHEN 3 THEN 'https://x.com/wp-content/uploads/2024/05/hero-1.jpg' WHEN 4 THEN 'https://x.com/cb-logo1.jpg' WHEN 5 THEN 'https://x.com/a/encuentra24_badge.jpg'
        WHEN 6 THEN 'https://x.com/img.gif?v=2' WHEN 7 THEN 'https://mls.cr-brand.png/x' WHEN 8 THEN 'https://x.com/favicon.jpg' WHEN 9 THEN 'https://x.com/verified%badge.jpg'
        WHEN 10 THEN 'https://x.com/coldwell/big-logo1.jpg' ELSE 'https://x.com/casa-1024x768.jpg?fit=1' END AS url
    FROM {lineitem}"""


@query("classify_photo", f"""
    SELECT photo_id, listing_id, width, height, url, {REASON_SQL} AS reject_reason FROM (SELECT *, {FILE} AS f FROM ({MORE_URLS.format(lineitem='lineitem')}))""")
def classify_photo(t):
    return t.sql(MORE_URLS).withColumn("reject_reason", ph.classify_photo("url", "width", "height"))


@query("classify_and_rewrite", f"SELECT photo_id, url, reject_reason FROM ({CLASSIFIED})")
def classify_and_rewrite(t):
    return ph.classify_and_rewrite(t.v_photos).select("photo_id", "url", "reject_reason")


@query("photo_key", r"""
    SELECT listing_id, photo_id, regexp_replace(regexp_replace(lower(regexp_extract(u, '^([a-z]+://[^/]*)', 1)) || regexp_extract(u, '^[a-z]+://[^/?]*([^?]*)', 1),
        '/\d{2,4}x\d{2,4}/', '/', 'g'), '/(w|h|q|c)_[^/]+/', '/', 'g')
      || CASE WHEN photo_id % 3 = 0 THEN '?id=' || photo_id % 7 ELSE '' END AS picture
    FROM (SELECT listing_id, photo_id, 'https://CDN.example.com/500x500/w_' || photo_id % 9 || '/p' || photo_id % 50 || '.jpg' AS u FROM v_photos)""")
def photo_key(t):
    pid = F.col("photo_id")
    url = F.concat(
        F.lit("https://CDN.example.com/500x500/w_"), pid % 9, F.lit("/p"), pid % 50, F.lit(".jpg?w="), pid % 900,
        F.when(pid % 3 == 0, F.concat(F.lit("&id="), pid % 7)).otherwise(F.lit("&Quality=80")))
    return t.v_photos.select("listing_id", "photo_id", urls.photo_key(url).alias("picture"))


@query("dedupe_photo_urls", """
    SELECT photo_id, 'https://a.com/' || photo_id % 50 || '.jpg?w=1 https://a.com/x.jpg' || CASE WHEN photo_id % 50 = 7 THEN '' ELSE ' https://a.com/7.jpg' END AS kept FROM v_photos""")
def dedupe_photo_urls(t):
    pid = F.col("photo_id")
    variants = F.array(
        F.concat(F.lit("https://a.com/"), pid % 50, F.lit(".jpg?w=1")), F.lit(""), F.lit("https://a.com/x.jpg"),
        F.concat(F.lit("https://a.com/"), pid % 50, F.lit(".jpg?H=2")), F.lit(None).cast("string"), F.lit("https://a.com/7.jpg"),
        F.lit("https://a.com/640x480/x.jpg"))
    return t.v_photos.select("photo_id", F.array_join(urls.dedupe_photo_urls(variants), " ").alias("kept"))


VERDICTS = """
    SELECT o_orderkey AS listing_id, CAST(o_custkey % 4 AS INTEGER) AS i, CASE WHEN o_orderstatus = 'O' THEN 'reject' ELSE 'accept' END AS verdict,
      o_orderpriority || ' picture of a brochure that goes on and on until it is longer than sixty chars' AS reason
    FROM {orders}"""


@query("apply_verdicts", f"""
    WITH c AS ({CLASSIFIED}), n AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY position, url, photo_id) AS rn FROM c WHERE reject_reason IS NULL)
    SELECT photo_id, CASE WHEN v.verdict = 'reject' THEN 'vision:' || substr(v.reason, 1, 60) END AS reject_reason
    FROM n LEFT JOIN ({VERDICTS.format(orders='orders')}) v ON v.listing_id = n.listing_id AND v.i + 1 = n.rn
    UNION ALL SELECT photo_id, reject_reason FROM c WHERE reject_reason IS NOT NULL""")
def apply_verdicts(t):
    return ph.apply_verdicts(ph.classify_and_rewrite(t.v_photos), t.sql(VERDICTS)).select("photo_id", "reject_reason")


EXISTING = """
    SELECT o_orderkey AS listing_id, 'https://img.example.com/p/' || CAST(o_custkey AS STRING) || '-1.jpg' AS url, CAST(o_custkey % 5 AS INTEGER) AS position,
      'ph' || CAST(o_custkey % 400 AS STRING) AS phash, o_custkey % 3 = 0 AS is_hero, o_custkey % 2 = 0 AS is_rejected
    FROM {orders}"""
NEW_SQL = f"""
    SELECT listing_id, url, arg_min(photo_id, (position, photo_id)) AS photo_id, min(position) AS position, arg_min(phash, (position, photo_id)) AS phash,
      arg_min(reject_reason, (position, photo_id)) AS reject_reason FROM b GROUP BY listing_id, url"""
ANTI_SQL = f"""
    WITH b AS ({CLASSIFIED}), e AS ({EXISTING.format(orders='orders')}), n AS ({NEW_SQL}), k AS (
      SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.listing_id = n.listing_id AND e.url = n.url)
        AND NOT EXISTS (SELECT 1 FROM e WHERE e.listing_id = n.listing_id AND e.phash = n.phash))"""


def _fresh(t):
    rows = ph.classify_and_rewrite(t.v_photos).select("listing_id", "photo_id", "position", "url", "phash", "reject_reason")
    return ph.new_photos(rows, t.sql(EXISTING))


@query("new_photos", ANTI_SQL + " SELECT listing_id, url, position, phash FROM k")
def new_photos(t):
    return _fresh(t).select("listing_id", "url", "position", "phash")


@query("assign_positions", ANTI_SQL + """,
    s AS (SELECT listing_id, max(position) AS last, bool_or(is_hero AND NOT is_rejected) AS has_hero FROM e GROUP BY 1),
    r AS (SELECT k.*, row_number() OVER (PARTITION BY k.listing_id ORDER BY k.position, k.url) AS rn FROM k),
    g AS (SELECT r.listing_id, r.url, coalesce(s.last, -1) + rn AS position, reject_reason IS NOT NULL AS is_rejected, coalesce(s.has_hero, false) AS has_hero,
        reject_reason IS NULL AND rn - 1 >= coalesce(p_size % 3, 0) AS eligible
      FROM r LEFT JOIN s USING (listing_id) LEFT JOIN part ON p_partkey = r.listing_id)
    SELECT listing_id, url, CAST(position AS INTEGER) AS position, is_rejected,
      coalesce(NOT has_hero AND position = min(position) FILTER (eligible) OVER (PARTITION BY listing_id), false) AS is_hero FROM g""")
def assign_positions(t):
    hero = t.part.select(F.col("p_partkey").alias("listing_id"), (F.col("p_size") % 3).alias("hero_index"))
    out = ph.assign_positions(_fresh(t), t.sql(EXISTING), hero)
    return out.select("listing_id", "url", "position", "is_rejected", "is_hero")


@query("photo_counts", """
    SELECT l.id, CAST(count(p.photo_id) FILTER (NOT p.is_rejected) AS INTEGER) AS photo_count
    FROM v_listings l LEFT JOIN v_photos p ON p.listing_id = l.id GROUP BY l.id""")
def photo_counts(t):
    return ph.photo_counts(t.v_listings, t.v_photos).select("id", "photo_count")


HERO_EDITS = "SELECT l_orderkey AS listing_id, max((((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT)) AS photo_id FROM {lineitem} GROUP BY l_orderkey HAVING count(*) > 4"


@query("set_hero", f"""
    SELECT p.photo_id, CASE WHEN e.photo_id IS NOT NULL THEN p.photo_id = e.photo_id ELSE p.is_hero END AS is_hero
    FROM v_photos p LEFT JOIN ({HERO_EDITS.format(lineitem='lineitem')}) e USING (listing_id)""")
def set_hero(t):
    return ph.set_hero(t.v_photos, t.sql(HERO_EDITS)).select("photo_id", "is_hero")


ADDS = """
    SELECT o_custkey AS listing_id, o_orderkey AS photo_id, 'https://hand.example.com/' || CAST(o_orderkey AS STRING) || '.jpg' AS url,
      CASE WHEN o_orderstatus = 'F' THEN 'view' END AS alt, o_orderstatus = 'O' AS is_hero FROM {orders}"""


@query("append_photo", f"""
    WITH a AS ({ADDS.format(orders='orders')}), h AS (SELECT listing_id, max(photo_id) AS hero FROM a WHERE is_hero GROUP BY 1),
    m AS (SELECT listing_id, max(position) AS last FROM v_photos GROUP BY 1)
    SELECT p.photo_id, p.url, p.position, CASE WHEN h.hero IS NOT NULL THEN false ELSE p.is_hero END AS is_hero, CAST(NULL AS VARCHAR) AS photo_type
    FROM v_photos p LEFT JOIN h USING (listing_id)
    UNION ALL SELECT a.photo_id, a.url, CAST(coalesce(m.last, -1) + row_number() OVER (PARTITION BY a.listing_id ORDER BY a.photo_id) AS INTEGER),
      coalesce(a.photo_id = h.hero, false), 'manual' FROM a LEFT JOIN m USING (listing_id) LEFT JOIN h USING (listing_id)""")
def append_photo(t):
    out = ph.append_photo(t.v_photos, t.sql(ADDS))
    return out.select("photo_id", "url", "position", "is_hero", "photo_type")


@query("gallery", """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY position, url, photo_id) AS rn FROM v_photos),
    f AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY NOT is_hero, position, url) AS fr FROM r WHERE rn <= 3)
    SELECT listing_id, position, url, fr = 1 AS featured FROM f""")
def gallery(t):
    return ph.gallery(t.v_photos, n=3).select("listing_id", "position", "url", "featured")


@query("split_gallery", """
    SELECT photo_id, 'active' AS part FROM v_photos WHERE NOT is_rejected UNION ALL SELECT photo_id, 'rejected' FROM v_photos WHERE is_rejected""")
def split_gallery(t):
    active, rejected = ph.split_gallery(t.v_photos)
    return active.select("photo_id", F.lit("active").alias("part")).unionByName(
        rejected.select("photo_id", F.lit("rejected").alias("part")))


MOVES = """
    SELECT max((((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT)) AS photo_id, CASE WHEN l_orderkey % 2 = 0 THEN -1 ELSE 1 END AS direction
    FROM {lineitem} WHERE l_returnflag <> 'R' GROUP BY l_orderkey"""


@query("swap_positions", f"""
    WITH a AS (SELECT listing_id, photo_id, position, row_number() OVER (PARTITION BY listing_id ORDER BY position, photo_id) AS n FROM v_photos WHERE NOT is_rejected),
    m AS (SELECT a.*, e.direction FROM a JOIN ({MOVES.format(lineitem='lineitem')}) e USING (photo_id)),
    t AS (SELECT m.photo_id AS a_id, m.position AS a_pos, b.photo_id AS b_id, b.position AS b_pos FROM m JOIN a b ON b.listing_id = m.listing_id AND b.n = m.n + m.direction),
    c AS (SELECT a_id AS photo_id, b_pos AS pos FROM t UNION ALL SELECT b_id, a_pos FROM t)
    SELECT p.photo_id, coalesce(c.pos, p.position) AS position FROM v_photos p LEFT JOIN c USING (photo_id)""")
def swap_positions(t):
    return ph.swap_positions(t.v_photos, t.sql(MOVES)).select("photo_id", "position")


HERO_LOG = """
    SELECT listing_id, photo_id, ((photo_id % 1000003) * 7919) % 1000003 AS seq, CASE WHEN photo_id % 2 = 0 THEN -1 ELSE 1 END AS direction
    FROM {v_photos} WHERE NOT is_rejected"""


@query("ordered_heroes", f"""
    SELECT p.photo_id, coalesce(p.photo_id = e.hero, p.is_hero) AS is_hero FROM v_photos p LEFT JOIN (
      SELECT listing_id, arg_max(photo_id, (seq, photo_id)) AS hero FROM ({HERO_LOG.format(v_photos='v_photos')}) GROUP BY 1) e USING (listing_id)""")
def ordered_heroes(t):
    """Several hero edits of a listing: the newest counts."""
    return ph.set_hero(t.v_photos, t.sql(HERO_LOG).drop("direction")).select("photo_id", "is_hero")


@query("surplus_moves", f"""
    SELECT photo_id, direction, seq FROM (SELECT *, min(seq) OVER (PARTITION BY listing_id) AS first FROM ({HERO_LOG.format(v_photos='v_photos')})) WHERE seq > first""")
def surplus_moves(t):
    """Of several moves in a listing the first by sequence is taken, the others are reported."""
    return ph.surplus_moves(t.v_photos, t.sql(HERO_LOG).drop("listing_id"))
