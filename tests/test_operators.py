"""Golden values, properties and hot-key behaviour of the operators."""

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from casona import refdata
from casona.functions import geo, money
from casona.operators import (
    accounting as acc, entity_resolution as er, enrich, extraction as ex, normalize as norm, photos as ph, sync, upsert as up,
)
from casona.operators.ranking import global_row_number, previous_row, running_totals, top_n_per_key


def at():
    return F.lit("2024-06-01").cast("timestamp")


# ---------------------------------------------------------------- normalize

TOWNS = [
    ("Tamarindo", "guanacaste"), ("Nosara", "nicoya"), ("Santa Teresa", "nicoya"), ("Jacó", "central-pacific"), ("Manuel Antonio", "central-pacific"),
    ("Quepos", "central-pacific"), ("Dominical", "south-pacific"), ("Uvita", "south-pacific"), ("Ojochal", "south-pacific"),
    ("Puerto Viejo", "caribbean"), ("Cahuita", "caribbean"), ("Limón", "caribbean"), ("Escazú", "central-valley"), ("Heredia", "central-valley"),
    ("San José", "central-valley"), ("Atenas", "central-valley"), ("Nosara, Guanacaste", "nicoya"), ("Atlantis", None),
    ("Playa Hermosa, Jaco", "guanacaste"), ("", None), (None, None),
]


def test_regions_of_towns(spark):
    df = spark.createDataFrame(TOWNS, "town string, want string").withColumn("got", norm.region_from_levels("town"))
    assert [r.got for r in df.collect()] == [w for _, w in TOWNS]


def test_region_by_point_and_order(spark):
    df = spark.createDataFrame([(9.4, -84.15), (9.4, -83.0), (0.0, 0.0), (None, -84.0)], "lat double, lng double")
    got = [r[0] for r in df.select(geo.region_by_bbox("lat", "lng")).collect()]
    assert got == ["central-pacific", "caribbean", None, None]


def test_money(spark):
    rows = [("270000000.00", "CRC"), ("350000.00", "USD"), ("350000.00", None), ("10.00", "EUR"), ("10.00", "XXX"), (None, "CRC")]
    df = spark.createDataFrame(rows, "price string, cur string").withColumn("price", F.col("price").cast("decimal(14,2)"))
    rates = money.rate_table(spark, {"CRC": 540.0, "XXX": 0.0})
    got = {(r.price, r.cur): r.usd for r in norm.to_usd(df, "price", "cur", rates, "usd").collect()}
    assert got[Decimal("270000000.00"), "CRC"] == Decimal("500000.00")
    assert got[Decimal("350000.00"), None] == Decimal("350000.00")
    assert got[Decimal("10.00"), "EUR"] is None and got[Decimal("10.00"), "XXX"] is None
    per = spark.range(1).select(money.price_per_sqm(F.lit("350000.00"), F.lit(200))).first()[0]
    assert per == Decimal("1750.00")


def test_nearest_place_ties_and_limit(spark):
    places = [("b", 9.0, -84.0), ("a", 9.0, -84.0), ("far", 11.9, -82.1)]
    df = spark.createDataFrame([(9.0, -84.0), (7.6, -86.4)], "lat double, lng double")
    got = [r[0] for r in df.withColumns(geo.unit_vector("lat", "lng")).withColumn("s", geo.nearest_square(places)).select(geo.nearest_place("s", places, max_km=100)).collect()]
    assert got[0].name == "b" and got[0].km < 1e-6 and got[1] is None


def test_grid_search_equals_brute_force(spark):
    rng = random.Random(5)
    # a third of everything sits in one small spot
    spot = lambda: (9.9 + rng.random() / 50, -84.1 + rng.random() / 50)
    wide = lambda: (7.6 + rng.random() * 4.3, -86.4 + rng.random() * 4.3)
    listings = [(i, *(spot() if i % 3 == 0 else wide())) for i in range(400)]
    pois = [(f"p{i}", *(spot() if i % 3 == 0 else wide())) for i in range(300)]
    df = spark.createDataFrame(listings, "id long, lat double, lng double")
    pdf = spark.createDataFrame(pois, "name string, lat double, lng double")
    got = {r.id: (r.name, r.km) for r in norm.nearest_poi_table(df, "id", pdf, max_km=60).collect()}

    def km(a, b):
        (la, lo), (lb, lp) = np.radians(a), np.radians(b)
        h = np.sin((lb - la) / 2) ** 2 + np.cos(la) * np.cos(lb) * np.sin((lp - lo) / 2) ** 2
        return 2 * 6371 * np.arcsin(min(1, np.sqrt(h)))

    for i, lat, lng in listings:
        best = min((km((lat, lng), (a, b)), n) for n, a, b in pois)
        if best[0] <= 60:
            assert got[i][0] == best[1] and abs(got[i][1] - best[0]) < 1e-6
        else:
            assert i not in got


def test_nearest_place_where_one_cell_holds_most(spark):
    rng = np.random.default_rng(6)
    n, m = 3000, 2000
    city = lambda k: np.c_[9.93 + rng.random(k) / 500, -84.08 + rng.random(k) / 500]
    wide = lambda k: np.c_[7.6 + rng.random(k) * 4.3, -86.4 + rng.random(k) * 4.3]
    listings = np.vstack([city(n * 8 // 10), np.tile(city(1), (n // 10, 1)), wide(n // 10)])
    places = np.vstack([city(m * 9 // 10), wide(m // 20), np.tile(city(1), (m // 20, 1))])
    df = spark.createDataFrame([(i, float(a), float(b), "x") for i, (a, b) in enumerate(listings)] + [(-1, None, -84.0, "x")], "key long, lat double, lng double, best string")
    pdf = spark.createDataFrame([(f"p{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(places)] + [("q", None, 1.0)], "name string, lat double, lng double")
    got = {r.key: (r.name, r.km) for r in norm.nearest_poi_table(df, "key", pdf, max_km=40).collect()}

    a, b = np.radians(listings)[:, None, :], np.radians(places)[None, :, :]
    h = np.sin((b - a)[..., 0] / 2) ** 2 + np.cos(a[..., 0]) * np.cos(b[..., 0]) * np.sin((b - a)[..., 1] / 2) ** 2
    km = 2 * 6371 * np.arcsin(np.sqrt(h))
    for i, row in enumerate(km):
        if row.min() > 40:
            assert i not in got
        else:
            name, best = got[i]
            assert abs(best - row.min()) < 1e-6 and abs(row[int(name[1:])] - row.min()) < 1e-9
    assert -1 not in got

    spots = pdf.dropna().groupBy(F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng")).agg(F.min("name").alias("name"))
    cells, leaves = norm.place_tree(spots, 32)
    assert leaves.count() == spots.count() and leaves.groupBy("level", "cy", "cx").count().agg(F.max("count")).first()[0] <= 32
    assert cells.filter("level > 5").count() > 0  # the city is split,
    assert cells.count() < 900  # the country is not
    assert norm.nearest_poi_table(df, "key", pdf.limit(0)).count() == 0
    assert norm.nearest_poi_table(df.limit(0), "key", pdf).count() == 0


# ---------------------------------------------------------------- ordered operators with a hot key

@pytest.fixture(scope="module")
def skewed(spark):
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 997).alias("t"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 13).alias("v"))
    return rows.cache()


def test_running_totals_equal_a_plain_window(skewed):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("id", F.sum(F.lit(1)).over(w).alias("n"), F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"))
    got = running_totals(skewed, ["k"], [F.col("t"), F.col("id")], {"n": F.lit(1), "s": F.coalesce("v", F.lit(0))})
    assert got.select("id", "n", "s").exceptAll(want).isEmpty()


def test_previous_row_equals_lag(skewed):
    want = skewed.select("id", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")).alias("p"))
    got = previous_row(skewed, ["k"], [F.col("t"), F.col("id")], {"p": "v"}).select("id", "p")
    assert got.exceptAll(want).isEmpty() and got.count() == 6000


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n_per_key(skewed, n):
    want = skewed.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("t", "id"))).filter(F.col("rank") <= n)
    got = top_n_per_key(skewed, ["k"], [F.col("t"), F.col("id")], n)
    assert got.select("id", "rank").exceptAll(want.select("id", "rank")).isEmpty() and got.count() == want.count()


# ---------------------------------------------------------------- entity resolution

def test_hash_embedding(spark):
    from casona.functions.vectors import hash_embedding

    df = spark.createDataFrame([("a",), ("a",), ("b",)], "s string").select(hash_embedding("s").alias("v"))
    a, a2, b = (np.array(r.v) for r in df.collect())
    assert len(a) == 1024 and abs((a * a).sum() - 1) < 1e-9 and (a == a2).all() and abs(a @ b) < 0.5


def scored(spark, rows):
    return spark.createDataFrame(rows, "query_id long, base_id long, rank int, c string").withColumn("confidence", F.col("c").cast("decimal(3,2)"))


def test_decisions(spark):
    s = scored(spark, [(1, 10, 1, "0.99"), (2, 10, 1, "0.70"), (3, 10, 1, "0.20"), (4, 10, 1, "0.30"), (4, 11, 2, "0.90"), (4, 12, 3, "0.99"), (5, 8, 1, "0.40"), (5, 9, 2, "0.40")])
    new = spark.createDataFrame([(i,) for i in range(1, 7)], "id long")
    got = {r.id: (r.action, r.method, r.candidate_id) for r in er.decide(new, er.best_candidate(s)).collect()}
    assert got == {
        1: ("merge", "embedding", 10), 2: ("review", "embedding", 10), 3: ("create", "embedding", 10),
        4: ("merge", "embedding", 11),  # first strong one in similarity order, not the most confident
        5: ("create", "embedding", 8), 6: ("create", "no_match", None)}


def test_top_k_with_a_hot_block_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(240, 16))
    block = [0 if i % 3 == 0 else i % 7 for i in range(240)]
    df = spark.createDataFrame([(i, [float(x) for x in m[i]], block[i]) for i in range(240)], "id long, embedding array<double>, b int")
    got = {}
    for r in er.top_k_similar(df, df, k=4, blocking=["b"], exclude_self=True, rows_per_chunk=16).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.base_id
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    for i in range(240):
        others = [j for j in range(240) if block[j] == block[i] and j != i]
        want = sorted(others, key=lambda j: (-(unit[i] @ unit[j]), j))[:4]
        assert [got[i][k] for k in sorted(got[i])] == want


def test_top_k_ties_take_the_smaller_id(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)], "id long, embedding array<double>")
    rows = er.top_k_similar(df, df, k=3, exclude_self=True, rows_per_chunk=8).filter("query_id = 40").orderBy("rank").collect()
    assert [r.base_id for r in rows] == [0, 1, 2]


def test_lsh_finds_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    near = base + rng.normal(size=base.shape) * 0.01
    mk = lambda m: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, embedding array<double>")
    pairs = er.lsh_candidates(mk(near), mk(base), 0.99).collect()
    assert {(p.query_id, p.base_id) for p in pairs} == {(i, i) for i in range(60)}


def test_top_k_keeps_the_type_of_ids(spark):
    df = spark.createDataFrame([(f"{i * 7919:08x}", [float(i % 5), 1.0]) for i in range(40)], "id string, embedding array<double>")
    rows = er.top_k_similar(df, df, k=2, exclude_self=True, rows_per_chunk=8)
    assert dict(rows.dtypes)["base_id"] == "string"
    best = {r.query_id: r.base_id for r in rows.filter("rank = 1").collect()}
    ids = [f"{i * 7919:08x}" for i in range(40)]
    assert all(best[ids[i]] == min(x for j, x in enumerate(ids) if j % 5 == i % 5 and j != i) for i in range(40))


def test_no_listing_url_is_dropped(spark):
    from casona.sources import discovery

    links = "".join(f'<a href="/l/{i}">x</a>' for i in range(2500))
    pages = spark.createDataFrame([("s", 1, links)], "source string, page int, html string")
    rules = spark.createDataFrame([("s", "https://a.b", "/l/", "url", None)], "source string, base_url string, href_pattern string, match_on string, exclude_pattern string")
    assert discovery.discover_listing_urls(pages, rules).count() == 2500
    assert discovery.discover_listing_urls(pages, rules, requested=2300, configured=9000).count() == 2300


def test_prompt_key_sees_the_whole_page(spark):
    page = "<p>" + "word " * 20000
    df = spark.createDataFrame([(page + "a",), (page + "b",)], "html string")
    keys = df.select(ex.prompt_key("html", F.lit("{}"), F.array(F.lit("x")), F.lit("u")).alias("k")).collect()
    assert keys[0].k != keys[1].k


@pytest.mark.parametrize("kind", ["chain", "hub", "giant"])
def test_clusters_settle_whatever_the_order_of_ids(spark, kind, monkeypatch):
    from casona.operators import graph

    rounds = []
    small = graph._small_star
    monkeypatch.setattr(graph, "_small_star", lambda *a: (rounds.append(1), small(*a))[1])
    rng = random.Random(1)
    ids = rng.sample(range(10**9), 5001)
    edges = {
        "chain": list(zip(ids, ids[1:])), "hub": [(ids[0], x) for x in ids[1:]],
        "giant": [(rng.choice(ids[:3000]), rng.choice(ids[:3000])) for _ in range(9000)],
    }[kind]
    got = {r.id: r.cluster_id for r in er.cluster_batch(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert len(rounds) < 25


def test_rows_are_numbered_across_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003 % 40).alias("k"), "id")
    rows = global_row_number(df, [F.desc("k"), F.asc("id")], "n").orderBy("n").collect()
    want = sorted(((r.k, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r.n, r.k, r.id) for r in rows] == [(i + 1, *w) for i, w in enumerate(want)]


def test_clusters_equal_union_find(spark):
    rng = random.Random(3)
    # a long chain, a hub with many leaves, and random edges
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, 200 + i) for i in range(1, 120)] + [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(90)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    got = {r.id: r.cluster_id for r in er.cluster_batch(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


# ---------------------------------------------------------------- upserts and sync

def raw_rows(spark, rows):
    base = spark.createDataFrame(rows, "source string, source_listing_id string, source_url string, t int")
    return base.select(
        "source", "source_listing_id", "source_url", F.lit(1).alias("run_id"), F.timestamp_seconds("t").alias("scraped_at"))


def test_upsert_raw_is_idempotent_and_last_wins(spark):
    empty = up.ensure_columns(
        raw_rows(spark, []), {**dict.fromkeys(refdata.STAGE_COLUMNS, "string"), "error": "string"})
    batch = raw_rows(spark, [("s", "1", "old", 1), ("s", "1", "new", 2), ("s", "2", "x", 1)])
    once = up.upsert_raw(empty, batch)
    twice = up.upsert_raw(once.drop("was_new"), batch)
    assert {(r.source_listing_id, r.source_url, r.was_new) for r in once.collect()} == {("1", "new", True), ("2", "x", True)}
    assert once.drop("was_new").exceptAll(twice.drop("was_new")).isEmpty() and twice.filter("was_new").isEmpty()


def test_merge_never_erases(spark):
    schema = "id long, slug string, property_type string, title_en string, address_line string, features array<string>, last_seen_at timestamp, updated_at timestamp"
    cur = spark.createDataFrame([(1, "s", "house", "old", None, ["pool"], None, None), (2, "t", "lot", "keep", "a", [], None, None)], schema)
    chg = spark.createDataFrame([(1, "other", "condo", None, "street", [])], "id long, slug string, property_type string, title_en string, address_line string, features array<string>")
    got = {r.id: r for r in up.merge_canonical(cur, chg, at()).collect()}
    assert (got[1].slug, got[1].property_type, got[1].title_en, got[1].address_line, got[1].features) == ("s", "house", "old", "street", ["pool"])
    assert got[1].updated_at is not None and got[2].updated_at is None


def canon_rows(spark):
    cols = {c: F.lit(None).cast("string") for c in sync.HASHED if c != "status"} | {c: F.lit(None).cast("array<string>") for c in sync.HASHED_ARRAYS}
    return spark.range(40).withColumns(cols).withColumns({
        "title_en": F.concat(F.lit("t"), "id"), "status": F.lit("active"), "updated_at": at(), "wp_synced_at": F.lit(None).cast("timestamp"),
        "wp_post_id": F.lit(None).cast("int"), "wp_content_hash": F.lit(None).cast("string"), "features": F.array(F.lit("b"), F.lit("a"))})


def test_after_marking_only_skips_remain(spark):
    canon = canon_rows(spark)
    plan = sync.plan_sync(sync.pending_sync(canon, None))
    assert plan.filter("sync_action = 'create'").count() == 40
    results = plan.select("id", F.col("id").cast("int").alias("post_id"), F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"))
    done = sync.mark_synced(canon, plan, results, at())
    assert sync.pending_sync(done, None).isEmpty()
    # same content in another array order, touched again: nothing to send
    touched = done.withColumns({"features": F.array(F.lit("a"), F.lit("b")), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY")})
    again = sync.plan_sync(sync.pending_sync(touched, None))
    assert again.count() == 40 and again.filter("sync_action <> 'skip'").isEmpty()


def test_batches(spark):
    rows = sync.assign_batches(sync.pending_sync(canon_rows(spark), 30)).groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in rows} == {1: 25, 2: 5}


# ---------------------------------------------------------------- photos, enrichment, accounting

def test_photo_rules(spark):
    cases = [
        ("https://x.com/logo.png", 900, 700, "logo_or_branding"), ("https://x.com/site_logo.jpg", 900, 700, None), ("https://x.com/Google-Play.png", None, None, "app_store_badge"),
        ("https://x.com/mls-1.png?a=1", 900, 700, "site_branding"), ("https://x.com/a.svg", 900, 700, "icon"), ("https://x.com/a.jpg", 299, 700, "tiny"),
        ("https://x.com/a.jpg", None, 10, None), ("https://x.com/a.jpg", 2000, 400, "unusual_aspect_ratio"), ("https://x.com/a.jpg", 800, 600, None),
    ]
    df = spark.createDataFrame(cases, "url string, w int, h int, want string").withColumn("got", ph.classify_photo("url", "w", "h"))
    assert [r.got for r in df.collect()] == [c[3] for c in cases]


def test_one_hero_after_positions(spark):
    photos = spark.createDataFrame([(1, i, f"u{i}", "logo" if i < 2 else None) for i in range(5)], "listing_id long, position int, url string, reject_reason string")
    none = spark.createDataFrame([], "listing_id long, url string, position int, is_hero boolean, is_rejected boolean")
    hero = spark.createDataFrame([(1, 1)], "listing_id long, hero_index int")
    rows = ph.assign_positions(photos, none, hero).orderBy("position").collect()
    assert [r.position for r in rows] == [0, 1, 2, 3, 4] and [r.is_hero for r in rows] == [False, False, True, False, False]


def test_categories(spark):
    cols = enrich.derive_categories("t", "p", "b", "f", "g")
    df = spark.createDataFrame(
        [("house", 2e6, 4.9, None, None), ("condo", None, None, ["oceanfront"], ["luxury"]), ("hotel", 5.0, 9.0, [], [])],
        "t string, p double, b double, f array<string>, g array<string>")
    assert [r[0] for r in df.select(cols).collect()] == [
        ["homes-and-villas", "beach-properties", "luxury-properties"], ["condominiums", "beach-properties", "luxury-properties"], []]


def test_model_cost(spark):
    calls = spark.createDataFrame([("haiku", 5000, 400)], "model string, input_tokens long, output_tokens long")
    prices = spark.createDataFrame(refdata.MODEL_PRICES, "family string, input double, output double")
    assert acc.model_cost(calls, prices).first().cost_usd == Decimal("0.007000")


def test_auto_pause_needs_a_sample(spark):
    rows = [(1, i, 500) for i in range(29)] + [(2, i, 500 if i < 10 else 200) for i in range(60)]
    df = spark.createDataFrame(rows, "source_id int, event_id long, http_status int").withColumn("ts", F.timestamp_seconds(F.col("event_id") * 600))
    out = acc.auto_pause(df)
    got = {r.source_id: (r.n, r.p) for r in out.groupBy("source_id").agg(F.count("*").alias("n"), F.max("paused").alias("p")).collect()}
    assert got == {1: (29, False), 2: (30, True)}


# ---------------------------------------------------------------- replies

LISTING_PAGE_DATA = '{"name": "Casa Tamarindo", "price": 425000, "priceCurrency": "USD", "address": {"addressLocality": "Tamarindo"}}'


@pytest.mark.parametrize(
    "reply, title, beds, salvaged",
    [
        ('```json\n{"title": "A", "bedrooms": 3}\n```', "A", 3, False), ('Sure: {"title": "B", "bedrooms": 2.5}', "B", 2.5, False),
        ('{"title": "C", "bedrooms": "three"}', "Casa Tamarindo", None, True), ('{"title": "D"} bye', "Casa Tamarindo", None, True),
        ("not json", "Casa Tamarindo", None, True), ('{"title": "E", "language": "fr"}', "Casa Tamarindo", None, True),
        ('{"title": "F", "features": "pool"}', "F", None, False), ('[1, 2]', "Casa Tamarindo", None, True),
    ],
)
def test_replies(spark, reply, title, beds, salvaged):
    payload = spark.createDataFrame(
        [("s", "1", "https://x.com/1", "<p>x</p>", LISTING_PAGE_DATA, ["Costa Rica", "Guanacaste", "Santa Cruz"])],
        "source string, source_listing_id string, source_url string, raw_html string, raw_extracted string, breadcrumbs array<string>")
    key = ex.prompt_key("raw_html", "raw_extracted", "breadcrumbs", "source_url")
    stored = payload.select(key.alias("prompt_key"), F.lit(reply).alias("reply"))
    r = ex.apply_extraction(payload, stored).first()
    assert (r.title, r.salvaged, r.province, r.canton, r.features) == (title, salvaged, "Guanacaste", "Santa Cruz", [])
    assert (None if r.bedrooms is None else float(r.bedrooms)) == beds
    if salvaged:
        assert r.price == Decimal("425000.00") and r.locality == "Tamarindo" and r.notes == ex.SALVAGE_NOTE




def test_newest_reply_by_sequence(spark):
    from casona.operators import enrich

    rows = spark.createDataFrame([("a", "x", "en")], "source_listing_id string, title string, language string").withColumn("description", F.lit("d"))
    reply = lambda seq, t: ("a", seq, t, None, None, None, None, None)
    replies = spark.createDataFrame([reply(1, "zz"), reply(3, "aa"), reply(2, "mm")], "source_listing_id string, seq int, " + ", ".join(f"{f} string" for f in enrich.RESPONSE_FIELDS))
    assert enrich.bilingual_copy(rows, replies).first().title_en == "aa"
    assert enrich.bilingual_copy(rows, replies.drop("seq")).first().title_en == "zz"


def test_best_k_over_many_tiles_and_ties():
    rng = np.random.default_rng(5)
    m = np.round(rng.normal(size=(90, 2)))  # many equal scores
    m[3] = 0
    ids = rng.permutation(90)
    unit = er._matrix(pd.Series(list(m)))
    got = er._best_k(ids, unit, ids, unit, 4, True, tile=16)
    exact = np.round(unit @ unit.T, 12)
    for q in range(90):
        want = sorted((-exact[q, b], ids[b]) for b in range(90) if b != q)[:4]
        mine = got[got.query_id == ids[q]]
        assert [round(-s, 9) + 0 for s in mine.similarity] == [round(s, 9) + 0 for s, _ in want]


def test_top_k_copies_rows_to_few_chunks(spark):
    """Chunks of 8 rows would copy each of 4,000 rows 500 times."""
    rng = np.random.default_rng(6)
    m = rng.normal(size=(4000, 3))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, embedding array<double>")
    found = er.top_k_similar(df, df, k=2, exclude_self=True, rows_per_chunk=8).filter("query_id < 50").collect()
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = unit[:50] @ unit.T
    sims[np.arange(50), np.arange(50)] = -1
    best = np.argsort(-sims, axis=1)[:, :2]
    assert sorted((r.query_id, r.rank, r.base_id) for r in found) == sorted((q, n + 1, int(best[q, n])) for q in range(50) for n in range(2))


def test_rounded_like_round(spark):
    from casona.functions.vectors import rounded

    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 3.2, -3.7, -0.2, 0.0, 1e15 + 0.5, None] + [random.Random(3).uniform(-400, 400) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    plan = df.select(rounded(F.col("x")).alias("r"))
    assert [r.r for r in plan.collect()] == [r.r for r in df.select(F.round("x").cast("bigint").alias("r")).collect()]


def test_hash_embedding_digests_need_no_decimals():
    import inspect

    from casona.plans import queries_resolution

    assert "F.round(" not in inspect.getsource(queries_resolution.hash_embedding)


def test_pages_are_parsed_few_at_a_time(spark, monkeypatch):
    from casona.functions import dom

    class Catch:
        dtypes = [("url", "string"), ("html", "string")]

        def selectExpr(self, *_):
            return self

        def mapInPandas(self, run, schema):
            return run

    run = dom.dom_fields(Catch(), ["url"])
    batch = pd.DataFrame({"url": [str(i) for i in range(1000)], "html": [f"<main>page {i}</main>" for i in range(1000)], "_classifieds": [False] * 1000})
    parts = list(run(iter([batch])))
    assert max(map(len, parts)) <= dom.PAGES_A_TIME
    whole = pd.concat(parts)
    assert list(whole.url) == list(batch.url) and list(whole.detail_text) == [f"page {i}" for i in range(1000)]
