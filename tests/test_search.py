"""Paging by cursor, the stored text index and gazetteers of any length."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from casona import refdata
from casona.operators import listings as ls, normalize as norm
from casona.operators.textindex import TextIndex
from casona.session import shared_folder, small_table


def test_cursors_walk_the_pages_of_search(spark):
    rng = random.Random(1)
    days = [None, *(dt.datetime(2024, 1, d) for d in range(1, 6))]
    rows = [(k, rng.choice(days), "active" if k % 5 else "sold") for k in range(200)]
    cards = spark.createDataFrame(rows, "id long, last_seen_at timestamp, status string").repartition(5)
    path = f"{shared_folder(spark)}/cards-{uuid.uuid4().hex}"
    ls.by_recency(cards, 4).write.parquet(path)
    laid, cursor, page = spark.read.parquet(path), None, 0
    while True:
        page += 1
        got = [(r.id, r.last_seen_at) for r in ls.search_after(laid, ls.SearchFilters(), cursor, 23).collect()]
        assert got == [(r.id, r.last_seen_at) for r in ls.search(cards, ls.SearchFilters(), page, 23)[0].collect()]
        if not got:
            break
        cursor = got[-1][::-1]
    assert page == 8
    plan = ls.search_after(laid, ls.SearchFilters(), (days[3], 7), 23)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "LessThanOrEqual(last_seen" in plan


def index(spark):
    return TextIndex(spark, f"{shared_folder(spark)}/text-{uuid.uuid4().hex}", T.LongType(), 8)


def listings(spark, rows):
    return spark.createDataFrame(rows, "id long, title_en string, locality string")


def test_updates_equal_a_rebuilt_index(spark):
    rng, t, now = random.Random(2), index(spark), {}
    words = ["casa", "playa", "lote", "río", "vista", "nosara"]
    for batch in range(4):
        changed = {rng.randrange(30): (" ".join(rng.choices(words, k=rng.randrange(5))) or None, rng.choice(words)) for _ in range(15)}
        gone = [k for k in rng.sample(range(30), 4) if k not in changed]
        now = {**{k: v for k, v in now.items() if k not in gone}, **changed}
        df = listings(spark, [(k, *v) for k, v in changed.items()])
        assert t.update(batch, df, spark.createDataFrame([(k,) for k in gone], "id long")) and not t.update(batch, df)
        if batch == 2:
            t.compact(most=3)
        rebuilt = ls.token_index(listings(spark, [(k, *v) for k, v in now.items()]))
        for q in ("casa", "playa vista", "nosara río lote", "nothing"):
            assert sorted(map(tuple, t.search(q).collect())) == sorted(map(tuple, ls.fulltext_rank(rebuilt, q).collect()))
    top = [tuple(r) for r in t.search("casa", 3).collect()]
    assert top == sorted(map(tuple, t.search("casa").collect()), key=lambda r: (-r[1], r[0]))[:3]


def test_a_query_reads_its_own_buckets(spark):
    t = index(spark)
    t.update(0, listings(spark, [(k, f"w{k} casa", None) for k in range(100)]))
    t.compact()
    read = {int(f.rpartition("_bucket=")[2].partition("/")[0]) for f in t.index("casa").inputFiles()}
    assert read == set(t.postings.buckets_of(spark.createDataFrame([("casa",)], "token string"))) and len(read) == 1


def test_long_gazetteer_equals_the_literal_form(spark):
    names = ["Nosara", "Tamarindo, Guanacaste", " JACÓ ", "playa hermosa de jaco", "x", "", None, "Puerto Viejo de Talamanca", "ab", "San José centro", "nosaranosara"]
    df = spark.createDataFrame([(i, n, "old") for i, n in enumerate(names)], "id int, locality string, region_slug string")
    fixed = small_table(spark, [(i, k, r) for i, (k, r) in enumerate(refdata.GAZETTEER)], "ord bigint, key string, region string")
    want = {r.id: r.w for r in df.select("id", norm.region_by_locality_contains("locality").alias("w")).collect()}
    found = norm.region_by_gazetteer(df, fixed)
    assert {r.id: r.region_slug for r in found.collect()} == want and any(want.values())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    short = small_table(spark, [(3, "ab", "two"), (1, "x", "one"), (2, "x", "later"), (9, "", "all"), (0, None, "no")], "ord bigint, key string, region string")
    got = {r.locality: r.region_slug for r in norm.region_by_gazetteer(df, short).collect()}
    assert got["ab"] == "two" and got["x"] == "one" and got["Nosara"] == "all" and got[""] == "all" and got[None] is None
    assert norm.region_by_gazetteer(df, short.limit(0)).filter(F.col("region_slug").isNotNull()).count() == 0


def test_ranges_by_recency_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ls, "RANGE_ROWS", 10)
    cards = spark.range(95).selectExpr("id", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 7)) last_seen_at")
    laid = ls.by_recency(cards, 2)
    assert laid.rdd.getNumPartitions() == 10
    rows = [(r.last_seen_at, r.id) for r in laid.collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0].timestamp(), r[1])) and len(rows) == 95
    assert ls.by_recency(cards.limit(5), 2).rdd.getNumPartitions() == 2


@pytest.mark.parametrize("most_sent", [100_000, 0])
def test_keys_of_any_length_in_names(spark, monkeypatch, most_sent):
    rng = random.Random(8)
    monkeypatch.setattr(norm, "MOST_SENT", most_sent)
    word = lambda low, high: "".join(rng.choice("ab1") for _ in range(rng.randint(low, high)))
    keys = [(rng.randint(0, 99), word(1, 11), f"r{k}") for k in range(60)] + [(None, "a", "x"), (1, None, "x")]
    keys = list({o: (o, k, r) for o, k, r in keys}.values())
    names = [None, "", "a", "b1"] + [word(0, 30) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(names)), "id int, locality string")
    first = lambda n, all_keys: next((r for o, k, r in sorted(x for x in all_keys if None not in x) if n is not None and k in n), None)
    for chosen in (keys, [k for k in keys if k[1] is not None and len(k[1]) > 6], [(200, "", "all"), (3, "b1b1", "mid")]):
        got = {r.id: r.region_slug for r in norm.region_by_gazetteer(df, spark.createDataFrame(chosen, "ord int, key string, region string")).collect()}
        assert got == {i: first(n, chosen) for i, n in enumerate(names)}


def test_long_names_ask_for_few_grams(spark, monkeypatch):
    """Grams that no key begins or ends like are dropped before they are shuffled; there were three a character."""
    df = spark.createDataFrame([(i, f"a long name of a house by the sea number {10_000 + i}") for i in range(50)], "id int, locality string")
    keys = spark.createDataFrame([(i, str(10_000 + i), "r") for i in range(0, 50, 2)], "ord int, key string, region string")
    found = norm.region_by_gazetteer(df, keys)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") >= 4
    assert sorted(r.id for r in found.filter("region_slug = 'r'").collect()) == list(range(0, 50, 2))


def test_words_of_new_listings_are_not_shuffled_one_by_one(spark):
    from casona.operators.listings import token_index

    rows = spark.range(20).selectExpr("id", "'casa beach casa' title_en", "'by the sea' description_en").repartition("id")
    folded = token_index(rows).groupBy("id").agg(F.count("*").alias("n"))
    assert folded._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    at = f"{shared_folder(spark)}/words-{uuid.uuid4().hex}"
    index = TextIndex(spark, at, T.LongType(), 4)
    seen = []
    plain = type(rows).repartition

    def noted(df, *to):
        seen.append(to)
        return plain(df, *to)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(rows), "repartition", noted)
        index.update(0, rows)
    assert ("id",) in seen
    assert [(r.id, float(r.score)) for r in index.search("casa sea").orderBy("id").collect()] == [(i, 2.1) for i in range(20)]
