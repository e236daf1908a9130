"""Streams over several batches: replays, bases, late rows, append and update modes."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from casona.operators.keyed import RawTable
from casona.session import shared_folder
from casona.streaming import jobs

RAW = """
    source string, source_listing_id string, source_url string, run_id bigint, raw_html string, scraped_at timestamp, extract_status string,
    normalize_status string, dedupe_status string, enrich_status string, publish_status string, error string"""


def folder(spark):
    return f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"


def arrive(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def payloads(batch):
    return batch.select("source", F.col("url").alias("source_listing_id"), F.col("url").alias("source_url"), F.lit(1).cast("bigint").alias("run_id"),
                        F.col("html").alias("raw_html"), F.col("fetched_at").alias("scraped_at"))


def test_ingest_updates_replays_and_compacts(spark):
    at, schema = folder(spark), "source string, url string, html string, fetched_at timestamp"
    table = RawTable(spark, f"{at}/raw", spark.createDataFrame([], RAW).schema, 4)
    day = lambda d: dt.datetime(2024, 6, d)

    def run():
        pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/pages")
        jobs.stream_ingest(pages, payloads, table, f"{at}/state").awaitTermination()

    def now(snapshot=None):
        return {r.source_listing_id: (r.raw_html, r.was_new) for r in table.read(snapshot).collect()}

    arrive(spark, f"{at}/pages", [("s", "a", "1", day(1)), ("s", "b", "1", day(1))], schema)
    run()
    arrive(spark, f"{at}/pages", [("s", "a", "2", day(2)), ("s", "c", "2", day(2))], schema)
    run()
    want = {"a": ("2", True), "b": ("1", True), "c": ("2", True)}
    assert now() == want
    # a batch that comes once more, as after a failure, changes nothing
    again = payloads(spark.createDataFrame([("s", "a", "9", day(9))], schema))
    assert not table.arrive(1, again) and not table.arrive(0, again) and now() == want
    before = table.snapshot()
    table.compact()
    settled = {k: (v, None) for k, (v, _) in want.items()}
    assert now() == settled and now(before) == want
    arrive(spark, f"{at}/pages", [("s", "b", "3", day(3)), ("s", "d", "3", day(3))], schema)
    run()
    assert now() == {**settled, "b": ("3", False), "d": ("3", True)}
    assert {r.source_listing_id for r in table.read().filter("extract_status = 'pending'").collect()} == set("abcd")


def test_crash_between_rows_and_manifest(spark, monkeypatch):
    at, schema = folder(spark), "source string, url string, html string, fetched_at timestamp"
    table = RawTable(spark, f"{at}/raw", spark.createDataFrame([], RAW).schema, 4)
    arrive(spark, f"{at}/pages", [("s", "a", "1", dt.datetime(2024, 6, 1))], schema)

    def run():
        pages = spark.readStream.schema(schema).parquet(f"{at}/pages")
        jobs.stream_ingest(pages, payloads, table, f"{at}/state").awaitTermination()

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(RawTable, "_commit", dies)
        with pytest.raises(StreamingQueryException):
            run()
    assert table.read().count() == 0
    run()  # the stream takes the same batch up again
    assert [r.source_listing_id for r in table.read().collect()] == ["a"]


def test_windows_close_once_and_late_rows_drop(spark):
    at, schema = folder(spark), "ts timestamp, source_id int, http_status int"
    hour = lambda h: dt.datetime(2024, 6, 1, h, 30)

    def run():
        fetches = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        jobs.run_available(jobs.error_rates(fetches, min_sample=1), f"{at}/out", f"{at}/state")

    arrive(spark, f"{at}/in", [(hour(8), 1, 200), (hour(8), 1, 500), (hour(12), 1, 200)], schema)
    run()
    arrive(spark, f"{at}/in", [(hour(8), 1, 500), (hour(11), 1, 404), (hour(20), 2, 200)], schema)  # 8:30 is beyond the watermark
    run()
    arrive(spark, f"{at}/in", [(hour(23), 2, 200)], schema)
    run()
    rows = {(r.window_start.hour, r.source_id): (r.attempts, r.errors, r.server_errors, r.breach) for r in spark.read.parquet(f"{at}/out").collect()}
    assert rows == {(8, 1): (2, 1, 1, True), (11, 1): (1, 1, 0, True), (12, 1): (1, 0, 0, False), (20, 2): (1, 0, 0, False)}


def test_cost_updates_fold_to_totals(spark):
    at, schema = folder(spark), "ts timestamp, cost_usd decimal(12,6), input_tokens bigint, output_tokens bigint"
    from decimal import Decimal

    seen = []

    def run():
        calls = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        query = jobs.cost_rollup(calls).writeStream.outputMode("update").option("checkpointLocation", f"{at}/state").foreachBatch(
            lambda b, i: seen.extend((i, r.day, r.cost_usd, r.call_count) for r in b.collect())).trigger(availableNow=True).start()
        query.awaitTermination()

    day = lambda d: dt.datetime(2024, 6, d, 9)
    for rows in ([(day(1), Decimal("1"), 1, 1)], [(day(1), Decimal("2"), 1, 1), (day(2), Decimal("5"), 1, 1)], [(day(2), Decimal("1"), 1, 1)]):
        arrive(spark, f"{at}/in", rows, schema)
        run()
    last = {}
    for i, d, cost, n in sorted(seen, key=lambda r: r[0]):
        last[d.day] = (float(cost), n)
    assert last == {1: (3.0, 2), 2: (6.0, 2)}


def test_searches_without_a_region_match(spark):
    listings = spark.createDataFrame(
        [(1, "active", "north", "house", 10.0, 3), (2, "active", None, "house", 10.0, 3), (3, "sold", "north", "house", 10.0, 3), (4, "active", "south", None, 10.0, None)],
        "id int, status string, region_slug string, property_type string, price_usd double, bedrooms int")
    searches = spark.createDataFrame(
        [(7, None, None, None, None, None), (8, "north", None, None, None, None), (9, None, "house", 5.0, 20.0, 3), (10, "south", None, None, None, 1)],
        "search_id int, region_slug string, property_type string, min_price double, max_price double, min_beds int")
    got = {(r.id, r.search_id) for r in jobs.saved_search_matches(listings, searches).collect()}
    assert got == {(1, 7), (2, 7), (4, 7), (1, 8), (1, 9), (2, 9)}


def test_searches_by_price_cells(spark):
    """Against all pairs, with edges of cells, parts of a unit, nulls and reversed ranges; few pairs fail the filter."""
    import random

    rng = random.Random(3)
    prices = [None, -5.0, 0.0, 0.5, 1.0, 15.99, 16.0, 16.01, 63.0, 64.0, 65.0, 1023.5, 1024.0, 4.0**20, 4.0**21] + [rng.uniform(0, 5000) for _ in range(120)]
    listings = [(k, "active" if k % 7 else "sold", rng.choice(["n", "s", None]), rng.choice(["house", None]), p, rng.choice([None, 0, 1, 2.5, 3, 11, 12, 15])) for k, p in enumerate(prices)]
    edge = lambda: rng.choice([None, 0.0, 0.5, 16.0, 63.99, 64.0, 1024.0, 4.0**20, rng.uniform(0, 5000)])
    searches = [(k, rng.choice(["n", None, None]), rng.choice(["house", None, None]), edge(), edge(), rng.choice([None, 0, 2, 2.5, 12, 14])) for k in range(150)]
    listings = [(a, b, c, d, e, None if f is None else float(f)) for a, b, c, d, e, f in listings]
    searches = [(a, b, c, d, e, None if f is None else float(f)) for a, b, c, d, e, f in searches]
    lf = spark.createDataFrame(listings, "id int, status string, region_slug string, property_type string, price_usd double, bedrooms double")
    sf = spark.createDataFrame(searches, "search_id int, region_slug string, property_type string, min_price double, max_price double, min_beds double")
    fits = lambda x, low, high: (low is None and high is None) or (x is not None and (low is None or x >= low) and (high is None or x <= high))
    want = sorted(
        (x[0], s[0]) for x in listings for s in searches
        if x[1] == "active" and s[1] in (None, x[2]) and s[2] in (None, x[3]) and fits(x[4], s[3], s[4]) and fits(x[5], s[5], None))
    got = sorted((r.id, r.search_id) for r in jobs.saved_search_matches(lf, sf).collect())
    assert got == want and len(want) > 500
    assert jobs._candidates(lf, sf).count() < 1.25 * len(want)
    assert jobs.saved_search_matches(lf, sf.limit(0)).count() == 0


def test_the_index_of_searches_is_small_and_not_broadcast(spark):
    searches = spark.createDataFrame(
        [(k, "n", "house", 400_000.0 + 37 * k, None, 1.0) for k in range(200)] + [(1000 + k, "n", None, 1e6 + k, 5e6 - k, None) for k in range(200)],
        "search_id int, region_slug string, property_type string, min_price double, max_price double, min_beds double")
    assert jobs._indexed(searches).count() < 40 * 400
    few = spark.range(3).selectExpr("id search_id", "'n' region_slug", "'house' property_type", "id * 1e5 min_price", "double(null) max_price", "1.0 min_beds")
    listings = spark.range(5).selectExpr("id", "'active' status", "'n' region_slug", "'house' property_type", "id * 6e4 price_usd", "2.0 bedrooms")
    joined = jobs.saved_search_matches(listings, few)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.id, r.search_id) for r in joined.collect()) == [(0, 0), (1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (4, 0), (4, 1), (4, 2)]


def _listings_and_searches(spark, seed=5):
    """Rows with nulls, repeats, prices at and near the edges of cells, and limits of parts of a unit or a room."""
    import random

    rng = random.Random(seed)
    price = lambda: rng.choice([None, -5.0, 0.0, 0.5, 64.0, 1024.0, 400_000.0, 400_000.5, 400_100.0, 2.0**30, 4.0**21, rng.uniform(0, 5000), rng.uniform(399_000, 401_000)])
    listings = [(k, rng.choice(["active", "active", "sold", None]), rng.choice(["n", "s", None]), rng.choice(["house", None]), price(), rng.choice([None, 0.0, 1.0, 2.5, 3.0, 12.0, 15.0])) for k in range(250)]
    searches = [(k, rng.choice(["n", None, None]), rng.choice(["house", None, None]), price(), price(), rng.choice([None, None, 0.0, 2.0, 2.5, 14.0])) for k in range(200)]
    searches += [(1000 + k, "n", None, 399_990.0 + k, None, None) for k in range(60)]
    listings, searches = listings + listings[:20] + [(None, "active", "n", "house", 400_050.0, 3.0)], searches + searches[:20] + [(None, None, None, None, None, None)]
    return (
        spark.createDataFrame(listings, "id bigint, status string, region_slug string, property_type string, price_usd double, bedrooms double"),
        spark.createDataFrame(searches, "search_id bigint, region_slug string, property_type string, min_price double, max_price double, min_beds double"))


@pytest.mark.parametrize("bits", [2, 10])
def test_blocks_of_matches_hold_each_match_once(spark, monkeypatch, bits):
    """Against all pairs, repeats counted, in blocks of 4 and of 1,024."""
    from collections import Counter

    monkeypatch.setattr(jobs, "BLOCK_BITS", bits)
    monkeypatch.setattr(jobs, "PAIRS_A_TASK", 1500)
    listings, searches = _listings_and_searches(spark)
    fits = lambda x, low, high: (low is None or (x is not None and x >= low)) and (high is None or (x is not None and x <= high))
    want = Counter(
        (x.id, s.search_id) for x in listings.collect() for s in searches.collect()
        if x.status == "active" and s.region_slug in (None, x.region_slug) and s.property_type in (None, x.property_type)
        and fits(x.price_usd, s.min_price, s.max_price) and fits(x.bedrooms, s.min_beds, None))
    blocks = jobs.saved_search_matches(listings, searches, blocks=True)
    assert Counter((r.id, r.search_id) for r in jobs.pairs(blocks).collect()) == want and sum(want.values()) > 4000
    most = blocks.agg(F.max(F.size("ids")), F.max(F.size("search_ids")), F.min(F.size("ids")), F.min(F.size("search_ids"))).first()
    assert most[0] <= 2**bits and most[1] <= 2**bits and min(most[2:]) > 0
    assert Counter((r.id, r.search_id) for r in jobs.saved_search_matches(listings, searches).collect()) == want
    assert jobs.pairs(jobs.saved_search_matches(listings, searches.limit(0), blocks=True)).count() == 0


def test_plain_matches_of_a_stream(spark):
    at, (listings, searches) = folder(spark), _listings_and_searches(spark, 6)
    listings.write.parquet(f"{at}/in")
    jobs.run_available(jobs.saved_search_matches(spark.readStream.schema(listings.schema).parquet(f"{at}/in"), searches).select("id", "search_id"), f"{at}/rows", f"{at}/state")
    got, want = spark.read.parquet(f"{at}/rows"), jobs.pairs(jobs.saved_search_matches(listings, searches, blocks=True))
    assert got.count() > 1000 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_saved_search_matches_stores_few_values_for_many_matches(spark, tmp_path):
    """The query's own tables: what its stream stores does not grow with listings times searches."""
    from pathlib import Path

    import pandas as pd

    from casona.plans import catalog

    catalog.load()
    n, m = 4000, 3000
    pd.DataFrame({
        "o_orderkey": range(n), "o_custkey": [10 + 12 * k for k in range(n)], "o_orderstatus": "O", "o_totalprice": [420_000.0 + k % 1000 for k in range(n)],
        "o_orderdate": pd.Timestamp("2024-01-01"), "o_orderpriority": "1-URGENT"}).to_parquet(tmp_path / "orders.parquet", index=False)
    pd.DataFrame({
        "c_custkey": range(1, m + 1), "c_name": "c", "c_nationkey": 2, "c_acctbal": [k % 900 * 1.0 for k in range(m)], "c_mktsegment": "x"}).to_parquet(tmp_path / "customer.parquet", index=False)
    before = set(Path(shared_folder(spark).removeprefix("file:")).glob("stream-*"))
    matches = catalog.QUERIES["saved_search_matches"](spark, str(tmp_path))
    (new,) = set(Path(shared_folder(spark).removeprefix("file:")).glob("stream-*")) - before
    stored = spark.read.parquet(f"{new}/rows")
    values = sum(stored.agg(F.sum(F.size(c) if kind.startswith("array") else F.lit(1))).first()[0] for c, kind in stored.dtypes if c != "batch")
    assert matches.count() > 1_000_000 and matches.distinct().count() == matches.count() and values < matches.count() / 50
