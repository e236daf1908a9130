"""The joined run: repeats, crashes between a stage's commits, skipped stages and rows left for later."""

import uuid

import pytest
from pyspark.sql import functions as F

from casona.functions import money
from casona.operators import entity_resolution as er, extraction as ex
from casona.plans.warehouse import RAW, Warehouse
from casona.session import shared_folder
from casona.sources.buckets import BucketTable

def at():
    return F.lit("2024-06-01").cast("timestamp")


SIDES = ["title", "price_usd", "bedrooms", "bathrooms", "lot_sqm", "interior_sqm", "locality", "canton", "property_type", "mls_id", "listing_agent_name", "address_line", "lat", "lng"]


def finder(new, canonical):
    side = lambda df, x, key: df.withColumn("title", F.col("title")).select(F.col("id").alias(key), F.col("address_line").alias(f"_{x}"), *(F.col(c).alias(f"{x}_{c}") for c in SIDES))
    return side(new, "a", "query_id").join(side(canonical.withColumn("title", F.col("title_en")), "b", "base_id"), F.col("_a") == F.col("_b")).withColumn("rank", F.lit(1))


@pytest.fixture(scope="module")
def given(spark):
    pages = spark.createDataFrame(
        [("s", f"p{k}", f"https://s/p{k}", f"<html>{k}</html>", "{}", None, [(f"https://s/{k}.jpg", 0), ("https://s/logo/x.svg", 1)]) for k in range(6)],
        "source string, source_listing_id string, source_url string, raw_html string, raw_extracted string, breadcrumbs array<string>, photos array<struct<url:string,position:int>>",
    ).withColumn("scraped_at", F.lit("2024-05-01").cast("timestamp"))
    number = F.substring("source_listing_id", 2, 1).cast("int")
    reply = F.to_json(F.struct(
        F.concat(F.lit("Casa "), number % 4).alias("title"), F.lit("en").alias("language"), F.lit(1000).alias("price"), F.lit("USD").alias("price_currency"),
        F.lit(2).alias("bedrooms"), F.lit(500).alias("lot_sqm"), F.lit("Nosara").alias("locality"), F.lit("house").alias("property_type")))
    replies = pages.select(ex.prompt_key("raw_html", "raw_extracted", "breadcrumbs", "source_url").alias("prompt_key"), reply.alias("reply"), number.alias("k")).cache()
    copy = spark.createDataFrame([], "id string, title_en string, title_es string, description_en string, description_es string, rewritten_en string, rewritten_es string")
    tags = spark.createDataFrame([], "id string, features array<string>, tags array<string>")
    return pages.cache(), replies, {"copy": copy, "tags": tags}


def house(spark, path=None):
    return Warehouse(
        spark, path or f"{shared_folder(spark)}/house-{uuid.uuid4().hex}", rates=money.rate_table(spark), finder=finder,
        judge=lambda pairs: er.score_pairs(er.pair_features(pairs)), buckets=2, dim=16)


def tables(w):
    return [w.raw, w.canonical, w.links, w.embeddings, w.photos]


def test_runs_take_up_what_failed_and_repeats_change_nothing(spark, given):
    pages, replies, more = given
    w = house(spark)
    w.run("a", at(), pages, responses=replies.filter("k < 3"), **more)
    raw = {r.source_listing_id: (r.extract_status, r.publish_status, r.error) for r in w.raw.read().collect()}
    assert raw == {f"p{k}": ("done", "done", None) if k < 3 else ("failed", "pending", "no reply") for k in range(6)}
    versions = [t.snapshot().version for t in tables(w)]
    again = house(spark, w.path)  # as another process would open it
    again.run("a", at(), pages.limit(1), responses=replies, **more)
    assert [t.snapshot().version for t in tables(again)] == versions
    with pytest.raises(ValueError):
        again.run("b", at(), stages=("guess",))
    again.run("b", at(), responses=replies, **more)
    rows = {r.run_id + r.stage + r.status: r.rows for r in again.outcomes().collect()}
    assert rows["aextractdone"] == 3 and rows["aextractfailed"] == 3 and rows["bextractdone"] == 3 and "bextractfailed" not in rows and rows["bpublishdone"] == 3
    assert {r.publish_status for r in again.raw.read().collect()} == {"done"}
    # 4 and 5 say what 0 and 1 said in the run before: they are merged into these
    listings = {r.title_en: r for r in again.canonical.read().collect()}
    assert set(listings) == {"Casa 0", "Casa 1", "Casa 2", "Casa 3"}
    links = again.links.read().groupBy("canonical_id").agg(F.count("*").alias("n"), F.min("method").alias("m")).collect()
    assert sorted((r.n, r.m) for r in links) == [(1, "no_match"), (1, "no_match"), (2, "no_match"), (2, "no_match")]
    assert again.embeddings.read().count() == 4
    assert {k: r.photo_count for k, r in listings.items()} == {"Casa 0": 2, "Casa 1": 2, "Casa 2": 1, "Casa 3": 1}
    photos = again.photos.read().groupBy("listing_id").agg(F.sort_array(F.collect_list("position")).alias("p"), F.count_if("is_hero").alias("h")).collect()
    assert sorted((r.p, r.h) for r in photos) == [([0, 1], 1), ([0, 1], 1), ([0, 1, 2], 1), ([0, 1, 2], 1)]


def test_crash_anywhere_is_made_good_by_the_same_run(spark, given, monkeypatch):
    pages, replies, more = given
    w, commit, left = house(spark), BucketTable._commit, [0]

    def dies(self, old, new):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("lost")
        commit(self, old, new)

    monkeypatch.setattr(BucketTable, "_commit", dies)
    crashes = 0
    for survive in (1, 2, 1, 3, 3, 1, 2, 1, 1, 2, 1, 9):  # commits until the next crash
        left[0] = survive
        try:
            w.run("a", at(), pages, responses=replies, **more)
            break
        except RuntimeError:
            crashes += 1
    assert crashes > 5
    assert {r.publish_status for r in w.raw.read().collect()} == {"done"}
    assert w.canonical.read().count() == 4 and w.links.read().count() == 6 and w.embeddings.read().count() == 4
    assert w.canonical.read().agg(F.sum("photo_count")).first()[0] == 6
