"""Forms of operators that large tables need, on rows of their own."""

import math

import numpy as np
import pytest

from casona.operators import entity_resolution as er, graph, neighbours, photos as ph, ranking, upsert as up
from casona.plans import queries_extraction
from casona.plans.standins import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<double>")


@pytest.mark.parametrize("all_pairs", [True, False, None])
def test_cross_links_are_those_of_all_pairs(spark, all_pairs):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    q = centres[rng.integers(0, 6, 150)] + rng.normal(size=(150, 12)) * 0.3
    b = np.vstack([q[:40], centres[rng.integers(0, 6, 160)] + rng.normal(size=(160, 12)) * 0.3])
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    cosines = unit(q) @ unit(b).T
    want = {(i, j % 190): cosines[i, j] for i, j in zip(*np.nonzero(cosines >= 0.9))}  # ids 0 to 9 twice
    rows = lambda m, n: [(i % n, [float(x) for x in v]) for i, v in enumerate(m)]
    bad = [(900, None), (901, [0.0] * 12), (None, [1.0] * 12), (902, [1.0, 2.0])]
    got = neighbours.cross_links(vectors(spark, rows(q, 150) + bad), vectors(spark, rows(b, 190) + bad), 0.9, missed=1e-9, all_pairs=all_pairs).collect()
    near = [r for r in got if r.query_id != 902]
    assert {(r.query_id, r.base_id) for r in near} == set(want) and len(near) == (cosines >= 0.9).sum()
    assert [(r.query_id, r.base_id) for r in got if r.query_id == 902] == [(902, 902)]
    assert all(any(math.isclose(r.similarity, c, abs_tol=1e-9) for c in cosines[r.query_id, r.base_id::190]) for r in near)


def test_candidates_below_the_threshold_are_not_shuffled(spark):
    df = vectors(spark, [(i, [1.0, float(i % 3)]) for i in range(9)])
    text = plan(er.lsh_candidates(df, df, 0.99))
    assert "keys=[query_id" not in text and "bands" not in text


def photo_rows(spark):
    rows = [(k, i, f"u{i:03d}", "logo" if i % 4 == 0 else None) for k, n in ((1, 40), (2, 3), (3, 1), (None, 5)) for i in range(n)]
    photos = spark.createDataFrame(rows, "listing_id long, position int, url string, reject_reason string")
    existing = spark.createDataFrame([(1, "x", 6, False, False), (2, "y", 2, True, False)], "listing_id long, url string, position int, is_hero boolean, is_rejected boolean")
    return photos, existing, spark.createDataFrame([(1, 9), (3, 0)], "listing_id long, hero_index int")


def test_positions_are_the_same_for_large_listings(spark, monkeypatch):
    found = []
    for most in (10_000, 4):
        monkeypatch.setattr(ranking, "MOST_ROWS", most)
        found.append(sorted(map(str, ph.assign_positions(*photo_rows(spark)).collect())))
        assert (ranking.by_size(photo_rows(spark)[0], ["listing_id"], "t")[1] is None) == (most == 10_000)
    assert found[0] == found[1] and len(found[0]) == 49
    heroes = [r for r in ph.assign_positions(*photo_rows(spark)).collect() if r.is_hero]
    assert [(r.listing_id, r.url, r.position) for r in heroes] == [(1, "u009", 16)]


def test_photos_are_shuffled_once_to_get_their_positions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ph.assign_positions(*photo_rows(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning" in line for line in text.splitlines()) <= 3  # photos, stored ones, choices


def test_raw_rows_are_sorted_by_the_key_that_tells_them_apart(spark):
    raw = spark.createDataFrame([("s", "1", "a", 1)], "source string, source_listing_id string, url string, scraped_at long")
    text = plan(up.upsert_raw(raw, raw))
    assert "hashpartitioning(source_listing_id" in text and "hashpartitioning(source#" not in text


def test_pages_of_a_run_are_assembled_once(spark, monkeypatch):
    labels = []

    def seen(df, label):
        labels.append(label)
        if label == "replies":
            raise KeyError(label)
        return df

    monkeypatch.setattr(queries_extraction, "stored", seen)
    with pytest.raises(KeyError):
        queries_extraction.joined_run(Tables(spark, "/root/testdata/sf0.001"))
    assert labels == ["payloads", "replies"]


def test_few_edges_have_few_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = graph.connected_components(spark.createDataFrame([(i, i + 1) for i in range(30) if i != 14], "a long, b long"))
        assert found.rdd.getNumPartitions() <= 1 + 8
        assert {(r.id, r.component) for r in found.collect()} == {(i, 0 if i < 15 else 15) for i in range(31)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
