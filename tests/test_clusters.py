"""Clusters over batches against one run over all edges, and what a batch leaves alone."""

import random
import uuid

import pytest
from pyspark.sql import types as T

from casona.operators import graph
from casona.operators.clusters import ClusterTable
from casona.session import shared_folder
from casona.sources.buckets import BucketTable


def brute(edges):
    name = {}

    def find(x):
        while name.setdefault(x, x) != x:
            x = name[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            name[b] = a
    return {x: find(x) for x in name}


def frame(spark, edges):
    return spark.createDataFrame(edges, "a long, b long")


def table(spark, buckets=4):
    return ClusterTable(spark, f"{shared_folder(spark)}/clusters-{uuid.uuid4().hex}", T.LongType(), buckets)


def labels(df):
    return {r.id: r.cluster_id for r in df.collect()}


def test_batches_equal_one_run(spark):
    rng = random.Random(4)
    t, seen = table(spark), []
    for batch in range(3):
        edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(12)] + [(None, 3), (5, 5)]
        seen += edges
        assert t.add(batch, frame(spark, edges)) and not t.add(batch, frame(spark, [(0, 1)]))
        assert labels(t.read()) == brute(seen)
        members = {(r.cluster_id, r.id) for r in t.members.read().collect()}
        assert members == {(c, i) for i, c in brute(seen).items()}
    t.add(3, frame(spark, [(10_000, k) for k in range(60)]))
    assert set(labels(t.read()).values()) == {0}


def test_other_clusters_are_not_rewritten(spark):
    t = table(spark, 16)
    t.add(0, frame(spark, [(k, k + 1) for k in range(0, 100, 2)]))
    heads, members = t.heads.snapshot(), t.members.snapshot()
    t.add(1, frame(spark, [(10, 12), (200, 13)]))
    moved = {12: 10, 13: 10, 200: 10}
    assert {k: v for k, v in labels(t.read()).items() if k in moved} == moved
    of = lambda bt, name, values: set(bt.buckets_of(spark.createDataFrame([(v,) for v in values], f"{name} long")))
    now = t.heads.snapshot()
    assert {b for b in now.base if now.base[b] != heads.base.get(b)} == of(t.heads, "id", moved)
    now = t.members.snapshot()
    assert {b for b in members.base if now.base.get(b) != members.base[b]} <= of(t.members, "cluster_id", [10, 12])


def test_crash_between_the_tables(spark, monkeypatch):
    t = table(spark)
    t.add(0, frame(spark, [(1, 2), (3, 4)]))
    merge = BucketTable.merge

    def dies(self, *a):
        if self is t.members:
            raise RuntimeError("lost")
        return merge(self, *a)

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "merge", dies)
        with pytest.raises(RuntimeError):
            t.add(1, frame(spark, [(2, 4), (5, 6)]))
    assert t.add(1, frame(spark, []))
    assert labels(t.read()) == brute([(1, 2), (3, 4), (2, 4), (5, 6)])
    assert {(r.cluster_id, r.id) for r in t.members.read().collect()} == {(c, i) for i, c in labels(t.read()).items()}


def test_hot_nodes_are_met_by_broadcast(spark, monkeypatch):
    edges = [(0, k) for k in range(1, 3000)] + [(k, k + 10_000) for k in range(1, 3000, 3)] + [(20_000 + k, 20_001 + k) for k in range(40)]
    want = brute(edges)
    assert {r.id: r.component for r in graph.connected_components(frame(spark, edges)).collect()} == want
    stars = frame(spark, [(b, a) for a, b in edges]).toDF("hi", "lo")
    plan = graph._large_star(stars, 1000)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan or "strategy=broadcast" in plan


def test_rounds_of_few_edges_have_small_plans(spark, monkeypatch):
    """The driver holds the plan of every round: three shuffles, no join."""
    plans = []

    def seen(df, kept=graph.checkpoint):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df)

    monkeypatch.setattr(graph, "checkpoint", seen)
    edges = [(0, k) for k in range(1, 2000)] + [(k, k + 10_000) for k in range(1, 2000, 3)] + [(20_000 + k, 20_001 + k) for k in range(40)]
    assert {r.id: r.component for r in graph.connected_components(frame(spark, edges)).collect()} == brute(edges)
    assert len(plans) > 2 and not any("Join" in p for p in plans) and max(p.count("Scan ExistingRDD") for p in plans[1:]) == 1


@pytest.mark.parametrize("few", [0, 10**6])
def test_rounds_of_few_and_of_many_edges_agree(spark, monkeypatch, few):
    rng = random.Random(few)
    monkeypatch.setattr(graph, "FEW_EDGES", few)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(None, 3), (3, None), (None, None), (7, 7), (900, 901), (901, 900), (900, 901)]
    rows = graph.connected_components(frame(spark, edges)).collect()
    assert len(rows) == len({r.id for r in rows}) and {r.id: r.component for r in rows} == brute(edges)
    names = spark.createDataFrame([("c", "b"), ("d", "c"), ("x", "y"), ("b", "d")], "a string, b string")
    assert {(r.id, r.component) for r in graph.connected_components(names).collect()} == {*((c, "b") for c in "bcd"), ("x", "x"), ("y", "x")}
