"""Mixing against a direct computation."""

import math
import re

import pytest
from pyspark.sql import functions as F

from casona.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while True:
        rest, share = total - sum(out.values()), sum(w[s] for s in free)
        over = {s for s in free if rest * w[s] > most * sizes[s] * share}
        if not over:
            return {**out, **{s: rest * w[s] / share for s in free}}
        out.update({s: most * sizes[s] for s in over})
        free -= over


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def rows(n=400):
    out = [(i, "word " * (i * 7 % 50) + "!!" * (i % 3), ["a", "b", "c", None, "é", "Z"][(i * i) % 6 if i % 3 else 0], 1) for i in range(n)]
    return out + [(None, "x y z", "a", 1), (3, "x y z", "a", 1), (3, "x y z", "a", 1), (900, None, "b", 1), (901, "", "only empty", 1), (902, "q " * 30000, "big", 1)]


@pytest.mark.parametrize("data", [rows(), rows(0), [(1, None, None, 1)], [(1, "a b", "s", 1)]])
def test_plan(spark, data):
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    plan = mixing.mix(docs).collect()
    sizes = {}
    for _, t, s, _ in data:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    assert len(plan) == len(data)
    taken = {}
    for r in plan:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken >= r.target // max(1, r.source_size) * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert t == math.floor(want[s] + 1e-9) or abs(t - want[s]) <= 1
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, plan), key=repr)


def test_weighted_draw_prefers_heavy_documents(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    heavy = F.when(F.col("doc_id") % 4 < 2, 1.0).otherwise(0.25)
    plan = mixing.mix(docs, weight=heavy).filter("source = '0' AND taken > 0")
    share = plan.filter("doc_id % 4 < 2").count() / plan.count()
    assert 0.6 < share < 0.75  # a third of the words of two equal sources


def test_documents_of_the_mix(spark):
    data = rows(60)
    docs = spark.createDataFrame([(d, t, s, len(t or "")) for d, t, s, _ in data if d != 3], "doc_id long, text string, source string, n_chars long")
    plan = mixing.mix(docs)
    out = mixing.mixed(docs, plan)
    assert out.columns == docs.columns
    want = {r.doc_id: r.taken for r in plan.collect() if r.taken}
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + words(r.text)
        assert r.n_chars == len(r.text)
    assert got == want


def test_null_and_repeated_ids_give_their_own_words(spark):
    """A word of its own in each text tells what of it came out."""
    sizes = {(None, "a"): [1000, 10, 40], (None, "b"): [300, 7], (None, None): [25], (5, "a"): [60, 11], (5, "b"): [90], (6, "c"): [400], (7, "d"): [3, 2]}
    data = [(d, f"w{n} " * n, s, len(f"w{n} " * n)) for (d, s), ns in sizes.items() for n in ns] + [(None, None, "a", 0), (None, "", "b", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, n_chars long")
    plan = mixing.mix(docs)
    want = {(r.doc_id, r.source, r["size"]): r.taken for r in plan.collect() if r.taken}
    assert len(want) < sum(map(len, sizes.values()))  # some give nothing
    got = {}
    for r in mixing.mixed(docs, plan).collect():
        n = int(r.text.split()[0][1:])
        got[r.doc_id, r.source, n] = got.get((r.doc_id, r.source, n), 0) + words(r.text)
    assert got == want


@pytest.mark.parametrize("copies", [2, 7, 40])
def test_equal_rows_share_what_is_taken(spark, copies):
    """Rows equal in id, source and text: all words of the plan come out, and one row of a source is cut at most."""
    data = [(None, "x y z", "a", 5, f"l{i % 3}") for i in range(copies)] + [(i, "q " * 11, "b", 22, "en") for i in range(9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, n_chars long, lang string")
    plan = mixing.mix(docs)
    taken = {}
    for r in plan.collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    got, cut = {}, {}
    for r in mixing.mixed(docs, plan).collect():
        got[r.source] = got.get(r.source, 0) + words(r.text)
        cut[r.source] = cut.get(r.source, 0) + (words(r.text) < {"a": 3, "b": 11}[r.source])
    assert got == {s: n for s, n in taken.items() if n} and max(cut.values()) <= 1
