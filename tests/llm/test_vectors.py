"""Top-k search and vector dedup against all pairs."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from casona.llm import topk_search, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int, grp int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def brute_top(rows, k, scale=64):
    terms = [
        (i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, t) in enumerate(terms):
        if q % 5 == 0:
            scored = sorted((-sum(x * y for x, y in zip(t, u)), c) for b, (c, u) in enumerate(terms) if a != b)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    return sorted(out)


ODD = [
    (None, [1.0, 2.0], 1), (1001, None, 1), (1005, [1.0, None], 1), (1010, [float("nan"), 1.0], 1), (1015, [float("inf"), 1.0], 1),
    (1020, [], 1), (1025, [0.0, 0.0], 1), (1030, [0.5, -0.5], None), (1035, [3e30, 1.0], 1), (1036, [3e30, 1.0], 1),
]


@pytest.mark.parametrize("rows,scale", [(ODD[:-2], 64), (ODD[:3], 64), ([], 64)])
def test_top_k_of_odd_rows(spark, rows, scale):
    rng = np.random.default_rng(2)
    data = [(int(i), [float(x) for x in v], 0) for i, v in enumerate(rng.normal(0, 1, (60, 2)))] if rows else []
    data += rows + data[:3] + [(7, [9.0, 9.0], 0)] * bool(rows)
    found = topk_search.top_k(frame(spark, data), F.col("vec_id") % 5 == 0, k=4, scale=scale, shard_rows=16, query_rows=4)
    assert sorted(map(tuple, found.collect())) == brute_top(data, 4, scale)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 700), st.integers(1, 6), st.integers(1, 30), st.sampled_from([1, 50, 10**5, 10**9]))
def test_best_scores(seed, n, dims, k, size):
    rng = np.random.default_rng(seed)
    c, q = rng.integers(-size, size + 1, (n, dims)), rng.integers(-size, size + 1, (5, dims))
    ids = rng.permutation(n)
    q_ids = np.array([int(ids[0]), -1, -2, -3, -4])
    qi, got, scores = topk_search.best_scores(q, q_ids, c, ids, ids, k)
    want = []
    for i in range(5):
        rows = sorted((-sum(int(a) * int(b) for a, b in zip(q[i], c[j])), int(ids[j])) for j in range(n) if ids[j] != q_ids[i])[:k]
        want += [(i, d, -s) for s, d in rows]
    assert list(zip(qi.tolist(), got.tolist(), scores.tolist())) == want


def test_rows_that_repeat_an_id_are_candidates(spark):
    data = [(20, [1.0, 0.0], 0), (20, [0.0, 1.0], 0), (21, [1.0, 1.0], 0)]
    found = topk_search.top_k(frame(spark, data), F.col("vec_id") % 20 == 0, k=5)
    assert sorted(map(tuple, found.collect())) == [(20, 1, 21, 4096), (20, 1, 21, 4096), (20, 2, 20, 0), (20, 2, 20, 0)]


def test_most_postings_are_skipped():
    rng = np.random.default_rng(8)
    fall = 0.8 ** np.arange(64)
    c = np.floor(640 * rng.normal(size=(4096, 64)) * fall).astype(np.int64)
    shard = topk_search.Shard(c.astype(float), np.arange(4096))
    for i in range(0, 4096, 128):
        rows, scores = shard.best(c[i].astype(float), i, 20)
        full = c @ c[i]
        full[i] = full.min()
        assert rows.tolist() == np.lexsort((np.arange(4096), -full))[:20].tolist() and scores.tolist() == full[rows].tolist()
    pairs = 32 * 4096 * 64
    assert shard.postings < pairs / 8 and shard.products < pairs / 4


def brute_links(rows, t=0.93):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and g is not None and i is not None for i, v, g in rows]
    root, count = {r[0]: r[0] for r in rows}, [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, v, g) in enumerate(rows):
        for b, (j, w, h) in enumerate(rows[:a]):
            if ok[a] and ok[b] and g == h and len(v) == len(w):
                x, y = (np.array(u, np.float32).astype(float) for u in (v, w))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= t:
                    count[a] += 1
                    count[b] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    return sorted(((r[0], n, None if r[0] is None else find(r[0]), r[0] is None or find(r[0]) == r[0]) for r, n in zip(rows, count)), key=repr)


def test_vector_links(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (8, 6))
    data = []
    for i in range(300):
        v = base[i % 8] + rng.normal(0, 0.25, 6)
        data.append((int(rng.integers(0, 10**6)), [float(np.float32(x)) for x in v], int(i % 3)))
    data += [(10**7 + i, data[0][1], data[0][2]) for i in range(200)]  # a hot copy
    data += [(data[5][0], data[9][1], data[9][2]), data[7]]  # repeated ids
    data += [r for r in ODD if r[0] != 1035 and r[0] != 1036] + [(5, [1e-30, 2e-30], 1), (6, [1e30, 2e30], 1), (8, [-1.0, -2.0], 1)]
    found = vector_dedup.near_copies(frame(spark, data), block_rows=64).collect()
    assert sorted(map(tuple, found), key=repr) == brute_links(data)


def test_no_vectors(spark):
    assert vector_dedup.near_copies(frame(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.floats(1e-3, 1e3))
def test_bound_never_hides_a_link(seed, dims, scale):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 1, (30, dims)) * scale
    b = a + rng.normal(0, 0.2 * scale, a.shape)
    ones = np.ones(30, np.int64)
    where, count, _ = vector_dedup.linked(a, ones, b, ones, 0.93, same=False)
    cos = (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
    if np.abs(cos - 0.93).min() > 1e-9:
        want = np.concatenate([(cos >= 0.93).sum(axis=1), (cos >= 0.93).sum(axis=0)])
        got = np.zeros(60, np.int64)
        got[where] = count
        assert (got == want).all()
