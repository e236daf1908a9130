"""Links between vectors against all pairs."""

import numpy as np
import pytest

from casona.operators import neighbours

SCHEMA = "id long, embedding array<double>, v int, node string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def usable(i, v):
    return i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, t):
    out = []
    for a, (i, v) in enumerate(rows):
        if not usable(i, v):
            out.append((i, i, 1, 0))
            continue
        same = [j for j, w in rows if usable(j, w) and list(v) == list(w)]
        links = sum(
            usable(j, w) and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= t - 1e-12
            for b, (j, w) in enumerate(rows) if a != b)
        out.append((i, min(same), len(same), int(links)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    heads = rng.normal(size=(12, 8))
    found = [(i, [float(x) for x in heads[i % 12] + rng.normal(size=8) * (0.3 if i % 2 else 0.02)]) for i in range(240)]
    found += [(1000 + i, found[5][1]) for i in range(300)]  # equal rows
    found += [(2000 + i, [float(x) for x in heads[1] * (i + 1) + rng.normal(size=8) * 1e-3]) for i in range(100)]  # one crowded bucket
    found += [(7, found[9][1]), (7, found[9][1]), (3000, None), (3001, []), (3002, [0.0] * 8), (3003, [1.0, None]), (3004, [float("nan"), 1.0]),
              (None, found[0][1]), (3005, [1.0, 2.0]), (3006, [2.0, 4.0]), (3007, [1e100, 2e100])]
    return found


def test_rows_with_their_links(spark, rows):
    found = neighbours.lsh_neighbours(frame(spark, rows), 0.9, missed=1e-6, chunk_rows=32)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, 0.9)


def test_links_of_classes(spark, rows):
    unique = list({i: (i, v) for i, v in rows if i is not None}.values())
    links, members = neighbours.lsh_links(frame(spark, unique), 0.9, missed=1e-6, chunk_rows=32)
    good = [r for r in unique if usable(*r)]
    head = {}
    for i, v in sorted(good):
        head.setdefault(tuple(v), i)
    want = {
        (min(a, b), max(a, b)) for v, a in head.items() for w, b in head.items()
        if a < b and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9}
    got = [(r.a, r.b) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {r.id: r.class_id for r in members.collect()} == {i: head[tuple(v)] for i, v in good}


def test_no_rows(spark):
    assert neighbours.lsh_neighbours(frame(spark, []), 0.9).count() == 0


def test_equal_rows_make_no_pairs(spark):
    links, members = neighbours.lsh_links(frame(spark, [(i, [1.0, 2.0]) for i in range(3000)]), 0.9)
    assert links.count() == 0 and members.count() == 3000


@pytest.mark.parametrize("cosine", [0.9, 0.8])
def test_recall_with_the_bands_of_a_large_table(spark, cosine):
    rng = np.random.default_rng(4)
    a, z = rng.normal(size=(2, 400, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = (cosine + 1e-6) * a + np.sqrt(1 - (cosine + 1e-6) ** 2) * z
    df = frame(spark, [(int(i), [float(x) for x in v]) for i, v in enumerate(np.vstack([a, b]))])
    _, bands = neighbours.plan_bands(10**9, cosine, 1e-3, 64, 5)
    assert bands <= 64
    links = {(r.a, r.b) for r in neighbours.lsh_links(df, cosine, planned_rows=10**9)[0].collect()}
    assert sum((i, i + 400) in links for i in range(400)) >= 396


@pytest.mark.parametrize("pairs", [True, False])
def test_all_pairs_give_what_bands_give(spark, rows, pairs):
    usable_rows = frame(spark, rows).filter("embedding IS NOT NULL AND size(embedding) > 0 AND id < 3000").selectExpr("id", "embedding v")
    classes = neighbours.vector_classes(usable_rows)
    got = neighbours._all_pairs(classes, 0.9, 10**5, pairs)
    banded = neighbours._tiles(classes, 0.9, 1e-6, 64, 5, 32, 10**9, pairs)

    def key(df):
        if pairs:
            return sorted((min(r.x, r.y), max(r.x, r.y), round(r.similarity, 9)) for r in df.collect())
        return sorted(map(tuple, df.groupBy("node").sum("n_links").collect()))

    assert key(got) == key(banded) and len(key(got)) > 100


def test_short_bands_give_way_to_all_pairs():
    """Bands for a cosine of 0.4 made 64 * 32 entries of every row; all pairs copy a row 24 times, at any size."""
    for rows in (10**4, 10**5, 6 * 10**5, 10**8):
        bits, bands = neighbours.plan_bands(rows, 0.4, 1e-9, 64, 5)
        assert neighbours.all_pairs_cheaper(rows, bits, bands, 5)
    bits, bands = neighbours.plan_bands(10**7, 0.9, 1e-3, 64, 5)
    assert not neighbours.all_pairs_cheaper(10**7, bits, bands, 5)
