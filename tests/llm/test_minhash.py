"""Near-dedup against all pairs, on odd rows and on groups of copies."""

import random

import numpy as np
import pyarrow as pa
import pytest

from casona.llm.minhash_dedup import Sketch, near_copies, _common


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {b" ".join(w)} if 0 < len(w) < k else {b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    """doc -> (set sizes, component), by comparing all pairs."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets), key=repr)


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed=5):
    rng = random.Random(seed)
    rows = []
    for group in range(12):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([8, 20, 60, 150, 600]))]
        for _ in range(rng.choice([1, 2, 5, 30])):
            rows.append(edited(base, rng.randrange(0, max(2, len(base) // 12)), rng))
    rows += ["A b C d", "a B c D", "one", "ONE", "one two", "", None, " \t\n", "one two", "x" * 30000, "x y " * 5000, "x y " * 4000]
    ids = rng.sample(range(-50, 10000), len(rows))
    return list(zip(ids, rows))


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("k,percent,bands,rows", [(3, 85, 40, 7), (5, 80, 48, 6)])
def test_like_all_pairs(spark, k, percent, bands, rows):
    data = corpus() + [(None, "A b C d"), (77777, "one"), (77777, "a b c d"), (77777, "a b c d")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in data], "doc_id long, text string, n int, node int")
    assert result(near_copies(docs, Sketch(k, percent, bands, rows))) == brute(data, k, percent)


def test_large_group_of_near_copies(spark):
    """Copies of one text with edits of their own: linked pairs, unlinked pairs, and several tiles."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    data = [(i, edited(base, rng.randrange(0, 9), rng)) for i in rng.sample(range(10**6), 500)] + [(i, " ".join(base)) for i in range(10**6, 10**6 + 300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert result(near_copies(docs)) == brute(data, 3, 85)


@pytest.mark.parametrize("texts", [["one"], ["one", None], ["a b", ""], [None], [" "], ["a b c"], ["a", "b"]])
def test_few_words(texts):
    sketch = Sketch(5, 80, 48, 6)
    got = [s for _, sets in sketch.shingles(pa.array(texts, pa.string())) for s in sets]
    assert [len(s) for s in got] == [len(shingles(t, 5)) for t in texts]


def test_no_documents(spark):
    assert near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registers_estimate_similarity():
    sketch, rng = Sketch(), np.random.default_rng(1)
    for n in (7, 40, 300, 3000):
        shared = rng.integers(0, 2**63, int(n * 0.8), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, n - len(shared), dtype=np.uint64)])) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        ra, rb = sketch.registers_of([a, b])
        got = sketch.estimate(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(got - true) < 0.15
    c = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
    ra, rc = sketch.registers_of([a, c])
    assert abs(sketch.estimate(ra[None], rc[None], np.array([3000.0]), np.array([500.0]))[0]) < 0.05


def test_common_counts():
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3], [2, 3, 4], [9], [1, 9])]
    got = _common(sets, step=2)
    assert [[int(got[i, j]) for j in range(4) if j != i] for i in range(4)] == [[2, 0, 1], [2, 0, 0], [0, 0, 1], [1, 0, 1]]


def test_texts_of_batches_are_whole():
    sketch = Sketch()
    texts = ["a b c d e"] * 3 + ["q " * 700000] + ["a b c d e"]
    out = {}
    for first, sets in sketch.shingles(pa.array(texts)):
        out.update({first + i: s.tolist() for i, s in enumerate(sets)})
    assert out[0] == out[2] == out[4] and len(out[0]) == 3 and len(out[3]) == 1


@pytest.mark.parametrize("bits", [5, 8, 10, 11])
def test_regular_words_are_told_apart(spark, bits):
    """Words that polynomial hashes modulo 2^64 take for equal, alone and inside texts."""
    from tests.llm.test_tokens import thue_morse

    a, b = thue_morse(bits)
    rows = [(1, a), (2, b), (3, f"{a} {a} {b} end"), (4, f"{b} {b} {a} end"), (5, a)]
    got = sorted(map(tuple, near_copies(spark.createDataFrame(rows, "doc_id long, text string"), Sketch()).collect()))
    assert got == brute(rows, 3, 85) and [r[2] for r in got] == [1, 2, 3, 4, 1]
