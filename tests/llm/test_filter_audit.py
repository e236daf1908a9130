"""The audit against plain counting, and the tries against sets."""

from collections import Counter
from itertools import permutations

from hypothesis import given, settings, strategies as st

from casona.llm import filter_audit

LONG = " ".join(f"word{k}" for k in range(120))
CAPS = " ".join(f"WORD{k}" for k in range(120))


def mask(text):
    words, out = text.encode().split(), 0
    out += len(words) < 100
    out += 2 * (100 * len(set(words)) < 80 * len(words))
    out += 4 * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text))
    return out + 8 * any(c in "#$%&*|" for c in text)


def brute(rows, labels):
    """(part, order, step) -> counts, by running each order over every document."""
    found = []
    for doc_id, part, text in rows:
        dup = doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, _, t in rows)
        mine = [x for x in labels if doc_id is not None and x[0] == doc_id]
        found.append((part or "", mask(text or "") + 16 * dup, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        left = list(found)
        for step, letter in enumerate(order, 1):
            bit = 1 << "ABCDE".index(letter)
            gone = [f for f in left if f[1] & bit]
            left = [f for f in left if not f[1] & bit]
            for part in {f[0] for f in found}:
                here = [f for f in gone if f[0] == part]
                fails = [f for f in found if f[0] == part and f[1] & bit]
                out[part, "".join(order), step] = [
                    sum(f[0] == part for f in left), len(here), len(fails) - len(here), sum(f[1] == bit for f in fails),
                    sum(f[2] for f in here), sum(f[3] for f in here), (part, letter)]
                shapley[part, letter] += len(here)
    return {k: tuple(v[:-1]) + (shapley[v[-1]],) for k, v in out.items()}


ROWS = [
    (5, "en", LONG), (3, "en", LONG), (9, None, LONG), (3, "de", LONG), (None, "en", LONG), (None, "de", None), (1, "", None), (2, "en", ""),
    (4, "en", CAPS), (6, "de", CAPS + " x"), (7, "de", CAPS + " #"), (8, "fr", "short | text"), (10, "fr", "a b " * 80), (10, "fr", "é" * 9 + "A"),
    (11, "fr", "é" * 8 + "AA"), (12, "en", LONG + " x"), (13, "en", LONG + "\x0bx"), (14, "en", LONG), (15, "en", LONG + " y"), (-1, "en", "short | text"),
]
LABELS = [(5, 1, 0), (9, 0, 1), (9, 1, None), (14, 1, 1), (8, 1, 1), (None, 1, 1), (4, None, None), (99, 1, 1), (6, 0, 1)]


def audited(spark, rows, labels, **how):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, lang string, text string, owner string, mask int").repartition(3)
    table = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, part int")
    result = filter_audit.audit(filter_audit.failures(docs, **how), table)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in result.collect()}


def test_every_order(spark, monkeypatch):
    want = brute(ROWS, LABELS)
    assert len(want) == 4 * 120 * 5
    assert audited(spark, ROWS, LABELS) == want
    assert audited(spark, ROWS, LABELS, leaf=8, grain=8) == want  # ranges by prefixes as long as the texts
    assert audited(spark, ROWS, LABELS, leaf=8, grain=8, most=2) == want
    monkeypatch.setattr(filter_audit, "LOCAL", 1)  # every row in a trie of its own
    assert audited(spark, ROWS, LABELS, leaf=200, grain=50) == want


def test_no_rows_and_no_labels(spark):
    assert audited(spark, [], LABELS) == {}
    assert audited(spark, ROWS[:3], []) == brute(ROWS[:3], [])


def test_prefixes_of_crowded_ranges_grow(spark):
    rows = [(k, "en", LONG * 3 + str(k % 40)) for k in range(80)] + [(100 + k, "en", str(k)) for k in range(20)]
    texts = filter_audit._read(spark.createDataFrame(rows, "doc_id long, lang string, text string"), "doc_id", "text", "lang").filter("text IS NOT NULL").cache()
    deep, leaves = filter_audit._deep(texts, 20_000, 20_000, 1000)
    assert len(deep) == 5 and leaves > 1  # the shared levels of 8 to 2048 bytes, none of the short texts'
    deep, leaves = filter_audit._deep(texts, 20_000, 20_000, 2)
    assert leaves <= 2 and len(deep) <= 2 * len(filter_audit.LEVELS)
    result = {r.doc_id: r.mask >> 4 for r in filter_audit.failures(spark.createDataFrame(rows, "doc_id long, lang string, text string"), leaf=20_000, grain=20_000).collect()}
    assert result == {k: int(40 <= k < 80) for k, _, _ in rows}


@settings(max_examples=300, deadline=None)
@given(rows=st.lists(st.tuples(st.one_of(st.text("ab", max_size=12), st.binary(max_size=6).map(lambda b: b.hex())), st.one_of(st.none(), st.integers(-5, 5)))))
def test_tries(rows):
    trie, want = filter_audit.Trie(), {}
    for text, least in rows:
        assert trie.insert(text.encode(), least) is trie.insert(text.encode(), None)
        trie.insert(text.encode(), least).owners.append(text)
        want[text] = min((x for x in (want.get(text), least) if x is not None), default=None)
    assert {n.owners[0]: n.least for n in trie.terminals()} == want
    waiting = [trie.root]
    while waiting:  # compressed: no node but the root and terminals has a single child
        node = waiting.pop()
        assert node is trie.root or node.owners is not None or len(node.below) > 1
        waiting.extend(node.below.values())
