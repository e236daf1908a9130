"""The two networks: gradients, held-out accuracy, whole texts, odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casona.llm import language_net, quality_net
from casona.llm.queries import QUERIES, table

ROOT = "/root/testdata/sf0.1"


def test_language_gradients():
    net = language_net.Net(["a", "b", "c"])
    x, y = np.frombuffer(b"abcdefghiabc", np.uint8).reshape(3, 4), np.array([0, 1, 2])
    g = net.gradients(x, y)
    loss = lambda: -np.log(net.positions(x)[:, np.arange(3), y]).mean()
    for key, at in (("uf", (3, 20)), ("ub", (1, 30)), ("xf", (98, 5)), ("xb", (100, 33)), ("cf", (30,)), ("cb", (3,)), ("out", (5, 1)), ("out_b", (2,))):
        w = net.w[key]
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert abs((up - down) / 2e-2 - g[key][at]) < 1e-3


def test_language_held_out(spark):
    rows = QUERIES["op3_language"](spark, ROOT).join(table(spark, ROOT, "documents").select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL")
    held = rows.filter("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert held[0] > 0.97 and held[1] > 1000 and 0 <= held[2] <= held[3] <= 1


def test_language_of_odd_rows(spark):
    learn = [(i, f"the {'and of '[i % 7:]}thing word{i} being", "en") for i in range(40)] + [(100 + i, f"ñandú mañana{i} cigüeña el niño", "es") for i in range(40)]
    net = language_net.fit(spark.createDataFrame(learn + [(None, "x", "en"), (5, None, "en"), (6, "zz", None)], "doc_id long, text string, lang string"))
    rows = [(1, None), (2, ""), (3, " 123 !? "), (4, "the thing and the being " * 40), (5, "mañana el niño " * 3000), (6, "n" * 100000), (None, "the of")]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_net.predict(docs, net).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred == "en" and got[5].lang_pred == "es"
    assert got[6].lang_pred in ("en", "es") and all(0 <= r.lang_score <= 1 for r in got.values()) and got[None].lang == "q"
    assert language_net.predict(docs, language_net.fit(docs.limit(0))).filter("lang_pred <> 'und'").count() == 0
    assert language_net.predict(docs.limit(0), net).count() == 0


def test_language_sums_do_not_depend_on_memory():
    net = language_net.Net(["a", "b"])
    texts = pa.array(["one two, one two", "two one", None, "", "x" * 100])
    reader = language_net.Reader(net)
    first, again = reader.texts(texts), reader.texts(texts)
    assert np.allclose(first, again, atol=1e-6) and np.allclose(first[[0, 1, 4]].sum(axis=1), 1, atol=1e-5) and not first[2:4].any()


def test_languages_of_long_texts_only_are_learned(spark):
    """German comes in texts of over the sample's characters only, and its words stand late in them."""
    rows = [(i, f"the thing word{i} being of and with other " * 3, "en") for i in range(60)] + [(100 + i, f"mañana{i} el niño cigüeña señor para " * 3, "es") for i in range(60)]
    rows += [(200 + i, "1234 " * 2000 + f"über die schöne straße und nicht wort{i} " * 900, "de") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(t) for i, t, _ in rows if i >= 200) > language_net.SAMPLE_CHARS
    net = language_net.fit(docs)
    assert net.languages == ["de", "en", "es"]
    got = language_net.predict(docs, net).filter("lang_pred <> lang").count()
    assert got == 0


def test_sample_is_bounded_and_even(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.when(F.col("id") < 2900, "aa").otherwise("bb").alias("lang"))
    seen = []
    train, language_net.train = language_net.train, lambda rows: seen.extend(rows)
    try:
        language_net.fit(docs, sample=160)
    finally:
        language_net.train = train
    count = {x: sum(lang == x for _, lang in seen) for x in ("aa", "bb")}
    assert count["aa"] == 160 and 60 <= count["bb"] <= 100


def test_quality_gradients(monkeypatch):
    """One step from fresh weights moves each weight against the numerical slope of the loss."""
    texts, labels = ["abcab cab " * 3, "XY!XY!!X " * 4, "abba", "!!"], [1, 0, 1, 0]
    one = quality_net.train(texts, labels, epochs=1)
    fresh = quality_net.Net(11)
    parts = [t.encode() for t in texts]

    def loss(net):
        p = np.clip(net.texts(pa.array(texts)), 1e-7, 1 - 1e-7)
        return -np.mean([np.log(q if y else 1 - q) for q, y in zip(p, labels)])

    assert len(parts) <= quality_net.BATCH
    checked = 0
    for key in ("out", "dense", "bias", "byte"):
        moved = one.w[key] - fresh.w[key]
        where = np.argwhere(np.abs(moved) > 0.9 * quality_net.RATE)
        for at in where[:: max(1, len(where) // 8)][:8]:
            at, old = tuple(at), fresh.w[key][tuple(at)]
            fresh.w[key][at] = old + 2e-2
            up = loss(fresh)
            fresh.w[key][at] = old - 2e-2
            slope = up - loss(fresh)
            fresh.w[key][at] = old
            if abs(slope) > 1e-4:
                checked += 1
                assert np.sign(slope) == -np.sign(moved[at]), key
    assert checked > 8


def test_quality_held_out(spark):
    rows = QUERIES["op5_quality"](spark, ROOT).join(table(spark, ROOT, "labels").select("doc_id", "quality"), "doc_id").filter("held_out")
    r = rows.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert r[0] > 0.97 and r[1] > 500 and 0 <= r[2] <= r[3] <= 1


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, "BUY!! NOW!! " * (3 + i % 5) if i % 2 else f"a plain line of words number {i} " * 4, "x") for i in range(80)]
        + [(500, None, "x"), (501, "", "x"), (502, "BUY!! NOW!! " * 9000, "x"), (None, "z", None)], "doc_id long, text string, score string")
    labels = docs.filter("doc_id < 80").select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(3).alias("text"))
    net = quality_net.fit(docs, labels.unionByName(labels.limit(3)))
    got = {r.doc_id: r for r in quality_net.score(docs, net).collect()}
    assert len(got) == 84 and all(0 <= r.quality_score <= 1 for r in got.values()) and got[502].quality_score < 0.3 < got[2].quality_score
    assert got[500].quality_score == got[501].quality_score
    none = quality_net.fit(docs, labels.limit(0))
    assert {r.quality_score for r in quality_net.score(docs, none).collect()} == {0.5}
    assert quality_net.score(docs.limit(0), net).count() == 0


def test_chunks_cover_every_byte():
    for sizes in ([0, 1, 255, 256, 257, 496, 497, 5000, 0], [0], []):
        offsets = np.cumsum([0] + sizes)
        start, length, row = quality_net.cut(offsets)
        seen = [set() for _ in sizes]
        for s, n, r in zip(start, length, row):
            assert 0 < n <= quality_net.CHUNK and offsets[r] <= s and s + n <= offsets[r + 1]
            seen[r].update(range(s - offsets[r], s - offsets[r] + n))
        assert [len(s) for s in seen] == sizes


def test_junk_deep_in_a_long_text_counts():
    rng = np.random.default_rng(0)
    clean = [" ".join(f"w{rng.integers(9999)}" for _ in range(200)) for _ in range(60)]
    junk = [" ".join(f"W{rng.integers(99)}!!" for _ in range(200)) for _ in range(60)]
    net = quality_net.train(clean + junk, [1] * 60 + [0] * 60)
    p = net.texts(pa.array([clean[0] * 20, clean[0] + junk[0] * 20, junk[1]]))
    assert p[0] > 0.7 and p[1] < 0.3 and p[2] < 0.3
