"""The pipeline's stages: columns, decisions, odd rows; the whole run on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casona.llm import language_net, quality_net
from casona.llm.queries import table
from tests.llm.test_minhash import brute, corpus
from tests.llm.test_secrets import brute as secret_spans
from tests.llm.test_token_files import check_packed

ROOT = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t or "")) for i, (d, t) in enumerate(rows)], SCHEMA)


def test_stages_have_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-dedup", "secret scans", "mixing", "packing"]


def test_quality_stage_keeps_what_the_score_allows(spark):
    root = "/root/testdata/sf0.01"
    docs = table(spark, root, "documents")
    kept = corpus_pipeline.good(spark, docs, root)
    assert kept.columns == docs.columns
    labelled = kept.join(table(spark, root, "labels"), "doc_id", "right").groupBy("quality").agg(F.avg(F.col("text").isNotNull().cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in labelled.collect()}
    assert share[1] > 0.95 and share[0] < 0.2


def test_dedup_stage_keeps_one_of_each_group(spark):
    rows = corpus(9) + [(424242, "A b C d e F"), (424243, "a b c d E f"), (424242, "A b C d e F")]
    docs = frame(spark, rows)
    kept = corpus_pipeline.distinct(spark, docs, ROOT)
    # every row is a node of its own; the smallest id of a group stays
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    want = sorted(rows[order[d]][0] for d, _, _, keep in brute([(k, rows[i][1]) for k, i in enumerate(order)], 5, 80) if keep)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want


def test_dedup_stage_with_null_and_shared_ids(spark):
    long = [" ".join(f"w{k}x{n}" for n in range(40)) for k in range(4)]
    rows = [(None, long[0]), (None, long[0]), (7, long[1]), (7, long[2]), (None, long[3]), (9, long[3] + " end"), (8, long[1]), (3, None), (None, None), (4, "")]
    docs = frame(spark, rows)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.distinct(spark, docs, ROOT).collect()), key=repr)
    want = [(None, long[0]), (7, long[1]), (7, long[2]), (9, long[3] + " end"), (3, None), (None, None), (4, "")]
    assert got == sorted(want, key=repr)


CLASHES = ["quality_score", "lang_pred", "lang_score", "row", "node", "_row", "body", "blocks", "gaps", "clean", "found", "_id", "_found", "_size", "size", "taken", "key", "want", "cut", "part", "copy", "row_key", "tail"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_columns_of_any_name(spark, name, stage):
    rows = [(i, f"a plain line of words number {i} token=abcdefabcdef99{i} end") for i in range(12)] + [(None, None), (5, "")]
    docs = frame(spark, rows)
    plain = sorted((tuple(r) for r in stage(spark, docs, ROOT).collect()), key=repr)
    more = docs.select("*", *(F.lit(c).alias(c) for c in CLASHES))
    out = stage(spark, more, ROOT)
    assert out.columns == more.columns
    got = out.collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == plain and {tuple(r)[5:] for r in got} <= {tuple(CLASHES)}


def test_networks_replace_columns_of_their_names(spark):
    docs = frame(spark, [(1, "a plain line"), (2, None)]).select("*", F.lit("x").alias("lang_pred"), F.lit("y").alias("quality_score"))
    net = language_net.train([("the line of words", "en"), ("la casa del río", "es")], steps=5)
    got = language_net.predict(docs, net)
    assert sorted(got.columns) == sorted([*docs.columns, "lang_score"]) and got.first().lang_pred in ("en", "es")
    got = quality_net.score(docs, quality_net.train([], []))
    assert sorted(got.columns) == sorted(docs.columns) and got.first().quality_score == 0.5


def test_secret_stage_leaves_clean_documents_alone(spark):
    rows = [(1, "clean text"), (2, "x token=abcdefabcdef99 y"), (3, None), (None, "password: correcthorsebattery"), (2, "x token=abcdefabcdef99 y"), (4, "")]
    got = {(r.doc_id, r.text): r.n_chars for r in corpus_pipeline.without_secrets(spark, frame(spark, rows), ROOT).collect()}
    assert set(got) == {(1, "clean text"), (2, "x [secret] y"), (3, None), (None, "[secret]"), (4, "")}
    assert all(n == len(t or "") for (_, t), n in got.items())
    assert secret_spans("clean text")[4] == ""


def test_mixing_and_packing_stages(spark):
    rows = [(i, f"word{i} " * (1 + i % 9)) for i in range(60)] + [(100, None), (101, ""), (None, "a b c")]
    docs = frame(spark, rows)
    mixed = corpus_pipeline.mixed(spark, docs, ROOT)
    assert mixed.columns == docs.columns
    total = sum(len((t or "").split()) for _, t in rows)
    got = [(r.doc_id, r.text) for r in mixed.collect()]
    assert abs(sum(len(t.split()) for _, t in got) - total) <= 4  # every source rounds its target down
    check_packed(corpus_pipeline.sequences(spark, docs, ROOT).collect(), rows)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_documents(spark, name, stage):
    assert stage(spark, frame(spark, [(1, "x")]).limit(0), ROOT).count() == 0


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, ROOT)
    sizes = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert rows.count() > 0 and sizes.filter("n <> end OR n > 1024").count() == 0
    ids = {r[0] for r in table(spark, ROOT, "documents").select("doc_id").collect()}
    assert {r[0] for r in rows.select("doc_id").distinct().collect()} <= ids
