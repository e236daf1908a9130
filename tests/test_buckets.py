"""Bucket tables: what a batch reads and writes, repeats, crashes, concurrent readers and writers, compaction."""

import uuid

import pytest
from pyspark.sql import functions as F, types as T

from casona.operators import upsert
from casona.session import shared_folder
from casona.sources.buckets import BucketTable, Conflict

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.StringType()), T.StructField("n", T.IntegerType())])


def newest(base, later):
    rows = base.withColumn("_added", F.lit(-1).cast("bigint")).unionByName(later)
    return upsert.latest_per_key(rows, ["id"], ["_added", "value"])


@pytest.fixture
def table(spark):
    return BucketTable(spark, f"{shared_folder(spark)}/buckets-{uuid.uuid4().hex}", SCHEMA, ["id"], 8, newest)


def rows(spark, pairs):
    return spark.createDataFrame([(i, v, 0) for i, v in pairs], SCHEMA)


def content(df):
    return {r.id: r.value for r in df.collect()}


def put(table, number, pairs, writer="w"):
    return table.merge(writer, number, rows(table.spark, pairs), lambda now, new: upsert.upsert(now, new, ["id"]))


def buckets_read(df):
    return {int(f.rpartition("_bucket=")[2].partition("/")[0]) for f in df.inputFiles()}


def test_a_batch_reads_and_writes_its_own_buckets(spark, table):
    assert put(table, 0, [(k, "a") for k in range(100)])
    before = table.snapshot()
    assert len(before.base) == 8 and content(table.read()) == {k: "a" for k in range(100)}
    batch, seen = rows(spark, [(3, "b"), (1000, "b")]), []

    def change(now, new):
        seen.extend(buckets_read(now))
        return upsert.upsert(now, new, ["id"])

    assert table.merge("w", 1, batch, change)
    touched, after = set(table.buckets_of(batch)), table.snapshot()
    assert set(seen) == touched and 0 < len(touched) <= 2
    assert {b for b in after.base if after.base[b] != before.base[b]} == touched
    assert content(table.read()) == {**{k: "a" for k in range(100)}, 3: "b", 1000: "b"}
    assert buckets_read(table.look_up(batch)) == touched
    plan = table.look_up(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_repeated_batch_changes_nothing(table):
    put(table, 0, [(1, "a")])
    put(table, 1, [(1, "b")])
    version = table.snapshot().version
    assert not put(table, 1, [(1, "c")]) and not put(table, 0, [(2, "c")])
    assert table.snapshot().version == version and content(table.read()) == {1: "b"}
    assert put(table, 0, [(2, "d")], writer="other") and content(table.read()) == {1: "b", 2: "d"}


def test_rows_can_go(spark, table):
    put(table, 0, [(k, "a") for k in range(20)])
    gone = rows(spark, [(k, "") for k in range(20)])
    table.merge("delete", 0, gone, lambda now, ids: now.join(ids, "id", "left_anti"))
    assert table.read().count() == 0 and table.snapshot().base == {}


def test_crash_between_write_and_commit(spark, table, monkeypatch):
    put(table, 0, [(1, "a"), (2, "a")])
    version = table.snapshot().version

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_commit", dies)
        with pytest.raises(RuntimeError):
            put(table, 1, [(1, "b")])
        with pytest.raises(RuntimeError):
            table.append("s", 0, rows(spark, [(2, "c")]))
    assert table.snapshot().version == version and content(table.read()) == {1: "a", 2: "a"}
    assert table.vacuum(older_than=3600) == []  # too young to be given up
    assert put(table, 1, [(1, "b")]) and table.append("s", 0, rows(spark, [(2, "c")]))
    assert content(table.read()) == {1: "b", 2: "c"}
    assert len(table.vacuum(keep=1, older_than=0)) >= 2 and content(table.read()) == {1: "b", 2: "c"}


def test_appends_wait_until_compaction(spark, table):
    put(table, 0, [(k, "a") for k in range(50)])
    assert table.append("s", 0, rows(spark, [(1, "b"), (60, "b")]))
    assert table.append("s", 1, rows(spark, [(1, "c")])) and not table.append("s", 1, rows(spark, [(1, "d")]))
    want = {**{k: "a" for k in range(50)}, 1: "c", 60: "b"}
    assert content(table.read()) == want
    reader = table.snapshot()
    reading = table.read(reader)
    before = table.snapshot()
    one = table.buckets_of(rows(spark, [(1, "")]))
    assert table.compact(least=2) == one  # only the bucket with two waiting commits
    after = table.snapshot()
    assert {b for b in after.base if after.base[b] != before.base.get(b)} == set(one)
    assert sum(len(b) for _, _, b in after.waiting) == sum(len(b) for _, _, b in before.waiting) - 2
    assert content(table.read()) == content(reading) == want
    table.compact()
    assert table.snapshot().waiting == [] and table.compact() == []
    assert content(table.read()) == content(reading) == want  # files of the old snapshot are still there
    assert table.append("s", 2, rows(spark, [(1, "e")])) and content(table.read()) == {**want, 1: "e"}
    assert content(table.read(reader)) == want
    table.vacuum(keep=1, older_than=0)
    assert content(table.read()) == {**want, 1: "e"}


def test_append_during_compaction_waits_on(spark, table, monkeypatch):
    put(table, 0, [(1, "a")])
    table.append("s", 0, rows(spark, [(1, "b")]))
    write = BucketTable._write

    def meanwhile(self, df):
        out = write(self, df)
        monkeypatch.setattr(BucketTable, "_write", write)
        self.append("s", 1, rows(spark, [(1, "c"), (2, "c")]))
        return out

    monkeypatch.setattr(BucketTable, "_write", meanwhile)
    table.compact()
    assert content(table.read()) == {1: "c", 2: "c"} and len(table.snapshot().waiting) == 1


def test_two_writers_of_one_version(spark, table, monkeypatch):
    put(table, 0, [(1, "a")])
    write = BucketTable._write

    def meanwhile(self, df):
        out = write(self, df)
        monkeypatch.setattr(BucketTable, "_write", write)
        put(table, 0, [(1, "first")], writer="x")
        return out

    monkeypatch.setattr(BucketTable, "_write", meanwhile)
    with pytest.raises(Conflict):
        put(table, 0, [(1, "second")], writer="y")
    assert content(table.read()) == {1: "first"}
    assert put(table, 0, [(1, "second")], writer="y") and content(table.read()) == {1: "second"}


def test_null_keys_and_empty_tables(spark, table):
    assert table.read().count() == 0 and table.vacuum() == [] and table.compact() == []
    put(table, 0, [(None, "x"), (1, "y")])
    assert content(table.read()) == {None: "x", 1: "y"}
    assert put(table, 1, []) and content(table.read()) == {None: "x", 1: "y"}
