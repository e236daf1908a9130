"""Numbers of rows: of their own, and the same under any cut of the files."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casona.llm.places import placed
from tests.llm.test_pipeline import frame

PACK = "spark.sql.files.maxPartitionBytes"


def numbers(docs):
    docs, place = placed(docs)
    return {r.text: r.place for r in docs.select("text", place.alias("place")).collect()}


@pytest.fixture()
def written(spark, tmp_path):
    rows = [(i, f"text {i} " + "x" * (i % 50)) for i in range(3000)]
    frame(spark, rows).repartition(7).write.parquet(str(tmp_path / "t"), compression="none")
    yield spark.read.parquet(str(tmp_path / "t"))
    spark.conf.unset(PACK)


def test_numbers_hold_when_files_are_dealt_anew(spark, written):
    first, tasks = numbers(written), written.rdd.getNumPartitions()
    assert len(set(first.values())) == 3000 and min(first.values()) >= 0
    spark.conf.set(PACK, "4096")
    anew = spark.read.parquet(*written.inputFiles())
    assert anew.rdd.getNumPartitions() != tasks
    assert numbers(anew) == first


def test_near_copies_survive_another_deal(spark, written):
    spark.conf.set(PACK, "4096")
    kept = corpus_pipeline.distinct(spark, written, "")
    spark.conf.unset(PACK)  # planned with small parts, run with large ones
    texts = {r.text for r in kept.collect()}
    assert texts == {r.text for r in written.collect()}


def test_rows_that_no_file_gives(spark, written):
    made = frame(spark, [(1, "a"), (1, "b"), (None, None)])
    assert len(set(numbers(made).values())) == 3
    twice = written.crossJoin(spark.range(2).withColumnRenamed("id", "again"))  # a place is seen twice
    docs, place = placed(twice)
    assert docs.select(place.alias("p")).distinct().count() == 6000
    part = written.filter(F.col("doc_id") < 10)
    assert len(set(numbers(part).values())) == 10


def test_tables_without_rows_and_with_clashing_names(spark, written, tmp_path):
    docs, place = placed(written.limit(0))
    assert docs.select(place).count() == 0
    written.withColumn("_metadata", F.lit(1)).withColumn("path", F.lit(2)).withColumn("place", F.lit(3)).write.parquet(str(tmp_path / "c"))
    assert len(set(numbers(spark.read.parquet(str(tmp_path / "c"))).values())) == 3000
