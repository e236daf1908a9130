"""A stored full-text index that changes with its listings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casona.operators.listings import fulltext_rank, token_index
from casona.operators.upsert import upsert
from casona.sources.buckets import ADDED, BucketTable


def _newest(base: DataFrame, later: DataFrame) -> DataFrame:
    """Postings after later ones; a posting without a weight takes an older one away."""
    rows = base.withColumn(ADDED, F.lit(-1).cast("bigint")).unionByName(later)
    return rows.groupBy("token", "id").agg(F.max(F.struct(ADDED, "weight")).alias("_p")).select("token", "id", F.col("_p.weight").alias("weight")).filter("weight IS NOT NULL")


class TextIndex:
    """Postings (token, id, weight) in buckets of tokens, and the words of each listing in buckets of ids.

    An update appends the postings that changed and marks for those that went, without reading
    postings; ``compact`` folds the fullest buckets. A query reads the buckets of its own words.
    """

    def __init__(self, spark: SparkSession, path: str, kind: T.DataType, buckets: int = 256):
        self.spark, self.path = spark, path.rstrip("/")
        postings = T.StructType([T.StructField("token", T.StringType()), T.StructField("id", kind), T.StructField("weight", T.DecimalType(14, 2))])
        words = T.StructType([T.StructField("id", kind), T.StructField("words", T.ArrayType(T.StructType(
            [T.StructField("token", T.StringType()), T.StructField("weight", T.DecimalType(14, 2))])))])
        self.postings = BucketTable(spark, f"{self.path}/postings", postings, ["token"], buckets, _newest)
        self.words = BucketTable(spark, f"{self.path}/words", words, ["id"], buckets)

    def update(self, batch: int, listings: DataFrame, gone: DataFrame | None = None, writer: str = "batch") -> bool:
        """New and changed listings, and ids that are ``gone``. False if the batch is there; an interrupted one goes on."""
        if self.words.done(writer, batch):
            return False
        place = f"{self.path}/updates/{writer}-{batch}"
        if "_SUCCESS" not in self.words.files.names(place):
            listings = listings.repartition("id")  # whole listings move once, not each of their words twice
            new = token_index(listings).withColumnRenamed("id", "_id").groupBy("_id").agg(F.collect_list(F.struct("token", "weight")).alias("words"))
            ids = listings.select("id").distinct()
            changed = ids.join(new, F.col("id") == F.col("_id"), "left").select("id", "words")
            if gone is not None:
                changed = changed.unionByName(gone.select("id").distinct().join(ids, "id", "left_anti").select("id", F.lit(None).cast(changed.schema["words"].dataType).alias("words")))
            before = self.words.look_up(changed).select("id", F.col("words").alias("old"))
            none = F.array().cast(changed.schema["words"].dataType)
            changed.join(before, "id", "left").select(
                "id", F.coalesce("words", none).alias("words"), F.coalesce("old", none).alias("old")).write.mode("overwrite").parquet(place)
        rows = self.spark.read.parquet(place)
        come = F.array_except("words", "old")
        went = F.transform(
            F.array_except(F.transform("old", lambda w: w["token"]), F.transform("words", lambda w: w["token"])),
            lambda t: F.struct(t.alias("token"), F.lit(None).cast("decimal(14,2)").alias("weight")))
        self.postings.append(writer, batch, rows.select("id", F.explode(F.concat(come, went)).alias("w")).select("w.token", "id", "w.weight"))
        self.words.merge(writer, batch, rows.select("id", "words"), lambda now, r: upsert(now, r, ["id"]).filter(F.size("words") > 0))
        return True

    def index(self, query: str) -> DataFrame:
        """Postings of the buckets that the words of a query fall into, fewer than all."""
        words = sorted({w for w in re.split(r"[\W_]+", query.lower()) if w})
        return self.postings.look_up(self.spark.createDataFrame([(w,) for w in words], "token string")).filter(F.col("token").isin(words))

    def search(self, query: str, n: int | None = None) -> DataFrame:
        """(id, score) of listings that hold every word, the heaviest first."""
        return fulltext_rank(self.index(query), query, n)

    def compact(self, least: int = 1, most: int | None = None) -> list[int]:
        return self.postings.compact(least, most)
