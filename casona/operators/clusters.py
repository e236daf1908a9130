"""Clusters that grow batch by batch: a batch touches only the clusters that its edges join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casona.operators.graph import connected_components
from casona.operators.upsert import upsert
from casona.session import stored
from casona.sources.buckets import BucketTable


class ClusterTable:
    """The cluster of every id that some batch linked, its name being its smallest id.

    Two bucket tables: ``heads`` (id, cluster_id) by id, to contract edges, and ``members``
    (cluster_id, id) by cluster, to find the rows that a merge re-labels. A batch's moves are
    written once under its number; both tables are then brought up to it, each in one commit, so
    a batch that was interrupted is finished by calling it again.
    """

    def __init__(self, spark: SparkSession, path: str, kind: T.DataType, buckets: int = 256):
        self.spark, self.path = spark, path.rstrip("/")
        field = lambda name: T.StructField(name, kind)
        self.heads = BucketTable(spark, f"{self.path}/heads", T.StructType([field("id"), field("cluster_id")]), ["id"], buckets)
        self.members = BucketTable(spark, f"{self.path}/members", T.StructType([field("cluster_id"), field("id")]), ["cluster_id"], buckets)

    def read(self) -> DataFrame:
        return self.heads.read()

    def add(self, batch: int, edges: DataFrame, writer: str = "batch") -> bool:
        """Links (a, b) of one batch. False if the batch is there. Nulls and loops are ignored."""
        if self.members.done(writer, batch):
            return False
        place = f"{self.path}/moves/{writer}-{batch}"
        if "_SUCCESS" not in self.heads.files.names(place):
            self._moves(edges).write.mode("overwrite").parquet(place)
        moves = self.spark.read.schema(self._kind()).parquet(place)
        # the moves name the old clusters, so either table can be behind when a crash comes between
        self.heads.merge(writer, batch, moves.select("id", "cluster_id"), lambda now, new: upsert(now, new, ["id"]))
        gone = moves.filter("old IS NOT NULL").select(F.col("old").alias("cluster_id"), "id", F.lit(True).alias("_gone"))
        come = moves.select("cluster_id", "id", F.lit(False).alias("_gone"))

        def change(now: DataFrame, new: DataFrame) -> DataFrame:
            kept = now.join(new.filter("_gone"), ["cluster_id", "id"], "left_anti")
            return kept.unionByName(new.filter("NOT _gone").select("cluster_id", "id")).distinct()

        self.members.merge(writer, batch, gone.unionByName(come), change)
        return True

    def _kind(self) -> T.StructType:
        kind = self.heads.schema["id"].dataType
        return T.StructType([T.StructField(c, kind) for c in ("id", "old", "cluster_id")])

    def _moves(self, edges: DataFrame) -> DataFrame:
        """(id, old, cluster_id) of the ids that are new or whose cluster gets another name.

        Edges are contracted through the stored heads first, so what is settled is a graph of the
        batch's clusters and new ids, however large the clusters are.
        """
        edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "cluster-edges")
        ids = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
        known = stored(ids.join(self.heads.look_up(ids), "id", "left"), "cluster-known")  # (id, cluster_id or null)
        head = lambda name: known.select(F.col("id").alias(name), F.coalesce("cluster_id", "id").alias(f"_{name}"))
        small = edges.join(head("a"), "a").join(head("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        settled = stored(connected_components(small), "cluster-settled")
        renamed = settled.filter("id <> component").select(F.col("id").alias("old"), F.col("component").alias("cluster_id"))
        relabelled = self.members.look_up(renamed.select(F.col("old").alias("cluster_id"))).withColumnRenamed("cluster_id", "old").join(renamed, "old")
        fresh = known.filter("cluster_id IS NULL").select("id").join(settled, "id", "left").select(
            "id", F.lit(None).cast(self.heads.schema["id"].dataType).alias("old"), F.coalesce("component", "id").alias("cluster_id"))
        return relabelled.select("id", "old", "cluster_id").unionByName(fresh)
