"""Raw and canonical tables kept in key buckets: a run reads and rewrites only the buckets of its own rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casona import refdata
from casona.operators import upsert
from casona.session import stored
from casona.sources.buckets import ADDED, BucketTable, Snapshot


class RawTable(BucketTable):
    """Raw records by (source, source_listing_id). ``was_new`` is known for rows that wait to be folded, else null."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = 256):
        fields = [f for f in schema if f.name != "was_new"]
        super().__init__(spark, path, T.StructType([*fields, T.StructField("was_new", T.BooleanType())]), upsert.RAW_KEY, buckets, self._fold_raw)

    @staticmethod
    def _fold_raw(base: DataFrame, later: DataFrame) -> DataFrame:
        """Later arrivals upserted; within a commit the latest scrape wins."""
        content = later.drop(*refdata.STAGE_COLUMNS, "error", "was_new")
        return upsert.upsert_raw(base.drop("was_new"), content, order=(ADDED, "scraped_at"))

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        given = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        return super()._write(rows.select(*given).withColumn("was_new", F.lit(None).cast("boolean")))

    def arrive(self, batch: int, payloads: DataFrame, writer: str = "stream") -> bool:
        """Appends a batch of payloads, as streams do; a batch number that was there changes nothing."""
        return self.append(writer, batch, payloads)

    def upsert(self, run_id, payloads: DataFrame, order: Sequence[str] = ("scraped_at",)) -> bool:
        """``upsert_raw`` on the buckets of the payloads' keys; the same run again changes nothing."""
        if self.done(f"run:{run_id}", 0):
            return False
        rows = stored(payloads, "raw-batch")
        return self.merge(f"run:{run_id}", 0, rows, lambda now, new: upsert.upsert_raw(now.drop("was_new"), new, order))

    def known_before(self, payloads: DataFrame, snapshot: Snapshot) -> DataFrame:
        """Keys of payloads with ``was_new`` as of a snapshot taken before they were put in."""
        keys = payloads.select(*self.keys).distinct()
        old = self.look_up(payloads, snapshot).select(*(F.col(k).alias(f"_{k}") for k in self.keys))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        return keys.join(old, same[1] & same[0], "left").select(*self.keys, F.col(f"_{self.keys[0]}").isNull().alias("was_new"))

    def set_stage(self, writer: str, stage: str, outcomes: DataFrame) -> bool:
        """Outcomes (source, source_listing_id, status, error) of one stage written to their rows."""
        column = f"{stage}_status"
        result = [F.col(k).alias(f"_{k}") for k in self.keys]

        def change(now: DataFrame, new: DataFrame) -> DataFrame:
            o = new.select(*result, F.col("status").alias("_status"), F.col("error").alias("_error"))
            both = now.join(o, F.col(self.keys[1]).eqNullSafe(F.col(f"_{self.keys[1]}")) & F.col(self.keys[0]).eqNullSafe(F.col(f"_{self.keys[0]}")), "left")
            # as stage_transition: an old error stays unless the outcome brings a new one
            return both.withColumns({column: F.coalesce("_status", column), "error": F.coalesce("_error", "error")}).select(*now.columns)

        return self.merge(writer, 0, outcomes, change)


class CanonicalTable(BucketTable):
    """Canonical listings by id."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = 256):
        super().__init__(spark, path, schema, ["id"], buckets)

    def update(self, run_id, changes: DataFrame, order: Sequence[str], at: Column, modes: dict[str, str] | None = None) -> bool:
        """``merge_canonical`` on the buckets of the changed ids; several changes of one id are folded first."""
        if self.done(f"update:{run_id}", 0):
            return False
        rows = stored(upsert.fold_changes(changes, order, modes=modes), "canonical-batch")
        return self.merge(f"update:{run_id}", 0, rows, lambda now, new: upsert.merge_canonical(now, new, at, modes=modes))

    def insert(self, run_id, rows: DataFrame) -> bool:
        """New listings with their ids; one that is there already stays as it is."""
        if self.done(f"insert:{run_id}", 0):
            return False
        new = stored(rows, "canonical-new")
        add = lambda now, r: now.unionByName(r.join(now.select("id"), "id", "left_anti"), allowMissingColumns=True).select(*now.columns)
        return self.merge(f"insert:{run_id}", 0, new, add)
