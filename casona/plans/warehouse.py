"""The ingest run over stored tables, driven by the stage columns of the raw table.

A stage takes the rows that every earlier stage is done with, writes its results once under the
run's name, puts them into the tables it owns and then writes the outcomes to the raw rows. Each
of these steps is a commit that knows the run: a run that was interrupted goes on where it
stopped, and one that is repeated changes nothing. A later run takes up whatever is not done.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casona import schemas
from casona.functions import vectors
from casona.operators import accounting, enrich as enrich_ops, entity_resolution as er, extraction, normalize as norm, photos as ph, upsert
from casona.operators.keyed import CanonicalTable, RawTable
from casona.sources.buckets import BucketTable

STAGES = tuple(accounting.STAGES)
KEYS = list(upsert.RAW_KEY)
LINKS = "canonical_id string, raw_id string, confidence decimal(3,2), method string, candidate_id string, action string, run_id string"
EMBEDDINGS = "canonical_id string, model string, embedding array<double>, text_hash string"
PHOTOS = (
    "listing_id string, url string, position int, width int, height int, phash string, alt string, reject_reason string, is_rejected boolean, is_hero boolean")
RAW = (
    "source string, source_listing_id string, source_url string, run_id string, raw_html string, raw_extracted string, breadcrumbs array<string>, "
    "photos array<struct<url:string,position:int>>, scraped_at timestamp, extract_status string, normalize_status string, dedupe_status string, "
    "enrich_status string, publish_status string, error string")

Finder = Callable[[DataFrame, DataFrame], DataFrame]
Judge = Callable[[DataFrame], DataFrame]


def _schema(spark: SparkSession, ddl: str) -> T.StructType:
    return spark.createDataFrame([], ddl).schema


def canonical_schema(spark: SparkSession) -> T.StructType:
    return _schema(spark, ", ".join(f"`{name}` {kind}" for name, kind in schemas.CANONICAL.items()))


def record_id() -> Column:
    """Id of a raw record: digest of its source and its id there."""
    return F.sha2(F.to_json(F.array(*KEYS)), 256)


class Warehouse:
    """Tables of an ingest under one folder, and the stages that move rows through them.

    ``finder(new, canonical)`` gives pairs (query_id, base_id, rank, and both sides' columns with
    the prefixes a_ and b_) and ``judge(pairs)`` their confidence.
    """

    def __init__(
        self, spark: SparkSession, path: str, *, rates: DataFrame, finder: Finder, judge: Judge, gazetteer: DataFrame | None = None,
        model: str = "hash-dev", dim: int = 64, buckets: int = 256,
    ):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.rates, self.finder, self.judge, self.gazetteer, self.model, self.dim = rates, finder, judge, gazetteer, model, dim
        self.raw = RawTable(spark, f"{self.path}/raw", _schema(spark, RAW), buckets)
        self.canonical = CanonicalTable(spark, f"{self.path}/canonical", canonical_schema(spark), buckets)
        self.links = BucketTable(spark, f"{self.path}/links", _schema(spark, LINKS), ["canonical_id", "raw_id"], buckets)
        self.embeddings = BucketTable(spark, f"{self.path}/embeddings", _schema(spark, EMBEDDINGS), ["canonical_id", "model"], buckets)
        self.photos = BucketTable(spark, f"{self.path}/photos", _schema(spark, PHOTOS), ["listing_id"], buckets)

    # ------------------------------------------------------------ results of stages

    def _results(self, stage: str) -> BucketTable:
        """What a stage gave for each record, whichever run it was; its columns are those of its first result."""
        path = f"{self.path}/stages/{stage}"
        kind = T.StructType.fromJson(json.loads(self.raw.files.read(f"{path}/schema.json")))
        return BucketTable(self.spark, path, kind, ["id"], self.buckets)

    def _keep(self, stage: str, run: str, rows: DataFrame) -> None:
        path = f"{self.path}/stages/{stage}"
        if "schema.json" not in self.raw.files.names(path):
            self.raw.files.write(f"{path}/schema.json", rows.schema.json())
        newest = lambda now, new: now.join(new.select("id"), "id", "left_anti").unionByName(new)
        self._results(stage).merge(f"run:{run}", 0, rows, newest)

    def _of(self, stage: str, ready: DataFrame) -> DataFrame:
        """Results of an earlier stage for the records that are ready."""
        return self._results(stage).read().join(ready.select("id"), "id", "left_semi")

    # ------------------------------------------------------------ stages: rows ready -> results with an error or null

    def _extract(self, ready: DataFrame, responses: DataFrame) -> DataFrame:
        read = extraction.apply_extraction(ready, responses, replied="_replied")
        return read.withColumn("error", F.when(~F.col("_replied"), "no reply")).drop("_replied", "raw_html", *(c for c in ready.columns if c.endswith("_status")))

    def _normalize(self, ready: DataFrame) -> DataFrame:
        return norm.normalize(self._of("extract", ready), self.rates, self.gazetteer, key="id")

    def _dedupe(self, ready: DataFrame) -> DataFrame:
        """Decisions: against published listings, by equal text with stored ones, and by equal text inside the run."""
        rows = self._of("normalize", ready).withColumn("embedding_text", er.embedding_text()).withColumn("text_hash", er.text_hash("embedding_text"))
        canonical = self.canonical.read()
        found = er.resolve(rows, lambda new: self.finder(new, canonical), self.judge)
        stored = self.embeddings.read().filter(F.col("model") == self.model).groupBy("text_hash").agg(F.min("canonical_id").alias("_same"))
        out = found.join(stored, "text_hash", "left")
        fresh = (F.col("action") == "create") & F.col("_same").isNull()
        heads = out.filter(fresh).groupBy(F.col("text_hash").alias("_h")).agg(F.min("id").alias("_head"))  # a row a text, combined before the shuffle
        out = out.join(heads, (F.col("text_hash") == F.col("_h")) & fresh, "left")
        twin = F.when(F.col("action") == "create", F.coalesce("_same", F.when(F.col("_head") != F.col("id"), self._new_id("_head"))))
        return out.select(
            "id", "embedding_text", "text_hash", "candidate_id",
            F.when(twin.isNotNull(), "merge").otherwise(F.col("action")).alias("action"),
            F.when(twin.isNotNull(), F.lit(1)).otherwise(F.col("confidence")).cast(er.CONFIDENCE).alias("confidence"),
            F.when(twin.isNotNull(), "same_text").otherwise(F.col("method")).alias("method"),
            F.when(F.col("action") == "merge", F.col("canonical_id")).otherwise(F.coalesce(twin, self._new_id("id"))).alias("canonical_id"))

    @staticmethod
    def _new_id(record: str) -> Column:
        return F.sha2(F.concat_ws("|", record), 256)

    def _enrich(self, ready: DataFrame, copy: DataFrame, tags: DataFrame) -> DataFrame:
        return enrich_ops.enrich(self._of("normalize", ready), copy, tags, key="id")

    def _publish(self, ready: DataFrame) -> DataFrame:
        """What is to be published: the enriched record with its decision."""
        decided = self._of("dedupe", ready).withColumnRenamed("confidence", "_confidence")
        rich = self._of("enrich", ready)
        return rich.drop(*(c for c in decided.columns if c != "id")).join(decided, "id").withColumn("confidence", F.col("_confidence")).drop("_confidence")

    def _put_out(self, run: str, rows: DataFrame, at: Column) -> None:
        """Links, embeddings, photos and then the listings of published rows; each table is rewritten once, and not at all if the run did it before."""
        writer = f"run:{run}"
        new, merged = rows.filter("action <> 'merge'"), rows.filter("action = 'merge'")
        self.links.merge(writer, 0, rows.select(
            "canonical_id", F.col("id").alias("raw_id"), "confidence", "method", "candidate_id", "action", F.lit(run).alias("run_id")), upsert.upsert_links)
        self.embeddings.merge(writer, 0, new.select(
            "canonical_id", F.lit(self.model).alias("model"), vectors.hash_embedding("embedding_text", self.dim).alias("embedding"), "text_hash"), upsert.upsert_embeddings)
        self._put_photos(writer, rows)
        if self.canonical.done(writer, 0):
            return
        names = {f.name: f.dataType for f in self.canonical.schema}
        given = new.withColumns({
            "id": F.col("canonical_id"), "status": upsert.quality_gate(), "listing_type": F.lit("sale"), "country": F.lit("CR"),
            "property_type": F.coalesce("property_type", F.lit("other")), "primary_source_url": F.col("source_url"),
            "created_at": at, "updated_at": at, "last_seen_at": at})
        given = given.select(*(F.col(c).try_cast(k).alias(c) for c, k in names.items() if c in given.columns))
        taken = [c for c in names if c in merged.columns and c in schemas.MERGE_MODES]
        changes = upsert.fold_changes(merged.select(
            F.col("canonical_id").alias("id"), F.col("id").alias("record"), *(F.col(c).try_cast(names[c]).alias(c) for c in taken)), ["record"])
        ids = rows.select(F.col("canonical_id").alias("id")).distinct()
        shown = self.photos.look_up(ids.withColumnRenamed("id", "listing_id"))

        def change(now: DataFrame, touched: DataFrame) -> DataFrame:
            listings = now.unionByName(given.join(now.select("id"), "id", "left_anti"), allowMissingColumns=True)
            listings = upsert.merge_canonical(listings, changes, at)
            counts = touched.join(shown.groupBy(F.col("listing_id").alias("id")).agg(F.count_if(~F.col("is_rejected")).cast("int").alias("_n")), "id", "left")
            counts = counts.select("id", F.coalesce("_n", F.lit(0)).alias("_n"))
            return listings.join(counts, "id", "left").withColumn("photo_count", F.coalesce("_n", "photo_count")).select(*now.columns)

        self.canonical.merge(writer, 0, ids, change)

    def _put_photos(self, writer: str, rows: DataFrame) -> None:
        none = lambda kind: F.lit(None).cast(kind)
        each = rows.select(F.col("canonical_id").alias("listing_id"), F.col("id").alias("record"), F.explode("photos").alias("p")).select(
            "listing_id", "record", "p.url", "p.position", none("int").alias("width"), none("int").alias("height"), none("string").alias("phash"), none("string").alias("alt"))
        # photos of several records of one listing follow one another
        order = F.struct("record", "position")
        raw = ph.classify_and_rewrite(each).groupBy("listing_id", "url").agg(
            F.min_by(F.struct("width", "height", "phash", "alt", "reject_reason"), order).alias("_p"), F.min(order).alias("_o"))
        raw = raw.select("listing_id", "url", "_p.*", F.col("_o.position").alias("position"))
        choices = rows.select(F.col("canonical_id").alias("listing_id"), F.lit(0).alias("hero_index"))

        def change(now: DataFrame, new: DataFrame) -> DataFrame:
            placed = ph.assign_positions(ph.new_photos(new, now), now, choices)
            return now.unionByName(placed, allowMissingColumns=True).select(*now.columns)

        self.photos.merge(writer, 0, raw, change)

    # ------------------------------------------------------------ runs

    def run(
        self, run_id, at: Column, payloads: DataFrame | None = None, *, responses: DataFrame | None = None, copy: DataFrame | None = None,
        tags: DataFrame | None = None, stages: Sequence[str] = STAGES,
    ) -> None:
        """Payloads put into the raw table, then every named stage over the rows that it may take.

        Without payloads the run takes up rows that earlier runs left, as after failures. Stages
        that are not named leave their rows for a later run.
        """
        run = str(run_id)
        if payloads is not None:
            self.raw.upsert(run, payloads.withColumn("run_id", F.lit(run)))
        unknown = set(stages) - set(STAGES)
        if unknown:
            raise ValueError(f"no stage {', '.join(sorted(unknown))}")
        steps: dict[str, Callable[[DataFrame], DataFrame]] = {
            "extract": lambda ready: self._extract(ready, responses), "normalize": self._normalize, "dedupe": self._dedupe,
            "enrich": lambda ready: self._enrich(ready, copy, tags), "publish": self._publish}
        for stage in STAGES:
            if stage in stages:
                self._step(run, stage, steps[stage], at)

    def _step(self, run: str, stage: str, compute: Callable[[DataFrame], DataFrame], at: Column) -> None:
        writer = f"{run}/{stage}"
        if self.raw.done(writer, 0):
            return
        place = f"{self.path}/runs/{run}/{stage}"
        if "_SUCCESS" not in self.raw.files.names(place):
            ready = accounting.ready_for(self.raw.read(), stage).drop("was_new", "error").withColumn("id", record_id())
            out = compute(ready)
            out = out if "error" in out.columns else out.withColumn("error", F.lit(None).cast("string"))
            with_keys = out if set(KEYS) <= set(out.columns) else out.join(ready.select("id", *KEYS), "id")
            with_keys.write.mode("overwrite").parquet(place)
        rows = self.spark.read.parquet(place)
        good = rows.filter("error IS NULL").drop("error")
        if stage == "publish":
            self._put_out(run, good, at)
        else:
            self._keep(stage, run, good if stage == "extract" else good.drop(*(KEYS if stage == "dedupe" else ())))
        outcomes = rows.select(*KEYS, F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"), "error")
        self.raw.set_stage(writer, stage, outcomes)

    def outcomes(self) -> DataFrame:
        """(run_id, stage, status, rows) of all runs so far, from the results that they left."""
        found = None
        for run in self.raw.files.names(f"{self.path}/runs"):
            for stage in self.raw.files.names(f"{self.path}/runs/{run}"):
                rows = self.spark.read.parquet(f"{self.path}/runs/{run}/{stage}").groupBy(
                    F.lit(run).alias("run_id"), F.lit(stage).alias("stage"), F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status")).agg(F.count("*").alias("rows"))
                found = rows if found is None else found.unionByName(rows)
        return found
