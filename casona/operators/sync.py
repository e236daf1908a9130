"""Diff-based publishing: which listings to send, as what, and what was sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata
from casona.functions.text import as_col, humanize, non_empty
from casona.operators.ranking import global_row_number

HASHED = [
    "title_en", "description_en", "price_usd", "bedrooms", "bathrooms", "interior_sqm", "lot_sqm", "year_built", "lat",
    "lng", "address_line", "locality", "canton", "province", "region_slug", "status",
]
HASHED_ARRAYS = ["features", "tags_ai", "tags_human"]


def _strings(c) -> Column:
    return F.coalesce(as_col(c), F.array().cast("array<string>"))


def pending_sync(canon: DataFrame, n: int | None = None) -> DataFrame:
    """Active or to-be-reviewed listings never sent or changed since: all, or the ``n`` newest changes."""
    due = canon.filter(
        F.col("status").isin("active", "pending_review")
        & (F.col("wp_synced_at").isNull() | (F.col("updated_at") > F.col("wp_synced_at"))))
    return due.orderBy(F.desc("updated_at"), "id").limit(n) if n else due


def content_hash() -> Column:
    """SHA-256 over the published fields; arrays count as sets in sorted order, nulls are kept apart from ''."""
    fields = [F.col(c) for c in HASHED] + [F.array_sort(_strings(c)).alias(c) for c in HASHED_ARRAYS]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def plan_sync(pending: DataFrame) -> DataFrame:
    """skip when a post exists and nothing it shows changed, update when it exists, else create."""
    posted = F.col("wp_post_id").isNotNull()
    same = F.coalesce(F.col("wp_content_hash") == F.col("content_hash"), F.lit(False))
    return pending.withColumn("content_hash", content_hash()).withColumn(
        "sync_action", F.when(posted & same, "skip").when(posted, "update").otherwise("create"))


def labels(tags_ai="tags_ai", tags_human="tags_human") -> Column:
    both = F.array_distinct(F.concat(_strings(tags_ai), _strings(tags_human)))
    return F.transform(both, humanize)


def publish_documents(df: DataFrame) -> DataFrame:
    """(id, post, meta, taxonomies) of each listing: post fields, meta values without nulls, term names."""
    text = lambda c: F.col(c).cast("string")
    placed = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    address = F.concat_ws(", ", *(non_empty(c) for c in ("address_line", "locality", "canton", "province")), F.lit("Costa Rica"))
    meta = {
        "fave_property_price": text("price_usd"),
        "fave_currency": F.lit("USD"),
        "fave_property_bedrooms": text("bedrooms"),
        "fave_property_bathrooms": text("bathrooms"),
        "fave_property_size": text("interior_sqm"),
        "fave_property_size_prefix": F.when(F.col("interior_sqm").isNotNull(), "m²"),
        "fave_property_land": text("lot_sqm"),
        "fave_property_year": text("year_built"),
        "fave_property_location": F.when(placed, F.concat_ws(",", text("lat"), text("lng"))),
        "fave_property_map_address": F.when(placed, address),
        "fave_property_map": F.when(placed, "enable"),
        "fave_property_map_street_view": F.when(placed, "enable"),
        "fave_property_hoa_dues": text("hoa_fee_usd"),
        "fave_property_id": non_empty("mls_id"),
    }
    meta_map = F.map_filter(
        F.map_from_arrays(F.array(*map(F.lit, meta)), F.array(*meta.values())), lambda k, v: v.isNotNull())
    region_names = F.create_map(*(F.lit(x) for slug, name, _ in refdata.REGIONS for x in (slug, name)))
    type_names = F.create_map(*(F.lit(x) for pair in refdata.TYPE_DISPLAY.items() for x in pair))
    one = lambda c: F.array_compact(F.array(c))
    terms = {
        "property_city": one(F.try_element_at(region_names, F.col("region_slug"))),
        "property_state": one(non_empty("canton")),
        "property_type": one(F.try_element_at(type_names, F.col("property_type"))),
        "property_feature": F.transform(_strings("features"), humanize),
        "property_label": labels(),
    }
    taxonomies = F.map_filter(
        F.map_from_arrays(F.array(*map(F.lit, terms)), F.array(*terms.values())), lambda k, v: F.size(v) > 0)
    post = F.struct(
        F.coalesce(non_empty("title_en"), non_empty("title_es"), F.lit("(untitled listing)")).alias("title"),
        F.col("slug").alias("slug"),
        F.coalesce(non_empty("description_en"), non_empty("description_es"), F.lit("")).alias("content"),
        F.when(F.col("status") == "active", "publish").otherwise("draft").alias("status"),
    )
    return df.withColumns({"post": post, "meta": meta_map, "taxonomies": taxonomies})


def assign_batches(pending: DataFrame, size: int = refdata.SYNC_BATCH_SIZE) -> DataFrame:
    """Batch number in update order, newest change first."""
    numbered = global_row_number(pending, [F.desc("updated_at"), F.asc("id")], "_row")
    return numbered.withColumn("batch", F.floor((F.col("_row") - 1) / size).cast("int") + 1).drop("_row")


def sync_log_rows(planned: DataFrame, results: DataFrame | None, at: Column, dry_run: bool = False) -> DataFrame:
    """One log row per attempt (skips are not attempts); results are (id, post_id, http_status, error).

    An attempt without a result has failed.
    """
    sent = planned.filter("sync_action <> 'skip'")
    if dry_run or results is None:
        return sent.select(
            F.col("id").alias("canonical_id"), F.col("wp_post_id").alias("post_id"), F.col("sync_action").alias("action"),
            F.lit("dry_run").alias("status"), F.lit(None).cast("int").alias("http_status"),
            F.lit(None).cast("string").alias("error"), at.alias("logged_at"))
    r = results.select(F.col("id").alias("_id"), "post_id", "http_status", "error")
    answered = F.col("_id").isNotNull()
    ok = answered & F.col("error").isNull()
    return sent.join(r, sent["id"] == F.col("_id"), "left").select(
        F.col("id").alias("canonical_id"), F.coalesce("post_id", "wp_post_id").alias("post_id"),
        F.col("sync_action").alias("action"), F.when(ok, "success").otherwise("failed").alias("status"),
        F.when(ok, F.lit(200)).otherwise(F.col("http_status")).cast("int").alias("http_status"), 
        F.when(answered, F.col("error")).otherwise("no answer").alias("error"), at.alias("logged_at"))


def sync_summary(planned: DataFrame, log: DataFrame) -> DataFrame:
    """ok, skipped and failed counts of a pass: two one-row aggregates laid side by side."""
    skipped = planned.agg(F.count_if(F.col("sync_action") == "skip").alias("skipped"))
    sent = log.agg(
        F.count_if(F.col("status") != "failed").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"))
    parts = sent.unionByName(skipped, allowMissingColumns=True)
    return parts.agg(*(F.max(name).alias(name) for name in ("ok", "skipped", "failed")))


def term_dictionary(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(taxonomy, name, term_id, is_new): known terms keep their id, new ones are numbered after the highest known id."""
    used = documents.select(F.explode("taxonomies").alias("taxonomy", "_names")).select(
        "taxonomy", F.explode("_names").alias("name")).distinct()
    known = terms.groupBy("taxonomy", "name").agg(F.min("term_id").alias("term_id"))
    highest = terms.agg(F.coalesce(F.max("term_id"), F.lit(0)).cast("bigint")).first()[0]
    fresh = global_row_number(used.join(known, ["taxonomy", "name"], "left_anti"), [F.col("taxonomy"), F.col("name")], "_n").select(
        "taxonomy", "name", (F.col("_n") + highest).cast("bigint").alias("term_id"), F.lit(True).alias("is_new"))
    return known.withColumn("is_new", F.lit(False)).unionByName(fresh)


def mark_synced(canon: DataFrame, planned: DataFrame, results: DataFrame, at: Column) -> DataFrame:
    """Post id, time and hash of sent listings; a skip only moves the time, so it is not pending again."""
    r = results.filter("error is null").select(F.col("id").alias("_rid"), F.col("post_id").alias("_post"))
    done = planned.join(r, planned["id"] == F.col("_rid"), "left").filter(
        (F.col("sync_action") == "skip") | F.col("_rid").isNotNull()
    ).select(F.col("id").alias("_id"), "_post", F.col("content_hash").alias("_hash"))
    joined = canon.join(done, canon["id"] == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    return joined.withColumns({
        "wp_post_id": F.coalesce("_post", "wp_post_id"),
        "wp_synced_at": F.when(hit, at).otherwise(F.col("wp_synced_at")),
        "wp_content_hash": F.coalesce("_hash", "wp_content_hash"),
    }).drop("_id", "_post", "_hash")
