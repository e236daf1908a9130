"""The stages of an ingest run as one plan, and the market report. ``plans.warehouse`` runs them stage by stage over stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casona.operators import enrich as enrich_ops, entity_resolution as er, extraction, normalize as norm, upsert

STAGES = ("extract", "normalize", "dedupe", "enrich", "publish")


def run_stages(
    payloads: DataFrame, *, responses: DataFrame, rates: DataFrame, copy: DataFrame, tags: DataFrame,
    candidates_fn: Callable[[DataFrame], DataFrame] | None = None,
    score_fn: Callable[[DataFrame], DataFrame] = er.score_pairs, gazetteer: DataFrame | None = None,
    stages: Sequence[str] = STAGES,
) -> DataFrame:
    """Payloads -> records ready to publish, with status; skipped stages leave their columns out.

    Row-wise stages are projections Catalyst folds together. Shuffles: the reply join, the
    candidate search and the two enrichment joins. ``candidates_fn`` and ``score_fn`` are the
    injectable finder and judge; without a finder every record is created.
    """
    out = payloads.withColumn("id", F.sha2(F.to_json(F.array("source", "source_listing_id")), 256))
    if "extract" in stages:
        out = extraction.apply_extraction(out, responses)
    if "normalize" in stages:
        out = norm.normalize(out, rates, gazetteer, key="id")
    if "dedupe" in stages:
        out = out.withColumn("embedding_text", er.embedding_text()).withColumn("text_hash", er.text_hash("embedding_text"))
        if candidates_fn is None:
            out = out.withColumns({
                "action": F.lit("create"), "confidence": F.lit(0).cast(er.CONFIDENCE), "method": F.lit("no_match"),
                "candidate_id": F.lit(None).cast("string"), "canonical_id": F.lit(None).cast("string")})
        else:
            out = er.resolve(out, candidates_fn, score_fn)
    if "enrich" in stages:
        out = enrich_ops.enrich(out, copy, tags, key="id")
    if "publish" in stages:
        out = out.withColumn("status", upsert.quality_gate())
    return out


def market_report(listings: DataFrame, rates: DataFrame) -> DataFrame:
    """Active listings per region and category: count, price range and total, beach distance.

    Exchange, region and nearest places are row-wise; the only shuffle is the final aggregate,
    on a few dozen keys after partial aggregation.
    """
    active = listings.filter(F.col("status") == "active")
    priced = norm.to_usd(active, "price", "price_currency", rates, "price_usd")
    placed = norm.nearest_pois_all(norm.assign_region(priced))
    listed = placed.withColumn(
        "categories", enrich_ops.derive_categories("property_type", "price_usd", "distance_to_beach_km", "features", "tags_ai"))
    return (
        listed.select("region_slug", F.explode("categories").alias("category"), "price_usd", "distance_to_beach_km")
        .groupBy(F.coalesce("region_slug", F.lit("none")).alias("region_slug"), "category")
        .agg(
            F.count("*").alias("listings"), F.min("price_usd").alias("min_price_usd"), F.max("price_usd").alias("max_price_usd"),
            F.sum("price_usd").cast("decimal(20,2)").alias("total_price_usd"),
            F.sum("distance_to_beach_km").cast("decimal(14,1)").alias("beach_km")))
