"""Operations views: funnel, runs, traces, KPIs, costs, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata


def stage_funnel(raw: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: records done at each stage, failed ones and the total."""
    done = {
        "extracted": "extract_status", "normalized": "normalize_status", "deduped": "dedupe_status",
        "enriched": "enrich_status", "published": "publish_status",
    }
    failed = (F.col("extract_status") == "failed") | (F.col("normalize_status") == "failed") | (F.col("enrich_status") == "failed")
    counts = raw.groupBy("source_id").agg(
        *(F.count_if(F.col(c) == "done").alias(name) for name, c in done.items()),
        F.count_if(failed).alias("failed"), F.count("*").alias("total"))
    # joined after counting: one row per source on either side
    s = sources.select(F.col("id").alias("source_id"), F.col("slug").alias("source_slug"), F.col("name").alias("source_name"))
    return counts.join(s, "source_id").drop("source_id")


def recent_runs(runs: DataFrame, sources: DataFrame, now: Column, n: int | None = None) -> DataFrame:
    """Runs with source names and rounded duration in seconds (running ones up to ``now``), newest first."""
    micros = F.unix_micros(F.coalesce("ended_at", now)) - F.unix_micros("started_at")
    s = sources.select(F.col("id").alias("source_id"), F.col("slug").alias("source_slug"), F.col("name").alias("source_name"))
    out = runs.join(s, "source_id").withColumn(
        "duration_seconds", F.round(micros.cast("decimal(20,0)") / 1_000_000, 0).cast("bigint"))
    return out.orderBy(F.desc("started_at"), "id").limit(n) if n else out


def stage_order(stage: str = "stage") -> Column:
    """Fixed position of a stage; unknown stages come last."""
    known = F.array(*map(F.lit, refdata.TRACE_STAGES))
    at = F.array_position(known, F.col(stage)).cast("int")
    return F.when(at > 0, at).otherwise(len(refdata.TRACE_STAGES) + 1)


def run_trace(logs: DataFrame, run_id) -> DataFrame:
    """Events of one run in stage order, then time order. A sort, not an array per stage."""
    return logs.filter(F.col("run_id") == run_id).withColumn("stage_order", stage_order()).orderBy(
        "stage_order", "stage", "ts", "event_id")


def run_trace_counts(logs: DataFrame) -> DataFrame:
    """Events, errors and warnings of every run and stage."""
    return logs.groupBy("run_id", "stage").agg(
        F.count("*").alias("events"), F.count_if(F.col("level") == "error").alias("errors"),
        F.count_if(F.col("level") == "warn").alias("warnings"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"),
    ).withColumn("stage_order", stage_order())


def kpis(canon: DataFrame, links: DataFrame, costs: DataFrame, today: Column, low: float = 0.60, high: float = 0.85) -> DataFrame:
    """One row: active, total and never-synced listings, reviews waiting, cost today and this week (from Sunday)."""
    bound = lambda x: F.lit(str(x)).cast("decimal(4,3)")
    c = canon.agg(
        F.count_if(F.col("status") == "active").alias("active_listings"), F.count("*").alias("total_listings"),
        F.count_if(F.col("wp_synced_at").isNull()).alias("never_synced"))
    waiting = F.col("reviewed_at").isNull() & F.col("confidence").between(bound(low), bound(high))
    r = links.agg(F.count_if(waiting).alias("pending_reviews"))
    # dayofweek counts from Sunday = 1
    week_start = F.date_sub(today, F.dayofweek(today) - 1)
    money = costs.filter(F.col("day") >= week_start).agg(
        F.coalesce(F.sum(F.when(F.col("day") == today, F.col("cost_usd"))), F.lit(0)).cast("decimal(14,4)").alias("cost_today"),
        F.coalesce(F.sum("cost_usd"), F.lit(0)).cast("decimal(14,4)").alias("cost_week"))
    # three one-row aggregates laid side by side
    parts = c.unionByName(r, allowMissingColumns=True).unionByName(money, allowMissingColumns=True)
    return parts.agg(*(F.max(name).alias(name) for name in parts.columns))


def last_success_per_source(runs: DataFrame, n: int | None = None) -> DataFrame:
    """Latest succeeded run per source, of all runs or of the newest ``n``."""
    newest = runs if n is None else runs.orderBy(F.desc("started_at"), "id").limit(n)
    newest = newest.filter("status = 'succeeded'")
    pick = F.max_by(F.struct(F.col("id").alias("run_id"), "started_at"), F.struct("started_at", -F.col("id")))
    return newest.groupBy("source_id").agg(pick.alias("_r")).select("source_id", "_r.*")


def cost_trend(costs: DataFrame, today: Column, days: int = 30) -> DataFrame:
    return costs.filter(F.col("day") >= F.date_sub(today, days)).select("day", "cost_usd").orderBy("day")


def alerts_feed(alerts: DataFrame, n: int | None = None) -> DataFrame:
    newest = alerts.orderBy(F.desc("created_at"), "id")
    return newest if n is None else newest.limit(n)


def unread_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter("acknowledged_at is null").orderBy(F.desc("created_at"), "id")


def sources_overview(sources: DataFrame, configs: DataFrame) -> DataFrame:
    """Every source with its effective flag and its regions as text (``all`` when none are named)."""
    c = configs.select("source_id", F.col("enabled").alias("_on"), F.col("regions").alias("_regions"), "last_run_at")
    named = F.when(F.size("_regions") > 0, F.array_join("_regions", ", "))
    return sources.join(c, sources.id == c.source_id, "left").select(
        "id", "slug", "name", F.coalesce("_on", "enabled").alias("enabled"),
        F.coalesce(named, F.lit("all")).alias("regions"), "last_run_at")


def pending_items(raw: DataFrame) -> DataFrame:
    """Raw records a re-run has to take up."""
    again = ("pending", "failed", "skipped")
    return raw.filter(F.col("publish_status").isin(*again) | F.col("extract_status").isin(*again, "running"))
