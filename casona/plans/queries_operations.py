"""Queries over runs, stages, sources and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from casona import refdata
from casona.operators import operations as ops
from casona.plans.catalog import query
from casona.plans.sqlparts import stamp
from casona.sources import rules

NOW = "2001-09-01 00:00:00"
TODAY = "2024-01-17"


def _stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


@query("stage_funnel", """
    SELECT s.slug AS source_slug, s.name AS source_name, count(*) FILTER (extract_status = 'done') AS extracted,
      count(*) FILTER (normalize_status = 'done') AS normalized, count(*) FILTER (dedupe_status = 'done') AS deduped,
      count(*) FILTER (enrich_status = 'done') AS enriched, count(*) FILTER (publish_status = 'done') AS published,
      count(*) FILTER (extract_status = 'failed' OR normalize_status = 'failed' OR enrich_status = 'failed') AS failed, count(*) AS total
    FROM v_stages r JOIN v_sources s ON s.id = r.source_id GROUP BY ALL""")
def stage_funnel(t):
    return ops.stage_funnel(t.v_stages, t.v_sources)


RUNS_SQL = f"""
    SELECT r.id, s.slug AS source_slug, r.status, {stamp('r.started_at')} AS started_at,
      CAST(round((epoch_us(coalesce(ended_at, TIMESTAMP '{NOW}')) - epoch_us(started_at)) / 1000000) AS BIGINT) AS duration_seconds
    FROM v_runs r JOIN v_sources s ON s.id = r.source_id"""


@query("recent_runs", RUNS_SQL + " ORDER BY r.started_at DESC, r.id LIMIT 100")
def recent_runs(t):
    out = ops.recent_runs(t.v_runs, t.v_sources, F.lit(NOW).cast("timestamp"), n=100)
    return out.select("id", "source_slug", "status", _stamp("started_at").alias("started_at"), "duration_seconds")


@query("all_runs", RUNS_SQL)
def all_runs(t):
    out = ops.recent_runs(t.v_runs, t.v_sources, F.lit(NOW).cast("timestamp"))
    return out.select("id", "source_slug", "status", _stamp("started_at").alias("started_at"), "duration_seconds")


STAGE_ORDER = "CASE stage " + " ".join(f"WHEN '{s}' THEN {i + 1}" for i, s in enumerate(refdata.TRACE_STAGES)) + " ELSE 9 END"


@query("run_trace", f"SELECT event_id, stage, level, CAST({STAGE_ORDER} AS INTEGER) AS stage_order FROM v_logs WHERE run_id = 7")
def run_trace(t):
    return ops.run_trace(t.v_logs, 7).select("event_id", "stage", "level", "stage_order")


@query("run_trace_counts", f"""
    SELECT run_id, stage, count(*) AS events, count(*) FILTER (level = 'error') AS errors, count(*) FILTER (level = 'warn') AS warnings,
      {stamp('min(ts)')} AS first_at, {stamp('max(ts)')} AS last_at, CAST({STAGE_ORDER} AS INTEGER) AS stage_order
    FROM v_logs GROUP BY run_id, stage""")
def run_trace_counts(t):
    return ops.run_trace_counts(t.v_logs).withColumns({c: _stamp(c) for c in ("first_at", "last_at")})


def costs(t):
    """Daily costs from the events' values."""
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.sum(F.col("value").cast("decimal(14,4)")).cast("decimal(14,4)").alias("cost_usd"))


COSTS_SQL = "SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(14,4))) AS DECIMAL(14,4)) AS cost_usd FROM events GROUP BY 1"


@query("kpis", f"""
    SELECT (SELECT count(*) FROM v_listings WHERE status = 'active') AS active_listings, (SELECT count(*) FROM v_listings) AS total_listings,
      (SELECT count(*) FROM v_listings WHERE wp_synced_at IS NULL) AS never_synced,
      (SELECT count(*) FROM v_links WHERE reviewed_at IS NULL AND confidence BETWEEN 0.60 AND 0.85) AS pending_reviews,
      CAST((SELECT coalesce(sum(cost_usd), 0) FROM ({COSTS_SQL}) WHERE day = DATE '{TODAY}') AS DECIMAL(14,4)) AS cost_today,
      CAST((SELECT coalesce(sum(cost_usd), 0) FROM ({COSTS_SQL}) WHERE day >= DATE '2024-01-14') AS DECIMAL(14,4)) AS cost_week""")
def kpis(t):
    return ops.kpis(t.v_listings, t.v_links, costs(t), F.lit(TODAY).cast("date"))


@query("last_success_per_source", f"""
    SELECT source_id, arg_max(id, (started_at, -id)) AS run_id, {stamp('max(started_at)')} AS started_at
    FROM v_runs WHERE status = 'succeeded' GROUP BY source_id""")
def last_success_per_source(t):
    return ops.last_success_per_source(t.v_runs).withColumn("started_at", _stamp("started_at"))


@query("cost_trend", f"SELECT day, cost_usd FROM ({COSTS_SQL}) WHERE day >= DATE '{TODAY}' - 10")
def cost_trend(t):
    return ops.cost_trend(costs(t), F.lit(TODAY).cast("date"), days=10)


ALERTS = """
    SELECT event_id AS id, CASE event_type WHEN 'error' THEN 'error' ELSE 'info' END AS severity, event_type AS message,
      CAST(ts AS TIMESTAMP) AS created_at, CASE WHEN value > 20 THEN CAST(ts AS TIMESTAMP) END AS acknowledged_at
    FROM {events}"""


@query("alerts_feed", f"SELECT id, severity, message FROM ({ALERTS.format(events='events')}) ORDER BY created_at DESC, id LIMIT 20")
def alerts_feed(t):
    return ops.alerts_feed(t.sql(ALERTS), n=20).select("id", "severity", "message")


@query("unread_alerts", f"SELECT id, severity, message FROM ({ALERTS.format(events='events')}) WHERE acknowledged_at IS NULL")
def unread_alerts(t):
    return ops.unread_alerts(t.sql(ALERTS)).select("id", "severity", "message")


@query("sources_overview", """
    SELECT s.id, s.slug, s.name, coalesce(c.enabled, s.enabled) AS enabled,
      coalesce(nullif(array_to_string(c.regions, ', '), ''), 'all') AS regions
    FROM v_sources s LEFT JOIN v_configs c ON c.source_id = s.id""")
def sources_overview(t):
    return ops.sources_overview(t.v_sources, t.v_configs).drop("last_run_at")


@query("pending_items", """
    SELECT id, extract_status, publish_status FROM v_stages
    WHERE publish_status IN ('pending', 'failed', 'skipped') OR extract_status IN ('pending', 'failed', 'skipped', 'running')""")
def pending_items(t):
    return ops.pending_items(t.v_stages).select("id", "extract_status", "publish_status")


@query("enabled_sources", """
    SELECT s.id, s.slug, c.cron_expression FROM v_sources s JOIN v_configs c ON c.source_id = s.id WHERE s.enabled AND c.enabled""")
def enabled_sources(t):
    return rules.enabled_sources(t.v_sources, t.v_configs)


@query("source_rules", f"""
    SELECT s.slug, array_to_string(CASE WHEN json_extract(m, '$.start_urls') IS NOT NULL THEN CAST(json_extract(m, '$.start_urls') AS VARCHAR[])
        WHEN s.base_url <> '' THEN [s.base_url] ELSE [] END, ' ') AS start_urls,
      coalesce(json_extract_string(m, '$.listing_url_regex'), '{rules.GENERIC_HREF}') AS listing_url_regex,
      coalesce(json_extract_string(m, '$.pagination_param'), 'page') AS pagination_param,
      coalesce(CAST(json_extract(m, '$.max_pages') AS INTEGER), 30) AS max_pages
    FROM v_sources s JOIN (SELECT source_id, CAST(coalesce(metadata, '{{}}') AS JSON) AS m FROM v_configs) c ON c.source_id = s.id""")
def source_rules(t):
    return rules.source_rules(t.v_sources, t.v_configs).withColumn("start_urls", F.array_join("start_urls", " "))


@query("source_listing", """
    SELECT s.slug, s.name, s.enabled, CAST(NULL AS VARCHAR) AS last_run_at FROM v_sources s JOIN v_configs c ON c.source_id = s.id""")
def source_listing(t):
    return rules.source_listing(t.v_sources, t.v_configs).withColumn("last_run_at", F.col("last_run_at").cast("string"))


@query("toggle_sources", """
    SELECT source_id, CASE WHEN source_id IN (SELECT n_nationkey FROM nation) THEN NOT enabled ELSE enabled END AS enabled FROM v_configs""")
def toggle_sources(t):
    ids = t.nation.select(F.col("n_nationkey").alias("source_id"))
    return rules.toggle_sources(t.v_configs, ids).select("source_id", "enabled")
