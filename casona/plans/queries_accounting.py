"""Queries over run accounting, costs, budgets and price history."""

from __future__ import annotations

from pyspark.sql import functions as F

from casona import refdata
from casona.operators import accounting as acc
from casona.plans.catalog import query, values
from casona.plans.sqlparts import stamp
from casona.session import small_table

TODAY = "2001-09-01"


def _stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def prices(t):
    return small_table(t.spark, refdata.MODEL_PRICES, "family string, input double, output double")


PRICE_ROWS = values([(f, int(i), int(o)) for f, i, o in refdata.MODEL_PRICES], "model, pin, pout")
CALLS_SQL = f"SELECT l.*, CAST((input_tokens * pin + output_tokens * pout) * 0.000001 AS DECIMAL(18,6)) AS cost_usd FROM v_logs l JOIN ({PRICE_ROWS}) p USING (model)"


def calls(t):
    return acc.model_cost(t.v_logs, prices(t))


COUNTERS_SQL = f"""
    SELECT run_id, count(*) FILTER (kind = 'seen') AS listings_seen, count(*) FILTER (kind = 'new') AS listings_new, count(*) FILTER (kind = 'updated') AS listings_updated,
      count(*) FILTER (kind = 'failed') AS listings_failed, CAST(sum(cost_usd) AS DECIMAL(18,6)) AS cost_usd FROM ({CALLS_SQL}) GROUP BY run_id"""


@query("run_counters", COUNTERS_SQL)
def run_counters(t):
    return acc.run_counters(calls(t))


@query("run_status", f"""
    SELECT run_id, CASE WHEN listings_seen < 8 THEN 'failed' WHEN cost_usd > 0.30 THEN 'paused' WHEN listings_failed > 0 AND listings_new + listings_updated = 0 THEN 'failed'
      WHEN listings_failed > 12 THEN 'partial' ELSE 'succeeded' END AS status FROM ({COUNTERS_SQL})""")
def run_status(t):
    rows = acc.run_counters(calls(t)).withColumns({
        "error": F.when(F.col("listings_seen") < 8, "crashed"), "paused": F.col("cost_usd") > 0.30,
        "listings_failed": F.when(F.col("listings_failed") > 12, F.col("listings_failed")).when(
            F.col("listings_new") + F.col("listings_updated") == 0, F.col("listings_failed")).otherwise(F.lit(0))})
    return acc.run_status(rows).select("run_id", "status")


RUNNING_SQL = """
    WITH w AS (SELECT source_id, event_id, ts, http_status, count(*) OVER o AS attempts, CAST(sum(CASE WHEN http_status >= 400 THEN 1 ELSE 0 END) OVER o AS BIGINT) AS errors,
        CAST(sum(CASE WHEN http_status >= 500 THEN 1 ELSE 0 END) OVER o AS BIGINT) AS server_errors FROM v_logs
        WINDOW o AS (PARTITION BY source_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    s AS (SELECT source_id, min((ts, event_id)) AS stop FROM w WHERE attempts >= 30 AND (errors > 0.2e0 * attempts OR server_errors > 0.1e0 * attempts) GROUP BY 1)"""


@query("auto_pause", RUNNING_SQL + """
    SELECT w.source_id, event_id, attempts, errors, server_errors, coalesce((ts, event_id) = stop, false) AS paused
    FROM w LEFT JOIN s ON s.source_id = w.source_id WHERE stop IS NULL OR (ts, event_id) <= stop""")
def auto_pause(t):
    return acc.auto_pause(t.v_logs).select("source_id", "event_id", "attempts", "errors", "server_errors", "paused")


@query("model_cost", f"SELECT event_id, model, cost_usd FROM ({CALLS_SQL})")
def model_cost(t):
    return calls(t).select("event_id", "model", "cost_usd")


DAY_SQL = f"""
    SELECT CAST(ts AS DATE) AS day, CAST(sum(cost_usd) AS DECIMAL(18,6)) AS cost_usd,
      {', '.join(f"CAST(coalesce(sum({d}_tokens) FILTER (model = '{m}'), 0) AS BIGINT) AS {m}_{d}_tokens" for m in ('haiku', 'sonnet') for d in ('input', 'output'))},
      count(*) AS call_count FROM ({CALLS_SQL}) GROUP BY 1"""


@query("daily_cost_rollup", DAY_SQL)
def daily_cost_rollup(t):
    return acc.daily_cost_rollup(calls(t))


@query("daily_cost_upsert", f"""
    SELECT day, CAST(2 * cost_usd AS DECIMAL(18,6)) AS cost_usd, 2 * haiku_input_tokens AS haiku_input_tokens, 2 * haiku_output_tokens AS haiku_output_tokens,
      2 * sonnet_input_tokens AS sonnet_input_tokens, 2 * sonnet_output_tokens AS sonnet_output_tokens, 2 * call_count AS call_count FROM ({DAY_SQL})""")
def daily_cost_upsert(t):
    return acc.daily_cost_rollup(calls(t), current=acc.daily_cost_rollup(calls(t)))


BUDGET_SQL = f"""
    WITH w AS (SELECT run_id, event_id, ts, CAST(ts AS DATE) AS day, sum(cost_usd) OVER (PARTITION BY run_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_spend,
        sum(cost_usd) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS day_spend FROM ({CALLS_SQL})),
    r AS (SELECT run_id, min((ts, event_id)) AS stop FROM w WHERE run_spend > 0.25 GROUP BY 1), d AS (SELECT day, min((ts, event_id)) AS stop FROM w WHERE day_spend > 1.8 GROUP BY 1),
    b AS (SELECT w.*, coalesce((ts, event_id) >= r.stop, false) OR coalesce((ts, event_id) >= d.stop, false) AS refused FROM w LEFT JOIN r USING (run_id) LEFT JOIN d USING (day))"""


def _budget(t):
    return acc.budget_cutoff(calls(t), 0.25, 1.8)


@query("budget_cutoff", BUDGET_SQL + """
    SELECT event_id, CAST(run_spend AS DECIMAL(18,6)) AS run_spend, CAST(day_spend AS DECIMAL(18,6)) AS day_spend, refused FROM b""")
def budget_cutoff(t):
    return _budget(t).select(
        "event_id", F.col("run_spend").cast("decimal(18,6)").alias("run_spend"), F.col("day_spend").cast("decimal(18,6)").alias("day_spend"), "refused")


@query("raise_alerts", RUNNING_SQL + ", " + BUDGET_SQL.strip()[5:].replace("w AS", "w2 AS").replace("FROM w ", "FROM w2 ").replace("w.*", "w2.*") + f"""
    SELECT 'warn' AS severity, 'adapter:' || w.source_id AS source, 'auto-paused after ' || attempts || ' fetches, ' || errors || ' errors' AS message, {stamp('ts')} AS created_at
    FROM w JOIN s ON s.source_id = w.source_id AND (ts, event_id) = stop
    UNION ALL SELECT 'error', 'worker', 'budget exceeded in run ' || run_id || ', ' || count(*) || ' calls refused', {stamp('min(ts)')} FROM b WHERE refused GROUP BY run_id""")
def raise_alerts(t):
    return acc.raise_alerts(acc.auto_pause(t.v_logs), _budget(t)).select("severity", "source", "message", _stamp("created_at").alias("created_at"))


@query("stage_transition", """
    SELECT s.id, CASE WHEN o_orderkey IS NULL THEN s.normalize_status WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'done' END AS normalize_status,
      CASE WHEN o_orderstatus = 'F' THEN 'bad price' ELSE s.error END AS error FROM v_stages s LEFT JOIN orders ON o_custkey = s.id AND o_orderkey = (SELECT max(o_orderkey) FROM orders x WHERE x.o_custkey = s.id)""")
def stage_transition(t):
    # the newest order of a customer stands for the outcome of a record
    newest = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("s"))
    failed = F.col("s") == "F"
    outcomes = newest.select("id", F.when(failed, "failed").otherwise("done").alias("status"), F.when(failed, "bad price").alias("error"))
    return acc.stage_transition(t.v_stages, outcomes, "normalize").select("id", "normalize_status", "error")


@query("ready_for", """
    SELECT id, 'enrich' AS stage FROM v_stages WHERE enrich_status <> 'done' AND extract_status = 'done' AND normalize_status = 'done' AND dedupe_status = 'done'
    UNION ALL SELECT id, 'publish' FROM v_stages WHERE publish_status <> 'done' AND extract_status = 'done' AND normalize_status = 'done' AND dedupe_status = 'done' AND enrich_status = 'done'""")
def ready_for(t):
    part = lambda stage: acc.ready_for(t.v_stages, stage).select("id", F.lit(stage).alias("stage"))
    return part("enrich").unionByName(part("publish"))


SNAPSHOTS = """
    SELECT l_orderkey AS listing_id, CAST(l_shipdate AS TIMESTAMP) AS seen_at, ((l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey AS snapshot_id,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(floor(l_quantity / 10) * 100000 AS DECIMAL(14,2)) END AS price_usd FROM {lineitem}"""
CHANGES_SQL = f"""
    WITH s AS ({SNAPSHOTS.format(lineitem='lineitem')}), c AS (SELECT * FROM (
      SELECT *, lag(price_usd) OVER (PARTITION BY listing_id ORDER BY seen_at, snapshot_id) AS previous_price_usd FROM s WHERE price_usd IS NOT NULL)
      WHERE price_usd IS DISTINCT FROM previous_price_usd)"""


@query("price_changes", CHANGES_SQL + f" SELECT listing_id, snapshot_id, {stamp('seen_at')} AS seen_at, price_usd, previous_price_usd FROM c")
def price_changes(t):
    return acc.price_changes(t.sql(SNAPSHOTS)).withColumn("seen_at", _stamp("seen_at"))


@query("price_history", CHANGES_SQL + f""", h AS (
      SELECT listing_id, arg_min(price_usd, (seen_at, snapshot_id)) AS original, arg_max(price_usd, (seen_at, snapshot_id)) AS price,
        (array_agg(previous_price_usd ORDER BY seen_at DESC, snapshot_id DESC))[1] AS previous, count(*) - 1 AS n FROM c GROUP BY 1)
    SELECT g.listing_id, original AS list_price_original_usd, price AS price_usd, previous AS previous_list_price_usd, n AS price_changes,
      CAST(date_diff('day', CAST(first AS DATE), DATE '{TODAY}') AS INTEGER) AS days_on_market, date_diff('day', CAST(last AS DATE), DATE '{TODAY}') > 30 AS is_stale
    FROM (SELECT listing_id, min(seen_at) AS first, max(seen_at) AS last FROM s GROUP BY 1) g LEFT JOIN h USING (listing_id)""")
def price_history(t):
    out = acc.price_history(t.sql(SNAPSHOTS), F.lit(TODAY).cast("date"))
    return out.drop("first_seen_at", "last_seen_at")


@query("ordered_outcomes", """
    SELECT s.id, CASE o.status WHEN 'F' THEN 'failed' WHEN 'O' THEN 'done' WHEN 'P' THEN 'pending' ELSE s.normalize_status END AS normalize_status
    FROM v_stages s LEFT JOIN (SELECT o_custkey AS id, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1) o ON o.id = s.id""")
def ordered_outcomes(t):
    """Several outcomes of a record: the newest counts, whatever its name."""
    names = F.create_map(*map(F.lit, ("F", "failed", "O", "done", "P", "pending")))
    outcomes = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), names[F.col("o_orderstatus")].alias("status"), F.lit(None).cast("string").alias("error"))
    return acc.stage_transition(t.v_stages, outcomes, "normalize").select("id", "normalize_status")
