"""Run counters, pauses, model costs, budgets, stage status and price history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata
from casona.operators.ranking import newest, previous_row, running_totals

COST = "decimal(18,6)"


def run_counters(events: DataFrame) -> DataFrame:
    """seen, new, updated, failed and cost per run from events (run_id, kind, cost_usd)."""
    n = lambda kind: F.count_if(F.col("kind") == kind)
    return events.groupBy("run_id").agg(
        n("seen").alias("listings_seen"), n("new").alias("listings_new"), n("updated").alias("listings_updated"),
        n("failed").alias("listings_failed"), F.coalesce(F.sum("cost_usd"), F.lit(0)).cast(COST).alias("cost_usd"))


def run_status(counters: DataFrame) -> DataFrame:
    """paused when stopped, failed on a run error or when nothing came through, partial on some failures."""
    through = F.col("listings_new") + F.col("listings_updated")
    return counters.withColumn(
        "status",
        F.when(F.col("error").isNotNull(), "failed")
        .when(F.col("paused"), "paused")
        .when((F.col("listings_failed") > 0) & (through == 0), "failed")
        .when(F.col("listings_failed") > 0, "partial")
        .otherwise("succeeded"))


def auto_pause(
    fetches: DataFrame, error_rate: float = refdata.PAUSE_ERROR_RATE, server_rate: float = refdata.PAUSE_5XX_RATE,
    min_sample: int = refdata.PAUSE_MIN_SAMPLE,
) -> DataFrame:
    """Fetches (source_id, ts, event_id, http_status) with running counts up to the first breach of each source.

    After ``min_sample`` attempts, an error share above ``error_rate`` or a 5xx share above
    ``server_rate`` pauses the source; later fetches are dropped. A busy source is
    cut into ranges of its fetches.
    """
    one = lambda cond: F.when(cond, 1).otherwise(0).cast("bigint")
    counted = running_totals(
        fetches, ["source_id"], [F.col("ts"), F.col("event_id")],
        {
            "attempts": F.lit(1).cast("bigint"),
            "errors": one(F.col("http_status") >= 400),
            "server_errors": one(F.col("http_status") >= 500),
        })
    breach = (F.col("attempts") >= min_sample) & (
        (F.col("errors") > error_rate * F.col("attempts")) | (F.col("server_errors") > server_rate * F.col("attempts")))
    first = counted.filter(breach).groupBy("source_id").agg(F.min(F.struct("ts", "event_id")).alias("_stop"))
    stop = F.coalesce(F.struct("ts", "event_id") <= F.col("_stop"), F.lit(True))
    at_stop = F.coalesce(F.struct("ts", "event_id") == F.col("_stop"), F.lit(False))
    return counted.join(first, "source_id", "left").filter(stop).withColumn("paused", at_stop).drop("_stop")


def model_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """cost_usd of each call: tokens per million times the model family's prices."""
    p = prices.select(
        F.col("family").alias("model"), F.col("input").cast("decimal(10,4)").alias("_in"),
        F.col("output").cast("decimal(10,4)").alias("_out"))
    tokens = F.col("input_tokens") * F.col("_in") + F.col("output_tokens") * F.col("_out")
    return calls.join(p, "model", "left").withColumn("cost_usd", (tokens / 1_000_000).cast(COST)).drop("_in", "_out")


ROLLUP_SUMS = ["cost_usd", "haiku_input_tokens", "haiku_output_tokens", "sonnet_input_tokens", "sonnet_output_tokens", "call_count"]


def daily_cost_rollup(calls: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Cost, tokens by model family and calls per day, added to the stored rollup if one is given."""
    of = lambda family, c: F.coalesce(F.sum(F.when(F.col("model") == family, F.col(c))), F.lit(0)).cast("bigint")
    day = calls.groupBy(F.to_date("ts").alias("day")).agg(
        F.sum("cost_usd").cast(COST).alias("cost_usd"),
        *(of(m, f"{d}_tokens").alias(f"{m}_{d}_tokens") for m in ("haiku", "sonnet") for d in ("input", "output")),
        F.count("*").alias("call_count"))
    if current is None:
        return day
    both = current.select("day", *ROLLUP_SUMS).unionByName(day.select("day", *ROLLUP_SUMS))
    casts = {"cost_usd": COST}
    return both.groupBy("day").agg(*(F.sum(c).cast(casts.get(c, "bigint")).alias(c) for c in ROLLUP_SUMS))


def budget_cutoff(calls: DataFrame, run_cap: float, day_cap: float) -> DataFrame:
    """Calls with running spend per run and per day; ``refused`` from the first call over a cap onwards.

    Refusal per run and per day starts at the first breach, found by a combining aggregate; a hot
    run or day is cut into ranges.
    """
    order = [F.col("ts"), F.col("event_id")]
    rows = calls.withColumn("day", F.to_date("ts"))
    rows = running_totals(rows, ["run_id"], order, {"run_spend": F.col("cost_usd")})
    rows = running_totals(rows, ["day"], order, {"day_spend": F.col("cost_usd")})
    at = F.struct("ts", "event_id")
    run_stop = rows.filter(F.col("run_spend") > run_cap).groupBy("run_id").agg(F.min(at).alias("_run_stop"))
    day_stop = rows.filter(F.col("day_spend") > day_cap).groupBy("day").agg(F.min(at).alias("_day_stop"))
    over = F.coalesce(at >= F.col("_run_stop"), F.lit(False)) | F.coalesce(at >= F.col("_day_stop"), F.lit(False))
    return rows.join(run_stop, "run_id", "left").join(day_stop, "day", "left").withColumn("refused", over).drop(
        "_run_stop", "_day_stop")


def stage_transition(raw: DataFrame, outcomes: DataFrame, stage: str, key: str = "id") -> DataFrame:
    """One stage's outcomes (key, status, error, seq) written to the raw rows, the newest of a row.

    An old error stays unless that outcome brings a new one.
    """
    o = outcomes.groupBy(key).agg(F.max_by(F.struct("status", "error"), newest(outcomes, "status", "error")).alias("_o"))
    column = f"{stage}_status"
    return raw.join(o, key, "left").withColumns({
        column: F.coalesce("_o.status", column), "error": F.coalesce("_o.error", "error")}).drop("_o")


STAGES = ["extract", "normalize", "dedupe", "enrich", "publish"]


def ready_for(raw: DataFrame, stage: str) -> DataFrame:
    """Rows a stage may take: every earlier stage done, its own not."""
    out = raw.filter(F.col(f"{stage}_status") != "done")
    for earlier in STAGES[: STAGES.index(stage)]:
        out = out.filter(F.col(f"{earlier}_status") == "done")
    return out


def price_changes(snapshots: DataFrame) -> DataFrame:
    """Price changes of each listing: (listing_id, seen_at, snapshot_id, price_usd, previous_price_usd).

    The first price of a listing has no previous one; unchanged snapshots are left out.
    """
    order = [F.col("seen_at"), F.col("snapshot_id")]
    seen = previous_row(
        snapshots.filter("price_usd is not null"), ["listing_id"], order,
        {"previous_price_usd": "price_usd"})
    return seen.filter(~F.col("price_usd").eqNullSafe(F.col("previous_price_usd")))


def price_history(snapshots: DataFrame, today: Column, stale_after_days: int = 30) -> DataFrame:
    """Per listing: original, current and previous price, number of changes, days on market, staleness.

    Aggregates only. ``previous`` is the price before the last change.
    """
    changes = price_changes(snapshots)
    at = F.struct("seen_at", "snapshot_id")
    prices = changes.groupBy("listing_id").agg(
        F.min_by("price_usd", at).alias("list_price_original_usd"), F.max_by("price_usd", at).alias("price_usd"),
        F.max_by("previous_price_usd", at).alias("previous_list_price_usd"), (F.count("*") - 1).alias("price_changes"))
    seen = snapshots.groupBy("listing_id").agg(F.min("seen_at").alias("first_seen_at"), F.max("seen_at").alias("last_seen_at"))
    return seen.join(prices, "listing_id", "left").withColumns({
        "days_on_market": F.datediff(today, F.to_date("first_seen_at")),
        "is_stale": F.datediff(today, F.to_date("last_seen_at")) > stale_after_days,
    })


def raise_alerts(pauses: DataFrame, budget: DataFrame) -> DataFrame:
    """Alert rows for paused sources and for runs that hit a budget cap; ids follow from their content."""
    p = pauses.filter("paused").select(
        F.lit("warn").alias("severity"), F.concat(F.lit("adapter:"), F.col("source_id")).alias("source"),
        F.concat(F.lit("auto-paused after "), F.col("attempts"), F.lit(" fetches, "), F.col("errors"), F.lit(" errors")).alias("message"),
        F.col("ts").alias("created_at"))
    stops = budget.filter("refused").groupBy("run_id").agg(F.min("ts").alias("created_at"), F.count("*").alias("_n"))
    b = stops.select(
        F.lit("error").alias("severity"), F.lit("worker").alias("source"),
        F.concat(F.lit("budget exceeded in run "), F.col("run_id"), F.lit(", "), F.col("_n"), F.lit(" calls refused")).alias("message"),
        "created_at")
    alerts = p.unionByName(b)
    return alerts.withColumns({
        "id": F.sha2(F.concat_ws("|", "source", "message", F.col("created_at").cast("string")), 256),
        "acknowledged_at": F.lit(None).cast("timestamp"),
    })
