"""Structured Streaming forms, run over what has arrived; each must equal its batch counterpart.

The event table's file is the stream source. Aggregates run in complete mode into one folder per
micro-batch under the session's shared folder; the newest folder is the answer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from casona import refdata
from casona.operators import extraction as ex
from casona.plans.catalog import query
from casona.plans.queries_accounting import DAY_SQL, prices
from casona.plans.queries_extraction import IDS
from casona.plans.sqlparts import stamp
from casona.plans.standins import DETAIL_PAGES, LISTINGS, LOGS
from casona.operators import accounting as acc
from casona.operators.keyed import RawTable
from casona.session import shared_folder
from casona.sources import rules
from casona.streaming import jobs


def _folder(t) -> str:
    return f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"


def _stream(t, table: str, view: str) -> DataFrame:
    """The stand-in view over a table's file as a stream."""
    schema = getattr(t, table).schema
    source = t.spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(t.root)
    return t.spark.sql(view, **{table: source})


def _complete(t, stream: DataFrame) -> DataFrame:
    """Whole result of an aggregating stream after everything available was read."""
    out = _folder(t)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{out}/state").trigger(
        availableNow=True).start().awaitTermination()
    batches = t.spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    last = batches.agg(F.max("batch")).first()[0]
    return batches.filter(F.col("batch") == last).drop("batch")


def _append(t, stream: DataFrame) -> DataFrame:
    out = _folder(t)
    jobs.run_available(stream, f"{out}/rows", f"{out}/state")
    return t.spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query("stream_error_rate", f"""
    SELECT {stamp("date_trunc('day', ts)")} AS window_start, source_id, count(*) AS attempts, count(*) FILTER (http_status >= 400) AS errors, count(*) FILTER (http_status >= 500) AS server_errors,
      count(*) >= {refdata.PAUSE_MIN_SAMPLE} AND (count(*) FILTER (http_status >= 400) > 0.2e0 * count(*) OR count(*) FILTER (http_status >= 500) > 0.1e0 * count(*)) AS breach
    FROM v_logs GROUP BY date_trunc('day', ts), source_id""")
def stream_error_rate(t):
    out = _complete(t, jobs.error_rates(_stream(t, "events", LOGS), window="1 day"))
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("stream_cost_rollup", f"""
    SELECT day, cost_usd, haiku_input_tokens + sonnet_input_tokens AS input_tokens, haiku_output_tokens + sonnet_output_tokens AS output_tokens, call_count FROM ({DAY_SQL})""")
def stream_cost_rollup(t):
    calls = acc.model_cost(_stream(t, "events", LOGS), prices(t))
    return _complete(t, jobs.cost_rollup(calls))


@query("stream_cost_updates", f"""
    SELECT day, cost_usd, haiku_input_tokens + sonnet_input_tokens AS input_tokens, haiku_output_tokens + sonnet_output_tokens AS output_tokens, call_count FROM ({DAY_SQL})""")
def stream_cost_updates(t):
    """Events that arrive in several files, one a batch, in update mode; the newest update of a day is its total."""
    at = _folder(t)
    logs = t.sql(LOGS)
    logs.repartitionByRange(4, "ts").write.parquet(f"{at}/in")
    arriving = t.spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    # files may be taken in any order, so no day is closed before all have arrived
    stream = jobs.cost_rollup(acc.model_cost(arriving, prices(t)), watermark="3650 days")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/rows/batch={batch_id}")

    stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{at}/state").trigger(
        availableNow=True).start().awaitTermination()
    updates = t.spark.read.option("basePath", f"{at}/rows").parquet(f"{at}/rows/batch=*")
    rest = [c for c in updates.columns if c not in ("day", "batch")]
    return updates.groupBy("day").agg(F.max_by(F.struct(*rest), "batch").alias("_u")).select("day", "_u.*")


@query("stream_run_trace", """
    SELECT run_id, stage, count(*) AS events, count(*) FILTER (level = 'error') AS errors, count(*) FILTER (level = 'warn') AS warnings FROM v_logs GROUP BY 1, 2""")
def stream_run_trace(t):
    return jobs.folded_trace(_complete(t, jobs.run_trace(_stream(t, "events", LOGS))))


@query("stream_dedupe", "SELECT DISTINCT source, source_listing_id, content_hash FROM (SELECT source_id AS source, run_id AS source_listing_id, stage AS content_hash FROM v_logs)")
def stream_dedupe(t):
    arrivals = _stream(t, "events", LOGS).select(
        F.col("source_id").alias("source"), F.col("run_id").alias("source_listing_id"), F.col("stage").alias("content_hash"), "ts")
    # the watermark spans the table, so every repeat is inside it
    kept = jobs.dedupe_arrivals(arrivals, watermark="400 days")
    return _append(t, kept).select("source", "source_listing_id", "content_hash")


@query("stream_run_sessions", f"""
    WITH o AS (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY run_id ORDER BY ts) + INTERVAL '6' HOUR THEN 1 ELSE 0 END AS cut FROM v_logs),
    s AS (SELECT *, sum(cut) OVER (PARTITION BY run_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM o)
    SELECT run_id, {stamp('min(ts)')} AS started_at, {stamp("max(ts) + INTERVAL '6' HOUR")} AS ended_at, count(*) AS events, count(*) FILTER (level = 'error') AS errors FROM s GROUP BY run_id, n""")
def stream_run_sessions(t):
    out = _complete(t, jobs.run_sessions(_stream(t, "events", LOGS), gap="6 hours"))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("started_at", "ended_at")})


SEARCHES = """
    SELECT c_custkey AS search_id, CASE WHEN c_custkey % 100 = 0 THEN NULL ELSE CASE c_nationkey % 4 WHEN 0 THEN 'Nosara' WHEN 1 THEN 'Uvita de Osa' WHEN 2 THEN 'Escazú' ELSE 'San José' END END AS region_slug,
      CASE WHEN c_nationkey % 3 = 0 THEN 'condo' END AS property_type, CAST(400000 + c_acctbal AS DECIMAL(14,2)) AS min_price,
      CASE WHEN c_nationkey % 2 = 0 THEN CAST(450000 AS DECIMAL(14,2)) END AS max_price, CASE WHEN c_nationkey > 5 THEN 3 END AS min_beds
    FROM {customer}"""


@query("saved_search_matches", f"""
    SELECT l.id, s.search_id FROM v_listings l JOIN ({SEARCHES.format(customer='customer')}) s ON (s.region_slug IS NULL OR s.region_slug = l.locality) AND (s.property_type IS NULL OR s.property_type = l.property_type)
      AND l.price >= s.min_price AND (s.max_price IS NULL OR l.price <= s.max_price) AND (s.min_beds IS NULL OR l.bedrooms >= s.min_beds) WHERE l.status = 'active'""")
def saved_search_matches(t):
    """Micro-batches store their matches in blocks, as these grow with listings times searches; the result has a row for each."""
    arriving = _stream(t, "orders", LISTINGS).withColumns({"region_slug": F.col("locality"), "price_usd": F.col("price")})
    searches, out = t.sql(SEARCHES), _folder(t)

    def write(batch: DataFrame, batch_id: int) -> None:
        jobs.saved_search_matches(batch, searches, blocks=True).write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    arriving.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return jobs.pairs(t.spark.read.parquet(f"{out}/rows"))


RAW_TABLE = """
    source string, source_listing_id string, source_url string, run_id bigint, raw_html string, raw_extracted string, breadcrumbs array<string>,
    photos array<struct<url:string, position:int>>, scraped_at timestamp, extract_status string, normalize_status string, dedupe_status string,
    enrich_status string, publish_status string, error string"""


def _stamped(payloads: DataFrame) -> DataFrame:
    return payloads.withColumns({"run_id": F.lit(1).cast("bigint"), "scraped_at": F.lit("2024-06-01").cast("timestamp")})


def _raw_table(t, path: str, buckets: int = 16) -> RawTable:
    return RawTable(t.spark, path, t.spark.createDataFrame([], RAW_TABLE).schema, buckets)


@query("stream_ingest", f"""
    SELECT source, {IDS} AS source_listing_id, url AS source_url, 'pending' AS extract_status, true AS was_new FROM v_details""")
def stream_ingest(t):
    pages = _stream(t, "pages", DETAIL_PAGES).select("source", "url", "html")
    rule_rows = rules.rule_table(t.spark)
    at = _folder(t)
    table = _raw_table(t, f"{at}/raw")
    to_payloads = lambda batch: _stamped(ex.assemble_payload(batch, rule_rows))
    jobs.stream_ingest(pages, to_payloads, table, f"{at}/state").awaitTermination()
    return table.read().select("source", "source_listing_id", "source_url", "extract_status", "was_new")


@query("ingest_snapshots", f"""
    SELECT source, source_listing_id, CAST(max(version) AS INTEGER) AS version, count(*) > 1 AS returned, CASE WHEN max(version) = 2 THEN count(*) = 1 END AS was_new FROM (
      SELECT source, {IDS} AS source_listing_id, 1 AS version FROM v_details
      UNION ALL SELECT source, {IDS}, 2 FROM v_details WHERE length(page_html) % 2 = 0
      UNION ALL SELECT source, 'late-' || page_id, 2 FROM v_details WHERE length(page_html) % 3 = 0) GROUP BY 1, 2""")
def ingest_snapshots(t):
    """Two streamed batches with a compaction between them; what was there before is told from the older snapshot."""
    at = _folder(t)
    rows = ex.assemble_payload(t.v_details.select("source", "url", "html"), rules.rule_table(t.spark))
    pages = t.v_details.select(F.col("url").alias("source_url"), "page_id", F.length("page_html").alias("size"))
    rows = _stamped(rows.join(pages, "source_url"))
    first = rows.drop("page_id", "size")
    again = rows.filter("size % 2 = 0").drop("page_id", "size")
    late = rows.filter("size % 3 = 0").withColumn("source_listing_id", F.concat(F.lit("late-"), "page_id")).drop("page_id", "size")
    second = again.unionByName(late).withColumn("run_id", F.lit(2).cast("bigint"))
    first.write.parquet(f"{at}/in/batch=1")
    table = _raw_table(t, f"{at}/raw")

    def run() -> None:
        arriving = t.spark.readStream.schema(first.schema).parquet(f"{at}/in/batch=*")
        jobs.stream_ingest(arriving, lambda batch: batch, table, f"{at}/state").awaitTermination()

    run()
    table.compact()
    before = table.snapshot()
    second.write.parquet(f"{at}/in/batch=2")
    run()
    old = table.read(before).select("source", "source_listing_id", F.lit(True).alias("old"))
    return table.read().select("source", "source_listing_id", F.col("run_id").cast("int").alias("version"), "was_new").join(
        old, ["source", "source_listing_id"], "left").select(
        "source", "source_listing_id", "version", (F.coalesce("old", F.lit(False)) & (F.col("version") == 2)).alias("returned"), "was_new")
