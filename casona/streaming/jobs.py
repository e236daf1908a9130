"""Streaming jobs: transformations on unbounded DataFrames, and the one stateful sink.

State is kept by built-in operators only, bounded by watermarks; late rows beyond the
watermark are dropped and counted by Spark's own metrics.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from casona import refdata
from casona.operators.accounting import COST
from casona.operators.keyed import RawTable


def stream_ingest(
    pages: DataFrame, to_payloads: Callable[[DataFrame], DataFrame], table: RawTable, checkpoint: str, writer: str = "stream", **trigger,
) -> StreamingQuery:
    """Page arrivals -> payloads -> raw table: micro-batch n is one append, numbered n by ``writer``.

    A batch writes its own rows only and reads nothing; its commit is one manifest. A replayed
    batch changes nothing, readers fold waiting rows for the buckets that have some, and
    ``RawTable.compact`` rewrites the fullest buckets while readers keep their snapshot.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table.arrive(batch_id, to_payloads(batch), writer)

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start()


def error_rates(
    fetches: DataFrame, window: str = "1 hour", watermark: str = "2 hours", min_sample: int = refdata.PAUSE_MIN_SAMPLE
) -> DataFrame:
    """Error and 5xx shares of each source per window; ``breach`` above the pause limits."""
    counted = (
        fetches.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), "source_id")
        .agg(
            F.count("*").alias("attempts"), F.count_if(F.col("http_status") >= 400).alias("errors"),
            F.count_if(F.col("http_status") >= 500).alias("server_errors")))
    breach = (F.col("attempts") >= min_sample) & (
        (F.col("errors") > refdata.PAUSE_ERROR_RATE * F.col("attempts"))
        | (F.col("server_errors") > refdata.PAUSE_5XX_RATE * F.col("attempts")))
    return counted.select(
        F.col("window.start").alias("window_start"), "source_id", "attempts", "errors", "server_errors", breach.alias("breach"))


def cost_rollup(calls: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Cost, tokens and calls per day as model calls arrive."""
    return (
        calls.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day"))
        .agg(
            F.sum("cost_usd").cast(COST).alias("cost_usd"), F.sum("input_tokens").cast("bigint").alias("input_tokens"),
            F.sum("output_tokens").cast("bigint").alias("output_tokens"), F.count("*").alias("call_count"))
        .select(F.to_date("window.start").alias("day"), "cost_usd", "input_tokens", "output_tokens", "call_count"))


def run_trace(logs: DataFrame, window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Events, errors and warnings of each run, stage and window; the watermark bounds the state."""
    return (
        logs.withWatermark("ts", watermark).groupBy(F.window("ts", window), "run_id", "stage")
        .agg(
            F.count("*").alias("events"), F.count_if(F.col("level") == "error").alias("errors"),
            F.count_if(F.col("level") == "warn").alias("warnings"))
        .select(F.col("window.start").alias("window_start"), "run_id", "stage", "events", "errors", "warnings"))


def folded_trace(windows: DataFrame) -> DataFrame:
    """Totals of each run and stage over the windows of ``run_trace``."""
    return windows.groupBy("run_id", "stage").agg(*(F.sum(c).alias(c) for c in ("events", "errors", "warnings")))


def dedupe_arrivals(payloads: DataFrame, ts: str = "ts", watermark: str = "1 day") -> DataFrame:
    """Payloads whose (source, id, content hash) was not seen within the watermark."""
    return payloads.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["source", "source_listing_id", "content_hash"])


def run_sessions(logs: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Run boundaries by silence in the logs: start, end and events of every session of a run id."""
    return (
        logs.withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap).alias("_s"), "run_id")
        .agg(F.count("*").alias("events"), F.count_if(F.col("level") == "error").alias("errors"))
        .select("run_id", F.col("_s.start").alias("started_at"), F.col("_s.end").alias("ended_at"), "events", "errors"))


#: Prices go by a code that rises with them: whole units below 2^EXACT, then their EXACT highest bits (off by 1 / 2,048 at most).
#: Price cells: level n is cut into cells of 4^n codes; the highest level is one cell.
EXACT, MOST_PRICE, LEVELS = 12, 2**40 - 1, 8
MOST_BEDS = 12
_ANY_TEXT, _ANY_BEDS, _ANY_PRICE = "\u0000", -1, -1


def _pieces(low: str, high: str) -> str:
    """SQL: the fewest cells (level, cell) that together are the whole numbers from ``low`` to ``high``.

    A cell is taken where it lies inside the range and its parent does not: at most six a level.
    """
    first, last = f"(({low} + w - 1) div w)", f"(({high} + 1) div w - 1)"
    up_first, up_last = f"(({low} + 4 * w - 1) div (4 * w))", f"(({high} + 1) div (4 * w) - 1)"
    run = lambda a, b: f"if({a} <= {b}, sequence({a}, {b}), array())"
    cells = f"if({up_first} > {up_last}, {run(first, last)}, concat({run(first, f'4 * {up_first} - 1')}, {run(f'4 * {up_last} + 4', last)}))"
    cells = f"transform({cells}, c -> named_struct('level', l, 'cell', c))"
    return f"flatten(transform(sequence(0, {LEVELS}), l -> element_at(transform(array(shiftleft(1L, 2 * l)), w -> {cells}), 1)))"


def _clamped(c: str, kind: str, top: int) -> Column:
    """Whole number from 0 to ``top``; null stays null (greatest and least would skip it)."""
    return F.when(F.col(c).isNotNull(), F.least(F.greatest(F.floor(c).cast(kind), F.lit(0)), F.lit(top)))


def _code(c: str) -> Column:
    """A price's place on the scale of cells."""
    p = _clamped(c, "bigint", MOST_PRICE)
    dropped = F.greatest(F.length(F.bin(p)) - EXACT, F.lit(0))
    return dropped.cast("bigint") * 2**(EXACT - 1) + F.call_function("shiftright", p, dropped)


def _indexed(searches: DataFrame) -> DataFrame:
    """A row for each key under which a listing finds a search: region, type, least beds and a price cell."""
    bounds = searches.select(
        "search_id", "min_price", "max_price", "min_beds", F.coalesce("region_slug", F.lit(_ANY_TEXT)).alias("_region"),
        F.coalesce("property_type", F.lit(_ANY_TEXT)).alias("_type"),
        F.coalesce(_code("min_price"), F.lit(0)).alias("_low"), F.coalesce(_code("max_price"), F.lit(4**LEVELS - 1)).alias("_high"),
        F.coalesce(_clamped("min_beds", "int", MOST_BEDS), F.lit(_ANY_BEDS)).alias("_beds"))
    unlimited = F.col("min_price").isNull() & F.col("max_price").isNull()
    price = F.when(unlimited, F.array(F.struct(F.lit(_ANY_PRICE).alias("level"), F.lit(0).cast("bigint").alias("cell")))).otherwise(F.expr(_pieces("_low", "_high")))
    return bounds.withColumn("_price", F.explode(price)).drop("_low", "_high")


def _asked(listings: DataFrame, keys: DataFrame) -> DataFrame:
    """Active listings, once for each key (``_k``) under which the index ``keys`` may hold searches that they meet.

    A listing asks only for kinds of keys that some search has: whether region and type are named,
    the least beds, and the price level, there between the lowest and the highest cell. There are at
    most 4 * (MOST_BEDS + 2) * (LEVELS + 2) of them, so they are read first.
    """
    shape = [F.col("_region") == _ANY_TEXT, F.col("_type") == _ANY_TEXT, F.col("_beds"), F.col("_price.level")]
    shapes = keys.groupBy(*(c.alias(name) for name, c in zip("rtbl", shape))).agg(F.min("_price.cell").alias("low"), F.max("_price.cell").alias("high"))
    shapes = F.from_json(F.lit(json.dumps([r.asDict() for r in shapes.collect()])), "array<struct<r: boolean, t: boolean, b: int, l: int, low: bigint, high: bigint>>")
    active = listings.filter("status = 'active'").withColumns({
        "_p": _code("price_usd"), "_b": _clamped("bedrooms", "int", MOST_BEDS), "_s": F.explode(shapes)})
    cell = F.when(F.col("_s.l") == _ANY_PRICE, 0).otherwise(F.expr("shiftright(_p, 2 * _s.l)"))
    active = active.filter((F.col("_s.b") <= F.coalesce("_b", F.lit(_ANY_BEDS))) & cell.between(F.col("_s.low"), F.col("_s.high")))
    return active.withColumn("_k", F.struct(
        F.when(F.col("_s.r"), _ANY_TEXT).otherwise(F.col("region_slug")).alias("region"), F.when(F.col("_s.t"), _ANY_TEXT).otherwise(F.col("property_type")).alias("type"),
        F.col("_s.b").alias("beds"), F.col("_s.l").alias("level"), cell.alias("cell"))).drop("_p", "_b", "_s")


def _candidates(listings: DataFrame, searches: DataFrame) -> DataFrame:
    """Active listings with the searches that they meet but for parts of a currency unit or a room and for beds beyond the highest.

    Spark takes the exploded index for as small as the searches, so the join is told not to broadcast it.
    """
    keys = _indexed(searches)
    on = [F.col(f"_k.{a}") == F.col(b) for a, b in (("region", "_region"), ("type", "_type"), ("beds", "_beds"), ("level", "_price.level"), ("cell", "_price.cell"))]
    return _asked(listings, keys).join(keys.hint("merge"), on[0] & on[1] & on[2] & on[3] & on[4]).drop("_k", "_region", "_type", "_beds", "_price")


#: Listings, and searches, of a block of matches (a power of two); matches that one task writes out of blocks.
BLOCK_BITS, PAIRS_A_TASK = 10, 2**24
_KEY = ["_region", "_type", "_beds", "_level", "_cell"]


def _runs(rows: DataFrame, order: list[str], name: str, *bounds: Column) -> DataFrame:
    """Rows of a key in arrays of at most 2^BLOCK_BITS, in order; the rows of a hot key spread over as many ranges as they need."""
    rows = rows.repartitionByRange(*_KEY, *order).sortWithinPartitions(*_KEY, *order)
    rows = rows.withColumn("_run", F.call_function("shiftright", F.monotonically_increasing_id(), F.lit(BLOCK_BITS)))
    return rows.groupBy(*_KEY, "_run").agg(F.collect_list(F.struct(*order)).alias(name), *bounds).drop("_run")


def _within(listing: Callable[[str], Column], search: Callable[[str], Column]) -> Column:
    """Whether a listing lies within a search's limits; null is no limit."""
    return (
        (search("min_price").isNull() | (listing("price_usd") >= search("min_price")))
        & (search("max_price").isNull() | (listing("price_usd") <= search("max_price")))
        & (search("min_beds").isNull() | (listing("bedrooms") >= search("min_beds"))))


def _blocks(listings: DataFrame, searches: DataFrame) -> DataFrame:
    """Matches in blocks (ids, search_ids): each listing of a row meets each search of it, a match is in one block.

    Listings and searches of a key meet run by run. Listings within the tightest limits of a run of
    searches meet all of it and are a block; each of the others is a block with the searches it meets.
    """
    keys = _indexed(searches)
    asked = _asked(listings, keys).select(*(F.col(f"_k.{c[1:]}").alias(c) for c in _KEY), "price_usd", "bedrooms", "id")
    keys = keys.withColumns({"_level": F.col("_price.level"), "_cell": F.col("_price.cell")})
    tightest = [F.max("min_price").alias("min_price"), F.min("max_price").alias("max_price"), F.max("min_beds").alias("min_beds")]
    runs = _runs(asked.dropna(subset=_KEY), ["price_usd", "bedrooms", "id"], "_l").join(
        _runs(keys, ["min_price", "max_price", "min_beds", "search_id"], "_s", *tightest).hint("merge"), _KEY)
    all_met = lambda x: F.coalesce(_within(lambda c: x[c], F.col), F.lit(False))
    met = lambda x: F.filter("_s", lambda s: _within(lambda c: x[c], lambda c: s[c]))
    block = lambda of, found: F.struct(of.alias("ids"), F.transform(found, lambda s: s["search_id"]).alias("search_ids"))
    whole = block(F.transform(F.filter("_l", all_met), lambda x: x["id"]), F.col("_s"))
    single = F.transform(F.filter("_l", lambda x: ~all_met(x)), lambda x: block(F.array(x["id"]), met(x)))
    return runs.select(F.inline(F.concat(F.array(whole), single))).filter((F.size("ids") > 0) & (F.size("search_ids") > 0))


def pairs(blocks: DataFrame) -> DataFrame:
    """A row (id, search_id) for each match in the blocks of ``saved_search_matches``, dealt out by their number.

    Generated code keeps all rows that it makes of one row until they are taken. So a block becomes a
    row for each listing first; ``coalesce`` to as many tasks moves nothing, but ends that code.
    """
    n = blocks.agg(F.sum(F.size("ids").cast("bigint") * F.size("search_ids"))).first()[0] or 0
    tasks = max(1, math.ceil(n / PAIRS_A_TASK))
    found = blocks.repartition(tasks).select(F.explode("ids").alias("id"), "search_ids").coalesce(tasks)
    return found.select("id", F.explode("search_ids").alias("search_id"))


def saved_search_matches(listings: DataFrame, searches: DataFrame, blocks: bool = False) -> DataFrame:
    """New active listings that meet stored filters (search_id, region_slug, property_type, min_price, max_price, min_beds).

    Null in any filter means no limit. Searches are indexed by region, type, beds and the cells
    that make up their price range, so a listing meets few searches that do not match, also where
    they name neither region nor type. The index is the static side and is shuffled, never
    broadcast. A listing meets a search under one key at most.

    Matches grow with listings times searches. With ``blocks`` they come as rows (ids, search_ids) in
    which all meet all, small enough to store; ``pairs`` gives a row for each match. Blocks are made
    of a whole table or micro-batch, plain matches also of a stream.
    """
    if blocks:
        return _blocks(listings, searches)
    return _candidates(listings, searches).filter(_within(F.col, F.col)).drop("min_price", "max_price", "min_beds")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what has arrived and stop; append results land in ``path`` as Parquet."""
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start(path).awaitTermination()
