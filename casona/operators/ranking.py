"""Order-dependent operators that stay parallel when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casona.session import stored

#: Rows of a key, and the share of all rows, up to which one task may hold them; at most 1 / share keys have more.
MOST_ROWS, MOST_SHARE = 10_000, 0.001


def newest(edits: DataFrame, *ties: str, seq: str = "seq") -> Column:
    """Order of edits: by their sequence column if the table has one, then by the tie columns."""
    return F.struct(*([seq] if seq in edits.columns else []), *ties)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of every key in a total order, or all of them, with their 1-based rank.

    Spark itself cuts each task's rows to ``n`` per key before the shuffle.
    """
    over = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(over))
    return ranked if n is None else ranked.filter(F.col(rank) <= n)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Rows numbered from 1 in a total order, without one task that sees them all.

    Rows are range partitioned and written once; counts of the ranges give the number of rows
    before each, and only rows of one range are numbered together.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "row-numbers")
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = dealt.join(ahead, F.col("_range") == F.col("_r")).withColumn(name, F.col("_ahead") + inside)
    return numbered.drop("_range", "_r", "_ahead")


def by_size(df: DataFrame, keys: Sequence[str], label: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the keys that one task may hold, and those of the few larger keys, None if there are none.

    The rows are written once and read from there.
    """
    rows = stored(df, label)
    bound = max(MOST_ROWS, int(MOST_SHARE * rows.count()))
    hot = rows.groupBy(*keys).count().filter(F.col("count") > bound).select(*(F.col(k).alias(f"_hot_{k}") for k in keys))
    hot = stored(hot, f"{label}-hot")
    if hot.isEmpty():
        return rows, None
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    return rows.join(F.broadcast(hot), same, "left_anti"), rows.join(F.broadcast(hot), same, "left_semi")


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """Rows range partitioned by key and order and written once, with their range's number."""
    return stored(df.repartitionByRange(*map(F.col, keys), *order).withColumn("_range", F.spark_partition_id()), label)


def _carried(dealt: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dealt`` with the columns that ``carried`` (_k_ keys, _k_range) brings into a range."""
    same = dealt["_range"] == carried["_k_range"]
    for k in keys:
        same = same & dealt[k].eqNullSafe(carried[f"_k_{k}"])
    return dealt.join(carried, same, "left")


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], totals: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per key in a total order, added as columns.

    The input is computed once. Range partitioning by key and order cuts a hot key into as many
    ranges as its rows need; sums of the ranges before are carried into a range only for the keys
    that span several, so what is joined has at most a row a range.
    """
    work = df.withColumns({f"_v_{name}": value for name, value in totals.items()})
    dealt = _dealt(work, keys, order, "running-totals")
    sums = dealt.groupBy(*keys, "_range").agg(*(F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_range").alias("_k_range"), F.count("*").over(before).alias("_before"),
        *(F.sum(f"_s_{n}").over(before).alias(f"_o_{n}") for n in totals),
    ).filter("_before > 0")
    inner = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = _carried(dealt, offsets, keys)
    for name in totals:
        zero = F.lit(0).cast(work.schema[f"_v_{name}"].dataType)
        out = out.withColumn(name, F.sum(f"_v_{name}").over(inner) + F.coalesce(F.col(f"_o_{name}"), zero))
    return out.select(*df.columns, *totals)


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: dict[str, str]) -> DataFrame:
    """Value of the row before, per key in a total order (out name -> column), over ranges like running_totals."""
    dealt = _dealt(df, keys, order, "previous-row")
    last = dealt.groupBy(*keys, "_range").agg(F.max_by(F.struct(*values.values()), F.struct(*order)).alias("_last"))
    carried = last.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_range").alias("_k_range"),
        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_range")).alias("_carry"),
    ).filter("_carry IS NOT NULL")
    inner = Window.partitionBy(*keys, "_range").orderBy(*order)
    out = _carried(dealt, carried, keys).withColumn("_first", F.row_number().over(inner) == 1)
    for name, column in values.items():
        out = out.withColumn(
            name, F.when(F.col("_first"), F.col(f"_carry.{column}")).otherwise(F.lag(column).over(inner)))
    return out.select(*df.columns, *values)
