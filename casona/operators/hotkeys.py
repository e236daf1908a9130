"""Joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than this share of all rows is joined by broadcast; there are at most 1 / share such keys.
HOT_SHARE = 0.001


def met(rows: DataFrame, keyed: DataFrame, key: list[str], least: int) -> DataFrame:
    """``rows`` with the columns of ``keyed``: one row a key, whose column n says how many ``rows`` have it.

    Keys with over ``least`` rows meet theirs by broadcast.
    """
    cold, hot = keyed.filter(F.col("n") <= least), keyed.filter(F.col("n") > least)
    return rows.join(cold, key).unionByName(rows.join(F.broadcast(hot), key))


def hot_join(rows: DataFrame, other: DataFrame, key: list[str], least: int = 1000) -> DataFrame:
    """Inner join of ``rows`` (stored, it is read several times) with the few rows that ``other`` has for each key.

    The rows of a hot key stay where they are and meet the other side by broadcast: at most
    1 / HOT_SHARE keys with their few rows.
    """
    total = rows.count()
    if total <= least:
        return rows.join(other, key)
    bound = max(least, int(HOT_SHARE * total))
    hot = rows.groupBy(*key).count().filter(F.col("count") > bound).select(*key)
    near = rows.join(F.broadcast(other.join(F.broadcast(hot), key, "left_semi")), key)
    return near.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(other, key))
