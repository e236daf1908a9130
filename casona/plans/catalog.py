"""Registry of queries and their SQL equivalents."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casona import refdata
from casona.plans.standins import VIEWS, Tables, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` as a query, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return fn(Tables(spark, root))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    """SQL preceded by the stand-in views and fixed tables it names."""
    available = {**{n: duck(v) for n, v in VIEWS.items()}, **FIXED}
    needed = [n for n in available if re.search(rf"\b{n}\b", sql)]
    if not needed:
        return sql
    ctes = ", ".join(f"{n} AS ({available[n].strip()})" for n in needed)
    body = sql.strip()
    if body[:15].upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def _text(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value!r}e0" if isinstance(value, float) else str(value)


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(map(_text, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


FIXED = {
    "f_localities": values([(i, k, r) for i, (k, r) in enumerate(refdata.GAZETTEER)], "ord, key, region"),
    "f_boxes": values([(i, *b) for i, b in enumerate(refdata.REGION_BOXES)], "ord, region, lat1, lat2, lng1, lng2"),
    "f_places": values(
        [("airport", i, a[0], a[3], a[4]) for i, a in enumerate(refdata.AIRPORTS)]
        + [("hospital", i, h[0], h[2], h[3]) for i, h in enumerate(refdata.HOSPITALS)]
        + [("school", i, s[0], s[2], s[3]) for i, s in enumerate(refdata.SCHOOLS)]
        + [("beach", i, b[0], b[1], b[2]) for i, b in enumerate(refdata.BEACHES)],
        "kind, ord, name, p_lat, p_lng"),
}


def load() -> None:
    """Import every query module once."""
    from casona.plans import (  # noqa: F401
        queries_accounting, queries_extraction, queries_normalize, queries_operations, queries_photos,
        queries_resolution, queries_search, queries_streaming, queries_sync, queries_tables, queries_upsert,
    )
