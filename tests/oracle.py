"""Side-by-side check of registered queries against DuckDB on the same tables.

``python -m tests.oracle [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from casona.plans.standins import ALL_TABLES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "float": "FLOAT",
}


def connect(root: str = SF_DIR):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, Decimal):
        return str(value)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    expected = con.sql(sql)
    names, types = expected.columns, [str(t) for t in expected.types]
    want = dict(zip(names, types))
    have = {n: TYPES.get(t, t.upper()) for n, t in df.dtypes}
    if sorted(want) != sorted(have):
        return f"columns {sorted(have)} != {sorted(want)}"
    bad = {n: (have[n], want[n]) for n in want if have[n] != want[n]}
    if bad:
        return f"types (spark, duckdb): {bad}"
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    right = _rows(names, expected.fetchall())
    if left != right:
        only_l, only_r = list((left - right).items())[:3], list((right - left).items())[:3]
        return (
            f"rows {sum(left.values())} vs {sum(right.values())}; differ {sum((left - right).values())};\n"
            f"   spark  {only_l}\n   duckdb {only_r}")
    return None


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from casona.session import get_spark

    if os.environ.get("CHECK_PLAIN"):  # a session without any of the package's settings
        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
    else:
        spark = get_spark("oracle", cores="8", shuffle_partitions=8)
    con = connect()
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, SF_DIR)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                rows = ""
            else:
                problem, rows = None, f" rows-only {len(df.collect())}"
        except Exception as e:  # report and go on
            problem, rows = f"{type(e).__name__}: {str(e)[:700]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{rows} {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
