"""Timings of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once to warm up and then three times; the median wall time counts. Results
go to Spark's noop sink, so every column is computed and nothing is collected. A Parquet file of
one row group cannot be split, so before timing the tables are copied once into as many files as
there are cores, as a cluster would store them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from casona.plans import catalog
from casona.plans.standins import ALL_TABLES
from casona.session import get_spark

HEADLINE = [
    "market_report", "fx_normalize", "region_locality", "nearest_poi", "clean_title", "clean_description", "build_slug",
    "normalize_stage", "derive_categories", "geocode_lookup", "score_pairs", "decide", "topk_similar", "cluster_same_text",
    "upsert_raw", "merge_canonical", "upsert_links", "apply_verdicts", "assign_positions", "gallery", "listing_cards", "search_page",
    "fulltext_rank", "stage_funnel", "run_trace_counts", "plan_sync", "publish_documents", "auto_pause", "budget_cutoff",
    "daily_cost_rollup", "price_history", "strip_noise", "open_graph", "page_links", "assemble_payload", "validate_extracted",
]


def split_tables(spark, root: str, files: int) -> str:
    """A folder with the same tables, each in ``files`` files."""
    folder = tempfile.mkdtemp(prefix="casona-bench-")
    for name in ALL_TABLES:
        spark.read.parquet(f"{root}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    sf = os.path.basename(root.rstrip("/")).removeprefix("sf")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    catalog.load()
    names = sys.argv[1:] or HEADLINE
    spark = get_spark("casona-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else None)
    root = split_tables(spark, root, int(cpus) if cpus.isdigit() else 8)
    timings: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": sf,
    }))


if __name__ == "__main__":
    main()
