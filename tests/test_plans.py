"""Physical plans: lookups broadcast, nothing pairs everything with everything, filters reach the scan."""

import pytest

from casona.plans import catalog

catalog.load()
ROOT = "/root/testdata/sf0.001"


def plan(spark, name):
    return catalog.QUERIES[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fx_normalize", "model_cost", "source_listing_id", "market_report"])
def test_lookups_are_broadcast_without_shuffling_the_big_side(spark, name):
    text = plan(spark, name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", [
    "region_bbox", "region_locality", "nearest_poi", "normalize_stage", "listing_cards", "upsert_raw", "merge_canonical", "auto_pause",
    "budget_cutoff", "topk_similar", "decide", "kpis", "sync_summary", "visible_rows", "geocode_lookup", "price_history"])
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(spark, "stage_funnel").replace("\n", " ")


@pytest.mark.parametrize("name,most", [("assign_positions", 3), ("budget_cutoff", 0), ("apply_verdicts", 1)])
def test_running_totals_read_their_input_once(spark, name, most):
    """What follows the one write of the input reads that, and the tables only for its own joins."""
    assert plan(spark, name).count(ROOT) <= most
