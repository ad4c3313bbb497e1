"""Plan guards for every registered query: no all-pairs joins, no Python in
the hot path, no row caps or sampling; scans pruned and filters pushed."""

import pytest

from orderflow.plans.catalog import QUERIES

from .conftest import SF_SMALL

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "GlobalLimit",
    "CollectLimit",
    "Sample",
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, (name, found)


def test_marts_prune_columns_and_push_filters(spark):
    plan = _plan(QUERIES["product_metrics"](spark, SF_SMALL))
    # the customer side contributes only its key (email, name and country are pruned)
    import re

    scans = [line for line in plan.splitlines() if "FileScan parquet [customer_id#" in line]
    assert any(re.search(r"FileScan parquet \[customer_id#\d+\]", line) and "IsNotNull(customer_id)" in line for line in scans), scans


def test_valid_reads_touch_the_valid_folder_only(spark):
    files = QUERIES["dedup_orders"](spark, SF_SMALL).inputFiles()
    assert files and all("/split=valid/" in f for f in files)


def test_stage_one_has_no_shuffle(spark):
    plan = _plan(QUERIES["validate_orders"](spark, SF_SMALL))
    assert "Exchange" not in plan
