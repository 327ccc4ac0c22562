"""Plan guards for every registered query: no cross products, and filters and
projections reach the scans."""

import pytest

from sluice.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

# building these writes files, so they are left to their own tests
WRITES = {"table_history", "layer_tables", "csv_round_trip", "csv_quarantine", "bucket_merge"}
NAMES = sorted(set(QUERIES) - WRITES)


def _plan(spark, capsys, name):
    QUERIES[name](spark, SF_SMALL).explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_products(spark, capsys, name):
    plan = _plan(spark, capsys, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lineitem_scan_reads_only_needed_columns(spark, capsys):
    plan = _plan(spark, capsys, "revenue_by_region")
    scan = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema: struct<l_orderkey")]
    assert scan and "l_shipdate" not in scan[0] and "l_tax" not in scan[0]


def test_source_filter_reaches_the_scan(spark, capsys):
    plan = _plan(spark, capsys, "merge_upsert")
    assert "LessThanOrEqual(l_linenumber,4)" in plan and "GreaterThan(l_linenumber,4)" in plan


SCANS = {"layer_audit": 1, "dedup_audit": 1, "source_overlap": 1, "source_summary": 1, "bronze_audit": 1, "silver_orders": 1, "merge_upsert": 2}


@pytest.mark.parametrize("name", SCANS)
def test_lineitem_is_scanned_as_often_as_needed(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_orderkey") > 0
    assert sum("FileScan parquet" in line and "l_orderkey" in line for line in plan.splitlines()) == SCANS[name]


def _executed(node):
    """Names and texts of the nodes that ran, subqueries included; what is reused counts once."""
    name = node.getClass().getSimpleName()
    if name == "ReusedExchangeExec":
        return
    yield name, node.toString()
    if name == "AdaptiveSparkPlanExec":
        below = [node.executedPlan()]
    elif name.endswith("QueryStageExec"):
        below = [node.plan()]
    else:
        below = [x.apply(i) for x in (node.children(), node.subqueries()) for i in range(x.size())]
    for n in below:
        yield from _executed(n)


FORECASTS = ["forecast_series", "holdout_split", "trend_fit", "trend_forecast", "forecast_accuracy", "trend_forecast_runs", "seasonal_forecast_by_region", "changepoint_fit", "forecast_runs"]


@pytest.mark.parametrize("name", FORECASTS)
def test_a_forecast_reads_lineitem_once(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    ran = list(_executed(df._jdf.queryExecution().executedPlan()))
    assert sum(n == "FileSourceScanExec" and "l_orderkey" in text for n, text in ran) == 1


PANDAS_GROUPS = {"seasonal_forecast_by_region", "changepoint_fit", "forecast_runs"}


@pytest.mark.parametrize("name", NAMES)
def test_python_only_where_intended(spark, capsys, name):
    plan = _plan(spark, capsys, name)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan  # no per-row Python UDFs
    assert ("FlatMapGroupsInPandas" in plan) == (name in PANDAS_GROUPS)


def test_typed_orders_casts_text(spark):
    plan = QUERIES["typed_orders"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().lower()
    for kind in ("bigint", "int", "double", "date"):
        assert f"as {kind})" in plan
    assert plan.count("no bigint") and plan.count("no date")  # values that do not fit fail with the column's name


def test_layer_audit_has_no_window(spark, capsys):
    assert "Window" not in _plan(spark, capsys, "layer_audit")
