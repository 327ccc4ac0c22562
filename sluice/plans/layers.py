"""B2: bronze -> silver -> gold -> forecast over the caller's own sources, every layer stored.

Each layer reads the *stored* previous layer, so the silver plan runs once
(not once per gold table) and every later step restarts from files in the
shared folder rather than from a long lineage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from sluice.config import LakeConfig, create_namespaces, fresh_lake
from sluice.operators import forecast as fc
from sluice.operators import quality as qa
from sluice.operators.tables import TableStore
from sluice.plans.gold import gold_tables_single_pass
from sluice.plans.silver import SILVER_KEYS, build_silver
from sluice.schema import SILVER_SCHEMA
from sluice.sources import testdata

# Table names and the reference's CHECK rules on revenue_by_region.
BRONZE_TABLES = ("sales_orders_csv", "sales_orders_postgres")
SILVER_TABLE = "sales_orders"
NULL_CHECK_COLUMNS = ("order_id", "customer_name", "product_name", "region", "status", "unit_price")
REGION_RULES = {"revenue_positive": "total_revenue > 0", "orders_positive": "total_orders > 0"}


@dataclass
class LayerRun:
    store: TableStore
    audit: DataFrame
    writes: DataFrame
    #: Q1 per bronze table and Q3 of silver, measured while they were written
    bronze_audit: DataFrame
    null_profile: DataFrame


def run_layers(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    lake: LakeConfig | None = None,
    clock: Column | None = None,
    horizon: int = 6,
    holdout: int = 2,
    forecast_model: str = "seasonal",
    tiebreak: Sequence[str] | None = None,
    drop_after: Sequence[str] = (),
) -> LayerRun:
    """Run every layer over ``sources`` (bronze table name -> frame, e.g. from
    ``read_orders_csv`` and ``read_postgres``) into ``lake`` (a new folder under
    ``spark.checkpoint.dir`` when omitted).

    Bronze is overwritten. Silver is created from ``SILVER_SCHEMA`` if absent and
    MERGEd by its key, so rerunning with the same data changes nothing. Gold is
    overwritten under the revenue rules, which are attached before its first
    write, so gold that breaks them is never the current version. The forecast
    table is overwritten and one run record per run is appended. Returns the
    store, the row count of every table, the list of writes, and the bronze audit
    and silver's NULL profile, which are measured in the writing jobs.
    """
    lake = lake or fresh_lake(spark, "run")
    create_namespaces(spark, lake)
    store = TableStore(spark, lake)
    for name, frame in sources.items():
        store.write("bronze", name, frame, measures=qa.bronze_measures())

    bronze = [store.read("bronze", name) for name in sources]
    updates = build_silver(*bronze, keys=SILVER_KEYS, tiebreak=tiebreak, drop_after=drop_after, clock=clock)
    store.create_if_absent("silver", SILVER_TABLE, SILVER_SCHEMA)
    # build_silver keeps one row per SILVER_KEYS, so the merge needs no duplicate check
    store.merge("silver", SILVER_TABLE, updates, SILVER_KEYS, check_unique=False, measures=qa.null_measures(NULL_CHECK_COLUMNS))

    silver = store.read("silver", SILVER_TABLE)
    store.add_constraints("gold", "revenue_by_region", REGION_RULES)
    # one scan of stored silver feeds all four gold tables
    for name, frame in gold_tables_single_pass(silver, clock).items():
        store.write("gold", name, frame)

    monthly = store.read("gold", "monthly_sales_trend")
    table, runs = fc.forecast_revenue(monthly, (), horizon, holdout, forecast_model, clock=clock)
    store.write("gold", "revenue_forecast", table)
    store.append("gold", "forecast_runs", runs)
    seen = [(name, *store.measured["bronze", name].values()) for name in sources]
    bronze_ddl = "table_name string, row_count long, earliest_order date, latest_order date, null_order_ids long, unique_regions long"
    nulls = list(store.measured["silver", SILVER_TABLE].items())
    return LayerRun(
        store,
        store.audit(),
        store.written(),
        spark.createDataFrame(seen, bronze_ddl),
        spark.createDataFrame(nulls, "column_name string, null_count long"),
    )


def run_test_layers(spark: SparkSession, sf_dir: str, **options) -> LayerRun:
    """``run_layers`` over the two order sources of the provided tables."""
    labels = ("csv", "postgres")
    sources = {name: testdata.bronze_source(spark, sf_dir, label, options.get("clock")) for name, label in zip(BRONZE_TABLES, labels, strict=True)}
    return run_layers(spark, sources, tiebreak=list(testdata.TIEBREAK), drop_after=testdata.TIEBREAK, **options)
