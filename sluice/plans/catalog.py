"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the provided tables (or what Spark derives from them) in
full. Audit timestamps (``ingested_at``, ``*_processed_at``, ``*_created_at``,
``run_at``) are left out of the returned frames so results compare across
engines; the library functions themselves keep them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import fresh_lake, remove_lake
from sluice.functions import growth_factor, seasonal_factor, year_month
from sluice.operators import aggregates as agg
from sluice.operators import forecast as fc
from sluice.operators import quality as qa
from sluice.operators.cleaning import clean_orders, enforce_types
from sluice.operators.dedup import dedup_counted, dedup_sources, overlap_within
from sluice.operators.tables import TableStore, merge_changes, merge_upsert, violations
from sluice.plans.gold import gold_sums, gold_tables_of, with_changes
from sluice.plans.layers import BRONZE_TABLES, NULL_CHECK_COLUMNS, SILVER_TABLE, run_test_layers
from sluice.plans.silver import SILVER_KEYS, build_silver, silver_orders
from sluice.schema import ORDER_COLUMNS, SILVER_SCHEMA, WIDE_SALES_ORDERS_SCHEMA
from sluice.sources import testdata
from sluice.sources.files import land_orders_csv, read_orders_csv, write_orders_csv

Query = Callable[[SparkSession, str], DataFrame]

SILVER_OUT = ORDER_COLUMNS + ("source",)
# Row rules checked on silver (the two gold rules are enforced in run_layers).
SILVER_RULES = {
    "customer_name_present": "customer_name IS NOT NULL",
    "status_present": "status IS NOT NULL",
    "quantity_positive": "quantity > 0",
    "price_positive": "unit_price > 0",
}
HOLDOUT = 2
HORIZON = 6
REGION_SCALE = 1e5  # per-region series in Lakh
MERGE_BUCKETS = 32
CHANGE_NOISE = 0.002  # noise variance of the scaled series in the one-bend fit


def _kept(df: DataFrame, lake) -> DataFrame:
    """The rows of stored tables, kept under the checkpoint folder (the lake behind them goes)."""
    out = df.checkpoint()
    remove_lake(df.sparkSession, lake)
    return out


def _silver(spark, sf_dir):
    return silver_orders(spark, sf_dir)


def _no_stamp(df: DataFrame) -> DataFrame:
    return df.drop("gold_created_at", "created_at", "run_at")


def _region_split(spark, sf_dir):
    monthly = agg.monthly_sales_trend(_silver(spark, sf_dir), keys=["region"], sort=False)
    return fc.holdout_split(fc.forecast_series(monthly, ["region"], REGION_SCALE), ["region"], HOLDOUT)


# --- silver and gold ------------------------------------------------------------

def q_silver_orders(spark, sf_dir):
    return _silver(spark, sf_dir).select(*SILVER_OUT)


def q_revenue_by_region(spark, sf_dir):
    return _no_stamp(agg.revenue_by_region(_silver(spark, sf_dir)))


def q_revenue_by_product(spark, sf_dir):
    return _no_stamp(agg.revenue_by_product(_silver(spark, sf_dir)))


def q_order_status_breakdown(spark, sf_dir):
    return _no_stamp(agg.order_status_breakdown(_silver(spark, sf_dir)))


def q_monthly_sales_trend(spark, sf_dir):
    return _no_stamp(agg.monthly_sales_trend(_silver(spark, sf_dir)))


def q_revenue_at_risk(spark, sf_dir):
    return agg.revenue_at_risk(_silver(spark, sf_dir))


def q_best_worst_month(spark, sf_dir):
    return agg.best_worst_month(agg.monthly_sales_trend(_silver(spark, sf_dir), sort=False))


def q_typed_orders(spark, sf_dir):
    """Both sources as text, as an untyped file holds them, deduplicated, cleaned and cast to the declared types."""
    bronze = testdata.bronze_orders(spark, sf_dir).drop("ingested_at")
    as_text = bronze.select(*[F.col(c).cast("string").alias(c) if c in ORDER_COLUMNS else F.col(c) for c in bronze.columns])
    kept = clean_orders(dedup_sources(as_text, list(SILVER_KEYS), tiebreak=list(testdata.TIEBREAK)))
    return enforce_types(kept, SILVER_SCHEMA).select(*SILVER_OUT)


# --- sources, set operations, audits --------------------------------------------

def q_silver_from_sources(spark, sf_dir):
    csv = testdata.bronze_source(spark, sf_dir, "csv")
    pg = testdata.bronze_source(spark, sf_dir, "postgres")
    return build_silver(csv, pg, tiebreak=list(testdata.TIEBREAK), drop_after=testdata.TIEBREAK).select(*SILVER_OUT)


def q_source_overlap(spark, sf_dir):
    return overlap_within(testdata.bronze_orders(spark, sf_dir), "order_id", "source", "csv", "postgres")


def q_dedup_audit(spark, sf_dir):
    return qa.dedup_audit(testdata.bronze_orders(spark, sf_dir), "order_id", "source", "csv", "postgres")


def q_bronze_audit(spark, sf_dir):
    return qa.bronze_audit(testdata.bronze_orders(spark, sf_dir))


def q_source_summary(spark, sf_dir):
    tables = dict(zip(("csv", "postgres"), BRONZE_TABLES, strict=True))
    return qa.source_summary(spark, testdata.bronze_orders(spark, sf_dir), tables)


def q_null_profile(spark, sf_dir):
    return qa.null_profile(_silver(spark, sf_dir), NULL_CHECK_COLUMNS)


def q_distinct_status(spark, sf_dir):
    return qa.distinct_values(_silver(spark, sf_dir), "status")


def q_distinct_region(spark, sf_dir):
    return qa.distinct_values(_silver(spark, sf_dir), "region")


def q_layer_audit(spark, sf_dir):
    bronze = testdata.bronze_orders(spark, sf_dir)
    tables = dict(zip(("csv", "postgres"), BRONZE_TABLES, strict=True))
    kept = clean_orders(dedup_counted(bronze, list(SILVER_KEYS), tiebreak=list(testdata.TIEBREAK), labels=tables))
    gold = {
        "revenue_by_region": F.col("region"),
        "revenue_by_product": F.col("product_name"),
        "order_status_breakdown": F.col("status"),
        "monthly_sales_trend": year_month("order_date"),
    }
    return qa.single_scan_audit(kept, BRONZE_TABLES, SILVER_TABLE, gold)


def q_csv_round_trip(spark, sf_dir):
    lake = fresh_lake(spark, "csv")
    read: list[DataFrame] = []
    for source in ("csv", "postgres"):
        write_orders_csv(testdata.bronze_source(spark, sf_dir, source).select(*ORDER_COLUMNS), f"{lake.root}/{source}")
        read.append(read_orders_csv(spark, f"{lake.root}/{source}", WIDE_SALES_ORDERS_SCHEMA, source=source).drop("ingested_at"))
    return _kept(read[0].unionAll(read[1]), lake)


def q_csv_quarantine(spark, sf_dir):
    """Orders landed from files in which the values of some parts do not fit: the rows that fit, and the keys of the lines that do not."""
    lake = fresh_lake(spark, "quarantine")
    store = TableStore(spark, lake)
    part, wrong = F.col("src_part"), {"order_id": 89, "quantity": 97, "unit_price": 83, "order_date": 79}
    bronze = testdata.bronze_orders(spark, sf_dir)
    broken = [F.when(part % wrong[c] == 0, F.concat(F.lit("?"), F.col(c).cast("string"))).otherwise(F.col(c).cast("string")).alias(c) if c in wrong else F.col(c) for c in ORDER_COLUMNS]
    write_orders_csv(bronze.select(*broken), f"{lake.root}/files")
    land_orders_csv(store, "bronze", "orders", f"{lake.root}/files", WIDE_SALES_ORDERS_SCHEMA)
    shown = ["order_id", "quantity", "unit_price", "order_date"]
    accepted = store.read("bronze", "orders").select(*shown, F.lit(None).cast("string").alias("rejected_key"))
    record = store.read("bronze", "orders_rejected").select(F.split("rejected_record", ",")[0].alias("rejected_key"))
    rejected = record.select(*[F.lit(None).cast(accepted.schema[c].dataType).alias(c) for c in shown], "rejected_key")
    return _kept(accepted.unionByName(rejected), lake)


# --- table operations --------------------------------------------------------------

def q_merge_upsert(spark, sf_dir):
    target = silver_orders(spark, sf_dir, sources=["csv"])
    updates = silver_orders(spark, sf_dir, sources=["postgres"])
    return merge_upsert(target, updates, ["order_id"]).select(*SILVER_OUT)


def q_constraint_violations(spark, sf_dir):
    bad = violations(_silver(spark, sf_dir), SILVER_RULES)
    return bad.select("order_id", F.explode("broken_rules").alias("rule"))


def q_bucket_merge(spark, sf_dir):
    """The merge above, into a stored table in hash buckets of its key."""
    lake = fresh_lake(spark, "buckets")
    store = TableStore(spark, lake)
    for source in ("csv", "postgres"):
        store.merge("silver", SILVER_TABLE, silver_orders(spark, sf_dir, sources=[source]).select(*SILVER_OUT), ["order_id"], buckets=MERGE_BUCKETS)
    return _kept(store.read("silver", SILVER_TABLE), lake)


def q_gold_kept_up(spark, sf_dir):
    """Gold of the merged silver, from the sums of the first source's silver and of what the merge changes."""
    target = silver_orders(spark, sf_dir, sources=["csv"])
    updates = silver_orders(spark, sf_dir, sources=["postgres"])
    changes = gold_sums(merge_changes(target, updates, ["order_id"]), change="change")
    return _gold_rows(gold_tables_of(with_changes(gold_sums(target), changes)))


def _gold_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The gold tables in one shape."""
    out = None
    for name, df in tables.items():
        revenue = "monthly_revenue" if name == "monthly_sales_trend" else "total_revenue"
        units, mean = ("total_units_sold", "avg_unit_price") if name == "revenue_by_product" else (None, "avg_order_value")
        rows = df.select(
            F.lit(name).alias("table_name"), F.col(df.columns[0]).alias("key"), F.col(revenue).alias("revenue"), F.col("total_orders").alias("orders"),
            (F.col(units) if units else F.lit(None)).cast("bigint").alias("units"), F.col(mean).alias("mean"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def q_stored_ranges(spark, sf_dir):
    """Row counts and date ranges of the stored bronze tables, from their files' footers."""
    lake = fresh_lake(spark, "ranges")
    store = TableStore(spark, lake)
    out = None
    for name, source in zip(BRONZE_TABLES, ("csv", "postgres"), strict=True):
        store.write("bronze", name, testdata.bronze_source(spark, sf_dir, source))
        row = store.footer_ranges("bronze", name, ["order_date", "quantity"]).withColumn("table_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return _kept(out, lake)


def q_table_history(spark, sf_dir):
    run = run_test_layers(spark, sf_dir, horizon=HORIZON, holdout=HOLDOUT, forecast_model="trend")
    remove_lake(spark, run.store.lake)
    return run.writes


def q_layer_tables(spark, sf_dir):
    """All rows of the stored silver, gold and forecast tables, in one shape."""
    store = run_test_layers(spark, sf_dir, horizon=HORIZON, holdout=HOLDOUT, forecast_model="trend").store
    none = F.lit(None)
    shapes = [
        ("silver", SILVER_TABLE, F.col("order_id").cast("string"), F.col("unit_price"), F.col("customer_id"), F.col("quantity"), none),
        ("gold", "revenue_by_region", F.col("region"), F.col("total_revenue"), F.col("total_orders"), none, F.col("avg_order_value")),
        ("gold", "revenue_by_product", F.col("product_name"), F.col("total_revenue"), F.col("total_orders"), F.col("total_units_sold"), F.col("avg_unit_price")),
        ("gold", "order_status_breakdown", F.col("status"), F.col("total_revenue"), F.col("total_orders"), none, F.col("avg_order_value")),
        ("gold", "monthly_sales_trend", F.col("year_month"), F.col("monthly_revenue"), F.col("total_orders"), none, F.col("avg_order_value")),
        ("gold", "revenue_forecast", F.col("month"), F.col("forecast_revenue"), F.col("is_forecast").cast("int"), none, F.col("actual_revenue")),
    ]
    out = None
    for layer, name, key, revenue, orders, units, mean in shapes:
        text = [F.col(c) for c in ("customer_name", "product_sku", "product_name", "region", "status", "source", "order_date")] if layer == "silver" else []
        rows = store.read(layer, name).select(
            F.lit(name).alias("table_name"), key.alias("key"), revenue.cast("double").alias("revenue"), orders.cast("bigint").alias("orders"),
            units.cast("bigint").alias("units"), mean.cast("double").alias("mean"), (F.concat_ws("|", *text) if text else none.cast("string")).alias("text"),
        )
        out = rows if out is None else out.unionByName(rows)
    return _kept(out, store.lake)


# --- forecasting -----------------------------------------------------------------

def q_forecast_series(spark, sf_dir):
    return fc.forecast_series(agg.monthly_sales_trend(_silver(spark, sf_dir), sort=False))


def q_holdout_split(spark, sf_dir):
    return fc.holdout_split(q_forecast_series(spark, sf_dir), (), HOLDOUT)


def q_trend_fit(spark, sf_dir):
    fit = fc.trend_fit(_region_split(spark, sf_dir), ["region"])
    return fit.select(
        "region",
        F.round("slope", 9).alias("slope"),
        F.round("intercept", 6).alias("intercept"),
        "train_months", "first_month", "last_month",
    )


def q_trend_forecast(spark, sf_dir):
    pred = fc.predict_trend(_region_split(spark, sf_dir), ["region"], HORIZON)
    return _no_stamp(fc.forecast_table(pred, ["region"]))


def q_forecast_accuracy(spark, sf_dir):
    pred = fc.predict_trend(_region_split(spark, sf_dir), ["region"], HORIZON)
    return fc.forecast_accuracy(pred, ["region"])


def q_seasonal_forecast_by_region(spark, sf_dir):
    """Months, actuals and flags, and whether the forecasts are those of a fit that satisfies its equations."""
    pred = fc.predict_seasonal(_region_split(spark, sf_dir), ["region"], HORIZON, with_fit=True)
    gap = fc.fit_gap(pred, ["region"]).select(F.col("region").alias("_region"), "equation_gap", "forecast_gap")
    fits = (F.col("equation_gap") < 1e-6) & (F.col("forecast_gap") < 1e-6)
    banded = F.col("lower").isNotNull() & (F.col("lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("upper"))
    joined = pred.filter("in_frame").join(gap, F.col("region").eqNullSafe(F.col("_region")))
    return joined.select(
        "region", F.date_format("month", "yyyy-MM").alias("month"), F.col("actual").alias("actual_revenue"),
        F.col("actual").isNull().alias("is_forecast"), fits.alias("fits"), banded.alias("banded"),
    )


def q_changepoint_fit(spark, sf_dir):
    """Coefficients of the trend with one place for a bend and a stated noise, which have a closed form."""
    pred = fc.predict_seasonal(_region_split(spark, sf_dir), ["region"], HORIZON, order=0, changepoints=1, noise=CHANGE_NOISE, with_fit=True)
    fit = pred.where(F.col("beta").isNotNull()).groupBy("region").agg(F.first("knots").alias("knots"), F.first("beta").alias("beta"), F.max_by("yhat", "month").alias("last"))
    place = {"change_at": F.get("knots", F.lit(0)), "level": F.get("beta", F.lit(0)), "slope": F.get("beta", F.lit(1)), "change": F.get("beta", F.lit(2)), "last_forecast": F.col("last")}
    return fit.select("region", *[(F.round(c, 7) + F.lit(0.0)).alias(name) for name, c in place.items()])


def q_forecast_runs(spark, sf_dir):
    """Run records of the seasonal model; of its errors (they depend on the solver's rounding) only whether they are there."""
    pred = fc.predict_seasonal(_region_split(spark, sf_dir), ["region"], HORIZON)
    runs = _no_stamp(fc.forecast_runs(fc.forecast_accuracy(pred, ["region"]), "seasonal", HORIZON, HOLDOUT))
    return runs.withColumns({c: F.col(c).isNotNull() & (F.col(c) >= 0) for c in ("mae", "mape_pct")}).withColumnsRenamed({"mae": "has_mae", "mape_pct": "has_mape"})


def q_trend_forecast_runs(spark, sf_dir):
    pred = fc.predict_trend(_region_split(spark, sf_dir), ["region"], HORIZON)
    return _no_stamp(fc.forecast_runs(fc.forecast_accuracy(pred, ["region"]), "trend", HORIZON, HOLDOUT))


# --- generator curves -------------------------------------------

def _dated(spark, sf_dir):
    silver = _silver(spark, sf_dir).select("order_id", "order_date")
    # every order keeps its date through the dedup, so the ends of the window come from bronze
    dates = testdata.bronze_orders(spark, sf_dir)
    bounds = dates.agg(F.struct(F.min("order_date").alias("s"), F.max("order_date").alias("e"))).scalar()
    return silver, bounds.getField("s"), bounds.getField("e")


def q_growth_factor(spark, sf_dir):
    silver, start, end = _dated(spark, sf_dir)
    return silver.select("order_id", "order_date", growth_factor("order_date", start, end).alias("growth_factor"))


def q_seasonal_factor(spark, sf_dir):
    silver = _silver(spark, sf_dir).select("order_id", "order_date")
    return silver.select("order_id", "order_date", seasonal_factor("order_date").alias("seasonal_factor"))


QUERIES: dict[str, Query] = {
    "silver_orders": q_silver_orders,
    "silver_from_sources": q_silver_from_sources,
    "revenue_by_region": q_revenue_by_region,
    "revenue_by_product": q_revenue_by_product,
    "order_status_breakdown": q_order_status_breakdown,
    "monthly_sales_trend": q_monthly_sales_trend,
    "revenue_at_risk": q_revenue_at_risk,
    "best_worst_month": q_best_worst_month,
    "typed_orders": q_typed_orders,
    "source_overlap": q_source_overlap,
    "dedup_audit": q_dedup_audit,
    "bronze_audit": q_bronze_audit,
    "source_summary": q_source_summary,
    "null_profile": q_null_profile,
    "distinct_status": q_distinct_status,
    "distinct_region": q_distinct_region,
    "layer_audit": q_layer_audit,
    "csv_round_trip": q_csv_round_trip,
    "csv_quarantine": q_csv_quarantine,
    "merge_upsert": q_merge_upsert,
    "bucket_merge": q_bucket_merge,
    "gold_kept_up": q_gold_kept_up,
    "stored_ranges": q_stored_ranges,
    "constraint_violations": q_constraint_violations,
    "table_history": q_table_history,
    "layer_tables": q_layer_tables,
    "forecast_series": q_forecast_series,
    "holdout_split": q_holdout_split,
    "trend_fit": q_trend_fit,
    "trend_forecast": q_trend_forecast,
    "forecast_accuracy": q_forecast_accuracy,
    "seasonal_forecast_by_region": q_seasonal_forecast_by_region,
    "changepoint_fit": q_changepoint_fit,
    "forecast_runs": q_forecast_runs,
    "trend_forecast_runs": q_trend_forecast_runs,
    "growth_factor": q_growth_factor,
    "seasonal_factor": q_seasonal_factor,
}
