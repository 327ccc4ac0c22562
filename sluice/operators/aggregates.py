"""Gold aggregates over clean orders (A1-A5, O2).

Every rollup is one hash aggregate with a map-side partial step, so a group
holding a third of all rows is pre-combined in every task before the shuffle;
the shuffle then carries one row per (task, group). Sums are exact DECIMAL
(see ``sluice.functions.money``). The sort happens on the aggregated rows and
``gold_created_at`` is added after it, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import as_money, as_price, money_mean, order_value, to_double, year_month

AT_RISK_STATUSES = ("PENDING", "CONFIRMED")


def _stamp(df: DataFrame, name: str, clock: Column | None) -> DataFrame:
    return df.withColumn(name, clock if clock is not None else F.current_timestamp())


def _money(df: DataFrame) -> DataFrame:
    return df.withColumn("_ov", as_money(order_value()))


def revenue_by_region(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """A1: revenue, order count and mean order value per region, biggest first."""
    out = (
        _money(df)
        .groupBy("region")
        .agg(F.sum("_ov").alias("_rev"), F.count("order_id").alias("total_orders"))
        .select(
            "region",
            to_double(F.col("_rev")).alias("total_revenue"),
            "total_orders",
            money_mean(F.col("_rev"), F.col("total_orders")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), F.asc("region"))
    )
    return _stamp(out, "gold_created_at", clock)


def revenue_by_product(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """A2: revenue, orders, units and mean unit price per product, biggest first."""
    out = (
        _money(df)
        .groupBy("product_name")
        .agg(
            F.sum("_ov").alias("_rev"),
            F.count("order_id").alias("total_orders"),
            F.sum("quantity").cast("bigint").alias("total_units_sold"),
            F.sum(as_price("unit_price")).alias("_price_sum"),
            F.count("unit_price").alias("_price_n"),
        )
        .select(
            "product_name",
            to_double(F.col("_rev")).alias("total_revenue"),
            "total_orders",
            "total_units_sold",
            money_mean(F.col("_price_sum"), F.col("_price_n")).alias("avg_unit_price"),
        )
        .orderBy(F.desc("total_revenue"), F.asc("product_name"))
    )
    return _stamp(out, "gold_created_at", clock)


def order_status_breakdown(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """A3: orders, revenue and mean order value per status, most orders first."""
    out = (
        _money(df)
        .groupBy("status")
        .agg(F.count("order_id").alias("total_orders"), F.sum("_ov").alias("_rev"))
        .select(
            "status",
            "total_orders",
            to_double(F.col("_rev")).alias("total_revenue"),
            money_mean(F.col("_rev"), F.col("total_orders")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_orders"), F.asc("status"))
    )
    return _stamp(out, "gold_created_at", clock)


def monthly_sales_trend(
    df: DataFrame, clock: Column | None = None, keys: Sequence[str] = (), sort: bool = True
) -> DataFrame:
    """A4: revenue, orders and mean order value per 'yyyy-MM' month, oldest first.

    ``keys`` adds series columns (e.g. ``region``) for per-series forecasting.
    ``sort=False`` skips the global sort (a range shuffle) when the result only
    feeds another distributed step, such as the forecast windows.
    """
    out = (
        _money(df)
        .withColumn("year_month", year_month("order_date"))
        .groupBy(*keys, "year_month")
        .agg(F.sum("_ov").alias("_rev"), F.count("order_id").alias("total_orders"))
        .select(
            *keys,
            "year_month",
            to_double(F.col("_rev")).alias("monthly_revenue"),
            "total_orders",
            money_mean(F.col("_rev"), F.col("total_orders")).alias("avg_order_value"),
        )
    )
    if sort:
        out = out.orderBy(*[F.asc(k) for k in keys], F.asc("year_month"))
    return _stamp(out, "gold_created_at", clock)


def revenue_at_risk(df: DataFrame, statuses: Sequence[str] = AT_RISK_STATUSES) -> DataFrame:
    """A5: one row with the value and count of orders not yet completed.

    The IN filter reaches the scan when ``df`` reads a stored table. Revenue is
    NULL when no order qualifies.
    """
    return (
        _money(df.filter(F.col("status").isin(list(statuses))))
        .agg(F.sum("_ov").alias("_rev"), F.count("order_id").alias("orders_at_risk"))
        .select(to_double(F.col("_rev")).alias("revenue_at_risk"), "orders_at_risk")
    )


def best_worst_month(monthly: DataFrame) -> DataFrame:
    """O2: best and worst month of a monthly trend in one pass.

    Best = highest revenue (NULL revenue never best), worst = lowest with NULL
    revenue first, as an ascending sort would give; ties go to the earliest
    month. ``min`` over a struct is an ordinary partial/final aggregate.
    """
    rev, ym, n = F.col("monthly_revenue"), F.col("year_month"), F.col("total_orders")
    best = F.min(F.struct(rev.isNull().alias("k0"), (-rev).alias("k1"), ym.alias("m"), rev.alias("r"), n.alias("n")))
    worst = F.min(F.struct(rev.alias("k1"), ym.alias("m"), n.alias("n")))
    return monthly.agg(best.alias("b"), worst.alias("w")).select(
        F.col("b.m").alias("best_month"),
        F.col("b.r").alias("best_revenue"),
        F.col("b.n").alias("best_orders"),
        F.col("w.m").alias("worst_month"),
        F.col("w.k1").alias("worst_revenue"),
        F.col("w.n").alias("worst_orders"),
    )
