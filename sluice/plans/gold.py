"""Gold layer: the four reporting tables built from one silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.config import shared_dir
from sluice.functions import as_money, as_price, money_mean, order_value, to_double
from sluice.operators import aggregates as agg

# Gold table names.
GOLD_TABLES = ("revenue_by_region", "revenue_by_product", "order_status_breakdown", "monthly_sales_trend")


def gold_tables(silver: DataFrame, clock: Column | None = None) -> dict[str, DataFrame]:
    """The four tables as four independent aggregates (each scans ``silver``)."""
    return {
        "revenue_by_region": agg.revenue_by_region(silver, clock),
        "revenue_by_product": agg.revenue_by_product(silver, clock),
        "order_status_breakdown": agg.order_status_breakdown(silver, clock),
        "monthly_sales_trend": agg.monthly_sales_trend(silver, clock),
    }


# --- sums that can be kept up to date -------------------------------------------------

#: Dimension of each gold table, with the expression that groups silver by it.
DIMENSIONS = {"region": "region", "product_name": "product_name", "status": "status", "year_month": "date_format(order_date, 'yyyy-MM')"}
_SUMS = ("revenue", "orders", "units", "price_sum", "price_n", "rows")


def gold_sums(silver: DataFrame, change: str | None = None) -> DataFrame:
    """One row per dimension and key: exact sums and counts that all four gold tables follow from.

    A grouping-sets aggregate computes the four rollups in one scan; every task
    pre-aggregates all of them before the (tiny) shuffle. ``change`` names a
    column of 1 (a row comes) and -1 (a row goes) by which rows are weighed:
    sums of changes can be added to earlier ones.
    """
    weight = F.col(change) if change else F.lit(1)
    base = silver.select(
        *[F.expr(e).alias(d) for d, e in DIMENSIONS.items()],
        weight.cast("int").alias("w"), "order_id", "quantity", as_money(order_value()).alias("value"), as_price("unit_price").alias("price"),
    )

    def counted(c: str) -> Column:
        return F.sum(F.when(F.col(c).isNotNull(), F.col("w")).otherwise(0))

    rolled = base.groupingSets([[d] for d in DIMENSIONS], *DIMENSIONS).agg(
        *[F.grouping(d).alias(f"_g_{d}") for d in DIMENSIONS],
        F.sum(F.col("value") * F.col("w")).cast("decimal(38,2)").alias("revenue"),
        counted("order_id").alias("orders"),
        F.sum(F.col("quantity").cast("bigint") * F.col("w")).alias("units"),
        F.sum(F.col("price") * F.col("w")).cast("decimal(38,8)").alias("price_sum"),
        counted("price").alias("price_n"),
        counted("value").alias("valued"),
        counted("quantity").alias("counted"),
        F.sum("w").alias("rows"),
    )
    which, key = None, None
    for d in DIMENSIONS:
        own = F.col(f"_g_{d}") == 0
        which = F.when(own, F.lit(d)) if which is None else which.when(own, F.lit(d))
        key = F.when(own, F.col(d)) if key is None else key.when(own, F.col(d))
    return rolled.select(which.alias("dimension"), key.alias("key"), *_SUMS, "valued", "counted")


def with_changes(sums: DataFrame, changes: DataFrame) -> DataFrame:
    """``gold_sums`` of a table after its rows have changed, from those before and those of the changes.

    A group that has lost all its rows goes. The result is exactly that of a full rebuild.
    """
    columns = [*_SUMS, "valued", "counted"]
    both = sums.unionByName(changes).groupBy("dimension", "key").agg(
        *[F.sum(c).cast(dict(sums.dtypes)[c]).alias(c) for c in columns]
    )
    return both.where(F.col("rows") > 0)


def gold_tables_of(sums: DataFrame, clock: Column | None = None) -> dict[str, DataFrame]:
    """The four gold tables from their sums."""
    stamp = clock if clock is not None else F.current_timestamp()
    revenue = to_double(F.when(F.col("valued") > 0, F.col("revenue")))
    mean = money_mean(F.when(F.col("valued") > 0, F.col("revenue")), F.col("orders"))
    orders, units = F.col("orders").alias("total_orders"), F.when(F.col("counted") > 0, F.col("units")).alias("total_units_sold")
    price = money_mean(F.when(F.col("price_n") > 0, F.col("price_sum")), F.col("price_n")).alias("avg_unit_price")
    total, each = revenue.alias("total_revenue"), mean.alias("avg_order_value")
    shapes = {
        "revenue_by_region": ("region", [total, orders, each], F.desc("total_revenue")),
        "revenue_by_product": ("product_name", [total, orders, units, price], F.desc("total_revenue")),
        "order_status_breakdown": ("status", [orders, total, each], F.desc("total_orders")),
        "monthly_sales_trend": ("year_month", [revenue.alias("monthly_revenue"), orders, each], None),
    }
    return {
        name: sums.filter(F.col("dimension") == d)
        .select(F.col("key").alias(d), *columns)
        .orderBy(*([order] if order is not None else []), F.asc(d))
        .withColumn("gold_created_at", stamp)
        for name, (d, columns, order) in shapes.items()
    }


def gold_tables_single_pass(silver: DataFrame, clock: Column | None = None) -> dict[str, DataFrame]:
    """The same four tables from ONE scan of ``silver``.

    The sums, one row per group, are checkpointed into the shared folder so the
    four tables are cut from them without re-reading silver. Values are
    identical to ``gold_tables`` (same exact-decimal sums).
    """
    shared_dir(silver.sparkSession)  # checkpoint() writes to spark.checkpoint.dir
    return gold_tables_of(gold_sums(silver).checkpoint(), clock)
