"""Audit and data-quality operators (Q1-Q6). Each returns a small DataFrame
computed in one distributed pass; nothing is counted in a driver loop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def bronze_audit(df: DataFrame, by: str = "source") -> DataFrame:
    """Q1/Q2: per source label: rows, date range, NULL ids, distinct regions."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("order_date").alias("earliest_order"),
        F.max("order_date").alias("latest_order"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
        F.count_distinct("region").alias("unique_regions"),
    )


def bronze_measures() -> dict[str, Column]:
    """Q1 as measures of a write. (DISTINCT is not allowed there; regions are few, so their set is small.)"""
    return {
        "row_count": F.count(F.lit(1)),
        "earliest_order": F.min("order_date"),
        "latest_order": F.max("order_date"),
        "null_order_ids": F.count_if(F.col("order_id").isNull()),
        "unique_regions": F.size(F.collect_set("region")).cast("bigint"),
    }


def null_measures(columns: Sequence[str]) -> dict[str, Column]:
    """Q3 as measures of a write."""
    return {c: F.count_if(F.col(c).isNull()) for c in columns}


def source_summary(spark: SparkSession, orders: DataFrame, tables: Mapping[str, str], by: str = "source") -> DataFrame:
    """Q2: rows, date range and distinct regions per source table, as SQL text over one scan.

    ``tables`` maps a value of ``by`` to its table's name; other values are left out.
    """
    names = " ".join(f"WHEN '{value}' THEN '{name}'" for value, name in tables.items())
    return spark.sql(
        f"SELECT table_name, COUNT(*) AS row_count, MIN(order_date) AS earliest_order, MAX(order_date) AS latest_order, "
        f"COUNT(DISTINCT region) AS unique_regions FROM (SELECT CASE {by} {names} END AS table_name, order_date, region FROM {{orders}}) "
        "WHERE table_name IS NOT NULL GROUP BY table_name",
        orders=orders,
    )


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q3: NULL count of every listed column from one aggregate, one row per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_count")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column (NULL is a value), sorted."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first())


def dedup_audit(rows: DataFrame, key: str, source: str, a: str, b: str) -> DataFrame:
    """Q5: rows before and after dedup by ``key``, rows removed, keys that sources ``a`` and ``b`` share.

    One aggregate per key (NULL is a key), then one over the keys: the rows are read once.
    """
    per_key = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        (F.bool_or(F.col(source) == a) & F.bool_or(F.col(source) == b)).alias("shared"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).cast("bigint").alias("rows_removed"),
        F.count_if("shared").alias("overlapping_keys"),
    )


def layer_audit(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Q6: ``(layer, table_name, row_count)`` for every table, one UNION ALL job,
    ordered by layer then table name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("layer", "table_name")


def single_scan_audit(
    silver: DataFrame, bronze_tables: Sequence[str], silver_table: str, gold_keys: Mapping[str, Column]
) -> DataFrame:
    """Q6 from silver rows that carry their key's bronze row counts: every layer's row count from one scan.

    ``bronze_tables`` names the columns that hold the counts, one per bronze
    table; ``gold_keys`` maps a gold table to the expression it groups silver by
    (NULL is a group).
    """
    counts = {("BRONZE", name): F.sum(name) for name in bronze_tables}
    counts[("SILVER", silver_table)] = F.count(F.lit(1))
    for name, key in gold_keys.items():
        counts[("GOLD", name)] = F.count_distinct(key) + F.max(key.isNull().cast("int"))
    wide = silver.agg(*[c.cast("bigint").alias(f"{layer}/{name}") for (layer, name), c in counts.items()])
    long = wide.unpivot([], [f"`{layer}/{name}`" for layer, name in counts], "at", "row_count")
    out = long.select(F.split_part("at", F.lit("/"), F.lit(1)).alias("layer"), F.split_part("at", F.lit("/"), F.lit(2)).alias("table_name"), F.coalesce("row_count", F.lit(0)).alias("row_count"))
    return out.orderBy("layer", "table_name")
