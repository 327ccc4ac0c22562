"""Maps the provided TPC-H-like tables onto the sales-order model.

One lineitem row is one bronze order line. Lines 1-4 of an order come from the
``csv`` source, later lines from ``postgres``, so a key appears in both sources
and more than once per source. Text is made dirty on purpose (padding, lower
case, blank names and statuses) so cleaning has work to do. ``src_*`` columns
give a total order for dedup ties.

Join plan: the big ``lineitem`` side meets ``part`` first (the only dimension
whose match depends on the line), and ``orders`` is joined to the customer
geography before it meets lineitem. ``nation``/``region`` are fixed-size TPC-H
tables; Spark's size-based threshold broadcasts them. No broadcast hint is
forced on tables that grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
TIEBREAK = ("src_line", "src_part", "src_supp", "src_price")
CSV_MAX_LINE = 4


# Declared schemas of the tables this adapter reads: no footer-sampling job per
# read, and a file with different column types fails loudly at the scan.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status() -> Column:
    flag, st = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when(F.col("src_part") % 97 == 0, F.lit(" "))
        .when(flag == "R", F.lit("cancelled"))
        .when((flag == "A") & (st == "F"), F.lit("delivered"))
        .when(flag == "A", F.lit("shipped"))
        .when(st == "F", F.lit("confirmed"))
        .otherwise(F.lit("pending"))
    )


def source_of_line(line: Column) -> Column:
    return F.when(line <= CSV_MAX_LINE, F.lit("csv")).otherwise(F.lit("postgres"))


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level columns as they are, joined to part (inner, on the part key)."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "l_returnflag",
        "l_linestatus",
        source_of_line(F.col("l_linenumber")).alias("source"),
        F.col("l_linenumber").alias("src_line"),
        F.col("l_partkey").alias("src_part"),
        F.col("l_suppkey").alias("src_supp"),
        F.col("l_extendedprice").alias("src_price"),
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("src_part"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("unit_price"),
    )
    return lines.join(part, "src_part", "inner")


def derived(lines: DataFrame) -> DataFrame:
    """SKU and status from the raw line columns (a projection, so it can follow a dedup)."""
    return lines.withColumns(
        {
            "product_sku": F.concat(F.lit(" sku-"), F.lpad(F.col("src_part").cast("string"), 6, "0")),
            "status": _status(),
        }
    ).select("order_id", "product_sku", "product_name", "quantity", "unit_price", "status", "source", *TIEBREAK)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level columns: lineitem joined to part."""
    return derived(raw_order_lines(spark, sf_dir))


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level columns: orders joined to customer, nation and region."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner")
        .join(region, nation.n_regionkey == region.r_regionkey, "inner")
        .select("c_custkey", "c_name", "r_name")
    )
    return orders.join(geo, orders.o_custkey == geo.c_custkey, "inner").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")))
        .alias("customer_name"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.concat(F.lower("r_name"), F.lit(" ")).alias("region"),
    )


BRONZE_COLUMNS = (
    "order_id", "customer_id", "customer_name", "product_sku", "product_name", "quantity",
    "unit_price", "order_date", "region", "status", "ingested_at", "source",
) + TIEBREAK


def assemble(lines: DataFrame, headers: DataFrame, clock: Column | None = None) -> DataFrame:
    """Join line columns to order columns and add ``ingested_at``."""
    joined = lines.join(headers, "order_id", "inner")
    stamped = joined.withColumn("ingested_at", clock if clock is not None else F.current_timestamp())
    return stamped.select(*BRONZE_COLUMNS)


def bronze_orders(spark: SparkSession, sf_dir: str, clock: Column | None = None) -> DataFrame:
    """Both bronze sources in one frame (``source`` column tells them apart).

    Equal to ``bronze_source('csv') UNION ALL bronze_source('postgres')`` but
    scans every table once.
    """
    return assemble(order_lines(spark, sf_dir), order_headers(spark, sf_dir), clock)


def lines_of(source: str) -> Column:
    """The lines of one source, as a range of ``src_line`` that reaches the scan."""
    line = F.col("src_line")
    return line <= CSV_MAX_LINE if source == "csv" else line > CSV_MAX_LINE


def bronze_source(spark: SparkSession, sf_dir: str, source: str, clock: Column | None = None) -> DataFrame:
    """One bronze source. The filter on ``src_line`` is pushed through the
    projection and the part join into the lineitem scan."""
    lines = order_lines(spark, sf_dir).filter(lines_of(source))
    return assemble(lines, order_headers(spark, sf_dir), clock)


__all__ = [
    "BRONZE_COLUMNS", "TABLES", "TIEBREAK", "assemble", "bronze_orders", "bronze_source", "derived", "lines_of",
    "order_headers", "order_lines", "raw_order_lines", "table",
]
