"""Table schemas of the sales lakehouse."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PROVENANCE_COLUMNS = ("ingested_at", "source")


def sales_orders_schema(id_type: DataType | None = None) -> StructType:
    """Raw order schema. ``id_type`` widens the id columns (LongType for keys past 2^31)."""
    ids = id_type or IntegerType()
    # Names and types of the order columns, in file order.
    return StructType(
        [
            StructField("order_id", ids, True),
            StructField("customer_id", ids, True),
            StructField("customer_name", StringType(), True),
            StructField("product_sku", StringType(), True),
            StructField("product_name", StringType(), True),
            StructField("quantity", IntegerType(), True),
            StructField("unit_price", DoubleType(), True),
            StructField("order_date", DateType(), True),
            StructField("region", StringType(), True),
            StructField("status", StringType(), True),
        ]
    )


def silver_schema(id_type: DataType | None = None) -> StructType:
    """Silver adds provenance and the processing time (never NULL)."""
    return StructType(
        sales_orders_schema(id_type).fields
        + [
            StructField("ingested_at", TimestampType(), True),
            StructField("source", StringType(), True),
            StructField("silver_processed_at", TimestampType(), False),
        ]
    )


SALES_ORDERS_SCHEMA = sales_orders_schema()
ORDER_COLUMNS = tuple(SALES_ORDERS_SCHEMA.fieldNames())
SILVER_SCHEMA = silver_schema(LongType())
WIDE_SALES_ORDERS_SCHEMA = sales_orders_schema(LongType())
