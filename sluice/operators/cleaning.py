"""Row-level cleaning: text normalisation, blanks, types, schema comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from sluice.functions import blank_to_null, order_value, title_case, upper_case

TITLE_COLUMNS = ("customer_name", "product_name")
UPPER_COLUMNS = ("product_sku", "region", "status")
# Only these two become NULL when blank (the documentation says "all strings";
# the code of record does two).
BLANK_COLUMNS = ("customer_name", "status")


def clean_orders(
    df: DataFrame,
    title_columns: Sequence[str] = TITLE_COLUMNS,
    upper_columns: Sequence[str] = UPPER_COLUMNS,
    blank_columns: Sequence[str] = BLANK_COLUMNS,
) -> DataFrame:
    """Trim + title case names, trim + upper case codes, blank -> NULL.

    One projection: Catalyst folds the chained expressions into a single
    codegen'd Project, so this never adds a stage.
    """
    exprs: dict[str, Column] = {}
    for c in title_columns:
        exprs[c] = title_case(c)
    for c in upper_columns:
        exprs[c] = upper_case(c)
    for c in blank_columns:
        exprs[c] = blank_to_null(exprs.get(c, F.col(c)))
    return df.withColumns(exprs)


def nullify_blanks(df: DataFrame, columns: Iterable[str] = BLANK_COLUMNS) -> DataFrame:
    """P10 on its own: whitespace-only text becomes NULL, other text is kept as is."""
    return df.withColumns({c: blank_to_null(c) for c in columns})


def with_order_value(df: DataFrame, name: str = "order_value") -> DataFrame:
    """Add ``round(unit_price * quantity, 2)``."""
    return df.withColumn(name, order_value())


def enforce_types(df: DataFrame, schema: StructType, bad_values: str = "fail") -> DataFrame:
    """Cast every column of ``schema`` present in ``df`` to its declared type.

    A value that does not fit its type (text in a number, an id beyond the
    range) fails the job with the column's name; with ``bad_values="null"`` it
    becomes NULL. Columns missing from ``df`` are skipped; columns not in
    ``schema`` are kept at the end.
    """
    if bad_values not in ("fail", "null"):
        raise ValueError("bad_values must be 'fail' or 'null'")
    present = dict(df.dtypes)
    declared = [f for f in schema.fields if f.name in present]

    def typed(name: str, kind: DataType) -> Column:
        if present[name] == kind.simpleString():
            return F.col(name)
        cast = F.col(name).try_cast(kind)
        if bad_values == "null":
            return cast.alias(name)
        msg = F.concat(F.lit(f"column {name} has a value that is no {kind.simpleString()}: "), F.col(name).cast("string"))
        bad = F.col(name).isNotNull() & cast.isNull()
        return F.when(bad, F.raise_error(msg).cast(kind)).otherwise(cast).alias(name)

    names = {f.name for f in declared}
    return df.select(*[typed(f.name, f.dataType) for f in declared], *[F.col(c) for c in df.columns if c not in names])


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns present on one side only.

    Returns ``(column_name, side, data_type)`` with side ``left_only`` or
    ``right_only``. Works on schemas (metadata), so no job reads data.
    """
    fa = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    fb = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    rows = [(c, "left_only", t) for c, t in fa.items() if c not in fb]
    rows += [(c, "right_only", t) for c, t in fb.items() if c not in fa]
    schema = StructType(
        [
            StructField("column_name", StringType(), False),
            StructField("side", StringType(), False),
            StructField("data_type", StringType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)
