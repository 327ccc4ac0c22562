"""File and catalog sources (S1, S2, S4, S6) and the CSV sink used by round trips."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.operators.tables import TableStore
from sluice.schema import SALES_ORDERS_SCHEMA

#: Column that holds the text of a line that does not fit the schema.
RECORD = "rejected_record"
#: Columns that say which file a row comes from.
FILE_COLUMNS = ("source_file", "source_modified")


def with_provenance(df: DataFrame, source: str | Column, clock: Column | None = None) -> DataFrame:
    """Add ``ingested_at`` (one value per query) and ``source``."""
    src = F.lit(source) if isinstance(source, str) else source
    return df.withColumns(
        {"ingested_at": clock if clock is not None else F.current_timestamp(), "source": src}
    )


def read_orders_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = SALES_ORDERS_SCHEMA,
    infer_schema: bool = False,
    source: str = "csv",
    clock: Column | None = None,
    with_record: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """Read order CSV files with a header row and add provenance.

    With a schema (default) the header must name the schema's columns in its
    order (``enforceSchema=false``): a reordered file fails instead of binding
    values to the wrong columns. Unparseable fields become NULL and the row is
    kept (PERMISSIVE). ``infer_schema=True`` samples the files instead (opt-in;
    one bad token turns a column into STRING). Files split across tasks by
    ``spark.sql.files.maxPartitionBytes``.

    ``with_record`` adds ``rejected_record``: the text of a line that does not fit
    the schema, NULL for one that does. (Spark finds a value wrong only where its
    column is read, so keep all columns when telling the lines apart.)
    ``with_file`` adds the path and modification time of each row's file.
    """
    reader = spark.read.option("header", True)
    if infer_schema or schema is None:
        reader = reader.option("inferSchema", True)
    else:
        if with_record:
            schema = StructType([*schema.fields, StructField(RECORD, StringType())])
            reader = reader.option("columnNameOfCorruptRecord", RECORD)
        reader = reader.schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE")
    if with_record and infer_schema:
        raise ValueError("lines can only be rejected against a schema")
    rows = reader.csv(path if isinstance(path, str) else list(path))
    if with_file:
        rows = rows.withColumns({"source_file": F.col("_metadata.file_path"), "source_modified": F.col("_metadata.file_modification_time")})
    return with_provenance(rows, source, clock)


class Landing(NamedTuple):
    accepted: int
    rejected: int


def land_orders_csv(
    store: TableStore,
    layer: str,
    name: str,
    path: str | Sequence[str],
    schema: StructType = SALES_ORDERS_SCHEMA,
    source: str = "csv",
    clock: Column | None = None,
) -> Landing:
    """Write the lines that fit ``schema`` to a table, the others to ``<name>_rejected``; both are overwritten.

    A line is rejected when a value does not fit its column or the number of
    values is wrong; the rejected table keeps its text and what could be read of
    it. Every line of the files (but headers and blank lines) is in one of the two. The
    files are read once; only when some line was rejected a second time, for
    those lines.
    """
    parsed = read_orders_csv(store.spark, path, schema, source=source, clock=clock, with_record=True)
    seen = Observation(f"rejected_{uuid.uuid4().hex[:8]}")
    counted = parsed.observe(seen, F.count_if(F.col(RECORD).isNotNull()).alias("n"))
    store.write(layer, name, counted.where(F.col(RECORD).isNull()).drop(RECORD))
    rejected = int(seen.get["n"])
    store.write(layer, f"{name}_rejected", parsed.where(F.col(RECORD).isNotNull()) if rejected else parsed.limit(0))
    return Landing(store.count(layer, name), rejected)


def append_new_files(
    store: TableStore,
    layer: str,
    name: str,
    path: str,
    schema: StructType = SALES_ORDERS_SCHEMA,
    source: str = "csv",
    clock: Column | None = None,
) -> int:
    """Append the rows of those files under ``path`` that the table does not hold yet; their number of files.

    A file is known by path and modification time, which the table keeps with
    its rows, so a file written anew counts as new. Only new files are opened.
    A file without rows is looked at again each time.
    """
    files = store.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    known_by = {"source_file": F.col("_metadata.file_path"), "source_modified": F.col("_metadata.file_modification_time")}
    files = files.select("path", *[c.alias(n) for n, c in known_by.items()])
    if store.exists(layer, name):
        files = files.join(store.read(layer, name).select(*FILE_COLUMNS).distinct(), list(FILE_COLUMNS), "left_anti")
    # Spark's own file listing keeps every path of a scan on the driver too
    new = sorted(r.path for r in files.select("path").collect())
    if new:
        store.append(layer, name, read_orders_csv(store.spark, new, schema, source=source, clock=clock, with_file=True))
    return len(new)


def write_orders_csv(df: DataFrame, path: str) -> None:
    """Write orders as CSV with a header, keeping leading/trailing spaces."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table by (multi-part) catalog name."""
    return spark.table(name)
