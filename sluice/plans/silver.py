"""B1: bronze sources -> one clean, deduplicated silver order table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.cleaning import clean_orders, enforce_types
from sluice.operators.dedup import align_and_union, dedup_sources
from sluice.schema import SILVER_SCHEMA
from sluice.sources import testdata


SILVER_KEYS = ("order_id",)


def _finish(deduped: DataFrame, drop_after: Sequence[str], schema: StructType, clock: Column | None) -> DataFrame:
    cleaned = enforce_types(clean_orders(deduped).drop(*drop_after), schema)
    return cleaned.withColumn("silver_processed_at", clock if clock is not None else F.current_timestamp())


def build_silver(
    *sources: DataFrame,
    keys: Sequence[str] = SILVER_KEYS,
    tiebreak: Sequence[str] | None = None,
    drop_after: Sequence[str] = (),
    clock: Column | None = None,
    schema: StructType = SILVER_SCHEMA,
) -> DataFrame:
    """Union the sources by name, keep one row per key (master source first),
    clean text, enforce the types of ``schema``, stamp ``silver_processed_at``.

    Dedup runs before cleaning, as in the reference. ``tiebreak`` orders rows
    of one key within one source (default: all other columns), so the result
    is the same on every run. ``drop_after`` removes helper columns (e.g. the
    tiebreak columns) from the result. Passing one frame twice still yields
    one row per key. A value that does not fit its declared type fails the job.
    """
    combined = align_and_union(list(sources))
    deduped = dedup_sources(combined, keys, tiebreak=tiebreak)
    return _finish(deduped, drop_after, schema, clock)


def silver_orders(
    spark: SparkSession,
    sf_dir: str,
    clock: Column | None = None,
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """Silver from the provided tables with the dedup moved below the order joins.

    Same rows as ``build_silver(bronze csv, bronze postgres, tiebreak=TIEBREAK)``:
    the priority and tiebreak only read line columns and every line of a key
    shares the key's order header, so picking the line first and joining the
    header after is equivalent. The shuffles below the dedup carry raw line
    columns; SKU and status are derived from the line that stays. ``sources``
    keeps only the named sources (pushed into the lineitem scan).

    The part join stays below the dedup because a line whose part is missing
    must not win its order (the inner join drops it).
    """
    lines = testdata.raw_order_lines(spark, sf_dir)
    if sources is not None:
        lines = lines.filter(reduce(or_, [testdata.lines_of(x) for x in sources]))
    best = testdata.derived(dedup_sources(lines, ["order_id"], tiebreak=list(testdata.TIEBREAK)))
    bronze = testdata.assemble(best, testdata.order_headers(spark, sf_dir), clock)
    return _finish(bronze, testdata.TIEBREAK, SILVER_SCHEMA, clock)
