"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: str | Column) -> Column:
    """``initcap(trim(c))``: words split on spaces only, rest lower case."""
    return F.initcap(F.trim(_col(c)))


def upper_case(c: str | Column) -> Column:
    return F.upper(F.trim(_col(c)))


def blank_to_null(c: str | Column) -> Column:
    """P10: NULL when the text is empty after trimming spaces, else unchanged."""
    c = _col(c)
    return F.when(F.trim(c) == F.lit(""), F.lit(None)).otherwise(c)
