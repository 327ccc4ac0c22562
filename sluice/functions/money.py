"""Money arithmetic that gives the same cents on every engine and every plan.

Order values are rounded to cents per row, summed as DECIMAL (exact, so the
result does not depend on how rows are split into partitions) and turned back
into DOUBLE only at the end. Means round the exact quotient half-up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# prices are averaged at 8 decimals so an unrounded input price keeps its value
PRICE = "decimal(24,8)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_value(price: str | Column = "unit_price", quantity: str | Column = "quantity") -> Column:
    """``round(unit_price * quantity, 2)`` as DOUBLE."""
    return F.round(_col(price) * _col(quantity), 2)


def as_money(c: str | Column) -> Column:
    """A DOUBLE amount as exact cents (DECIMAL(18,2), half-up)."""
    return _col(c).cast(MONEY)


def as_price(c: str | Column) -> Column:
    """A DOUBLE price as an exact decimal with 8 places."""
    return _col(c).cast(PRICE)


def to_double(c: Column) -> Column:
    return c.cast("double")


def money_mean(total: Column, n: Column) -> Column:
    """``round(total / n, 2)`` with NULL instead of a division error when ``n`` is 0."""
    return F.round(F.try_divide(total, n), 2).cast("double")
