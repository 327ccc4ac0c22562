"""Calendar helpers: month keys and the order generator's trend and season curves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's generator): seasonal weight of each
# calendar month (1 = January).
SEASONAL_WEIGHTS = {
    1: 1.1, 2: 0.9, 3: 1.0, 4: 0.85, 5: 0.8, 6: 0.9,
    7: 1.0, 8: 1.05, 9: 1.1, 10: 1.2, 11: 1.3, 12: 1.25,
}
# Fixed value: prices and volumes grow by this fraction over the data window.
GROWTH = 0.6


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_month(c: str | Column) -> Column:
    """'yyyy-MM' key of a date; NULL stays NULL."""
    return F.date_format(_col(c), "yyyy-MM")


def month_start(ym: str | Column) -> Column:
    """DATE of the first day of a 'yyyy-MM' key."""
    return F.to_date(F.concat(_col(ym), F.lit("-01")), "yyyy-MM-dd")


def growth_factor(day: str | Column, start: Column, end: Column) -> Column:
    """1.0 at ``start`` rising linearly to 1.6 at ``end``.

    A window of zero days counts as one day, as in the generator.
    """
    total = F.datediff(end, start)
    total = F.when(total == 0, F.lit(1)).otherwise(total)
    progress = F.datediff(_col(day), start) / total
    return F.lit(1.0) + F.lit(GROWTH) * progress


def seasonal_factor(day: str | Column) -> Column:
    """Seasonal weight of the day's calendar month."""
    weights = F.array(*[F.lit(SEASONAL_WEIGHTS[m]) for m in range(1, 13)])
    return F.element_at(weights, F.month(_col(day)))
