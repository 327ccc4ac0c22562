"""Column expressions shared by the operators (all built-in, JVM-side)."""

from sluice.functions.dates import growth_factor, month_start, seasonal_factor, year_month
from sluice.functions.money import as_money, as_price, money_mean, order_value, to_double
from sluice.functions.text import blank_to_null, title_case, upper_case

__all__ = [
    "as_money",
    "as_price",
    "blank_to_null",
    "growth_factor",
    "money_mean",
    "month_start",
    "order_value",
    "seasonal_factor",
    "title_case",
    "to_double",
    "upper_case",
    "year_month",
]
