"""Rounding, safe ratios and money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: keeps the tip percentage finite when the fare is zero.
FARE_EPSILON = 1e-9


def steady_round(value: Column, digits: int) -> Column:
    """Round a sum or average of doubles.

    Spark adds partial sums in whatever order tasks finish, so the last bits move between runs. Rounding at the
    ninth digit first drops those bits, and a value on a tie rounds the same way on every run.
    """
    return F.round(F.round(value, 9), digits)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is above zero."""
    return F.when(denominator > 0, numerator / denominator)


def total_fare(fare: Column, tip: Column) -> Column:
    return fare + tip


def tip_percent(fare: Column, tip: Column) -> Column:
    """Null when fare and tip cancel out. ANSI division would raise where fare is exactly minus the epsilon."""
    return F.when(fare + tip != 0, F.try_divide(tip, fare + FARE_EPSILON) * 100)
