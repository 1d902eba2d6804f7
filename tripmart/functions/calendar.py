"""Dates, names of days and months, and periods of the day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels that appear in the marts.
MONTH_NAMES = {
    1: "January", 2: "February", 3: "March", 4: "April", 5: "May", 6: "June",
    7: "July", 8: "August", 9: "September", 10: "October", 11: "November", 12: "December",
}
DAY_NAMES = {
    1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday", 5: "Thursday", 6: "Friday", 7: "Saturday",
}
WEEKEND = ("Saturday", "Sunday")
RUSH_PERIODS = ("Morning Rush", "Evening Rush")
# Last hour of each period; hour 24 counts as late night.
PERIOD_ENDS = {
    3: "After Midnight", 5: "Early Morning", 9: "Morning Rush", 15: "Midday",
    19: "Evening Rush", 21: "Night", 24: "Late Night",
}
AS_OF = dt.date(2016, 1, 1)
DAYS_PER_YEAR = 365.25


def lookup(names: dict, key: Column) -> Column:
    """Map a key through a literal table; a missing key gives null."""
    return F.create_map(*[F.lit(part) for item in names.items() for part in item])[key]


def month_name(number: Column) -> Column:
    return lookup(MONTH_NAMES, number)


def day_name(number: Column) -> Column:
    return lookup(DAY_NAMES, number)


def pickup_period(hour: Column) -> Column:
    period = F.when(hour.isNull(), "Unknown").when(hour < 0, "InvalidHour")
    for end, label in PERIOD_ENDS.items():
        period = period.when(hour <= end, label)
    return period.otherwise("InvalidHour")


def duration_minutes(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def years_until(day: Column, as_of: dt.date = AS_OF) -> Column:
    """Years from ``day`` to a fixed date, two digits."""
    return F.round(F.datediff(F.lit(as_of), F.to_date(day)) / F.lit(DAYS_PER_YEAR), 2)


def iso_text_date(text: Column) -> Column:
    """The date part of ``2024-01-31T05:00``."""
    return F.to_date(F.substring_index(text, "T", 1))
