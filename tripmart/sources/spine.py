"""Runs of dates to fetch readings for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# First day of a full load, and the most days one request may span.
FIRST_DAY = dt.date(2009, 1, 1)
DAYS_PER_BATCH = 30


def first_missing_day(current: DataFrame | None, loadtype: str, first: dt.date = FIRST_DAY) -> dt.date:
    """The fixed start for a full load, the day after the last stored one for a delta load."""
    if loadtype == "full":
        return first
    if loadtype != "delta":
        raise ValueError(f"loadtype must be full or delta, not {loadtype!r}")
    last = current.agg(F.max("date")).first()[0]
    return last + dt.timedelta(days=1) if last else first


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from start to end, both included; none when end lies before start."""
    days = max((end - start).days + 1, 0)
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def spine_batches(spine: DataFrame, size: int = DAYS_PER_BATCH) -> DataFrame:
    """The distinct days in order, ``size`` to a group: first, last and members of each. Gaps do not shorten a group.

    A spine has a row a day, some tens of thousands in a century, so one window over it is small.
    """
    days = spine.where("date is not null").select("date").distinct()
    place = F.row_number().over(Window.orderBy("date")) - 1
    batch = F.floor(place / F.lit(size)).cast("int")
    return days.withColumn("batch", batch).groupBy("batch").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.count("*").alias("n_dates"),
        # At most ``size`` members.
        F.sort_array(F.collect_list("date")).alias("dates"),
    )
