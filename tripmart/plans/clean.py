"""Cleaning of raw drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.keys import keep_first, new_rows
from tripmart.operators.lookup import settle

# Fixed value: trips at or below this fare are dropped.
MIN_FARE = 2.5
COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
# Vehicles go by driver: one vehicle each.
DIMENSION_KEYS = {"customers": "customer_id", "drivers": "driver_id", "vehicles": "driver_id"}


def with_calendar(trips: DataFrame) -> DataFrame:
    at = F.col("pickup_datetime")
    return trips.withColumns({
        "date": F.to_date(at), "pickup_hour": F.hour(at), "pickup_day": F.dayofweek(at), "pickup_month": F.month(at),
    }).where(F.col("date").isNotNull())


def _only_new(cleaned: DataFrame, current: DataFrame | None, key: str, small_batch: bool) -> DataFrame:
    if current is None:
        return cleaned
    return new_rows(settle(cleaned, "batch") if small_batch else cleaned, current, [key], small_batch)


def clean_trips(raw: DataFrame, current: DataFrame | None = None, small_batch: bool = False) -> DataFrame:
    """Located trips above the minimum fare, one per id, with calendar columns; only new ids when ``current`` is given.

    Duplicates are settled before the fare filter, so which copy survives does not depend on its fare passing.
    ``small_batch`` stores what was cleaned and sends its keys to the current table, which then needs no shuffle.
    """
    located = raw.dropna(subset=list(COORDINATES)).withColumn(
        "passenger_count", F.coalesce(F.col("passenger_count").cast("int"), F.lit(1)))
    kept = keep_first(located, ["trip_id"], ["pickup_datetime"]).where(F.col("fare_amount") > MIN_FARE)
    cleaned = with_calendar(kept)
    return _only_new(cleaned, current, "trip_id", small_batch)


def clean_trip_details(
    raw: DataFrame, current: DataFrame | None = None, small_batch: bool = False
) -> DataFrame:
    cleaned = keep_first(raw.dropna(subset=["trip_id", "driver_id", "customer_id"]), ["trip_id"])
    return _only_new(cleaned, current, "trip_id", small_batch)


def clean_dimension(
    raw: DataFrame, table: str, current: DataFrame | None = None, small_batch: bool = False
) -> DataFrame:
    if table not in DIMENSION_KEYS:
        raise ValueError(f"unsupported dimension {table!r}")
    key = DIMENSION_KEYS[table]
    cleaned = keep_first(raw.dropna(subset=[key]), [key])
    return _only_new(cleaned, current, key, small_batch)
