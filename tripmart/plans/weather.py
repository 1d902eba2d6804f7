"""Daily weather and its join to trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.sphere import haversine_km
from tripmart.operators.lookup import settle
from tripmart.operators.readings import MIN_READINGS, reduce_readings

METRICS = (
    "avg_temp", "precipitation", "weather_code", "avg_humidity", "avg_wind_speed", "avg_cloud_cover", "avg_snow_fall",
)
# Hourly reading and the daily column it becomes.
DAILY_AVERAGES = {
    "temperature_2m": "avg_temp", "relative_humidity_2m": "avg_humidity", "wind_speed_10m": "avg_wind_speed",
    "cloudcover": "avg_cloud_cover", "snowfall": "avg_snow_fall",
}


def daily_weather(hourly: DataFrame, precipitation: str = "avg", least: int = MIN_READINGS) -> DataFrame:
    """Hourly readings to one row per date. A backfill averages precipitation, an enrichment sums it."""
    averages, sums = dict(DAILY_AVERAGES), {}
    if precipitation == "avg":
        averages["precipitation"] = "precipitation"
    elif precipitation == "sum":
        sums["precipitation"] = "precipitation"
    else:
        raise ValueError("precipitation must be avg or sum")
    daily = reduce_readings(hourly, ["date"], averages, sums, ("weather_code", "weather_code"), least)
    return daily.select("date", *METRICS)


def fill_spine(spine: DataFrame, daily: DataFrame) -> DataFrame:
    """Every wanted date, null where no readings came."""
    return spine.join(daily, "date", "left")


def split_by_weather(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with no metric at all (metrics dropped), and rows with at least one."""
    some = F.coalesce(*[F.col(m).cast("double") for m in METRICS]).isNotNull()
    return trips.where(~some).drop(*METRICS), trips.where(some)


def best_weather(weather: DataFrame, backup: DataFrame) -> DataFrame:
    """One weather table of two: a date empty in the first takes the second's row."""
    both = weather.select("date", F.struct(*METRICS).alias("a")).join(
        backup.select("date", F.struct(*METRICS).alias("b")), "date", "full")
    some = F.coalesce(*[F.col("a")[m].cast("double") for m in METRICS]).isNotNull()
    return both.select("date", *[F.when(some, F.col("a")[m]).otherwise(F.col("b")[m]).alias(m) for m in METRICS])


def attach_weather(trips: DataFrame, weather: DataFrame, backup: DataFrame | None = None) -> DataFrame:
    """Left join daily weather on date.

    The weather, of one table or two merged, is stored first. Trips are then joined once, and to a table whose size Spark knows:
    it goes to the trips, and no busy date has to be gathered in one task.
    """
    table = settle(weather.select("date", *METRICS) if backup is None else best_weather(weather, backup), "weather")
    return trips.drop(*METRICS).join(table, "date", "left")


def attach_distance(trips: DataFrame) -> DataFrame:
    return trips.withColumn("distance_km", haversine_km(
        F.col("pickup_latitude"), F.col("pickup_longitude"), F.col("dropoff_latitude"), F.col("dropoff_longitude")))
