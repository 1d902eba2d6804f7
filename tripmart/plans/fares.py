"""The fares mart and the weather-impact mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import calendar as C
from tripmart.functions import categories as K
from tripmart.functions import numbers as N
from tripmart.operators.keys import new_rows
from tripmart.operators.lookup import settle

ROUTE = ("pickup_borough", "dropoff_borough", "pickup_period")
# Fixed value: a rating below this is low.
LOW_RATING = 3
FARE_COLUMNS = (
    "trip_id", "date", "pickup_datetime", "dropoff_datetime", "distance_km", "trip_duration_min", "fare_amount",
    "tip_amount", "fare_per_km", "fare_per_min", "tip_pct", "total_fareamount", "pickup_month", "pickup_day",
    "pickup_period", "rain_intensity", "snow_intensity", "wind_intensity", "temperature_intensity",
    "is_weather_extreme", "pickup_borough", "dropoff_borough", "pickupboroughsource", "dropoffboroughsource",
)


def fares(
    located: DataFrame, details: DataFrame, current: DataFrame | None = None, small_batch: bool = False
) -> DataFrame:
    """One row per trip with details: ratios, labels and weather categories; only new trips when ``current`` is given.

    ``small_batch`` stores the located trips first and sends their keys to the current table and to the details.
    """
    tips = details.select("trip_id", "tip_amount")
    if current is not None:
        # The join drops details of known trips anyway.
        located = new_rows(settle(located, "batch") if small_batch else located, current, ["trip_id"], small_batch)
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    priced = located.join(tips, "trip_id").withColumn(
        "trip_duration_min", C.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime")))
    return priced.withColumns({
        "fare_per_km": F.round(N.safe_ratio(fare, F.col("distance_km")), 2),
        "fare_per_min": F.round(N.safe_ratio(fare, F.col("trip_duration_min")), 2),
        "tip_pct": F.round(N.tip_percent(fare, tip), 2),
        "total_fareamount": F.round(N.total_fare(fare, tip), 2),
        "pickup_month": C.month_name(F.col("pickup_month")),
        "pickup_day": C.day_name(F.col("pickup_day")),
        "pickup_period": C.pickup_period(F.col("pickup_hour")),
        "rain_intensity": K.categorize(F.col("precipitation"), *K.RAIN),
        "snow_intensity": K.categorize(F.col("snow_fall"), *K.SNOW),
        "wind_intensity": K.categorize(F.col("wind_speed"), *K.WIND),
        "temperature_intensity": K.categorize(F.col("temperature"), *K.TEMPERATURE),
    }).withColumn("is_weather_extreme", K.is_weather_extreme(
        F.col("rain_intensity"), F.col("snow_intensity"), F.col("wind_intensity"), F.col("temperature_intensity"),
    )).select(*FARE_COLUMNS)


def route_baseline(fare_table: DataFrame) -> DataFrame:
    """Expected fare and duration per route and period, from trips in ordinary weather."""
    return fare_table.where(~F.col("is_weather_extreme")).groupBy(*ROUTE).agg(
        N.steady_round(F.avg("fare_amount"), 2).alias("expected_fare_amount"),
        N.steady_round(F.avg("trip_duration_min"), 2).alias("expected_trip_duration_min"),
    )


def weather_impact(fare_table: DataFrame, details: DataFrame) -> DataFrame:
    """Excess fare and time of trips in extreme weather over the baseline of their route.

    Building the frame already runs a job: it stores the baseline.
    """
    # One row per route: stored, it is small enough for Spark to send to the trips, which then need no shuffle by
    # route, where one busy route could hold a third of them.
    baseline = settle(route_baseline(fare_table), "baseline")
    outcome = details.select("trip_id", "trip_status", "driver_rating")
    extreme = F.col("is_weather_extreme")

    def excess(actual: str, expected: str):
        return F.when(extreme & (F.col(actual) > F.col(expected)), F.col(actual) - F.col(expected)).otherwise(F.lit(0.0))

    def share(difference: str, expected: str):
        return F.when(F.col(expected) > 0, F.col(difference) / F.col(expected) * 100).otherwise(F.lit(0.0))

    return (
        fare_table.join(outcome, "trip_id").join(baseline, list(ROUTE), "left")
        .withColumns({
            "_fare": excess("fare_amount", "expected_fare_amount"),
            "_time": excess("trip_duration_min", "expected_trip_duration_min"),
        })
        .select(
            "trip_id", "date", "pickup_datetime", "dropoff_datetime", "trip_duration_min", "fare_amount",
            "expected_fare_amount", "expected_trip_duration_min",
            F.round("_fare", 2).alias("fare_amount_diff"),
            F.round("_time", 2).alias("tip_duration_diff"),
            F.round(share("_fare", "expected_fare_amount"), 2).alias("fare_amount_pct_diff"),
            F.round(share("_time", "expected_trip_duration_min"), 2).alias("trip_duration_pct_diff"),
            "pickup_period", "rain_intensity", "snow_intensity", "wind_intensity", "temperature_intensity",
            "is_weather_extreme", "driver_rating",
            F.coalesce((F.col("driver_rating") < LOW_RATING) & extreme, F.lit(False)).alias("low_rating_due_to_weather"),
            "trip_status",
            F.coalesce((F.lower("trip_status") == "cancelled") & extreme, F.lit(False))
            .alias("cancellation_due_to_weather"),
            "pickup_borough", "dropoff_borough",
        )
    )
