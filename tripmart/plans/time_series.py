"""The time-series mart: fares by hour, day, month, period, week and year.

The nine tables are cuts of one small cube. Trips are grouped once, by date, hour and their labels, which leaves at
most 24 rows per date and label set; the nine groupings then run over those rows. A grouping-sets query straight
over the trips would write each trip six times before its first aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.calendar import RUSH_PERIODS, WEEKEND
from tripmart.functions.categories import or_unknown
from tripmart.functions.numbers import steady_round
from tripmart.operators.states import add_batch, merged_state
from tripmart.operators.unions import tagged_union

MEASURES = ("fare_amount", "trip_duration_min", "fare_per_km", "fare_per_min")
CUBE_KEYS = ("pickup_year", "pickup_hour", "pickup_day", "pickup_month", "pickup_period", "pickup_week")

# Fixed values. Per table: label in the mart, grouping column next to the year (none for yearly), the names of the
# averages of fare, duration, fare per km and fare per minute, and the name of the trip count.
TABLES = {
    "weekday_fares": (
        "weekday", "pickup_day",
        ("avg_weekday_fare_amount", "avg_weekday_trip_duration_min", "avg_fare_per_km_weekday",
         "avg_fare_per_min_weekday"), "weekday_trip_count"),
    "yearly_fares": (
        "yearly", None,
        ("avg_fare_amount_year", "avg_trip_duration_min_year", "avg_fare_per_km_year", "avg_fare_per_min_year"),
        "trip_count_year"),
    "peak_hour": (
        "peak", "pickup_period",
        ("peak_hour_avg_fare_amount", "peak_hour_avg_trip_duration_min", "avg_fare_per_km_peak_hour",
         "avg_fare_per_peak_hour"), "peak_hour_trip_count"),
    "monthly_aggregation": (
        "monthly", "pickup_month",
        ("avg_fare_amount_month", "avg_trip_duration_min_month", "avg_fare_per_km_month", "avg_fare_per_min_month"),
        "trip_count_month"),
    "daily_aggregation": (
        "daily", "pickup_day",
        ("avg_fare_amount_day", "avg_trip_duration_min_day", "avg_fare_per_km_day", "avg_fare_per_min_day"),
        "trip_count_day"),
    "hourly_aggregation": (
        "hourly", "pickup_hour",
        ("avg_fare_amount_hour", "avg_trip_duration_min_hour", "avg_fare_per_km_hour", "avg_fare_per_min_hour"),
        "trip_count_hour"),
    "weekend_fares": (
        "weekend", "pickup_day",
        ("avg_weekend_fare_amount", "avg_weekend_trip_duration_min", "avg_fare_per_km_weekend",
         "avg_fare_per_min_hour_weekend"), "weekend_trip_count"),
    "weekly_fares": (
        "weekly", "pickup_week",
        ("avg_fare_amount_week", "avg_trip_duration_min_week", "avg_fare_per_km_weekly", "avg_fare_per_min_weekly"),
        "trip_count_week"),
    "non_peak_hour": (
        "non_peak", "pickup_period",
        ("non_peak_hour_avg_fare_amount", "non_peak_hour_avg_trip_duration_min", "avg_fare_per_km_non_peak_hour",
         "avg_fare_per_min_non_peak_hour"), "non_peak_hour_trip_count"),
}
_LABELS = {label: table for table, (label, *_) in TABLES.items()}


# What a stored cube is keyed by; year and week follow from the date.
STATE_KEYS = ("date", "pickup_hour", "pickup_day", "pickup_month", "pickup_period")


def hour_cube(fare_table: DataFrame, trips: DataFrame | None = None) -> DataFrame:
    """Sums and counts per date, hour and label. The year is the calendar's, the week is the ISO week.

    The hour is that of the fares' pickup time. ``trips`` is for callers whose trips carry another one; it costs a join of both
    large tables.
    """
    labels = ["date", "pickup_day", "pickup_month", "pickup_period", *MEASURES]
    if trips is None:
        joined = fare_table.select(F.hour("pickup_datetime").alias("pickup_hour"), *labels)
    else:
        joined = fare_table.select("trip_id", *labels).join(trips.select("trip_id", "pickup_hour"), "trip_id")
    return _with_years(joined.groupBy(*STATE_KEYS).agg(
        F.count("*").alias("trips"),
        *[F.sum(m).alias(f"sum_{m}") for m in MEASURES],
        *[F.count(m).alias(f"n_{m}") for m in MEASURES],
    ))


def _with_years(cube: DataFrame) -> DataFrame:
    return cube.withColumns({"pickup_year": F.year("date"), "pickup_week": F.weekofyear("date")})


def add_fares(fare_table: DataFrame, path: str, batch: int) -> None:
    """Add the fares of one load to the stored cube at ``path``. Late trips of an old date are sums like any other."""
    add_batch(hour_cube(fare_table).drop("pickup_year", "pickup_week"), path, batch)


def stored_series(spark: SparkSession, path: str) -> DataFrame:
    """The mart from the stored cube; no fare is read again."""
    return series_of_cube(_with_years(merged_state(spark, path, STATE_KEYS)))


def calendar_rollup(cube: DataFrame) -> DataFrame:
    """The six groupings of the cube in one pass; ``grouped_by`` names the column next to the year."""
    sets = [["pickup_year"]] + [["pickup_year", k] for k in CUBE_KEYS[1:]]
    # A key is rolled up where its bit is set; bits run from the last key.
    grouped_by = F.coalesce(*[
        F.when(F.grouping(k) == 0, F.lit(k)) for k in CUBE_KEYS[1:]
    ], F.lit("pickup_year"))
    rolled = cube.groupingSets(sets, *CUBE_KEYS).agg(
        grouped_by.alias("grouped_by"),
        F.sum("trips").alias("trips"),
        *[F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(f"avg_{m}") for m in MEASURES],
    )
    return rolled


def _in_table(table: str) -> Column:
    """Whether a rolled-up row belongs to a table. Rows without a day or period are on neither side of a split."""
    label, by, *_ = TABLES[table]
    of_kind = F.col("grouped_by") == (by or "pickup_year")
    split = {
        "weekend": F.col("pickup_day").isin(*WEEKEND), "weekday": ~F.col("pickup_day").isin(*WEEKEND),
        "peak": F.col("pickup_period").isin(*RUSH_PERIODS), "non_peak": ~F.col("pickup_period").isin(*RUSH_PERIODS),
    }.get(label, F.lit(True))
    return of_kind & F.coalesce(split, F.lit(False))


def _measures(table: str) -> dict[str, Column]:
    """Columns of a table in the order of its names: averages, then the count."""
    _, _, averages, count = TABLES[table]
    columns = {name: steady_round(F.col(f"avg_{m}"), 2) for name, m in zip(averages, MEASURES)}
    return columns | {count: F.col("trips")}


def calendar_table(rollup: DataFrame, table: str) -> DataFrame:
    """One of the nine tables."""
    by = TABLES[table][1]
    keys = ["pickup_year"] + ([by] if by else [])
    return rollup.where(_in_table(table)).select(
        *[or_unknown(F.col(k)).alias(k) for k in keys], *[c.alias(n) for n, c in _measures(table).items()])


def calendar_tables(rollup: DataFrame) -> dict[str, DataFrame]:
    """All nine, for export. Store the rollup first: it is small, and each table reads it."""
    return {t: calendar_table(rollup, t) for t in TABLES}


def union_time_series(tables: dict[str, DataFrame]) -> DataFrame:
    """The mart from stored tables: their union, missing columns null, ``time_period`` naming the origin."""
    return tagged_union({TABLES[t][0]: df for t, df in tables.items()}, "time_period")


def time_series(fare_table: DataFrame, trips: DataFrame | None = None) -> DataFrame:
    """The same rows in one plan: each rolled-up row goes to the one or two tables it belongs to."""
    return series_of_cube(hour_cube(fare_table, trips))


def series_of_cube(cube: DataFrame) -> DataFrame:
    """The mart from the cube alone."""
    rollup = calendar_rollup(cube)
    homes = F.filter(F.array(*[
        F.when(_in_table(table), F.lit(label)) for label, table in _LABELS.items()
    ]), lambda label: label.isNotNull())
    placed = rollup.withColumn("time_period", F.explode(homes))
    columns: dict[str, Column] = {}
    for table, (label, by, *_) in TABLES.items():
        here = F.col("time_period") == label
        for key in ("pickup_year", *([by] if by else [])):
            columns[key] = F.when(here, or_unknown(F.col(key))) if key not in columns else F.coalesce(
                columns[key], F.when(here, or_unknown(F.col(key))))
        for name, column in _measures(table).items():
            columns[name] = F.when(here, column)
    return placed.select(*[c.alias(n) for n, c in columns.items()], "time_period")
