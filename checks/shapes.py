"""The plain shapes of some jobs, to measure the rewrites against. Each returns the rows its rewrite returns."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs
from checks.domain import box_shapes, cells, view
from tripmart.functions import geometry as G
from tripmart.functions.categories import or_unknown
from tripmart.functions.numbers import steady_round
from tripmart.operators.unions import stack, tagged_union
from tripmart.plans import boroughs
from tripmart.plans.time_series import MEASURES, TABLES


def nine_scans(spark, sf):
    """Time series as nine groupings of the fares."""
    fares = inputs.fare_table(spark, sf).join(
        view(spark, sf, "trips").select("trip_id", "pickup_hour"), "trip_id").withColumns(
        {"pickup_year": F.year("date"), "pickup_week": F.weekofyear("date")})
    keep = {
        "weekend": F.col("pickup_day").isin("Saturday", "Sunday"),
        "weekday": ~F.col("pickup_day").isin("Saturday", "Sunday"),
        "peak": F.col("pickup_period").isin("Morning Rush", "Evening Rush"),
        "non_peak": ~F.col("pickup_period").isin("Morning Rush", "Evening Rush"),
    }
    frames = {}
    for label, by, averages, count in TABLES.values():
        keys = ["pickup_year"] + ([by] if by else [])
        grouped = fares.where(keep.get(label, F.lit(True))).groupBy(*keys).agg(
            *[steady_round(F.avg(m), 2).alias(n) for n, m in zip(averages, MEASURES)], F.count("trip_id").alias(count))
        frames[label] = grouped.withColumns({k: or_unknown(F.col(k)) for k in keys})
    return tagged_union(frames, "time_period")


def four_branches(spark, sf):
    """Borough fallback as four filters and a union."""
    located = boroughs.with_boroughs(view(spark, sf, "trips"), cells(spark, sf))
    details = view(spark, sf, "trip_details").select("trip_id", "pickup_location", "dropoff_location")
    branches = []
    for p_null in (False, True):
        for d_null in (False, True):
            p, d = F.col("pickup_borough"), F.col("dropoff_borough")
            part = located.where((p.isNull() if p_null else p.isNotNull()) & (d.isNull() if d_null else d.isNotNull()))
            if p_null or d_null:
                part = part.join(details, "trip_id")
                if p_null:
                    part = part.withColumn("pickup_borough", F.col("pickup_location"))
                if d_null:
                    part = part.withColumn("dropoff_borough", F.col("dropoff_location"))
            branches.append(part.select(*located.columns).withColumns({
                "pickupboroughsource": F.lit(boroughs.FROM_DETAILS if p_null else boroughs.FROM_SHAPE),
                "dropoffboroughsource": F.lit(boroughs.FROM_DETAILS if d_null else boroughs.FROM_SHAPE)}))
    return stack(*branches)


def one_pass(spark, sf):
    """The rewrite of ``four_branches``."""
    return boroughs.fill_boroughs(
        boroughs.with_boroughs(view(spark, sf, "trips"), cells(spark, sf)), view(spark, sf, "trip_details"))


def python_distance(spark, sf):
    """Distance by a row-at-a-time Python function."""
    def distance(lat1, lon1, lat2, lon2):
        if None in (lat1, lon1, lat2, lon2):
            return None
        s = math.sin(math.radians(lat2 - lat1) / 2) ** 2
        s += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
        return round(2 * 6371 * math.atan2(math.sqrt(s), math.sqrt(1 - s)), 2)

    call = F.udf(distance, T.DoubleType(), useArrow=False)
    return view(spark, sf, "trips").select("trip_id", call(
        "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude").alias("distance_km"))


def nested_loop_boroughs(spark, sf):
    """Boroughs by testing every trip against every shape."""
    shapes = box_shapes(spark, sf)
    trips = view(spark, sf, "trips").select(
        "trip_id", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    for end in ("pickup", "dropoff"):
        s = shapes.select(F.col("borough").alias(f"{end}_borough"), F.col("shape").alias(f"_{end}"))
        trips = trips.join(s, G.contains(f"_{end}", f"{end}_longitude", f"{end}_latitude"), "left").drop(f"_{end}")
    return trips.select("trip_id", "pickup_borough", "dropoff_borough")


def count_per_number(spark, sf):
    """Load counters with a job for each number."""
    trips = view(spark, sf, "trips")
    kept = trips.join(view(spark, sf, "current_trips").select("trip_id"), "trip_id", "left_anti")
    total, n_kept = trips.count(), kept.count()
    missing = trips.where("dropoff_longitude is null").count()
    valid = trips.where("dropoff_longitude is not null").count()
    return spark.createDataFrame(
        [(total, n_kept, total - n_kept, missing, valid, round(n_kept / total * 100, 2))],
        "total_rows long, kept_rows long, removed_rows long, null_rows long, valid_rows long, retention_pct double")


# Rewrite (a registered query or a function here) and its plain shape.
PAIRS = {
    "time_series": ("time_series_mart", nine_scans),
    "borough_fallback": (one_pass, four_branches),
    "distance": ("trip_distances", python_distance),
    "spatial_join": ("trip_boroughs", nested_loop_boroughs),
    "load_counters": ("load_counters", count_per_number),
}
