"""Borough boundaries and the boroughs of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import geometry as G
from tripmart.operators.keys import new_rows
from tripmart.operators.lookup import settle
from tripmart.operators.spatial import Cells, locate, stored_cells

FROM_SHAPE, FROM_DETAILS = "features", "tripdetails"
LOCATED_COLUMNS = (
    "date", "trip_id", "dropoff_datetime", "pickup_datetime", "fare_amount", "passenger_count",
    "pickup_hour", "pickup_day", "pickup_month", "temperature", "precipitation", "humidity", "wind_speed",
    "snow_fall", "distance_km",
)


def load_boundaries(collections: DataFrame) -> DataFrame:
    """Feature collections to (borough, geometry_json, shape), shapes closed and turned the standard way."""
    return shapes_of(collections.select(F.explode("features").alias("f")))


def shapes_of(features: DataFrame) -> DataFrame:
    """The same from one row ``f`` per feature, as ``read_features`` gives them."""
    shaped = features.select(
        F.col("f.properties.name").alias("borough"),
        G.repair(G.multipolygon(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))).alias("shape"),
    )
    text = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.col("shape").alias("coordinates")))
    return shaped.select("borough", F.when(F.col("shape").isNotNull(), text).alias("geometry_json"), "shape")


def borough_cells(boundaries: DataFrame, cell_size: float | None = None) -> Cells:
    """Grid cells of the boundaries, prepared once and used by every load."""
    return stored_cells(boundaries, "borough", size=cell_size)


def with_boroughs(trips: DataFrame, cells: Cells) -> DataFrame:
    """Pickup and dropoff borough by position, null outside every boundary."""
    for end in ("pickup", "dropoff"):
        trips = locate(trips, cells, "borough", f"{end}_longitude", f"{end}_latitude", f"{end}_borough", "trip_id")
    return trips


def fill_boroughs(located: DataFrame, details: DataFrame) -> DataFrame:
    """Missing boroughs from the trip details, with the origin of each; such trips without details are dropped.

    One left join stands for the four cases of pickup and dropoff being known or not.
    """
    places = details.select(
        "trip_id", F.col("pickup_location").alias("_p"), F.col("dropoff_location").alias("_d"),
        F.lit(True).alias("_known"))
    source = lambda c: F.when(F.col(c).isNull(), FROM_DETAILS).otherwise(FROM_SHAPE)
    return (
        located.join(places, "trip_id", "left")
        .where((F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull()) | F.col("_known"))
        .withColumns({
            "pickupboroughsource": source("pickup_borough"), "dropoffboroughsource": source("dropoff_borough"),
            "pickup_borough": F.coalesce("pickup_borough", "_p"), "dropoff_borough": F.coalesce("dropoff_borough", "_d"),
        })
        .select(*located.columns, "pickupboroughsource", "dropoffboroughsource")
    )


def locate_trips(
    trips: DataFrame, cells: Cells, details: DataFrame, current: DataFrame | None = None, small_batch: bool = False
) -> DataFrame:
    """Trips with weather and distance to trips with boroughs; only new ones when ``current`` is given."""
    if current is not None:
        trips = new_rows(settle(trips, "batch") if small_batch else trips, current, ["trip_id"], small_batch)
    shaped = with_boroughs(trips, cells).withColumns({
        "temperature": F.round("avg_temp", 2), "precipitation": F.round("precipitation", 2),
        "humidity": F.round("avg_humidity", 2), "wind_speed": F.round("avg_wind_speed", 2),
        "snow_fall": F.round("avg_snow_fall", 2),
    }).select(*LOCATED_COLUMNS, "pickup_borough", "dropoff_borough")
    return fill_boroughs(shaped, details)
