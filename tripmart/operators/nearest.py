"""The nearest of many places, for each of many points: a join over a tree of cells.

Places and points become points in space on a unit globe, so there is no date line and no pole to mind, and the straight line orders them as the great circle
does. Space is cut into cubes, each of them into ``STEP`` ** 3 smaller ones, down to a level where a cube holds a few places. A point goes down the
levels: of the cubes below its candidates it keeps those that may hold something nearer than the nearest representative seen, each cube naming one of its places.
Each level is a join on the parent cube and a minimum within the point's rows, so nothing is compared with all places and a table of any size will do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.lookup import settle

STEP = 4
IN_CUBE = 4  # places in a cube of the last level, where places do not lie closer than its side
DEEPEST = 12  # cubes of a metre or so
TIE = 1e-9  # the relative difference of squared distances that counts as equal


def _on_globe(lat: str, lon: str) -> dict[str, Column]:
    la, lo = F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    return {"_x": F.cos(la) * F.cos(lo), "_y": F.cos(la) * F.sin(lo), "_z": F.sin(la)}


def _side(level: int) -> float:
    return 2.0 / STEP**level


def _cube(axis: str, level: int) -> Column:
    return F.least(F.floor((F.col(axis) + 1) / F.lit(_side(level))), F.lit(STEP**level - 1)).cast("long")


def _levels(places: DataFrame) -> int:
    """The first level whose cubes hold at most ``IN_CUBE`` places. One number for each level comes to the driver."""
    levels = F.explode(F.sequence(F.lit(1), F.lit(DEEPEST)))
    cube = [F.least(F.floor((F.col(a) + 1) * F.pow(F.lit(float(STEP)), F.col("level")) / 2), F.pow(F.lit(float(STEP)), F.col("level")) - 1).cast("long").alias(a)
            for a in ("_x", "_y", "_z")]
    crowded = places.select("_x", "_y", "_z").distinct().withColumn("level", levels).select("level", *cube).groupBy("level", "_x", "_y", "_z").count()
    most = {r[0]: r[1] for r in crowded.groupBy("level").agg(F.max("count")).collect()}
    return next((k for k in range(1, DEEPEST) if most.get(k, 0) <= IN_CUBE), DEEPEST)


def _squared(a: tuple[str, str, str], b: tuple[str, str, str]) -> Column:
    total = F.lit(0.0)
    for p, q in zip(a, b):
        total = total + (F.col(p) - F.col(q)) * (F.col(p) - F.col(q))
    return total


def nearest_of(points: DataFrame, key: str, lat: str, lon: str, places: DataFrame, name: str = "name", place_lat: str = "lat", place_lon: str = "lon",
               out: str = "nearest") -> DataFrame:
    """(key, out) of each point with coordinates: the name of the nearest place, the first by name where several are equally near.

    ``key`` must tell points apart. Points and places without usable coordinates take no part; without places there are no rows.
    """
    usable = lambda la, lo: F.col(la).between(-90, 90) & F.col(lo).between(-math.inf, math.inf) & ~F.isnan(F.col(lo)) & (F.abs(F.col(lo)) < math.inf)
    globe = settle(places.where(usable(place_lat, place_lon) & F.col(name).isNotNull())
                   .select(F.col(name).alias("_name"), *[c.alias(a) for a, c in _on_globe(place_lat, place_lon).items()]), "places")
    last = _levels(globe)
    axes, own, spot = ("_x", "_y", "_z"), ("_i", "_j", "_k"), ("_px", "_py", "_pz")
    rows = points.where(usable(lat, lon)).select(F.col(key).alias("_key"), *[c.alias(p) for p, c in zip(spot, _on_globe(lat, lon).values())])
    # The topmost cube holds everything.
    found = rows.withColumns({c: F.lit(0).cast("long") for c in own})
    mine = Window.partitionBy("_key")
    for level in range(1, last + 1):
        side = _side(level)
        cubes = globe.select(*[_cube(a, level).alias(f"{c}2") for a, c in zip(axes, own)], F.struct("_name", *axes).alias("_one")).groupBy(
            *[f"{c}2" for c in own]).agg(F.min("_one").alias("_one"))
        cubes = settle(cubes.select(*[F.floor(F.col(f"{c}2") / STEP).cast("long").alias(c) for c in own], *[f"{c}2" for c in own], "_one.*").drop("_name"), "cubes")
        away = F.lit(0.0)
        for p, c in zip(spot, own):
            low = F.col(f"{c}2") * side - 1
            gap = F.greatest(low - F.col(p), F.col(p) - low - side, F.lit(0.0))
            away = away + gap * gap
        joined = found.join(cubes, list(own)).withColumns({"_away": away, "_near": _squared(spot, axes)})
        # A hair of slack for rounding, and for places that tie.
        best = F.min("_near").over(mine)
        kept = joined.withColumn("_best", best).where(F.col("_away") <= F.col("_best") * (1 + 2 * TIE) + 1e-15)
        found = kept.select("_key", *spot, *[F.col(f"{c}2").alias(c) for c in own])
        if level % 4 == 0:
            found = settle(found, "level")
    inside = globe.select("_name", *axes, *[_cube(a, last).alias(c) for a, c in zip(axes, own)])
    near = found.join(inside, list(own)).withColumn("_near", _squared(spot, axes))
    tied = near.withColumn("_best", F.min("_near").over(mine)).where(F.col("_near") <= F.col("_best") * (1 + TIE))
    return tied.groupBy(F.col("_key").alias(key)).agg(F.min("_name").alias(out))
