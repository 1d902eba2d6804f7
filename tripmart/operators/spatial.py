"""Point-in-polygon and nearest-centre joins."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import geometry as G
from tripmart.operators.lookup import settle

# Cells along the longer side of a shape, at most; each level's cells are STEP times wider than those of the one before.
CELLS_PER_SIDE = 16
STEP = 16
NULL_SPREAD = 4096
# Relative difference of squared distances below which two centres are equally near.
TIE = 1e-9


class Cells(NamedTuple):
    """Shapes cut into grid cells: rows of (level, ix, iy, found), ``found`` being the (name, solid, edges) of every shape in the cell.

    Level n has cells ``size * STEP ** n`` degrees wide; ``levels`` lists those in use.
    """

    rows: DataFrame
    size: float
    levels: tuple[int, ...]


def _span() -> Column:
    low, high = _extent("_edges")
    return F.greatest(F.expr(f"{high('x')} - {low('x')}"), F.expr(f"{high('y')} - {low('y')}"))


def grid_size(shapes: DataFrame, shape: str = "shape", cells_per_side: int = CELLS_PER_SIDE) -> float:
    """The width of the finest cells: the narrowest shape covers about ``cells_per_side`` squared of them, or fewer."""
    narrowest = shapes.select(G.edges(shape).alias("_edges")).select(_span().alias("span")).where("span > 0").agg(F.min("span")).first()[0]
    return float(narrowest) / cells_per_side if narrowest else 1.0


def _extent(edges: str):
    """SQL of the least and greatest coordinate of a list of edges."""
    low = lambda axis: f"array_min(transform({edges}, e -> least(e.{axis}1, e.{axis}2)))"
    high = lambda axis: f"array_max(transform({edges}, e -> greatest(e.{axis}1, e.{axis}2)))"
    return low, high


def shape_cells(shapes: DataFrame, name: str, size: float, shape: str = "shape") -> DataFrame:
    """Cut each shape into cells of the level that fits it: ``(level, ix, iy, name, solid, edges)``.

    A cell no edge touches lies wholly inside (``solid``, no edges kept) or wholly outside (dropped). Any other
    cell keeps just the edges a rightward ray from one of its points can meet.
    """
    low, high = _extent("_edges")
    # A handful of shapes sits in one small file; cutting them up is worth a task each.
    spread = int(shapes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The least level at which the shape has at most STEP * CELLS_PER_SIDE cells a side.
    level = F.greatest(F.lit(0), F.ceil(F.log(_span() / F.lit(size * CELLS_PER_SIDE * STEP)) / F.lit(math.log(STEP)))).cast("int")
    sized = (
        shapes.repartition(spread, name).select(name, G.edges(shape).alias("_edges"))
        .where(F.size("_edges") > 0)
        .withColumn("level", F.coalesce(level, F.lit(0)))
        .withColumn("_w", F.lit(float(size)) * F.pow(F.lit(float(STEP)), F.col("level")))
    )
    cell_range = lambda axis: F.expr(f"sequence(floor({low(axis)} / _w), floor({high(axis)} / _w))")
    cells = sized.withColumn("ix", F.explode(cell_range("x"))).withColumn("iy", F.explode(cell_range("y")))
    # A hair of slack keeps rounding of the cell border from losing an edge.
    slack = "(_w * 1e-9D)"
    near = (
        f"filter(_edges, e -> least(e.y1, e.y2) <= (iy + 1) * _w + {slack}"
        f" and greatest(e.y1, e.y2) >= iy * _w - {slack} and greatest(e.x1, e.x2) >= ix * _w - {slack})"
    )
    touched = f"exists(_near, e -> least(e.x1, e.x2) <= (ix + 1) * _w + {slack})"
    return (
        cells.withColumn("_near", F.expr(near))
        .withColumn("_touched", F.expr(touched))
        .where(F.col("_touched") | G.inside("_near", "((ix + 0.5D) * _w)", "((iy + 0.5D) * _w)"))
        .select(
            # Two ints pack into one long join key.
            "level", F.col("ix").cast("int").alias("ix"), F.col("iy").cast("int").alias("iy"), name,
            (~F.col("_touched")).alias("solid"),
            F.expr("if(_touched, _near, slice(_near, 1, 0))").alias("edges"),
        )
    )


def stored_cells(shapes: DataFrame, name: str, shape: str = "shape", size: float | None = None) -> Cells:
    """Cells written out, once per set of shapes. Their real size then decides whether the joins broadcast them.

    A cell is one row, whatever shapes overlap there, so a join with it never repeats a point.
    """
    size = size or grid_size(shapes, shape)
    found = F.struct(F.col(name).alias("name"), "solid", "edges")
    rows = settle(shape_cells(shapes, name, size, shape).groupBy("level", "ix", "iy").agg(F.collect_list(found).alias("found")), "cells")
    levels = tuple(sorted(r["level"] for r in rows.select("level").distinct().toLocalIterator()))
    return Cells(rows, size, levels)


def _cell(value: Column, size: float) -> Column:
    """The cell number; null for what no cell can hold, such as infinity or a number beyond the globe's."""
    return F.when(value.isNotNull() & ~F.isnan(value), F.floor(value / size).try_cast("int"))


def locate(
    points: DataFrame, cells: Cells, name: str, lon: str, lat: str, out: str, spread_by: str
) -> DataFrame:
    """Left join: the name of the shape around each point, null outside all. Overlapping shapes repeat the row.

    A point falls in one cell of each level, so there is a join on equal cells for each level in use, and the exact test runs on
    the matches alone. Points without coordinates get scattered cell numbers that match nothing; left null they would all
    meet in one task. Beyond the broadcast threshold a join shuffles both sides, and adaptive execution splits a busy cell: a
    cell has one row, so its points may meet it in as many tasks as they fill.
    """
    scattered = F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD)).cast("int")
    located = points
    for level in cells.levels:
        cell = lambda c: _cell(F.col(c), cells.size * STEP**level)
        known = cell(lon).isNotNull() & cell(lat).isNotNull()
        marked = located.withColumns({
            "_ix": F.when(known, cell(lon)).otherwise(scattered), "_iy": F.when(known, cell(lat))})
        c = cells.rows.where(F.col("level") == level).select(
            F.col("ix").alias("_c_ix"), F.col("iy").alias("_c_iy"), F.col("found").alias(f"_found{level}"))
        located = marked.join(c, F.expr("_ix = _c_ix and _iy = _c_iy"), "left").drop("_ix", "_iy", "_c_ix", "_c_iy")
    none = F.expr("slice(array(named_struct('name', '', 'solid', true, 'edges', array(named_struct("
                  "'x1', 0D, 'y1', 0D, 'x2', 0D, 'y2', 0D)))), 1, 0)")
    met = F.concat(*[F.coalesce(f"_found{level}", none) for level in cells.levels]) if cells.levels else none
    inside = F.expr(f"transform(filter(_met, s -> s.solid or {G.inside_sql('s.edges', lon, lat)}), s -> s.name)")
    return located.withColumn("_met", met).select(*points.columns, F.explode_outer(inside).alias(out))


def with_nearest(
    points: DataFrame, lat: str, lon: str, out: str, centres: Sequence[tuple[str, float, float]]
) -> DataFrame:
    """Add the name of the nearest (name, latitude, longitude); distances equal to nine digits go to the first name.

    For a fixed list such as states or cities: it travels with the function, so nothing is joined and no pairs become
    rows. The straight line through the globe orders points as the great circle does and needs no trigonometry per
    centre. Spark interprets array lambdas element by element; NumPy over Arrow batches took a seventh of the time.
    """
    if not centres:
        raise ValueError("no centres given")
    named, tie = sorted(centres), TIE

    # Defined in here, the helper travels to the tasks with the function.
    def on_globe(lat, lon):
        return np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)

    names = np.array([c[0] for c in named], dtype=object)
    places = on_globe(np.radians([c[1] for c in named]), np.radians([c[2] for c in named]))

    @F.pandas_udf("string")
    def nearest(la: pd.Series, lo: pd.Series) -> pd.Series:
        known = (la.notna() & lo.notna()).to_numpy()
        spots = on_globe(np.radians(la[known].to_numpy()), np.radians(lo[known].to_numpy()))
        squared = sum((s[:, None] - p[None, :]) ** 2 for s, p in zip(spots, places))
        near = squared <= squared.min(axis=1, keepdims=True) * (1 + tie)
        found = np.full(len(la), None, dtype=object)
        found[known] = names[near.argmax(axis=1)]
        return pd.Series(found)

    return points.withColumn(out, nearest(F.col(lat).cast("double"), F.col(lon).cast("double")))

