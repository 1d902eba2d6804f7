"""Polygons as nested arrays of doubles, and the tests that need nothing else.

A multipolygon is ``array<array<array<array<double>>>>``: polygons, rings, points, (lon, lat).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTIPOLYGON = "array<array<array<array<double>>>>"
# How near, in degrees, a point may be to an edge and still count as lying on it (about 0.1 micrometres).
EDGE_TOLERANCE = 1e-12


def parse_geometry(geojson: Column) -> Column:
    """GeoJSON geometry text to a multipolygon; other geometry types give null."""
    geometry = F.from_json(geojson, "type string, coordinates string")
    return multipolygon(geometry["type"], geometry["coordinates"])


def multipolygon(kind: Column, coordinates: Column) -> Column:
    """Coordinates text to a multipolygon; a lone polygon becomes a list of one."""
    listed = F.when(kind == "Polygon", F.concat(F.lit("["), coordinates, F.lit("]"))).when(
        kind == "MultiPolygon", coordinates
    )
    return F.from_json(listed, MULTIPOLYGON)


def _pairs(ring: Column, combine) -> Column:
    """``combine`` over each point and the next one."""
    steps = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), steps), F.slice(ring, F.lit(2), steps), combine)


def signed_area(ring: Column) -> Column:
    """Above zero for a counter-clockwise closed ring."""
    crosses = _pairs(ring, lambda a, b: a[0] * b[1] - b[0] * a[1])
    return F.aggregate(crosses, F.lit(0.0), lambda total, c: total + c) / 2


def repair(shape: Column) -> Column:
    """Close open rings and turn them the standard way: outer rings counter-clockwise, holes clockwise."""

    def fix(ring: Column, index: Column) -> Column:
        closed = F.when(
            F.element_at(ring, 1) != F.element_at(ring, -1),
            F.concat(ring, F.slice(ring, 1, 1)),
        ).otherwise(ring)
        area = signed_area(closed)
        return F.when((index == 0) & (area < 0), F.reverse(closed)).when(
            (index > 0) & (area > 0), F.reverse(closed)
        ).otherwise(closed)

    usable = lambda polygon: F.filter(polygon, lambda ring: F.size(ring) > 0)
    return F.transform(shape, lambda polygon: F.transform(usable(polygon), fix))


def edges_sql(shape: str) -> str:
    """SQL for every edge of every ring as ``struct<x1, y1, x2, y2>``; ``shape`` is a column name or SQL."""
    return (
        f"flatten(transform(flatten({shape}), r -> zip_with("
        "slice(r, 1, greatest(size(r) - 1, 0)), slice(r, 2, greatest(size(r) - 1, 0)), "
        "(a, b) -> named_struct('x1', a[0], 'y1', a[1], 'x2', b[0], 'y2', b[1]))))"
    )


def edges(shape: str) -> Column:
    return F.expr(edges_sql(shape))


def inside_sql(edge_list: str, x: str, y: str) -> str:
    """SQL for the even-odd test over all edges, so holes and several parts need no special case.

    The sign of ``side`` tells on which side of an edge the point lies; without a division a flat edge is safe in
    ANSI mode. A point on an edge is outside.
    """
    side = f"((e.x2 - e.x1) * ({y} - e.y1) - ({x} - e.x1) * (e.y2 - e.y1))"
    crosses = f"(e.y1 > {y}) != (e.y2 > {y}) and (e.y2 > e.y1) = ({side} > 0)"
    on_edge = (
        f"abs({side}) <= {EDGE_TOLERANCE!r}D * (abs(e.x2 - e.x1) + abs(e.y2 - e.y1))"
        f" and {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2)"
        f" and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2)"
    )
    return f"(size(filter({edge_list}, e -> {crosses})) % 2 = 1 and not exists({edge_list}, e -> {on_edge}))"


def inside(edge_list: str, x: str, y: str) -> Column:
    return F.expr(inside_sql(edge_list, x, y))


def contains(shape: str, x: str, y: str) -> Column:
    """Whether the shape in one column holds the point in two others."""
    return F.expr(inside_sql(edges_sql(shape), x, y))
