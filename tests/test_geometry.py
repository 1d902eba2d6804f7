import json
import random

import pytest
from pyspark.sql import functions as F

from tripmart.functions import geometry as G
from tripmart.functions.us_states import STATE_CENTRES
from tripmart.operators import spatial
from tripmart.plans import boroughs
from tripmart.sources.readers import read_geojson

SQUARE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
HOLED = [SQUARE[0], [[1, 1], [1, 3], [3, 3], [3, 1], [1, 1]]]
CONCAVE = [[[0, 0], [4, 0], [4, 4], [2, 1], [0, 4], [0, 0]]]
DIAMOND = [[[6, 0], [8, 2], [6, 4], [4, 2], [6, 0]]]


def _floats(shape):
    return [[[[float(v) for v in p] for p in ring] for ring in polygon] for polygon in shape]


def _plain_inside(shape, x, y):
    """Even-odd loop, the boundary being outside."""
    odd = False
    for polygon in shape:
        for ring in polygon:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
                if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    return False
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
    return odd


def _shapes(spark, **shapes):
    return spark.createDataFrame([(n, _floats(s)) for n, s in shapes.items()], f"borough string, shape {G.MULTIPOLYGON}")


@pytest.mark.parametrize("shape", [[SQUARE], [HOLED], [CONCAVE], [DIAMOND], [SQUARE, DIAMOND]])
def test_contains_matches_a_plain_loop(spark, shape):
    points = [(x / 2, y / 2) for x in range(-2, 18) for y in range(-2, 10)]
    df = spark.createDataFrame([(x, y, _floats(shape)) for x, y in points], f"x double, y double, shape {G.MULTIPOLYGON}")
    got = [r[0] for r in df.select(G.contains("shape", "x", "y")).collect()]
    assert got == [_plain_inside(shape, x, y) for x, y in points]


def test_locate_matches_plain_loop_and_keeps_overlaps(spark):
    shapes = {"square": [SQUARE], "holed": [HOLED], "mixed": [CONCAVE, DIAMOND]}
    cells = spatial.stored_cells(_shapes(spark, **shapes), "borough", size=0.7)
    rng = random.Random(1)
    points = [(i, rng.uniform(-1, 9), rng.uniform(-1, 5)) for i in range(400)]
    points += [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate((x, y) for x in range(9) for y in range(5))]
    points += [(2000, None, 1.0), (2001, 1.0, None), (2002, float("nan"), 1.0)]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    got = sorted((r["id"], r["where"]) for r in spatial.locate(
        df, cells, "borough", "lon", "lat", "where", "id").collect() if r["where"])
    want = sorted((i, n) for i, x, y in points[:-3] for n, s in shapes.items() if _plain_inside(s, x, y))
    assert got == want
    everyone = spatial.locate(df, cells, "borough", "lon", "lat", "where", "id")
    assert everyone.select("id").distinct().count() == len(points)


def test_locate_without_broadcast_gives_the_same_rows(spark):
    shapes = _shapes(spark, square=[SQUARE], mixed=[CONCAVE, DIAMOND])
    cells = spatial.stored_cells(shapes, "borough")
    df = spark.range(2000).selectExpr("id", "(id * 7919 % 900) / 100D as lon", "(id * 104729 % 500) / 100D as lat")
    run = lambda: sorted(map(tuple, spatial.locate(df, cells, "borough", "lon", "lat", "where", "id").collect()), key=str)
    sent = run()
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        assert run() == sent
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_solid_cells_hold_no_edges(spark):
    cells = spatial.shape_cells(_shapes(spark, square=[SQUARE]), "borough", 0.5).collect()
    assert all(len(c["edges"]) == 0 for c in cells if c["solid"]) and any(c["solid"] for c in cells)
    assert all(len(c["edges"]) > 0 for c in cells if not c["solid"])


def test_repair_closes_and_turns_rings(spark):
    clockwise_open = [[0, 0], [0, 4], [4, 4], [4, 0]]
    hole_ccw = [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]
    df = spark.createDataFrame([(_floats([[clockwise_open, hole_ccw]]),)], f"shape {G.MULTIPOLYGON}")
    fixed = df.select(G.repair(F.col("shape")).alias("s"))
    outer, hole = fixed.first()["s"][0]
    assert outer[0] == outer[-1] and len(outer) == 5
    areas = fixed.select(G.signed_area(F.col("s")[0][0]), G.signed_area(F.col("s")[0][1])).first()
    assert areas[0] == 16.0 and areas[1] == -4.0
    again = fixed.select(G.repair(F.col("s")).alias("s")).first()["s"]
    assert again == fixed.first()["s"]


def test_geometry_text(spark):
    texts = [
        json.dumps({"type": "Polygon", "coordinates": SQUARE}),
        json.dumps({"type": "MultiPolygon", "coordinates": [SQUARE, DIAMOND]}),
        json.dumps({"type": "Point", "coordinates": [1, 2]}), None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(G.parse_geometry(F.col("t"))).collect()]
    assert got == [_floats([SQUARE]), _floats([SQUARE, DIAMOND]), None, None]


def test_load_boundaries_from_geojson(spark, tmp_path):
    feature = lambda name, kind, coordinates: {
        "type": "Feature", "properties": {"name": name, "cartodb_id": 1, "created_at": "x", "updated_at": "y"},
        "geometry": {"type": kind, "coordinates": coordinates}}
    file = {"type": "FeatureCollection", "features": [
        feature("A", "Polygon", [SQUARE[0][::-1]]), feature("B", "MultiPolygon", [DIAMOND])]}
    (tmp_path / "all.geojson").write_text(json.dumps(file, indent=1))
    loaded = boroughs.load_boundaries(read_geojson(spark, str(tmp_path)))
    found = {r["borough"]: r for r in loaded.collect()}
    assert found["A"]["shape"] == _floats([SQUARE])
    assert json.loads(found["B"]["geometry_json"])["coordinates"] == _floats([DIAMOND])
    trips = spark.createDataFrame([(1, 2.0, 2.0, 6.0, 2.0)], "trip_id int, pickup_longitude double, "
                                  "pickup_latitude double, dropoff_longitude double, dropoff_latitude double")
    got = boroughs.with_boroughs(trips, boroughs.borough_cells(loaded)).first()
    assert (got["pickup_borough"], got["dropoff_borough"]) == ("A", "B")


def test_nearest_state(spark):
    df = spark.createDataFrame([(1, 40.7, -74.0), (2, 61.0, -150.0), (3, None, -74.0), (4, 36.778261, -119.417932)],
                               "id int, lat double, lon double")
    got = {r["id"]: r["state"] for r in spatial.with_nearest(df, "lat", "lon", "state", STATE_CENTRES).collect()}
    assert got == {1: "New Jersey", 2: "Alaska", 3: None, 4: "California"}


def test_nearest_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([(0.0, 0.5)], "lat double, lon double")
    assert spatial.with_nearest(df, "lat", "lon", "n", [("b", 0, 1), ("a", 0, 0)]).first()["n"] == "a"


def test_borough_fallback_cases(spark):
    located = spark.createDataFrame(
        [(1, "P", "D"), (2, None, "D"), (3, "P", None), (4, None, None), (5, None, "D"), (6, "P", None), (7, "P", "D")],
        "trip_id int, pickup_borough string, dropoff_borough string")
    details = spark.createDataFrame(
        [(1, "x", "y"), (2, "x", "y"), (3, "x", "y"), (4, "x", None)],
        "trip_id int, pickup_location string, dropoff_location string")
    got = sorted(tuple(r) for r in boroughs.fill_boroughs(located, details).collect())
    assert got == [
        (1, "P", "D", "features", "features"), (2, "x", "D", "tripdetails", "features"),
        (3, "P", "y", "features", "tripdetails"), (4, "x", None, "tripdetails", "tripdetails"),
        (7, "P", "D", "features", "features")]
