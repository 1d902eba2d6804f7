"""Tables stored for cheap joins, pages, refreshes and lookups: what is read and moved, and that results are whole."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from checks import QUERIES, inputs
from checks.domain import view
from tripmart.operators import key_filter, keyed_store, nearest, paging, states
from tripmart.plans import boroughs, customers, fares, time_series
from tripmart.sinks import publish_days
from tripmart.sources import bucketed, readers

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# Buckets ----------------------------------------------------------------------------------------------------------


def test_joins_of_buckets_move_nothing(spark, tmp_path, no_broadcast):
    located, details = inputs.located(spark, SF), view(spark, SF, "trip_details")
    want = sorted(map(str, fares.fares(located, details).collect()))
    a = bucketed.write_bucketed(located, str(tmp_path / "l"), "located_b", "trip_id", 4)
    b = bucketed.write_bucketed(details, str(tmp_path / "d"), "details_b", "trip_id", 4)
    made = fares.fares(a, b)
    assert "Exchange" not in plan(made)
    assert sorted(map(str, made.collect())) == want
    f = bucketed.write_bucketed(made, str(tmp_path / "f"), "fares_b", "trip_id", 4)
    shuffles = [line for line in plan(customers.customer_statistics(customers.rides(f, b), {
        "payment_method": [], **{c: [] for c in customers.CATEGORIES}})).splitlines() if "Exchange" in line]
    assert shuffles and all("hashpartitioning(customer_id" in line for line in shuffles)
    # Another session knows the table by its folder.
    schema = a.schema
    spark.sql("DROP TABLE located_b")
    again = bucketed.open_bucketed(spark, str(tmp_path / "l"), "located_b", "trip_id", 4, schema)
    assert "Exchange" not in plan(fares.fares(again, b)) and again.count() == located.count()
    for name in ("located_b", "details_b", "fares_b"):
        spark.sql(f"DROP TABLE {name}")


def test_number_of_buckets_grows():
    assert [bucketed.buckets_for_bytes(n << 30) for n in (0, 1, 3, 100_000)] == [1, 2, 8, 262_144]


# Pages ------------------------------------------------------------------------------------------------------------


def test_a_middle_page_reads_one_or_two_ranges(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), "id", F.when(F.col("id") % 9 > 0, F.col("id") % 5).alias("w"))
    index = paging.rank_index(rows, ["w", "v"], str(tmp_path / "ranks"), ranges=10)
    assert index.rows == 1000 and index.before[0] == 0 and len(index.before) == 10
    everything = [tuple(r) for r in rows.orderBy("w", "v").collect()]
    for number, size in ((0, 30), (7, 30), (16, 30), (33, 30), (34, 30), (1, 999), (0, 5000)):
        page = paging.indexed_page(spark, index, number, size)
        assert [tuple(r) for r in page.collect()] == everything[number * size:(number + 1) * size]
    assert len(paging.ranges_of_page(index, 16, 30)) <= 2 and paging.ranges_of_page(index, 50, 30) == []
    assert "PartitionFilters: [_range" in plan(paging.indexed_page(spark, index, 16, 30))
    assert paging.open_index(spark, index.path, ["w", "v"]) == index
    with pytest.raises(ValueError):
        paging.indexed_page(spark, index, -1, 10)


# Filters of keys --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_part", [1, 100_000])
def test_filters_never_lose_a_key(spark, tmp_path, rows_per_part, monkeypatch):
    monkeypatch.setattr(key_filter, "BITMAP", 64 if rows_per_part == 1 else key_filter.BITMAP)
    known = spark.range(0, 2000, 2).toDF("k")
    store = keyed_store.create_store(known, str(tmp_path / "s"), ["k"], 4)
    filt = key_filter.create_filter(spark, store, known.where("k < 1000"), str(tmp_path / "f"), rows_per_part)
    key_filter.add_keys(filt, known.where("k >= 1000"), 1)
    key_filter.add_keys(filt, known.where("k >= 1000"), 1)  # a repeated load
    batch = spark.range(1500, 3000).select(F.col("id").alias("k"), F.lit("x").alias("v")).unionByName(
        spark.createDataFrame([(None, "null")], "k long, v string"))
    maybe = {r.k for r in key_filter.maybe_stored(spark, filt, batch).collect()}
    assert set(range(1500, 2000, 2)) <= maybe
    # Sixty-four bits for some hundred keys let nearly all keys through: the table still decides.
    assert len(maybe) > 1000 if rows_per_part == 1 else len(maybe) < 400
    fresh = key_filter.new_rows_by_filter(spark, batch, store, filt)
    assert sorted((r.k or -1) for r in fresh.collect()) == sorted([-1, *range(1501, 2000, 2), *range(2000, 3000)])


def test_new_keys_read_no_partition(spark, tmp_path):
    known = spark.range(500).toDF("k")
    store = keyed_store.create_store(known, str(tmp_path / "s"), ["k"], 8)
    filt = key_filter.create_filter(spark, store, known, str(tmp_path / "f"), 10_000)
    batch = spark.range(10_000, 10_020).toDF("k")
    assert key_filter.maybe_stored(spark, filt, batch).count() == 0
    assert key_filter.new_rows_by_filter(spark, batch, store, filt).count() == 20
    assert key_filter.new_rows_by_filter(spark, batch.limit(0), store, filt).count() == 0


# Days -------------------------------------------------------------------------------------------------------------


def test_restated_days_replace_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "days")
    day = lambda k: dt.date(2024, 1, k)
    rows = spark.createDataFrame([(k, day(k % 5 + 1), "a") for k in range(50)], "k int, date date, v string")
    publish_days(rows, path, files_per_day=2)
    before = {p for p in (tmp_path / "days").rglob("*.parquet")}
    publish_days(spark.createDataFrame([(100, day(2), "b"), (101, day(9), "b")], "k int, date date, v string"), path)
    after = {p for p in (tmp_path / "days").rglob("*.parquet")}
    assert {p.parent.name for p in before - after} == {"date=2024-01-02"} and {p.parent.name for p in after - before} == {"date=2024-01-02", "date=2024-01-09"}
    some = readers.read_days(spark, path, day(2), day(3))
    assert "PartitionFilters: [isnotnull(date" in plan(some)
    assert sorted((r.k, r.v) for r in some.collect()) == [(k, "a") for k in range(50) if k % 5 == 2] + [(100, "b")]


def test_the_weather_prunes_days_while_it_runs(spark):
    assert "dynamicpruningexpression" in plan(QUERIES["trips_of_rainy_days"].run(spark, SF))


# Features ---------------------------------------------------------------------------------------------------------


def collection(names, first="type"):
    square = lambda k: [[[k, 0], [k + 1, 0], [k + 1, 1], [k, 1], [k, 0]]]
    head = {"type": "FeatureCollection", "crs": {"type": "name"}}
    features = []
    for k, n in enumerate(names):
        f = {"type": "Feature", "properties": {"name": n, "cartodb_id": k}, "geometry": {"type": "Polygon", "coordinates": square(k)}}
        features.append(f if first == "type" else {"properties": f["properties"], "type": "Feature", "geometry": f["geometry"]})
    return head | {"features": features, "total": len(names)}


@pytest.mark.parametrize("indent", [None, 2])
def test_one_file_is_split_between_its_features(spark, tmp_path, indent):
    names = [f"é {k} {'x' * 200}" for k in range(400)]
    (tmp_path / "a.geojson").write_text(json.dumps(collection(names), indent=indent))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        features = readers.read_features(spark, str(tmp_path / "a.geojson"))
        assert features.rdd.getNumPartitions() > 4
        got = boroughs.shapes_of(features)
        whole = boroughs.load_boundaries(readers.read_geojson(spark, str(tmp_path / "a.geojson")))
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
        assert got.count() == 400 and got.where("shape is null").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_features_that_cannot_be_told_apart_end_the_load(spark, tmp_path):
    (tmp_path / "late.geojson").write_text(json.dumps(collection(["a", "b", "c"], first="properties")))
    (tmp_path / "word.geojson").write_text(json.dumps(collection(["a", "Feature", "c"])))
    (tmp_path / "none.geojson").write_text(json.dumps(collection([])))
    for name in ("late", "word"):
        with pytest.raises(Exception, match="begin with its type"):
            readers.read_features(spark, str(tmp_path / f"{name}.geojson")).collect()
    assert readers.read_features(spark, str(tmp_path / "none.geojson")).count() == 0


# Nearest places ---------------------------------------------------------------------------------------------------


def brute_nearest(points, places):
    globe = lambda la, lo: (math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la))
    spots = [(n, globe(math.radians(a), math.radians(o))) for n, a, o in places]
    out = {}
    for k, a, o in points:
        at = globe(math.radians(a), math.radians(o))
        far = sorted((sum((p - q) ** 2 for p, q in zip(at, s)), n) for n, s in spots)
        out[k] = min(n for d, n in far if d <= far[0][0] * (1 + nearest.TIE))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_equals_brute_force(spark, seed):
    """Places in crowds, alone, at the poles, on the date line and on each other."""
    rng = random.Random(seed)
    places = [(f"p{k:03d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(40)]
    places += [(f"c{k:03d}", 40.7 + rng.uniform(-.01, .01), -74 + rng.uniform(-.01, .01)) for k in range(60)]
    places += [("north", 90.0, 0.0), ("south", -90.0, 10.0), ("line", 5.0, 179.999), ("line 2", 5.0, -179.999), ("same b", 1.0, 1.0), ("same a", 1.0, 1.0)]
    points = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(150)]
    points += [(200 + k, 40.7 + rng.uniform(-.02, .02), -74 + rng.uniform(-.02, .02)) for k in range(100)]
    points += [(400, 5.0, 180.0), (401, 5.0, -180.0), (402, 89.9, 77.0), (403, -90.0, 0.0), (404, 1.0, 1.0), (405, 0.0, 0.0)]
    bad = [(500, None, 1.0), (501, 1.0, None), (502, float("nan"), 0.0), (503, 0.0, float("inf")), (504, 95.0, 0.0)]
    p = spark.createDataFrame(points + bad, "k long, lat double, lon double")
    c = spark.createDataFrame(places + [(None, 0.0, 0.0), ("nowhere", None, 0.0)], "name string, lat double, lon double")
    found = nearest.nearest_of(p, "k", "lat", "lon", c)
    assert {r.k: r.nearest for r in found.collect()} == brute_nearest(points, places)
    assert not any(word in plan(found) for word in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    assert nearest.nearest_of(p, "k", "lat", "lon", c.limit(0)).count() == 0
    assert nearest.nearest_of(p.limit(0), "k", "lat", "lon", c).count() == 0


# States -----------------------------------------------------------------------------------------------------------


def test_states_add_up(spark, tmp_path):
    path = str(tmp_path / "state")
    put = lambda batch, rows, schema="k string, n long, s double": states.add_batch(spark.createDataFrame(rows, schema), path, batch)
    total = lambda **more: {r.k: (r.n, r.s) for r in states.merged_state(spark, path, ["k"], **more).collect()}
    with pytest.raises(ValueError):
        total()
    put(0, [("a", 1, 0.5), ("b", 2, None)])
    put(1, [("a", 10, 1.0), ("c", 1, 2.0), (None, 1, 1.0)])
    assert total() == {"a": (11, 1.5), "b": (2, None), "c": (1, 2.0), None: (1, 1.0)}
    assert total(upto=0) == {"a": (1, 0.5), "b": (2, None)}
    assert states.compact(spark, path, ["k"]) == 1 and states.compact(spark, path, ["k"]) == 1
    put(2, [("a", 100, 1.0)])
    put(2, [("a", 200, 1.0)])  # a repeated load replaces its batch
    assert total()["a"] == (211, 2.5) and total()["c"] == (1, 2.0)
    put(3, [("a", 1, 7)], "k string, n long, cnt_new long")
    got = {r.k: r.asDict() for r in states.merged_state(spark, path, ["k"]).collect()}
    assert got["a"] == {"k": "a", "n": 212, "s": 2.5, "cnt_new": 7} and got["b"]["cnt_new"] is None
    assert states.compact(spark, path, ["k"]) == 3
    assert {r.k: r.asDict() for r in states.merged_state(spark, path, ["k"]).collect()} == got


def test_refreshes_read_no_old_fares(spark, tmp_path):
    fare = inputs.stored_fares(spark, SF)
    old, new = fare.where("date < '1998-01-01'"), fare.where("date >= '1998-01-01'")
    cube, rides = str(tmp_path / "cube"), str(tmp_path / "rides")
    details = view(spark, SF, "trip_details")
    for batch, rows in enumerate((old, new)):
        time_series.add_fares(rows, cube, batch)
        customers.add_rides(rows, details, rides, batch)
    series = time_series.stored_series(spark, cube)
    profile = customers.stored_profile(spark, view(spark, SF, "customers"), rides)
    assert all("/cube/" in f for f in series.inputFiles())
    assert all("/rides/" in f or "customer.parquet" in f for f in profile.inputFiles())
    assert sorted(map(str, series.collect())) == sorted(map(str, time_series.time_series(fare).collect()))


def test_rides_meet_once_for_all_loads(spark, monkeypatch):
    from checks import mart_queries

    met, join = [], customers.rides
    monkeypatch.setattr(customers, "rides", lambda *a: met.append(a) or join(*a))
    assert mart_queries.profile_after_delta(spark, "/root/testdata/sf0.001").count() > 0
    assert len(met) == 1


def test_rows_to_fit_on_are_stored(spark):
    from checks import other_queries

    rows = other_queries._training(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Scan parquet" in plan
