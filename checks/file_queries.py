"""Queries that write files from the given tables and read them back, and the parts of the fare model that SQL can state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import inputs
from checks.domain import table, view
from checks.registry import query
from tripmart import sinks
from tripmart.functions import geometry as G
from tripmart.operators import quality
from tripmart.paths import Lake
from tripmart.plans import boroughs, model
from tripmart.session import new_path
from tripmart.sources import readers

DAY = dt.date(2024, 1, 1)


# Drops ----------------------------------------------------------------------------------------------------------

# The layout of a details drop, every column of it.
_DETAIL_COLUMNS = """cast(trip_id as varchar(20)) as trip_id, cast(driver_id as varchar(20)) as driver_id,
    cast(customer_id as varchar(20)) as customer_id, pickup_location, dropoff_location, tip_amount, payment_method, trip_status,
    customer_rating, driver_rating, trip_intention"""


def _dropped(spark, sf) -> Lake:
    """Details as CSV drops of three days, dealt by trip id."""
    lake = Lake(new_path(spark, "lake"), runtype="dev")
    rows = spark.sql(f"select {_DETAIL_COLUMNS.replace('varchar(20)', 'string')}, trip_id % 3 as part from {{d}}", d=view(spark, sf, "trip_details"))
    for part in range(3):
        day = DAY + dt.timedelta(days=part)
        rows.where(F.col("part") == part).drop("part").write.option("header", True).csv(lake.drop("trip_details", "delta", day))
    return lake


@query("S1 S5 S8 K10", f"""
    select {_DETAIL_COLUMNS}, date'2024-01-01' + cast(trip_id % 3 as int) as drop_date from {{trip_details}}""")
def full_load_of_drops(spark, sf):
    return readers.read_drop(spark, _dropped(spark, sf), "trip_details", "full")


@query("S1 S5 S8 K10", f"""
    select {_DETAIL_COLUMNS}, date'2024-01-02' as drop_date from {{trip_details}} where trip_id % 3 = 1""")
def one_day_of_drops(spark, sf):
    return readers.read_drop(spark, _dropped(spark, sf), "trip_details", "delta", "2024-01-02")


@query("S1", "select c_custkey as id, c_name as label, c_acctbal as balance from customer")
def csv_by_position(spark, sf):
    """A schema names the columns, whatever the header calls them."""
    path = new_path(spark, "csv")
    table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_acctbal").write.option("header", True).csv(path)
    from pyspark.sql.types import StructType

    return readers.read_csv(spark, path, StructType.fromDDL("id BIGINT, label STRING, balance DOUBLE"))


# Published tables -----------------------------------------------------------------------------------------------


@query("K1", "select c_custkey, c_name from customer union all select s_suppkey, s_name from supplier")
def written_then_appended(spark, sf):
    path = new_path(spark, "written")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    sinks.write_table(customers.where("c_custkey % 2 = 0"), path, "full")
    sinks.write_table(customers, path, "full")
    sinks.write_table(table(spark, sf, "supplier").selectExpr("s_suppkey as c_custkey", "s_name as c_name"), path, "delta")
    return readers.read_columns(spark, path)


@query("K2 S6", """
    select 'trips' as name, count(*) as n, max(trip_id) as last_id from {trips}
    union all select 'fares', count(*), max(trip_id) from {fares} where trip_id % 2 = 0""")
def published_sources(spark, sf):
    """A mart's inputs, published and found again; the second publish reads the table it replaces."""
    lake = Lake(new_path(spark, "lake"))
    fares = sinks.publish(inputs.fare_table(spark, sf), lake, "fares", "enrich", "full", DAY)
    sinks.publish(fares.where("trip_id % 2 = 0"), lake, "fares", "enrich", "full", DAY + dt.timedelta(days=1))
    sinks.publish(view(spark, sf, "trips"), lake, "trips", "raw", "full", DAY)
    found = readers.load_mart_sources(spark, lake, "time_series")
    count = lambda name: found[name].agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.max("trip_id").alias("last_id"))
    return count("trips").unionByName(count("fares"))


@query("Q3", """
    select 'trips' as table_name, n as expected_count, n as actual_count, 'Pass' as result from (select count(*) as n from {trips}) a
    union all select 'trips', n, n - 1, 'Fail' from (select count(*) as n from {trips}) b""")
def recorded_balance(spark, sf):
    """Results are appended, a failed check raises after it is recorded."""
    path, trips = new_path(spark, "balance"), view(spark, sf, "trips").select("trip_id")
    at = dt.datetime(2024, 1, 1)
    less = trips.where(F.col("trip_id") != trips.select(F.max("trip_id")).scalar())
    for target in (trips, less):
        try:
            quality.record_balance(quality.balance_suite(spark, {"trips_file": trips, "trips": target}, at, ["trips"]), path)
        except quality.BalanceError:
            if target is trips:
                raise
    return spark.read.parquet(path).select("table_name", "expected_count", "actual_count", "result")


@query("S11", """
    select count(*) as rows, count(passenger_count) as known, max(trip_id) as last_id from {trips}""")
def load_profile(spark, sf):
    """Counters that ride along with a load, next to nothing of its own."""
    watched, counters = quality.observed(
        view(spark, sf, "trips"), "load", known=F.count("passenger_count"), last_id=F.max("trip_id"))
    watched.write.parquet(new_path(spark, "observed"))
    return table(spark, sf, "region").where("r_regionkey = 0").select(*[F.lit(counters.get[n]).cast("bigint").alias(n) for n in ("rows", "known", "last_id")])


# Boundaries -----------------------------------------------------------------------------------------------------

# A box per nation; some turned the wrong way, some left open, some with a hole in the middle.
_X0, _Y0 = "cast(n_nationkey % 5 as double)", "cast(floor(n_nationkey / cast(5 as double)) as double)"


def _boundary_files(spark, sf) -> str:
    """A feature collection of each nation, one JSON document a file."""
    def point(x: float, y: float):
        return F.array(F.expr(_X0) + F.lit(x), F.expr(_Y0) + F.lit(y))

    ring = lambda *points: F.array(*[point(x, y) for x, y in points])
    right = ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    wrong = ring((0, 0), (0, 1), (1, 1), (1, 0), (0, 0))
    unclosed = ring((0, 0), (1, 0), (1, 1), (0, 1))
    hole = ring((0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25))
    k = F.col("n_nationkey") % 4
    rings = F.when(k == 0, F.array(right)).when(k == 1, F.array(wrong)).when(k == 2, F.array(unclosed)).otherwise(F.array(right, hole))
    single = F.col("n_nationkey") % 2 == 0
    geometry = lambda kind, shape: F.struct(F.lit(kind).alias("type"), shape.alias("coordinates"))
    feature = lambda shape: F.struct(
        F.lit("Feature").alias("type"), F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("int").alias("cartodb_id")).alias("properties"),
        shape.alias("geometry"))
    text = lambda shape: F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature(shape)).alias("features")))
    path = new_path(spark, "boundaries")
    table(spark, sf, "nation").select(
        "n_nationkey", F.when(single, text(geometry("Polygon", rings))).otherwise(text(geometry("MultiPolygon", F.array(rings)))).alias("value"),
    ).write.partitionBy("n_nationkey").text(path)
    return f"{path}/*"


_NATION_SHAPES = f"""
    select n_name as borough, case when n_nationkey % 4 = 3 then 2 else 1 end as rings, cast(5 as int) as points,
           cast(1.0 as double) as outer_area, case when n_nationkey % 4 = 3 then cast(-0.25 as double) end as hole_area,
           {_X0} as west, 'MultiPolygon' as kind from nation"""


def _described(loaded):
    again = G.parse_geometry(F.col("geometry_json"))
    rings = lambda: again[0]
    return loaded.select(
        "borough", F.size(rings()).alias("rings"), F.size(rings()[0]).alias("points"), G.signed_area(rings()[0]).alias("outer_area"),
        F.when(F.size(rings()) > 1, G.signed_area(F.get(rings(), F.lit(1)))).alias("hole_area"),
        F.array_min(F.transform(rings()[0], lambda p: p[0])).alias("west"), F.get_json_object("geometry_json", "$.type").alias("kind"))


@query("S4 X16 X17 X18 F2 B7", _NATION_SHAPES)
def loaded_boundaries(spark, sf):
    """Boundaries read from files: rings closed, outer ones counter-clockwise, holes clockwise, as shape and as text."""
    return _described(boroughs.load_boundaries(readers.read_geojson(spark, _boundary_files(spark, sf))))


@query("S4 X16 X17 X18 B7", _NATION_SHAPES)
def boundaries_of_one_file(spark, sf):
    """All nations in one file, which is split between its features."""
    parts = spark.read.text(_boundary_files(spark, sf)).select(F.get_json_object("value", "$.features[0]").alias("f"))
    # Twenty-five features.
    one = parts.agg(F.concat(F.lit('{"type":"FeatureCollection", "features": ['), F.array_join(F.collect_list("f"), ",\n "), F.lit("]}")).alias("value"))
    path = new_path(spark, "collection")
    one.coalesce(1).write.text(path)
    return _described(boroughs.shapes_of(readers.read_features(spark, path)))


@query("S4 X16 X17 J5 B7 B8", f"""
    select trip_id, n_name as borough from {{trips}} left join (select *, {_X0} as x, {_Y0} as y from nation) n
    on pickup_longitude > x and pickup_longitude < x + 1 and pickup_latitude > y and pickup_latitude < y + 1
       and not (n_nationkey % 4 = 3 and pickup_longitude - x between 0.25 and 0.75 and pickup_latitude - y between 0.25 and 0.75)""")
def located_in_loaded_boundaries(spark, sf):
    from tripmart.operators.spatial import locate

    shapes = boroughs.load_boundaries(readers.read_geojson(spark, _boundary_files(spark, sf)))
    points = view(spark, sf, "trips").select("trip_id", "pickup_longitude", "pickup_latitude")
    grid = boroughs.borough_cells(shapes.select("borough", "shape"))
    return locate(points, grid, "borough", "pickup_longitude", "pickup_latitude", "borough", "trip_id").select("trip_id", "borough")


# Model ----------------------------------------------------------------------------------------------------------


def _rows(spark, sf):
    return model.training_rows(inputs.enriched(spark, sf).select(
        "trip_id", *model.NUMERIC, F.concat(F.lit("b"), (F.col("trip_id") % 7 % 5).cast("string")).alias("borough"), "fare_amount"))


_ROWS = """select trip_id, concat('b', cast(trip_id % 7 % 5 as varchar)) as borough, passenger_count, pickup_hour, pickup_day, avg_temp,
    precipitation, distance_km from {enriched} where passenger_count is not null and avg_temp is not null and precipitation is not null
    and distance_km is not null"""


@query("M1", f"""
    select borough, cast(row_number() over (order by count(*) desc, borough) - 1 as double) as place, count(*) as n
    from ({_ROWS}) a group by borough""")
def borough_index(spark, sf):
    """Labels by frequency, ties by label."""
    rows = _rows(spark, sf)
    return model.indexer().fit(rows).transform(rows).groupBy("borough").agg(
        F.max(model.BOROUGH_INDEX).alias("place"), F.count("*").alias("n"))


@query("M2", f"""
    select trip_id, cast(passenger_count as double) as f0, cast(pickup_hour as double) as f1, cast(pickup_day as double) as f2,
           avg_temp as f3, precipitation as f4, distance_km as f5, place as f6
    from ({_ROWS}) a join (select borough, cast(row_number() over (order by count(*) desc, borough) - 1 as double) as place
                           from ({_ROWS}) b group by borough) using (borough)""")
def feature_vectors(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = _rows(spark, sf)
    vectors = model.assembler().transform(model.indexer().fit(rows).transform(rows))
    values = vector_to_array("features")
    return vectors.select("trip_id", *[values[i].alias(f"f{i}") for i in range(7)])


@query("M3", """
    select trip_id, cast(k as double) as small, cast(dense_rank() over (order by k) - 1 as double) as small_index, large, large as large_index
    from (select trip_id, (trip_id % 4) * 10 - 15 as k, cast(trip_id % 11 as double) as large from {trips}) a""")
def small_categories(spark, sf):
    """A feature of at most four values is indexed in their order, one of more stays as it is."""
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.functions import vector_to_array

    rows = view(spark, sf, "trips").selectExpr("trip_id", "cast((trip_id % 4) * 10 - 15 as double) as small", "cast(trip_id % 11 as double) as large")
    vectors = VectorAssembler(inputCols=["small", "large"], outputCol="features").transform(rows)
    indexed = VectorIndexer(
        inputCol="features", outputCol="indexed", maxCategories=model.MAX_CATEGORIES, handleInvalid="keep").fit(vectors).transform(vectors)
    values = vector_to_array("indexed")
    return indexed.select("trip_id", "small", values[0].alias("small_index"), "large", values[1].alias("large_index"))


@query("M5 M6 M9", """
    select true as same_after_reload, true as better_than_mean, true as tuned_in_grid from region where r_regionkey = 0""")
def fitted_forest(spark, sf):
    """A forest on a label that follows from the features: saved, loaded and tuned."""
    rows = _rows(spark, sf).withColumn("fare_amount", 2.5 + F.col("pickup_hour") * 0.5 + F.col("passenger_count"))
    train, test = model.split(rows, "trip_id")
    fitted = model.fare_pipeline("keep", trees=5).fit(train)
    path = new_path(spark, "model")
    model.save(fitted, path)
    first, again = fitted.transform(test), model.score(path, test)
    both = first.select("trip_id", F.col(model.PREDICTION).alias("a")).join(again.select("trip_id", F.col(model.PREDICTION).alias("b")), "trip_id")
    spread = test.agg(F.stddev("fare_amount")).first()[0]
    tuned = model.tune(train, trees=(2, 3), depths=(2, 4), folds=2).bestModel.stages[-1]
    return table(spark, sf, "region").where("r_regionkey = 0").select(
        F.lit(both.where("a <> b").isEmpty()).alias("same_after_reload"),
        F.lit(model.scores(first).first()["rmse"] < 0.5 * spread).alias("better_than_mean"),
        F.lit(tuned.getNumTrees in (2, 3) and tuned.getMaxDepth() in (2, 4)).alias("tuned_in_grid"))
