import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.domain import view
from tripmart.operators.keys import new_rows
from tripmart.plans import clean, customers, fares, generate, model, refresh, time_series, weather
from tripmart.paths import Lake

SF = "/root/testdata/sf0.001"
RAW = ("trip_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pickup_longitude double, "
       "pickup_latitude double, dropoff_longitude double, dropoff_latitude double, passenger_count int, fare_amount double")
NOON = dt.datetime(2015, 1, 2, 12)


def _raw(spark, *changes):
    base = dict(trip_id="a", pickup_datetime=NOON, dropoff_datetime=NOON, pickup_longitude=1.0, pickup_latitude=1.0,
                dropoff_longitude=1.0, dropoff_latitude=1.0, passenger_count=2, fare_amount=5.0)
    rows = [tuple((base | c).values()) for c in changes]
    return spark.createDataFrame(rows, RAW)


def test_clean_trips_edges(spark):
    raw = _raw(
        spark, *[{"trip_id": f"n{c}", c: None} for c in clean.COORDINATES],
        {"trip_id": "low", "fare_amount": 2.5}, {"trip_id": "ok", "fare_amount": 2.51},
        {"trip_id": "lone", "passenger_count": None}, {"trip_id": "undated", "pickup_datetime": None},
        {"trip_id": "twice", "fare_amount": 9.0}, {"trip_id": "twice", "fare_amount": 8.0})
    got = {r["trip_id"]: r for r in clean.clean_trips(raw).collect()}
    assert set(got) == {"ok", "lone", "twice"}
    assert got["lone"]["passenger_count"] == 1 and got["twice"]["fare_amount"] == 8.0
    assert (got["ok"]["date"], got["ok"]["pickup_hour"], got["ok"]["pickup_day"], got["ok"]["pickup_month"]) == (
        dt.date(2015, 1, 2), 12, 6, 1)


def test_first_copy_may_lose_to_the_fare_filter(spark):
    raw = _raw(spark, {"fare_amount": 1.0}, {"fare_amount": 8.0})
    assert clean.clean_trips(raw).count() == 0


def test_full_load_equals_delta_onto_nothing(spark):
    raw = view(spark, SF, "raw_trips")
    full = clean.clean_trips(raw)
    assert clean.clean_trips(raw, full.limit(0)).exceptAll(full).count() == 0
    assert clean.clean_trips(raw, full).count() == 0


def test_clean_dimension_rejects_unknown(spark):
    with pytest.raises(ValueError):
        clean.clean_dimension(spark.range(1), "rides")


FARE = ("trip_id int, fare_amount double, trip_duration_min double, is_weather_extreme boolean, pickup_borough string, "
        "dropoff_borough string, pickup_period string")


def test_weather_impact_edges(spark):
    rows = [
        (1, 10.0, 10.0, False, "A", "B", "Midday"), (2, 20.0, 5.0, True, "A", "B", "Midday"),
        (3, 5.0, 30.0, True, "A", "B", "Midday"), (4, 50.0, 5.0, True, "X", "B", "Midday"),
        (5, 50.0, 5.0, True, None, "B", "Midday"), (6, 0.0, 0.0, False, "Z", "Z", "Night"),
        (7, 9.0, 9.0, True, "Z", "Z", "Night")]
    fare = spark.createDataFrame(rows, FARE).withColumns({
        c: F.lit(None).cast("string") for c in (
            "date", "pickup_datetime", "dropoff_datetime", "rain_intensity", "snow_intensity", "wind_intensity",
            "temperature_intensity")})
    details = spark.createDataFrame(
        [(1, "Cancelled", 1.0), (2, "cancelled", 2.9), (3, "Completed", 3.0), (4, "Cancelled", None), (5, "x", 1.0),
         (6, "x", 1.0), (7, None, 1.0)], "trip_id int, trip_status string, driver_rating double")
    got = {r["trip_id"]: r for r in fares.weather_impact(fare, details).collect()}
    pick = lambda i: tuple(got[i][c] for c in (
        "fare_amount_diff", "tip_duration_diff", "fare_amount_pct_diff", "trip_duration_pct_diff",
        "low_rating_due_to_weather", "cancellation_due_to_weather"))
    assert pick(1) == (0.0, 0.0, 0.0, 0.0, False, False)
    assert pick(2) == (10.0, 0.0, 100.0, 0.0, True, True)
    assert pick(3) == (0.0, 20.0, 0.0, 200.0, False, False)
    assert pick(4) == (0.0, 0.0, 0.0, 0.0, False, True)
    assert pick(5) == (0.0, 0.0, 0.0, 0.0, True, False)
    assert pick(7) == (9.0, 9.0, 0.0, 0.0, True, False)


def test_hot_route_and_union_forms_of_time_series_agree(spark):
    fare = spark.range(3000).select(
        F.col("id").alias("trip_id"), F.date_add(F.lit(dt.date(2012, 12, 25)), (F.col("id") % 20).cast("int")).alias("date"),
        F.when(F.col("id") % 3 != 0, "Monday").otherwise("Sunday").alias("pickup_day"),
        F.when(F.col("id") % 5 != 0, "January").alias("pickup_month"),
        F.when(F.col("id") % 2 == 0, "Morning Rush").otherwise("Unknown").alias("pickup_period"),
        *[(F.col("id") % 97 / 3).alias(m) for m in time_series.MEASURES])
    trips = fare.select("trip_id", F.when(F.col("trip_id") % 7 != 0, (F.col("trip_id") % 24).cast("int")).alias("pickup_hour"))
    whole = time_series.time_series(fare, trips)
    rollup = time_series.calendar_rollup(time_series.hour_cube(fare, trips))
    parts = time_series.union_time_series(time_series.calendar_tables(rollup)).select(whole.columns)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0
    labels = {r["time_period"]: r["n"] for r in whole.groupBy("time_period").agg(F.count("*").alias("n")).collect()}
    assert labels["yearly"] == 2 and labels["peak"] == 2 and labels["non_peak"] == 2 and labels["hourly"] == 50
    assert whole.where("time_period = 'monthly' and pickup_month = 'Unknown'").count() == 2
    assert whole.where("time_period = 'weekly' and pickup_year = '2012'").select("pickup_week").distinct().count() == 2


def test_profile_columns_follow_the_values(spark):
    fare = spark.createDataFrame(
        [(1, 1.0, 2.0, 0.5, 3.5, 10.0, "May", "Monday", "Morning Rush", True),
         (2, 1.0, 2.0, 0.5, 3.5, 10.0, "May", "Monday", "Night", False)],
        "trip_id int, distance_km double, trip_duration_min double, tip_amount double, total_fareamount double, "
        "tip_pct double, pickup_month string, pickup_day string, pickup_period string, is_weather_extreme boolean")
    details = spark.createDataFrame(
        [(1, 7, "Credit Card", "No Show", "Event/Show (x)", 4.0), (2, 7, None, "Completed", "Errand", None)],
        "trip_id int, customer_id int, payment_method string, trip_status string, trip_intention string, customer_rating double")
    people = spark.createDataFrame([(7,), (8,)], "customer_id int").withColumns(
        {c: F.lit("x") for c in customers.ATTRIBUTES[1:5] + customers.ATTRIBUTES[7:]}
        | {c: F.lit(dt.date(1990, 1, 1)) for c in customers.ATTRIBUTES[5:7]})
    profile = customers.customer_profile(people, fare, details)
    row = profile.collect()
    assert len(row) == 1
    row = row[0].asDict()
    assert row["cnt_Credit_Card_payment"] == 1 and row["total_Credit_Card_amount"] == 3.5
    assert not any("None" in c for c in row)
    assert row["trip_intention_Event/Show__x__count"] == 1 and row["pickup_period_Morning_Rush_count"] == 1
    assert row["weather_extreme_true_count"] == 1 and row["total_fareamount"] == 7.0 and row["age"] == 26.0
    trips = spark.createDataFrame([(1, 2), (2, 3)], "trip_id int, passenger_count int")
    ends = fare.select("trip_id").withColumns({"pickup_borough": F.lit(None).cast("string"), "dropoff_borough": F.lit("Q")})
    likes = customers.customer_preference(profile, ends, details.withColumn("driver_rating", F.lit(2.0)), trips).first()
    assert likes["preferred_trip_intention"] == "Errand" and likes["preferred_pickup_borough"] is None
    assert likes["preferred_dropoff_borough"] == "Q" and likes["preferred_avg_passenger_count"] == 3.0


def test_refresh_inserts_updates_and_keeps(spark, tmp_path):
    lake = Lake(str(tmp_path))
    first = spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "customer_id int, n int, name string")
    refresh.refresh_people(spark, lake, "customer_profile", first, "2024-01-01")
    later = spark.createDataFrame([(2, 9, "B", 4), (3, 1, "c", 2)], "customer_id int, n int, name string, m int")
    got = refresh.refresh_people(spark, lake, "customer_profile", later, "2024-01-02")
    assert sorted(tuple(r) for r in got.select("customer_id", "n", "name", "m").collect()) == [
        (1, 5, "a", 0), (2, 9, "B", 4), (3, 1, "c", 2)]


def test_weather_refill_leaves_gaps_null(spark):
    day = lambda d: dt.date(2024, 1, d)
    table = lambda rows: spark.createDataFrame(rows, "date date, avg_temp double").withColumns(
        {m: F.lit(None).cast("int" if m == "weather_code" else "double") for m in weather.METRICS[1:]})
    trips = spark.createDataFrame([(i, day(i)) for i in range(1, 5)], "trip_id int, date date")
    got = weather.attach_weather(trips, table([(day(1), 1.0), (day(2), None)]), table([(day(1), 9.0), (day(2), 2.0), (day(3), 3.0)]))
    assert [(r["trip_id"], r["avg_temp"]) for r in got.orderBy("trip_id").collect()] == [(1, 1.0), (2, 2.0), (3, 3.0), (4, None)]


def test_trip_details_rules(spark):
    ids = spark.range(4000).withColumnRenamed("id", "trip_id")
    people = spark.createDataFrame([(i, "Active" if i % 2 else "Inactive") for i in range(50)], "customer_id long, membership_status string")
    drivers = spark.createDataFrame([(i, "On Leave") for i in range(9)], "driver_id long, status string")
    cars = generate.new_vehicles(drivers)
    places = {"JFK Airport": 5, "Grand Hotel": 3, "Main Street": 8}
    details = generate.trip_details(ids, people, drivers, cars, places).cache()
    assert details.count() == 4000 and details.select("trip_id").distinct().count() == 4000
    assert details.where("pickup_location = dropoff_location").count() == 0
    assert details.where("customer_id % 2 = 0").count() == 0 and details.select("driver_id").distinct().count() == 9
    flights = details.where("pickup_location = 'JFK Airport' or dropoff_location = 'JFK Airport'")
    share = flights.where("trip_intention = 'Airport Transfer'").count() / flights.count()
    assert share == pytest.approx(0.7 + 0.3 * 0.08, abs=0.04)
    starts = {r[0]: r[1] / 4000 for r in details.groupBy("pickup_location").count().collect()}
    assert starts == pytest.approx({"JFK Airport": 5 / 16, "Grand Hotel": 3 / 16, "Main Street": 0.5}, abs=0.03)
    fuels = cars.where("model like '%Tesla%'").select("fuel_type").distinct().collect()
    assert {r[0] for r in fuels} <= {"Electric"}
    details.unpersist()


def test_generated_trips_are_reproducible(spark):
    ids = spark.range(500).withColumnRenamed("id", "trip_id")
    sky = spark.createDataFrame([], "date date, precipitation double, avg_snow_fall double, avg_wind_speed double, avg_temp double")
    areas = [("a", 40.0, 40.1, -74.0, -73.9, 3), ("b", 41.0, 41.2, -73.0, -72.5, 1)]
    one = generate.generate_trips(ids, areas, sky)
    two = generate.generate_trips(ids.repartition(7), areas, sky)
    assert one.exceptAll(two).count() == 0 and one.count() == 500
    bounds = one.agg(F.min("fare_amount"), F.min("pickup_datetime"), F.max("pickup_datetime"), F.min("passenger_count")).first()
    assert bounds[0] >= 4.0 and bounds[1].year >= 2009 and bounds[2].year <= 2015 and bounds[3] == 1
    same = one.where("(pickup_latitude < 40.5) = (dropoff_latitude < 40.5)").count() / 500
    assert same == pytest.approx(0.7 + 0.3 * (9 + 1) / 16, abs=0.06)


def test_new_ids_follow_the_largest(spark):
    old = spark.createDataFrame([("3",), ("10",)], "driver_id string")
    rows = generate.with_new_ids(spark.range(20), old, "driver_id", ["id"])
    assert sorted(r["driver_id"] for r in rows.collect()) == list(range(11, 31))


@pytest.fixture(scope="module")
def training(spark):
    return spark.range(600).select(
        F.col("id").alias("trip_id"), (F.col("id") % 4 + 1).alias("passenger_count"), (F.col("id") % 24).alias("pickup_hour"),
        (F.col("id") % 7 + 1).alias("pickup_day"), (F.col("id") % 30).cast("double").alias("avg_temp"),
        (F.col("id") % 5).cast("double").alias("precipitation"), (F.col("id") * 37 % 101 / 4).alias("distance_km"),
        F.concat(F.lit("b"), (F.col("id") % 6).cast("string")).alias("borough"),
        (F.col("id") * 37 % 101 / 2 + 3).alias("fare_amount")).cache()


def test_forest_learns_and_reloads(spark, training, tmp_path):
    train, test = model.split(training, "trip_id")
    assert train.count() + test.count() == 600 and test.count() == 60
    fitted = model.fare_pipeline(trees=10).fit(train)
    predictions = fitted.transform(test).cache()
    mine, theirs = model.scores(predictions).first(), model.evaluator("rmse").evaluate(predictions)
    assert mine["rmse"] == pytest.approx(theirs) and mine["r2"] == pytest.approx(model.evaluator("r2").evaluate(predictions))
    assert mine["r2"] > 0.5
    weights = {r["feature"]: r["importance"] for r in model.importances(fitted).collect()}
    assert max(weights, key=weights.get) == "distance_km"
    model.save(fitted, str(tmp_path / "m"))
    model.save(fitted, str(tmp_path / "m"))
    again = model.score(str(tmp_path / "m"), test)
    assert sorted(r[0] for r in again.select(model.PREDICTION).collect()) == sorted(
        r[0] for r in predictions.select(model.PREDICTION).collect())


def test_unseen_borough(spark, training):
    train = training.where("borough <> 'b5'")
    strict = model.fare_pipeline(trees=2).fit(train)
    with pytest.raises(Exception):
        strict.transform(training).select(model.PREDICTION).collect()
    assert model.fare_pipeline("keep", trees=2).fit(train).transform(training).count() == 600


def test_grid_search(training):
    best = model.tune(training, trees=[2, 4], depths=[2], folds=2)
    assert len(best.avgMetrics) == 2


def test_default_places():
    from tripmart.plans import places

    areas = places.default_areas()
    assert len(areas) == 156 and len({a[0] for a in areas}) == 156 and areas == places.default_areas()
    assert all(a[1] < a[2] and a[3] < a[4] for a in areas)
    weight = {a[0]: a[5] for a in areas}
    assert (weight["Midtown"], weight["JFK Airport"], weight["Newark Airport"], weight["Harlem"], weight["Area_125"]) == (15, 15, 8, 5, 1)
    assert all(40.48 <= a[1] and a[2] <= 42.02 and -74.53 <= a[3] and a[4] <= -71.47 for a in areas if a[0].startswith("Area_"))
    assert places.location_weights(["Queens", "Nowhere"]) == {"Queens": 30, "Nowhere": 1}
