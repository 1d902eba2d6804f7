import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.functions import calendar as C
from tripmart.functions import categories as K
from tripmart.functions import chance, numbers, sphere, text
from tripmart.plans import pricing


def test_right_closed_bins(one):
    values = [None, 0.0, 0.1, 0.1 + 1e-9, 2.0, 2.0 + 1e-9, 10.0, 10.1, -5.0, float("nan")]
    assert one(values, "double", lambda c: K.categorize(c, *K.RAIN)) == [
        "Unknown", "No Rain", "No Rain", "Slight Rain", "Slight Rain", "Medium Rain", "Medium Rain", "Heavy Rain",
        "No Rain", "Heavy Rain"]


def test_left_closed_bins(one):
    values = [0.1 - 1e-9, 0.1, 2.0 - 1e-9, 2.0, 10.0, None]
    assert one(values, "double", lambda c: K.categorize(c, *K.RAIN, closed="left")) == [
        "No Rain", "Slight Rain", "Slight Rain", "Medium Rain", "Heavy Rain", "Unknown"]


def test_bins_reject_wrong_labels():
    with pytest.raises(ValueError):
        K.categorize(F.lit(1), [1, 2], ["a", "b"])


def test_pickup_period(one):
    hours = [None, -1, 0, 3, 4, 5, 6, 9, 10, 15, 16, 19, 20, 21, 22, 24, 25]
    assert one(hours, "int", C.pickup_period) == [
        "Unknown", "InvalidHour", "After Midnight", "After Midnight", "Early Morning", "Early Morning", "Morning Rush",
        "Morning Rush", "Midday", "Midday", "Evening Rush", "Evening Rush", "Night", "Night", "Late Night",
        "Late Night", "InvalidHour"]


def test_names_of_unknown_numbers_are_null(one):
    assert one([1, 7, 0, 8, None], "int", C.day_name) == ["Sunday", "Saturday", None, None, None]
    assert one([1, 12, 13], "int", C.month_name) == ["January", "December", None]


def test_safe_ratio(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -2.0), (1.0, None), (None, 2.0)], "n double, d double")
    assert [r[0] for r in rows.select(numbers.safe_ratio(F.col("n"), F.col("d"))).collect()] == [
        0.5, None, None, None, None]


def test_tip_percent_is_null_when_fare_and_tip_cancel(spark):
    rows = spark.createDataFrame([(10.0, 1.0), (5.0, -5.0), (0.0, 0.0), (None, 1.0)], "fare double, tip double")
    got = [r[0] for r in rows.select(numbers.tip_percent(F.col("fare"), F.col("tip"))).collect()]
    assert got[0] == pytest.approx(10.0) and got[1:] == [None, None, None]


def test_steady_round_forgives_the_last_bits(one):
    values = [0.125, 0.12499999999999997, 0.1249, 2.675, None]
    assert one(values, "double", lambda c: numbers.steady_round(c, 2)) == [0.13, 0.13, 0.12, 2.68, None]


def test_unknown_label_keeps_numbers_as_text(one):
    assert one([5, None], "int", K.or_unknown) == ["5", "Unknown"]


def test_tolerant_casts(one):
    assert one(["12", "x", None, ""], "string", lambda c: text.to_number(c, "bigint")) == [12, None, None, None]
    with pytest.raises(ValueError):
        text.to_number(F.lit("1"), "date")


def test_sanitize(one):
    assert one(["No Show", "a/b", "x;(1)=\t{y}"], "string", text.sanitize) == ["No_Show", "a/b", "x__1____y_"]


def test_iso_text_date(one):
    assert one(["2024-02-29T05:00"], "string", C.iso_text_date) == [dt.date(2024, 2, 29)]


def test_years_until(one):
    days = [dt.date(1990, 1, 1), dt.date(2016, 1, 1), None]
    assert one(days, "date", C.years_until) == [26.0, 0.0, None]


def _haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(a)))


def test_haversine_special_points(spark):
    points = [(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 50.0), (1.0, 2.0, None, 3.0)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(sphere.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert got == [0.0, round(6371 * math.pi, 2), round(6371 * math.pi, 2), None]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.floats(-89, 89), st.floats(-179, 179)] * 2), min_size=1, max_size=20))
def test_haversine_matches_plain_python(spark, points):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, a double, b double, c double, d double")
    got = [r[0] for r in df.orderBy("i").select(sphere.great_circle_km(*[F.col(c) for c in "abcd"])).collect()]
    assert got == pytest.approx([_haversine(*p) for p in points], abs=1e-4)


def test_time_factor(one):
    at = lambda *a: dt.datetime(*a)
    # Friday 2 January 2015 and the weekend after it.
    values = [
        at(2015, 1, 2, 17, 59), at(2015, 1, 2, 18, 0), at(2015, 1, 4, 22, 59), at(2015, 1, 4, 23, 0),
        at(2015, 1, 5, 4, 59), at(2015, 1, 5, 5, 0), at(2015, 1, 5, 6, 59), at(2015, 1, 5, 7, 0)]
    assert one(values, "timestamp_ntz", pricing.time_factor) == pytest.approx(
        [1.15, 1.15 * 1.15, 1.15 * 1.2, 1.2, 1.2, 1.0, 1.0, 1.15])


def test_inflation_steps(one):
    values = [dt.datetime(2009, 1, 1), dt.datetime(2009, 6, 30), dt.datetime(2009, 7, 1), dt.datetime(2010, 1, 1)]
    assert one(values, "timestamp_ntz", pricing.inflation) == pytest.approx([1, 1, 1.015, 1.03 * 1.015 ** 2])


def test_passenger_surcharge(one):
    assert one([1, 2, 3, 6], "int", pricing.passenger_surcharge) == [0.0, 0.0, 0.5, 2.0]


def test_fare_floor_and_missing_weather(spark):
    trips = spark.createDataFrame(
        [(0.1, 1.0, dt.datetime(2009, 1, 5, 12), 1, "ev", False), (10.0, 20.0, dt.datetime(2009, 1, 5, 12), 4, "petrol", False),
         (1.0, 10.0, dt.datetime(2009, 1, 5, 12), 4, "petrol", True), (40.0, 10.0, dt.datetime(2009, 1, 5, 12), 4, "petrol", True)],
        "distance_km double, trip_duration_min double, pickup_datetime timestamp_ntz, passenger_count int, "
        "fuel_type string, over boolean").withColumns({"km_factor": F.lit(2.0), "minute_factor": F.lit(3.0)})
    weather = spark.createDataFrame(
        [], "date date, precipitation double, avg_snow_fall double, avg_wind_speed double, avg_temp double")
    got = [r["fare"] for r in pricing.price_trips(trips, weather, F.col("over")).orderBy("distance_km").collect()]
    plain = 2.5 + 10 * 1.75 + 20 * 0.35 + 0.25 + 1.0
    short = 2.5 + 1 * 1.75 * 2 + 10 * 0.35 + 0.25
    long = 2.5 + 40 * 1.75 + 10 * 0.35 * 3 + 0.25
    assert got == pytest.approx([4.0, short, plain, long])


def test_weather_factor_bins_are_left_closed(spark):
    df = spark.createDataFrame([(0.1, 0.0, 0.0, 68.0), (None, None, None, None)], "r double, s double, w double, t double")
    got = [r[0] for r in df.select(pricing.weather_factor(*[F.col(c) for c in "rswt"])).collect()]
    assert got == pytest.approx([1.05, 1.0])


def test_weighted_choice_follows_weights(spark):
    df = spark.range(20000).select(chance.weighted_choice(F.col("id"), "t", {"a": 6, "b": 3, "c": 1}).alias("v"))
    shares = {r["v"]: r["count"] / 20000 for r in df.groupBy("v").count().collect()}
    assert shares == pytest.approx({"a": 0.6, "b": 0.3, "c": 0.1}, abs=0.02)


def test_draws_do_not_depend_on_partitions(spark):
    pick = lambda n: sorted(
        (r[0], r[1]) for r in spark.range(0, 500, 1, n).select("id", chance.uniform(F.col("id"), "s")).collect())
    assert pick(1) == pick(7)
