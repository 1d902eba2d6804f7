import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.operators import keys, paging, pivots, quality, readings, unions
from tripmart.operators import upsert as U
from tripmart.operators.lookup import settle


def test_keep_first_is_deterministic(spark, rows):
    data = [(1, 5.0, "b"), (1, 5.0, "a"), (1, 4.0, None), (1, 4.0, "z"), (2, None, "x"), (2, 1.0, "y")]
    for parts in (1, 3):
        df = spark.createDataFrame(data, "id int, fare double, note string").repartition(parts)
        assert rows(keys.keep_first(df, ["id"], ["fare"]), "id") == [(1, 4.0, None), (2, None, "x")]


def test_keep_first_drops_hot_duplicates_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").alias("v"))
    plan = keys.keep_first(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_new_rows_both_ways(spark, rows):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    current = spark.createDataFrame([(2, 9.0), (5, 9.0)], "id int, x double")
    for small in (False, True):
        assert rows(keys.new_rows(source, current, ["id"], small), "v") == [(1, "a"), (None, "c")]
        assert rows(keys.new_rows(source, current.limit(0), ["id"], small), "v") == [(1, "a"), (2, "b"), (None, "c")]


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_dense_ids(spark, buckets):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(5)
    ordered = keys.ordered_ids(df, "k", ranges=buckets)
    assert all(r["k"] == r["row_id"] for r in ordered.collect())
    hashed = keys.hashed_ids(df, ["k"], start=10, buckets=buckets)
    assert sorted(r["row_id"] for r in hashed.collect()) == list(range(10, 1010))
    again = keys.hashed_ids(df.repartition(3), ["k"], start=10, buckets=buckets)
    assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, again.collect()))


def test_max_id_skips_text(spark):
    df = spark.createDataFrame([("7",), ("12",), ("x",), (None,)], "id string")
    assert keys.max_id(df, "id").first()[0] == 12


def test_distinct_values_are_sorted_and_unlimited(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 2)], "c string, n int")
    assert pivots.distinct_values(df, ["c", "n"]) == {"c": ["a", "b"], "n": ["1", "2"]}
    many = spark.range(2001).selectExpr("id % 3 as k", "cast(id as string) as c")
    assert len(pivots.distinct_values(many, ["c"])["c"]) == 2001
    long = pivots.long_counts(many.unionByName(many.limit(1)), "k", ["c"])
    assert long.count() == 2001 and long.agg(F.sum("count")).first()[0] == 2002


def test_top_label_and_unpivot(spark, rows):
    df = spark.createDataFrame(
        [(1, 2, 2, 0), (2, 0, 0, 0), (3, 0, 1, 5)], "id int, `c_b/x_count` int, c_a_count int, c_z_count int")
    assert rows(df.select("id", pivots.top_label(df, "c_", "_count")), "id") == [(1, "a"), (2, "a"), (3, "z")]
    long = pivots.unpivot_counts(df, "id", "c_", "_count", "label")
    assert rows(long.where("id = 1"), "label") == [(1, "a", 2), (1, "b/x", 2), (1, "z", 0)]


def test_top_value_ties_and_nulls(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, None, 3), (2, "a", 3), (3, "c", 1)], "k int, v string, n int")
    assert rows(df.groupBy("k").agg(pivots.top_value(F.col("v"), F.col("n"))), "k") == [(1, "a"), (2, None), (3, "c")]


def test_least_readings(spark, rows):
    data = [(d, i, None if i >= n else float(i), i % 3 if i < n else None) for d, n in ((1, 11), (2, 12), (3, 13), (4, 0)) for i in range(14)]
    df = spark.createDataFrame(data, "d int, i int, t double, code int")
    got = rows(readings.reduce_readings(df, ["d"], {"t": "avg"}, {"t": "total"}, ("code", "mode")), "d")
    assert got == [(1, None, 55.0, None), (2, 5.5, 66.0, 0), (3, 6.0, 78.0, 0), (4, None, 0.0, None)]
    short = df.groupBy("d").agg(readings.supported_avg(F.col("t")).alias("a"))
    assert rows(short, "d") == [(1, None), (2, 5.5), (3, 6.0), (4, None)]


def test_active_or_all(spark):
    df = spark.createDataFrame([(1, "Active"), (2, "Idle")], "id int, status string")
    assert [r["id"] for r in unions.active_or_all(df, "status").collect()] == [1]
    assert unions.active_or_all(df, "status", "Gone").count() == 2


def test_tagged_union_fills_missing_columns(spark, rows):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert rows(unions.tagged_union({"a": a, "b": b}, "tag").select("tag", "x", "y"), "tag") == [("a", 1, None), ("b", None, "q")]
    with pytest.raises(ValueError):
        unions.tagged_union({}, "tag")


def test_pages(spark):
    df = spark.range(25)
    assert [r[0] for r in paging.page(df, ["id"], 2, 10).collect()] == [20, 21, 22, 23, 24]
    assert [r[0] for r in paging.page_after(df, "id", 19, 3).collect()] == [20, 21, 22]
    assert [r[0] for r in paging.first_new_keys(df, "id").collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        paging.page(df, ["id"], -1, 10)


TARGET = [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)]
SOURCE = [(2, "B", 20.0), (3, "c", 3.0), (None, "m", 9.0), (None, "m", 9.0)]
COLUMNS = "id int, name string, v double"


def _upsert(spark, target, source, **kw):
    out = U.upsert(spark.createDataFrame(target, COLUMNS), spark.createDataFrame(source, COLUMNS), ["id"], **kw)
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_upsert_updates_inserts_and_keeps(spark):
    nulls = [(None, "m", 9.0), (None, "m", 9.0), (None, "n", 0.0)]
    assert _upsert(spark, TARGET, SOURCE) == sorted([(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0), *nulls], key=str)
    assert (2, "b", 20.0) in _upsert(spark, TARGET, SOURCE, update_columns=["v"])
    for columns in (None, ["v"]):
        large = _upsert(spark, TARGET, SOURCE, update_columns=columns, small_source=False)
        assert large == _upsert(spark, TARGET, SOURCE, update_columns=columns)


def test_upsert_empty_sides_and_idempotence(spark):
    assert _upsert(spark, TARGET, []) == sorted(TARGET, key=str)
    assert _upsert(spark, [], SOURCE) == sorted(SOURCE, key=str)
    keyed = [r for r in SOURCE if r[0] is not None]
    once = _upsert(spark, TARGET, keyed)
    assert _upsert(spark, once, keyed) == once


def test_upsert_rejects_duplicates_and_unknown_columns(spark):
    with pytest.raises(Exception, match="more than once"):
        _upsert(spark, TARGET, [(2, "x", 1.0), (2, "y", 2.0)])
    with pytest.raises(ValueError):
        _upsert(spark, TARGET, SOURCE, update_columns=["nope"])
    with pytest.raises(ValueError):
        U.upsert(spark.createDataFrame(TARGET, COLUMNS), spark.range(1), ["id"])


def test_upsert_can_null_a_value(spark):
    assert (2, None, 5.0) in _upsert(spark, TARGET, [(2, None, 5.0)])


def test_versions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for version, n in ((1, 3), (2, 5)):
        U.commit_version(spark.range(n), path, version)
    assert rows(U.history(U.versions(spark, path)), "version") == [(1, 3), (2, 5)]
    assert U.as_of(U.versions(spark, path), 1).count() == 3
    assert U.restore(spark, path, 1) == 3
    assert rows(U.latest(U.versions(spark, path)), "id") == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        U.restore(spark, path, 9)


AT = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("source,target,result", [(3, 3, "Pass"), (4, 3, "Fail"), (3, 4, "Fail"), (3, 0, "Fail")])
def test_balance(spark, source, target, result):
    got = quality.balance("t", spark.range(source), spark.range(target), AT).first()
    assert (got["expected_count"], got["actual_count"], got["difference"], got["result"]) == (
        source, target, source - target, result)


def test_record_balance_appends_then_raises(spark, tmp_path):
    path = str(tmp_path / "results")
    trips = spark.range(3).withColumnRenamed("id", "trip_id")
    good = quality.balance_suite(spark, {"trips_file": trips, "trips": trips}, AT, ["trips"])
    quality.record_balance(good, path)
    bad = quality.balance_suite(spark, {"trips_file": trips, "trips": trips.limit(1)}, AT, ["trips"])
    with pytest.raises(quality.BalanceError, match="trips"):
        quality.record_balance(bad, path)
    assert spark.read.parquet(path).count() == 2
    rejects = {"trips": trips.where("trip_id > 0")}
    assert quality.balance_suite(
        spark, {"trips_file": trips, "trips": trips.limit(1)}, AT, ["trips"], rejects).first()["result"] == "Pass"
    with pytest.raises(ValueError):
        quality.balance_suite(spark, {}, AT, ["nope"])


def test_observed_counters_ride_along(spark):
    df, watch = quality.observed(spark.range(10), "load", evens=F.count_if(F.col("id") % 2 == 0))
    df.write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 10, "evens": 5}


def test_settle_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "a int, b array<double>")
    assert sorted(map(str, settle(df).collect())) == sorted(map(str, df.collect()))
    assert settle(df.limit(0)).count() == 0


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tripmart.session import is_cluster, shared_folder

    session = lambda master, folder: SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master))
    assert is_cluster("spark://host:7077") and is_cluster("local-cluster[3,2,1000]") and not is_cluster("local[8]")
    assert shared_folder(session("spark://host:7077", "hdfs://store/shared/")) == "hdfs://store/shared"
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master, None))


def test_a_workspace_removes_what_was_stored_in_it(spark):
    from pathlib import Path

    from tripmart.session import workspace

    kept = settle(spark.range(2))
    with workspace(spark) as paths:
        inner = settle(spark.range(3))
        assert inner.count() == 3 and len(paths) == 1
        place = Path(paths[0].removeprefix("file:").replace("//", "/"))
        assert place.exists()
    assert not place.exists() and kept.count() == 2


def test_small_batch_goes_to_the_current_table(spark, tmp_path):
    from tripmart.plans.clean import clean_dimension

    spark.range(1000).select(F.col("id").alias("customer_id")).write.parquet(str(tmp_path / "current"))
    current = spark.read.parquet(str(tmp_path / "current"))
    batch = spark.createDataFrame([(5, "known"), (2000, "new"), (2000, "new"), (None, "x")], "customer_id long, name string")
    out = clean_dimension(batch, "customers", current, small_batch=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # What stands between the semi join and the batch keys sent to it is the scan of the current table alone.
    current_side = plan.split("LeftSemi", 1)[1].split("BroadcastExchange", 1)[0]
    assert "FileScan" in current_side and "hashpartitioning" not in current_side
    assert [tuple(r) for r in out.collect()] == [(2000, "new")]


def test_only_a_missing_path_is_a_first_load(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from tripmart.operators.lookup import stored_table

    assert stored_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        stored_table(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception):
        stored_table(spark, str(tmp_path), lambda p: spark.read.format("nosuchformat").load(p))


def test_missing_input_has_no_price(one):
    from tripmart.plans import pricing

    lit = F.lit
    at = lit("2012-03-03 10:00:00").cast("timestamp")
    price = lambda km: pricing.fare(km, lit(10), at, lit(None).cast("int"), lit("petrol"), lit(1.0))
    known, missing = one([1.0, None], "double", price)
    assert known > 4 and missing is None
    assert one([None, 1, 4], "int", pricing.passenger_surcharge) == [0.0, 0.0, 1.0]
