import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart import schemas, sinks
from tripmart.paths import Lake
from tripmart.sources import readers, spine
from tripmart.streaming import ingest


def test_schema_catalogue():
    assert schemas.schema_for("trips")["trip_id"].nullable is False
    assert len(schemas.schema_for("vehicles")) == 13 and len(schemas.schema_for("weather")) == 8
    assert schemas.schema_for("boundaries")["features"] is not None
    with pytest.raises(ValueError):
        schemas.schema_for("rides")


def test_paths():
    lake, dev = Lake("/lake/"), Lake("/lake", "dev")
    assert lake.drop("trips", "full") == "/lake/drops/*/trips.csv"
    assert lake.drop("trips", "delta", dt.date(2024, 1, 2)) == "/lake/drops/2024-01-02/trips.csv"
    assert dev.current("fares", "enrich") == "/lake/sandbox/enrich/fares/current/fares.parquet"
    assert lake.current("boundaries", "raw", "delta") == "/lake/raw/boundaries/boundaries/current/boundaries.delta"
    assert lake.snapshot("fares", "enrich", "2024-01-02") == "/lake/enrich/fares/delta/2024-01-02/fares.parquet"
    assert lake.boundary_file("a.geojson").endswith("input/boroughs/a.geojson")
    for call in (
        lambda: lake.drop("fares", "full"), lambda: lake.drop("trips", "delta"), lambda: lake.drop("trips", "some"),
        lambda: lake.current("fares", "gold"), lambda: Lake("/x", "qa"), lambda: lake.boundary_file("a.json"),
    ):
        with pytest.raises(ValueError):
            call()


HEADER = ("key,pickup_datetime,dropoff_datetime,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,"
          "passenger_count,fare_amount\n")


def _drop(root, day, *ids):
    folder = root / "drops" / day
    folder.mkdir(parents=True)
    (folder / "trips.csv").write_text(HEADER + "".join(
        f"{i},{day} 10:00:00 UTC,{day} 10:30:00 UTC,1,2,3,4,,{n + 5}.5\n" for n, i in enumerate(ids)))


def test_drops_bind_by_position_and_carry_their_date(spark, tmp_path):
    _drop(tmp_path, "2024-01-01", "a", "b")
    _drop(tmp_path, "2024-01-02", "c")
    lake = Lake(str(tmp_path))
    full = readers.read_drop(spark, lake, "trips", "full").orderBy("trip_id").collect()
    assert [(r["trip_id"], r["drop_date"].day, r["pickup_datetime"].hour) for r in full] == [
        ("a", 1, 10), ("b", 1, 10), ("c", 2, 10)]
    assert [r["trip_id"] for r in readers.read_drop(spark, lake, "trips", "delta", "2024-01-02").collect()] == ["c"]


def test_load_kinds(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    spark.range(3).write.option("header", True).csv(str(tmp_path / "c"))
    assert readers.load(spark, str(tmp_path / "p"), "parquet").count() == 3
    assert readers.load(spark, str(tmp_path / "c"), "csv").columns == ["id"]
    with pytest.raises(ValueError):
        readers.load(spark, "x", "xml")
    got = readers.sql_over_files(spark, "SELECT count(*) AS n FROM {t}", t=str(tmp_path / "p"))
    assert got.first()["n"] == 3


def test_jdbc_options():
    """Options only: no database may run here."""
    assert readers.jdbc_options("jdbc:x", "fares.f", {"user": "u"}) == {"url": "jdbc:x", "dbtable": "fares.f", "user": "u"}
    split = readers.jdbc_options("jdbc:x", "t", None, "id", 0, 100, 4)
    assert split["numPartitions"] == "4" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")
    assert sinks.jdbc_target("jdbc:x", "f", "fares") == {"url": "jdbc:x", "dbtable": "fares.f"}


def test_export_marts(spark, tmp_path):
    tables = {n: spark.range(2) for n in sinks.EXPORT_SCHEMAS}
    write = lambda df, table, schema: df.write.parquet(str(tmp_path / schema / table))
    assert sinks.export_marts(tables, write, ["fares"]) == ["fares"]
    assert spark.read.parquet(str(tmp_path / "fares" / "fares")).count() == 2
    assert len(sinks.export_marts(tables, lambda *a: None)) == 8
    with pytest.raises(ValueError):
        sinks.export_marts(tables, write, ["rides"])


def test_publish_modes_and_reading_its_own_target(spark, tmp_path):
    lake = Lake(str(tmp_path))
    sinks.publish(spark.range(3), lake, "fares", "enrich", "full", "2024-01-01")
    grown = sinks.publish(spark.range(10, 12), lake, "fares", "enrich", "delta", "2024-01-02")
    assert grown.count() == 5
    doubled = sinks.publish(grown.select((F.col("id") * 2).alias("id")), lake, "fares", "enrich", "full", "2024-01-03")
    assert sorted(r[0] for r in doubled.collect()) == [0, 2, 4, 20, 22]
    assert spark.read.parquet(lake.snapshot("fares", "enrich", "2024-01-02")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), "x", "some")


def test_mart_sources(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for table in readers.MART_SOURCES["weather_impact"]:
        sinks.write_table(spark.range(2), lake.current(table, readers.TABLE_LAYERS[table]), "full")
    assert set(readers.load_mart_sources(spark, lake, "weather_impact")) == {"fares", "trip_details"}
    with pytest.raises(ValueError):
        readers.load_mart_sources(spark, lake, "nothing")


def test_dated_batches_round_trip(spark, tmp_path):
    df = sinks.dated_batches(spark.range(25), "id", dt.date(2024, 1, 1), rows=10)
    assert {r["batch_date"]: r["count"] for r in df.groupBy("batch_date").count().collect()} == {
        dt.date(2024, 1, 1): 10, dt.date(2024, 1, 2): 10, dt.date(2024, 1, 3): 5}
    sinks.write_batches(df, str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").glob("batch_date=*")) == [f"batch_date=2024-01-0{i}" for i in (1, 2, 3)]
    report = sinks.write_report(df.withColumn("file", F.col("batch_date").cast("string")), "file")
    assert [tuple(r) for r in report.where("file = 'TOTAL'").collect()] == [("TOTAL", 25, "", "3 files generated")]


def test_spine(spark):
    assert spine.first_missing_day(None, "full") == dt.date(2009, 1, 1)
    stored = spark.createDataFrame([(dt.date(2024, 2, 28),)], "date date")
    start = spine.first_missing_day(stored, "delta")
    assert start == dt.date(2024, 2, 29)
    days = spine.date_spine(spark, start, dt.date(2024, 4, 1))
    assert days.count() == 33
    batches = spine.spine_batches(days).orderBy("batch").collect()
    assert [(b["n_dates"], len(b["dates"])) for b in batches] == [(30, 30), (3, 3)]
    assert spine.date_spine(spark, start, dt.date(2024, 2, 1)).count() == 0


def test_stream_reads_each_file_and_key_once(spark, tmp_path):
    _drop(tmp_path, "2024-01-01", "a", "b", "a")
    schema = schemas.schema_for("trips")
    glob = str(tmp_path / "drops" / "*")
    run = lambda: ingest.ingest_new_keys(
        ingest.open_drops(spark, glob, schema), str(tmp_path / "out"), str(tmp_path / "cp"), ["trip_id"], ["fare_amount"], 120)
    run()
    stored = lambda: sorted((r["trip_id"], r["fare_amount"]) for r in ingest.stored_rows(spark, str(tmp_path / "out")).collect())
    assert stored() == [("a", 5.5), ("b", 6.5)]
    run()
    assert stored() == [("a", 5.5), ("b", 6.5)]
    _drop(tmp_path, "2024-01-02", "b", "c")
    run()
    assert stored() == [("a", 5.5), ("b", 6.5), ("c", 6.5)]


def test_stream_changes(spark, tmp_path):
    _drop(tmp_path, "2024-01-01", "a", "b")
    schema = schemas.schema_for("trips")
    run = lambda: ingest.ingest_changes(
        ingest.open_drops(spark, str(tmp_path / "drops" / "*"), schema), str(tmp_path / "out"), str(tmp_path / "cp"), ["trip_id"], timeout=120)
    run()
    _drop(tmp_path, "2024-01-02", "c", "b", "z")
    run()
    base = readers.read_csv(spark, str(tmp_path / "drops" / "2024-01-01"), schema).where("trip_id = 'a'")
    now = ingest.upserted(base, spark.read.parquet(str(tmp_path / "out")), ["trip_id"])
    assert sorted((r["trip_id"], r["fare_amount"]) for r in now.collect()) == [("a", 5.5), ("b", 6.5), ("c", 5.5), ("z", 7.5)]
