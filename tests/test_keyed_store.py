"""The partitioned store: results of upserts, and what they leave untouched."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tripmart.operators import keyed_store as K
from tripmart.streaming import ingest


def files(store):
    return {p.relative_to(store.path) for p in pathlib.Path(store.path).rglob("*.parquet")}


def content(spark, store):
    return sorted(tuple(r) for r in K.read_store(spark, store).collect())


@pytest.fixture
def store(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"), F.col("id").cast("string").alias("t"))
    return K.create_store(rows, str(tmp_path / "store"), ["k"], 16)


def test_untouched_partitions_keep_their_files(spark, store):
    before = files(store)
    source = spark.createDataFrame([(3, 1, "x"), (1000, 2, None)], "k long, v long, t string")
    _, touched = K.upsert_store(spark, store, source)
    after = files(store)
    assert 1 <= len(touched) <= 2
    outside = lambda names: {f for f in names if int(f.parts[0].split("=")[1]) not in touched}
    assert outside(before) == outside(after)
    assert {int(f.parts[0].split("=")[1]) for f in after - before} == set(touched)
    want = [(k, k * 10, str(k)) for k in range(200) if k != 3] + [(3, 1, "x"), (1000, 2, None)]
    assert content(spark, store) == sorted(want, key=lambda r: r[0])


def test_only_touched_partitions_are_read(spark, store):
    plan = K.find_keys(spark, store, spark.createDataFrame([(7,)], "k long"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in text or "PartitionFilters: [(_part" in text
    assert [tuple(r) for r in plan.collect()] == [(7, 70, "7")]
    assert K.find_keys(spark, store, spark.createDataFrame([], "k long")).count() == 0


def test_repeated_upsert_changes_nothing(spark, store):
    source = spark.createDataFrame([(k, -k, "again") for k in range(5, 8)] + [(500, 1, "new")], "k long, v long, t string")
    K.upsert_store(spark, store, source)
    once = content(spark, store)
    K.upsert_store(spark, store, source)
    assert content(spark, store) == once
    assert K.upsert_store(spark, store, source.limit(0))[1] == []
    assert content(spark, store) == once


def test_chosen_columns(spark, store):
    K.upsert_store(spark, store, spark.createDataFrame([(1, 5, "no"), (300, 6, "yes")], "k long, v long, t string"), ["v"])
    rows = {r[0]: r for r in content(spark, store)}
    assert rows[1] == (1, 5, "1") and rows[300] == (300, 6, "yes")


def test_bad_sources(spark, store):
    for rows, error in (([(1, 1, "a"), (1, 2, "b")], "more than once"), ([(None, 1, "a")], "without a key")):
        with pytest.raises(Exception, match=error):
            K.upsert_store(spark, store, spark.createDataFrame(rows, "k long, v long, t string"))
    with pytest.raises(ValueError, match="differ"):
        K.upsert_store(spark, store, spark.createDataFrame([(1, 1)], "k long, extra long").withColumn("v", F.lit(1)).withColumn("t", F.lit("")))
    assert len(content(spark, store)) == 200


def test_new_columns_read_as_zero(spark, store):
    source = spark.createDataFrame([(1, 9, "new")], "k long, cnt_cash long, note string")
    wider, _ = K.upsert_store(spark, store, source, new_columns=True)
    reopened = K.open_store(spark, store.path)
    assert reopened == wider and reopened.schema.names == ["k", "v", "t", "cnt_cash", "note"]
    rows = {r["k"]: r.asDict() for r in K.read_store(spark, reopened).collect()}
    assert rows[1] == {"k": 1, "v": 0, "t": None, "cnt_cash": 9, "note": "new"}
    assert all(r["cnt_cash"] == 0 and r["note"] is None for k, r in rows.items() if k != 1)


def test_empty_and_two_keys(spark, tmp_path):
    empty = K.create_store(spark.createDataFrame([], "a string, b int, v int"), str(tmp_path / "two"), ["a", "b"])
    assert empty.parts == 1 and K.read_store(spark, empty).count() == 0
    K.upsert_store(spark, empty, spark.createDataFrame([("x", 1, 1), ("x", 2, 2)], "a string, b int, v int"))
    assert content(spark, empty) == [("x", 1, 1), ("x", 2, 2)]
    assert K.open_store(spark, str(tmp_path / "none")) is None
    bigger = K.resplit(spark, empty, str(tmp_path / "split"), 4)
    assert bigger.parts == 4 and content(spark, bigger) == content(spark, empty)


def test_folds_apply_each_batch_once(spark, store, tmp_path):
    log = str(tmp_path / "log")
    put = lambda batch, rows: spark.createDataFrame(rows, "k long, v long, t string").write.parquet(f"{log}/batch={batch}")
    assert ingest.fold_into_store(spark, store.path, log) == []
    put(0, [(1, 1, "a"), (2, 2, "a")])
    put(1, [(1, 11, "b"), (900, 1, "b")])
    first = ingest.fold_into_store(spark, store.path, log)
    assert first and ingest.fold_into_store(spark, store.path, log) == []
    put(2, [(2, 22, "c")])
    before = files(store)
    touched = ingest.fold_into_store(spark, store.path, log)
    assert len(touched) == 1 and len(files(store) & before) >= len(before) - 1
    rows = {r[0]: r[1:] for r in content(spark, store)}
    assert rows[1] == (11, "b") and rows[2] == (22, "c") and rows[900] == (1, "b") and len(rows) == 201
