"""Tables stored in partitions of a hash of their key, so that an upsert costs what it touches.

A store is a folder with one sub-folder for each partition. A row's partition follows from its key alone, so the rows that a batch can change
lie in the partitions of its own keys: those are read, merged and written, and Spark's dynamic partition overwrite leaves all others as they are. What the
store looks like (keys, number of partitions, schema) stands beside it.

An upsert repeated after a failure ends in the same table: a job commits its files only when all are written, and rows that are merged a second time
replace themselves. Two writers at once are not kept apart.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from tripmart.operators.lookup import settle, stored_table
from tripmart.operators.upsert import upsert

PART = "_part"
ROWS_PER_PART = 2_000_000


@dataclass(frozen=True)
class KeyedStore:
    path: str
    keys: tuple[str, ...]
    parts: int
    schema: StructType

    @property
    def layout_path(self) -> str:
        return f"{self.path}-layout"


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def parts_for(rows: int, rows_per_part: int = ROWS_PER_PART) -> int:
    """Partitions grow with the rows, so that one holds about ``rows_per_part``."""
    return max(1, -(-rows // rows_per_part))


def _save_layout(spark: SparkSession, store: KeyedStore) -> None:
    row = (",".join(store.keys), store.parts, store.schema.json())
    spark.createDataFrame([row], "keys string, parts int, layout string").coalesce(1).write.mode("overwrite").parquet(store.layout_path)


def _placed(rows: DataFrame, store: KeyedStore) -> DataFrame:
    """Rows with their partition, each partition in one task."""
    return rows.withColumn(PART, part_of(store.keys, store.parts)).repartition(PART)


def _checked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return rows.withColumn(keys[0], F.when(missing, F.raise_error(F.lit("a keyed store takes no row without a key"))).otherwise(F.col(keys[0])))


def create_store(rows: DataFrame, path: str, keys: Sequence[str], parts: int | None = None) -> KeyedStore:
    """Write a whole table, one row for each key, replacing what stood there."""
    spark = rows.sparkSession
    if PART in rows.columns:
        raise ValueError(f"a stored table has no column {PART}")
    store = KeyedStore(path.rstrip("/"), tuple(keys), parts or parts_for(rows.count()), rows.schema)
    # The layout goes first: a store with a layout and no rows yet is an empty table.
    _save_layout(spark, store)
    _placed(_checked(rows, store.keys), store).write.mode("overwrite").partitionBy(PART).parquet(store.path)
    return store


def open_store(spark: SparkSession, path: str) -> KeyedStore | None:
    """The store at ``path``, or None before its first load."""
    layout = stored_table(spark, f"{path.rstrip('/')}-layout")
    if layout is None:
        return None
    keys, parts, schema = layout.first()
    return KeyedStore(path.rstrip("/"), tuple(keys.split(",")), parts, StructType.fromJson(json.loads(schema)))


def read_store(spark: SparkSession, store: KeyedStore, touched: Sequence[int] | None = None) -> DataFrame:
    """The table, or those of its partitions that are listed. Partitions written before a column came hold zero or null for it."""
    schema = StructType([*store.schema.fields]).add(PART, "integer")
    rows = spark.read.schema(schema).parquet(store.path)
    if touched is not None:
        rows = rows.where(F.col(PART).isin(list(touched)) if touched else F.lit(False))
    return rows.select(*[
        F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name) if f.metadata.get("since") == "upsert" and isinstance(f.dataType, NumericType)
        else F.col(f.name) for f in store.schema])


def _widened(store: KeyedStore, rows: DataFrame) -> KeyedStore:
    """The store with the columns that only ``rows`` have."""
    known = set(store.schema.names)
    fields = list(store.schema.fields)
    for f in rows.schema:
        if f.name not in known:
            fields.append(type(f)(f.name, f.dataType, True, {"since": "upsert"}))
    return KeyedStore(store.path, store.keys, store.parts, StructType(fields))


def upsert_store(spark: SparkSession, store: KeyedStore, source: DataFrame, update_columns: Sequence[str] | None = None,
                 new_columns: bool = False) -> tuple[KeyedStore, list[int]]:
    """Upsert ``source`` into the store; returns the store and the partitions written.

    With ``new_columns`` either side may have columns that the other lacks: numbers become zero there, the rest null. Otherwise they must agree.
    Only partitions that hold a key of ``source`` are read and written. Their numbers, at most as many as the store has, come to the driver.
    """
    if new_columns:
        wider = _widened(store, source)
        if wider.schema != store.schema:
            store = wider
            _save_layout(spark, store)
        lacking = [f for f in store.schema if f.name not in source.columns]
        source = source.withColumns({
            f.name: F.lit(0 if isinstance(f.dataType, NumericType) else None).cast(f.dataType) for f in lacking}) if lacking else source
    odd = set(source.columns) ^ set(store.schema.names)
    if odd:
        raise ValueError(f"source and store differ in columns: {', '.join(sorted(odd))}")
    source = settle(_checked(source, store.keys).select(*source.columns), "upsert")
    numbers = source.select(part_of(store.keys, store.parts).alias(PART)).distinct()
    touched = sorted(r[0] for r in numbers.toLocalIterator())
    if not touched:
        return store, []
    current = read_store(spark, store, touched if len(touched) < store.parts else None)
    merged = upsert(current, source.select(*store.schema.names), store.keys, update_columns)
    _placed(merged, store).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(store.path)
    return store, touched


def find_keys(spark: SparkSession, store: KeyedStore, keys: DataFrame) -> DataFrame:
    """The stored rows with one of ``keys``; only the partitions that can hold them are read."""
    keys = settle(keys.select(*store.keys).distinct(), "keys")
    touched = sorted(r[0] for r in keys.select(part_of(store.keys, store.parts).alias(PART)).distinct().toLocalIterator())
    return read_store(spark, store, touched).join(keys, list(store.keys), "left_semi")


def resplit(spark: SparkSession, store: KeyedStore, path: str, parts: int | None = None) -> KeyedStore:
    """A copy of the store at another path with as many partitions as its rows ask for now."""
    return create_store(read_store(spark, store), path, store.keys, parts)
