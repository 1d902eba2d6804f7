"""Refreshing stored marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tripmart.operators.keyed_store import create_store, open_store, read_store, upsert_store
from tripmart.operators.lookup import settle, stored_table
from tripmart.operators.upsert import upsert
from tripmart.paths import Lake
from tripmart.sinks import publish
from tripmart.sources.readers import read_columns

MART_KEYS = {"customer_profile": ["customer_id"], "customer_preference": ["customer_id"]}


def stored(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None before its first load."""
    return stored_table(spark, path, lambda p: read_columns(spark, p, fmt))


def refresh_people(
    spark: SparkSession, lake: Lake, table: str, fresh: DataFrame, date: dt.date | str,
    update_columns: list[str] | None = None,
) -> DataFrame:
    """First load writes the mart, later loads upsert into it.

    Pivot columns follow the values present, so a later load may bring new counters or lack old ones: either side
    gets zero for what it lacks.
    """
    if table not in MART_KEYS:
        raise ValueError(f"no refresh keys for {table!r}")
    current = stored(spark, lake.current(table, "enrich"))
    if current is None:
        return publish(fresh, lake, table, "enrich", "full", date)
    # The upsert reads its source more than once; a mart is dear to compute.
    fresh = _aligned(settle(fresh, table), current)
    current = _aligned(current, fresh)
    merged = upsert(current, fresh.select(*current.columns), MART_KEYS[table], update_columns)
    return publish(merged, lake, table, "enrich", "full", date)


def refresh_in_place(
    spark: SparkSession, lake: Lake, table: str, fresh: DataFrame, update_columns: list[str] | None = None, parts: int | None = None,
) -> DataFrame:
    """The refresh of a mart that is kept as a keyed store: later loads read and write only the partitions of the customers they bring.

    New pivot counters widen the store; its older partitions stay as they are and read as zero there.
    """
    if table not in MART_KEYS:
        raise ValueError(f"no refresh keys for {table!r}")
    path = lake.current(table, "enrich")
    store = open_store(spark, path)
    if store is None:
        return read_store(spark, create_store(fresh, path, MART_KEYS[table], parts))
    store, _ = upsert_store(spark, store, fresh, update_columns, new_columns=True)
    return read_store(spark, store)


def _aligned(df: DataFrame, other: DataFrame) -> DataFrame:
    """Add the columns only ``other`` has: zero for numbers, null for the rest."""
    added = {
        f.name: F.lit(0 if isinstance(f.dataType, NumericType) else None).cast(f.dataType)
        for f in other.schema if f.name not in df.columns
    }
    return df.withColumns(added) if added else df
