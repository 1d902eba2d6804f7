"""Pages of a sorted table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.keys import buckets_for


def page(df: DataFrame, order_by: Sequence[str], number: int, size: int) -> DataFrame:
    """Page ``number`` (from zero). Each task keeps just its first rows; no task sorts the whole table."""
    if number < 0 or size < 1:
        raise ValueError("page number must be at least 0 and size at least 1")
    return df.orderBy(*order_by).offset(number * size).limit(size)


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The page after the key ``last``: a filter on the scan, so deep pages cost no more than the first."""
    return df.where(F.col(key) > F.lit(last)).orderBy(key).limit(size)


@dataclass(frozen=True)
class RankIndex:
    """A table cut into ranges of its order, and how many rows lie before each range."""

    path: str
    order_by: tuple[str, ...]
    before: tuple[int, ...]
    rows: int


def rank_index(df: DataFrame, order_by: Sequence[str], path: str, ranges: int | None = None) -> RankIndex:
    """Store ``df`` in ranges of its order, which must tell all rows apart. One shuffle; each range is sorted in its task."""
    ranges = ranges or buckets_for(df.count())
    placed = df.repartitionByRange(ranges, *order_by).withColumn("_range", F.spark_partition_id())
    placed.sortWithinPartitions("_range", *order_by).write.mode("overwrite").partitionBy("_range").parquet(path)
    return open_index(df.sparkSession, path, order_by)


def open_index(spark: SparkSession, path: str, order_by: Sequence[str]) -> RankIndex:
    """The counts come from the files' footers: one number for each range."""
    counts = {r[0]: r[1] for r in spark.read.parquet(path).groupBy("_range").count().collect()}
    before, total = [], 0
    for k in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(k, 0)
    return RankIndex(path, tuple(order_by), tuple(before), total)


def ranges_of_page(index: RankIndex, number: int, size: int) -> list[int]:
    """The ranges that hold some of a page."""
    first, end = number * size, min((number + 1) * size, index.rows)
    ends = [*index.before[1:], index.rows]
    return [k for k, (a, b) in enumerate(zip(index.before, ends)) if a < end and b > first]


def indexed_page(spark: SparkSession, index: RankIndex, number: int, size: int) -> DataFrame:
    """Page ``number`` (from zero) of an indexed table. However deep the page lies, only the ranges that hold it are read."""
    if number < 0 or size < 1:
        raise ValueError("page number must be at least 0 and size at least 1")
    held = ranges_of_page(index, number, size)
    rows = spark.read.parquet(index.path).where(F.col("_range").isin(held) if held else F.lit(False)).drop("_range")
    skipped = number * size - index.before[held[0]] if held else 0
    return rows.orderBy(*index.order_by).offset(skipped).limit(size)


def first_new_keys(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    return df.select(key).orderBy(key).limit(k)
