"""One row per key, rows with new keys, and dense row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows in one bucket of a row numbering. Each bucket is sorted in one task, and only the buckets' counts ever meet in one.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int) -> int:
    """Buckets grow with the rows, without a ceiling, so that a task's share does not."""
    return max(1, -(-rows // ROWS_PER_BUCKET))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, then by every other column, nulls first.

    Spark keeps the first row of each key on the map side before the shuffle, so a key with a third of all rows
    sends one row per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = [F.col(c).asc_nulls_first() for c in [*order_by, *rest]] or [F.col(keys[0])]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def new_rows(source: DataFrame, current: DataFrame, keys: Sequence[str], small_batch: bool = False) -> DataFrame:
    """Rows of ``source`` whose keys ``current`` does not hold.

    With ``small_batch`` the current keys are first cut down to those of the batch. Spark can then send the batch
    keys to the current table instead of shuffling that table; the price is reading the batch twice.
    """
    keys = list(keys)
    known = current.select(*keys)
    if small_batch:
        known = known.join(source.select(*keys), keys, "left_semi")
    return source.join(known, keys, "left_anti")


def _number(df: DataFrame, bucket: Column, order: Sequence[str], name: str, start: int | Column) -> DataFrame:
    """Rows before the bucket plus the place within it. Both parts depend on the data alone, so reruns agree."""
    bucketed = df.withColumn("_bucket", bucket)
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # One row per bucket reaches this window.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*[F.col(c) for c in order]))
    start = F.lit(start) if isinstance(start, int) else start
    return (
        bucketed.withColumn("_place", place)
        .join(offsets, "_bucket")
        .withColumn(name, (start + F.col("_before") + F.col("_place") - 1).cast("bigint"))
        .select(*df.columns, name)
    )


def hashed_ids(
    df: DataFrame, keys: Sequence[str], name: str = "row_id", start: int | Column = 0, buckets: int | None = None
) -> DataFrame:
    """Dense numbers in no meaningful order. ``keys`` must tell rows apart; each bucket holds an even share."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets or buckets_for(df.count())))
    return _number(df, bucket, keys, name, start)


def ordered_ids(df: DataFrame, key: str, name: str = "row_id", start: int = 0, ranges: int | None = None) -> DataFrame:
    """Dense numbers in the order of one unique numeric key.

    Rows go to key ranges cut at approximate quantiles, so ranges stay even for unevenly spread keys.
    """
    ranges = ranges or buckets_for(df.select(key).count())
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.approxQuantile(key, shares, 0.1 / ranges) if shares else []
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=key, outputCol="_range", handleInvalid="keep").transform(df)
    return _number(ranged, F.col("_range").cast("bigint"), [key], name, start).select(*df.columns, name)


def max_id(df: DataFrame, key: str) -> DataFrame:
    """The largest number among text keys; keys that are no numbers do not count."""
    return df.agg(F.max(F.col(key).try_cast("bigint")).alias("max_id"))
