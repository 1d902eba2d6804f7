"""Bloom filters of stored keys, to tell new keys apart without reading the table.

A filter belongs to one partition of a keyed store. Its bits are kept as bitmaps of a few kilobytes, one row each, made by Spark's bitmap aggregates; a load adds the
bitmaps of its own keys as a batch and a reader joins them by OR. A key that misses one of its bits is new for certain; only keys that have all of them
are looked up in the table, in the partitions they can lie in. So a daily batch of new keys reads a few bitmaps and hardly any partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.keyed_store import KeyedStore, find_keys, part_of
from tripmart.operators.lookup import settle

HASHES = 5
BITMAP = 32_768  # bits in one bitmap of Spark's
BITS_PER_KEY = 10  # with five hashes, one key in a hundred passes without being stored


@dataclass(frozen=True)
class KeyFilter:
    path: str
    keys: tuple[str, ...]
    parts: int
    bits: int  # of one partition


def bits_for(rows_per_part: int) -> int:
    """Bits of a partition's filter, whole bitmaps."""
    return max(1, -(-rows_per_part * BITS_PER_KEY // BITMAP)) * BITMAP


def _places(rows: DataFrame, keys: Sequence[str], parts: int, bits: int, *more: str) -> DataFrame:
    """One row for each bit of each key: its partition, bitmap and place."""
    place = F.explode(F.array(*[F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(bits)) + 1 for i in range(HASHES)]))
    spread = rows.select(*more, part_of(keys, parts).alias("part"), place.alias("_n"))
    return spread.select(*more, "part", F.bitmap_bucket_number("_n").alias("bitmap"), F.bitmap_bit_position("_n").alias("bit"))


def add_keys(filt: KeyFilter, rows: DataFrame, batch: int) -> None:
    """Add the keys of one load; a load that is repeated replaces its batch."""
    marked = _places(rows, filt.keys, filt.parts, filt.bits).groupBy("part", "bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
    marked.write.mode("overwrite").parquet(f"{filt.path}/batch={batch}")


def create_filter(spark: SparkSession, store: KeyedStore, stored: DataFrame, path: str, rows_per_part: int, batch: int = 0) -> KeyFilter:
    """The filter of a store that holds ``stored``; ``rows_per_part`` should leave room for the keys to come."""
    filt = KeyFilter(path, store.keys, store.parts, bits_for(rows_per_part))
    add_keys(filt, stored, batch)
    return filt


def merged_filter(spark: SparkSession, filt: KeyFilter) -> DataFrame:
    return spark.read.parquet(filt.path).groupBy("part", "bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_stored(spark: SparkSession, filt: KeyFilter, rows: DataFrame) -> DataFrame:
    """The distinct keys of ``rows`` that have all their bits: those stored, and a few others."""
    keys = list(filt.keys)
    asked = settle(_places(rows.select(*keys).distinct(), keys, filt.parts, filt.bits, *keys), "asked")
    # Only bitmaps that are asked for are merged.
    wanted = asked.select("part", "bitmap").distinct()
    held = (spark.read.parquet(filt.path).join(wanted, ["part", "bitmap"], "left_semi")
            .groupBy("part", "bitmap").agg(F.bitmap_or_agg("bits").alias("bits")))
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("cast(pow(2, bit % 8) as int)").bitwiseAND(byte) > 0
    return (asked.join(held, ["part", "bitmap"]).groupBy(*keys).agg(F.count_if(is_set).alias("_set"))
            .where(F.col("_set") == HASHES).select(*keys))


def new_rows_by_filter(spark: SparkSession, source: DataFrame, store: KeyedStore, filt: KeyFilter) -> DataFrame:
    """Rows of ``source`` whose keys the store does not hold. The filter decides for most, the store's own rows for the rest."""
    batch = settle(source, "batch")
    known = find_keys(spark, store, maybe_stored(spark, filt, batch)).select(*store.keys)
    return batch.join(settle(known, "known"), list(store.keys), "left_anti")
