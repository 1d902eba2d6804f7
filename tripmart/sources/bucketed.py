"""Tables stored in buckets of a key, so that joins on the key need no shuffle.

Every table of a lake that is joined by trip id is written once in the same number of buckets; a join of two such tables reads bucket n of both in one
task. The catalog of a session knows a table by its name and folder; ``open_bucketed`` tells a new session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BYTES_PER_BUCKET = 512 << 20


def buckets_for_bytes(size: int) -> int:
    """A power of two, so that tables of different sizes still share a divisor of their buckets."""
    buckets = 1
    while buckets * BYTES_PER_BUCKET < size:
        buckets *= 2
    return buckets


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write and register a table with one sorted file for each bucket."""
    # The shuffle places rows as the buckets do, so each task writes one file.
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, path: str, table: str, key: str, buckets: int, schema: StructType) -> DataFrame:
    """Register a table that another session wrote."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(table)
