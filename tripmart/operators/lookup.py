"""Joining a derived lookup table without guessing its size.

Nothing here is broadcast by hand. Spark estimates the size of an aggregate or a join from its inputs, so a
lookup of a thousand rows drawn from a huge table looks huge, and the big side of its join gets shuffled.
Written out first, the lookup has a known file size: below spark.sql.autoBroadcastJoinThreshold Spark sends it
to every executor, above it the join shuffles and adaptive execution splits its hot keys.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripmart.session import new_path


def settle(df: DataFrame, name: str = "lookup") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_table(spark: SparkSession, path: str, read=None) -> DataFrame | None:
    """The table at ``path``, or None if there is no such path. Any other failure, such as an empty folder that a broken
    write left, is an error: taking it for a first load would overwrite what is stored."""
    try:
        return read(path) if read else spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
