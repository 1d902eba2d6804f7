"""Stored states of aggregates: sums and counts by key, to which each load adds the state of its own rows.

A state is a table of keys and additive measures. Every load writes one batch, under its own number, so a load that is repeated replaces its batch and nothing
counts twice. A reader adds up the batches; measures that a batch lacks count as nothing. Now and then the batches are compacted into a base that holds
all of them up to a number; readers take the newest base and the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def add_batch(state: DataFrame, path: str, batch: int) -> None:
    """Store the state of one load."""
    state.write.mode("overwrite").parquet(f"{path}/batches/batch={batch}")


def _all(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest_base(spark: SparkSession, path: str) -> int:
    bases = _all(spark, f"{path}/bases")
    # The numbers are folder names, so this reads no rows.
    return -1 if bases is None else bases.select("upto").distinct().agg(F.max("upto")).first()[0]


def merged_state(spark: SparkSession, path: str, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """The sum of all batches, or of those up to a number, per key. Null measures stay null where no batch has a value."""
    base = _newest_base(spark, path)
    parts = []
    if base >= 0:
        parts.append(_all(spark, f"{path}/bases").where(F.col("upto") == base).drop("upto"))
    batches = _all(spark, f"{path}/batches")
    if batches is not None:
        wanted = F.col("batch") > base if upto is None else (F.col("batch") > base) & (F.col("batch") <= upto)
        parts.append(batches.where(wanted).drop("batch"))
    if not parts:
        raise ValueError(f"no state at {path}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    measures = [c for c in rows.columns if c not in keys]
    # Map-side sums leave one row for each key and task before the shuffle.
    return rows.groupBy(*keys).agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in measures])


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Store the sum of all batches as a base and return the last batch it holds. Older folders may be removed once no reader needs them."""
    batches = _all(spark, f"{path}/batches")
    last = None if batches is None else batches.agg(F.max("batch")).first()[0]
    if last is None:
        raise ValueError(f"no state at {path}")
    if last > _newest_base(spark, path):
        merged_state(spark, path, keys, last).write.mode("overwrite").parquet(f"{path}/bases/upto={last}")
    return last
