"""Unions by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """Union of frames with the same columns in any order."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of differently shaped frames: missing columns are null, ``tag`` names the origin."""
    if not frames:
        raise ValueError("nothing to union")
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def pool(existing: DataFrame, added: DataFrame, columns: list[str]) -> DataFrame:
    """Old and new entities as one pool."""
    return existing.select(*columns).unionByName(added.select(*columns))


def active_or_all(df: DataFrame, status: str, active: str = "Active") -> DataFrame:
    """Active rows, or every row when none is active."""
    active_rows = df.where(F.col(status) == active)
    n_active = active_rows.select(F.count("*")).scalar()
    return df.where((F.col(status) == active) | (n_active == 0))
