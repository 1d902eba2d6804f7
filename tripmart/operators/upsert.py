"""Keyed upsert and versioned snapshots over plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.lookup import settle


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None,
    small_source: bool = True,
) -> DataFrame:
    """Update rows whose keys match, insert the others, keep unmatched target rows.

    Two source rows with one non-null key raise when the upsert is built. Null keys match nothing, so such rows are inserted.
    The source is computed once, into the shared folder. With ``small_source`` the target is only ever the big side of a left
    and a semi join, so Spark can send the source to it instead of shuffling it. Otherwise one full join shuffles each side once.
    """
    keys = list(keys)
    missing = set(source.columns) ^ set(target.columns)
    if missing:
        raise ValueError(f"source and target differ in columns: {', '.join(sorted(missing))}")
    values = [c for c in target.columns if c not in keys]
    changed = values if update_columns is None else list(update_columns)
    unknown = [c for c in changed if c not in values]
    if unknown:
        raise ValueError(f"cannot update {', '.join(unknown)}")

    source = settle(source, "upsert")
    keyed = source.dropna(subset=keys)
    # Partial counts leave one row per key and task, so a key repeated a million times costs no more than twice.
    twice = keyed.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    if not twice.isEmpty():
        raise ValueError("the upsert source holds a key more than once")
    one = keyed.select(*keys, F.struct(*values).alias("_new"), F.lit(True).alias("_given"))

    hit = F.col("_given").isNotNull()

    def merged(held) -> list:
        new = lambda c: hit if c in changed else hit & ~held
        return [F.when(new(c), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns]

    if small_source:
        updated = target.join(one, keys, "left").select(*merged(F.lit(True)))
        known = target.select(*keys).join(keyed.select(*keys), keys, "left_semi")
        inserted = keyed.join(known, keys, "left_anti").select(*target.columns)
        rows = updated.unionByName(inserted)
    else:
        both = target.withColumn("_held", F.lit(True)).join(one, keys, "full")
        rows = both.select(*merged(F.col("_held").isNotNull()))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return rows.unionByName(source.where(null_key).select(*target.columns))


def merge_delta(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                update_columns: Sequence[str] | None = None) -> None:
    """The same upsert in place, where Delta Lake is on the classpath."""
    from delta.tables import DeltaTable

    changed = [c for c in source.columns if c not in keys] if update_columns is None else list(update_columns)
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    (
        DeltaTable.forPath(spark, path).alias("t").merge(source.alias("s"), on)
        .whenMatchedUpdate(set={c: f"s.`{c}`" for c in changed})
        .whenNotMatchedInsert(values={c: f"s.`{c}`" for c in source.columns})
        .execute()
    )


def commit_version(df: DataFrame, path: str, version: int) -> None:
    """Store ``df`` as one version; a repeated commit of a version replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions, ``version`` being a partition column, so a filter on it reads one folder."""
    return spark.read.parquet(path)


def history(table: DataFrame) -> DataFrame:
    """Rows per version, all in one job."""
    return table.groupBy("version").agg(F.count("*").alias("record_count"))


def as_of(table: DataFrame, version: int) -> DataFrame:
    return table.where(F.col("version") == version).drop("version")


def latest(table: DataFrame) -> DataFrame:
    newest = table.select(F.max("version")).scalar()
    return table.where(F.col("version") == newest).drop("version")


def restore(spark: SparkSession, path: str, version: int) -> int:
    """Append an old version as the newest one and return its number."""
    table = versions(spark, path)
    newest = table.agg(F.max("version")).first()[0]
    old = as_of(table, version)
    if old.isEmpty():
        raise ValueError(f"version {version} does not exist")
    commit_version(old, path, newest + 1)
    return newest + 1
