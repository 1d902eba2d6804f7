"""Writing tables: load modes, staged publishing, databases, dated batches and write reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.keys import ordered_ids
from tripmart.paths import Lake

# Database schema of each exported table.
EXPORT_SCHEMAS = {
    "fares": "fares", "weather_impact": "fares", "time_series": "fares",
    "customers": "raw", "drivers": "raw", "vehicles": "raw",
    "customer_preference": "people", "customer_profile": "people",
}
# Within the 100,000 to 200,000 rows of a daily drop.
ROWS_PER_DROP = 150_000


def mode_for(loadtype: str) -> str:
    if loadtype not in ("full", "delta"):
        raise ValueError(f"loadtype must be full or delta, not {loadtype!r}")
    return "append" if loadtype == "delta" else "overwrite"


def write_table(df: DataFrame, path: str, loadtype: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode(mode_for(loadtype)).save(path)


def publish(
    df: DataFrame, lake: Lake, table: str, layer: str, loadtype: str, date: dt.date | str, fmt: str = "parquet"
) -> DataFrame:
    """Write a dated snapshot, read it back, write the published table from it.

    The snapshot breaks the cycle of a job that reads the table it replaces, and a failed publish can be redone
    from it without the sources.
    """
    staged = lake.snapshot(table, layer, date)
    df.write.mode("overwrite").parquet(staged)
    write_table(df.sparkSession.read.schema(df.schema).parquet(staged), lake.current(table, layer, fmt), loadtype, fmt)
    return df.sparkSession.read.format(fmt).load(lake.current(table, layer, fmt))


def publish_days(df: DataFrame, path: str, date: str = "date", files_per_day: int = 1) -> None:
    """Write a table with a folder for each day. Days that ``df`` holds replace their folders, all other days stay as they are.

    A repeated publish of a day replaces it, so a restated day is published like a new one. Rows without a date keep a folder of their own.
    ``files_per_day`` lets several tasks write a busy day.
    """
    share = F.pmod(F.xxhash64(*[c for c in df.columns if c != date]), F.lit(files_per_day))
    dealt = df.repartition(F.col(date), share) if files_per_day > 1 else df.repartition(date)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def jdbc_target(url: str, table: str, schema: str | None = None, properties: dict[str, str] | None = None) -> dict:
    return {"url": url, "dbtable": f"{schema}.{table}" if schema else table, **(properties or {})}


def write_jdbc(
    df: DataFrame, url: str, table: str, schema: str | None = None, loadtype: str = "full",
    properties: dict[str, str] | None = None,
) -> None:
    """Write to a database the caller names; set ``numPartitions`` in the properties to bound the connections."""
    df.write.format("jdbc").options(**jdbc_target(url, table, schema, properties)).mode(mode_for(loadtype)).save()


def export_marts(
    tables: dict[str, DataFrame], write: Callable[[DataFrame, str, str], None], names: Iterable[str] | str = "all",
    schemas: dict[str, str] = EXPORT_SCHEMAS,
) -> list[str]:
    """Send marts to a database. ``write`` takes (frame, table, schema), as ``write_jdbc`` bound to a URL does."""
    names = list(schemas) if names == "all" else list(names)
    unknown = [n for n in names if n not in schemas]
    if unknown:
        raise ValueError(f"no export schema for {', '.join(unknown)}")
    for name in names:
        write(tables[name], name, schemas[name])
    return names


def dated_batches(df: DataFrame, key: str, start: dt.date, rows: int = ROWS_PER_DROP) -> DataFrame:
    """Give each run of ``rows`` rows in key order a day of its own."""
    numbered = ordered_ids(df, key, "_row")
    day = F.date_add(F.lit(start), F.floor(F.col("_row") / F.lit(rows)).cast("int"))
    return numbered.withColumn("batch_date", day).drop("_row")


def write_batches(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One folder per batch date."""
    df.write.mode("overwrite").option("header", True).partitionBy("batch_date").format(fmt).save(path)


def write_report(df: DataFrame, file: str) -> DataFrame:
    """Records per written file and a TOTAL row; the total adds up the files, not the rows again."""
    total = F.grouping(file) == 1
    n = F.sum("_n")
    return df.groupBy(file).agg(F.count("*").alias("_n")).rollup(file).agg(
        F.when(total, "TOTAL").otherwise(F.col(file).cast("string")).alias("_file"),
        n.alias("records"),
        F.when(total, "").otherwise("Success").alias("status"),
        F.when(total, F.concat(F.count("*").cast("string"), F.lit(" files generated")))
        .otherwise(F.concat(F.lit("Created with "), n.cast("string"), F.lit(" records"))).alias("message"),
    ).select(F.col("_file").alias("file"), "records", "status", "message")
