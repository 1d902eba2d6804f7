"""Row-count reconciliation and load counters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.lookup import settle
from tripmart.operators.unions import stack

@dataclass(frozen=True)
class Check:
    """What a table should hold: as many rows as its source, or as many keys as the source tells apart.

    ``source`` and ``target`` name tables of the suite. Only source rows with a partner in each table of ``matching`` count;
    it maps such a table to the column they share.
    """
    source: str
    target: str
    distinct: str | None = None
    matching: Mapping[str, str] = field(default_factory=dict)


# {x}_file is the drop that table x was cleaned from. There is one vehicle for each driver.
CHECKS = {
    "trips": Check("trips_file", "trips", distinct="trip_id"),
    "trip_details": Check("trip_details_file", "trip_details", distinct="trip_id"),
    "customers": Check("customers_file", "customers", distinct="customer_id"),
    "drivers": Check("drivers_file", "drivers", distinct="driver_id"),
    "vehicles": Check("drivers_file", "vehicles", distinct="driver_id"),
    "weather_trips": Check("trips", "weather_trips"),
    "located_trips": Check("trips", "located_trips"),
    "fares": Check("located_trips", "fares", matching={"trip_details": "trip_id"}),
    "weather_impact": Check("fares", "weather_impact", matching={"trip_details": "trip_id"}),
    "customer_profile": Check("customers", "customer_profile", matching={"riders": "customer_id"}),
    "customer_preference": Check("customer_profile", "customer_preference", matching={"riders_on_trips": "customer_id"}),
}
# Tables that a check matches against and that follow from others: details of trips that stand in each of these.
RIDERS = {"riders": ("fares",), "riders_on_trips": ("fares", "trips")}


def matched(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The source rows a check expects in its target."""
    rows = tables[check.source]
    for name, key in check.matching.items():
        if name in RIDERS:
            partner = tables["trip_details"]
            for other in RIDERS[name]:
                partner = partner.join(tables[other].select("trip_id"), "trip_id", "left_semi")
        else:
            partner = tables[name]
        rows = rows.join(partner.select(key), key, "left_semi")
    return rows


def balance(table: str, expected: DataFrame, actual: DataFrame, checked_at: dt.datetime, distinct: str | None = None) -> DataFrame:
    """Compare the row counts of two frames; ``distinct`` counts the values of that column of the expected one instead.

    Both counts are one row each, joined as such.
    """
    wanted = F.count_distinct(F.col(distinct)) if distinct else F.count("*")
    counts = expected.agg(wanted.alias("expected_count")).select("expected_count", actual.select(F.count("*")).scalar().alias("actual_count"))
    difference = F.col("expected_count") - F.col("actual_count")
    return counts.select(
        F.lit(table).alias("table_name"), "expected_count", "actual_count", difference.alias("difference"),
        F.when(difference == 0, "Pass").otherwise("Fail").alias("result"), F.lit(checked_at).alias("date"))


def balance_suite(
    spark: SparkSession, tables: dict[str, DataFrame], checked_at: dt.datetime,
    names: Iterable[str] | str = "all", rejects: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """All checks or a chosen list. ``rejects`` holds the rows a cleaning step drops on purpose, by table;
    the check then expects that many fewer."""
    names = list(CHECKS) if names == "all" else list(names)
    unknown = [n for n in names if n not in CHECKS]
    if unknown:
        raise ValueError(f"no balance check for {', '.join(unknown)}")
    results = []
    for name in names:
        check = CHECKS[name]
        result = balance(name, matched(check, tables), tables[check.target], checked_at, check.distinct)
        if rejects and name in rejects:
            dropped = rejects[name].select(F.count("*")).scalar()
            result = result.withColumn("expected_count", F.col("expected_count") - dropped).withColumn(
                "difference", F.col("expected_count") - F.col("actual_count")).withColumn(
                "result", F.when(F.col("difference") == 0, "Pass").otherwise("Fail"))
        results.append(result)
    return stack(*results)


class BalanceError(RuntimeError):
    """A balance check failed."""


def record_balance(results: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append results, then raise if any check failed. The counts run once: the verdict reads the written rows."""
    done = settle(results, "balance")
    done.write.format(fmt).mode("append").save(path)
    failed = [r["table_name"] for r in done.where("result = 'Fail'").select("table_name").collect()]
    if failed:
        raise BalanceError(f"balance checks failed: {', '.join(sorted(failed))}")


def retention_counters(source: DataFrame, kept: Column, metrics: Column | None = None) -> DataFrame:
    """Total, kept, removed, missing-metric and retention counters in one pass."""
    total, n_kept = F.count("*"), F.count_if(kept)
    missing = F.count_if(metrics.isNull()) if metrics is not None else F.lit(0).cast("bigint")
    return source.agg(
        total.alias("total_rows"),
        n_kept.alias("kept_rows"),
        (total - n_kept).alias("removed_rows"),
        missing.alias("null_rows"),
        (total - missing).alias("valid_rows"),
        F.when(total > 0, F.round(n_kept / total * 100, 2)).alias("retention_pct"),
    )


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Counters that ride along with the job that writes ``df``; read them from ``Observation.get`` afterwards."""
    watch = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]]
    return df.observe(watch, *columns), watch
