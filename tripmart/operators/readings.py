"""Reducing hourly readings to days, with a least number of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.pivots import top_value

# Fixed value: a day with fewer readings than this gets null.
MIN_READINGS = 12


def supported_avg(value: Column, least: int = MIN_READINGS) -> Column:
    return F.when(F.count(value) >= least, F.avg(value))


def reduce_readings(
    readings: DataFrame,
    keys: Sequence[str],
    averages: dict[str, str],
    sums: dict[str, str] | None = None,
    mode: tuple[str, str] | None = None,
    least: int = MIN_READINGS,
) -> DataFrame:
    """Averages, sums and the most frequent code per group; maps and pairs read (input, output).

    The first grouping adds the code to the keys and keeps partial sums, so no task ever holds the readings or
    the codes of a group. The mode takes the smallest of equally frequent codes.
    """
    sums = sums or {}
    keys = list(keys)
    inputs = sorted({*averages, *sums})
    partial = readings.groupBy(*keys, *([mode[0]] if mode else [])).agg(
        F.count("*").alias("_rows"),
        *[F.sum(c).alias(f"_sum_{c}") for c in inputs],
        *[F.count(c).alias(f"_n_{c}") for c in inputs],
    )
    out = []
    for c, name in averages.items():
        n = F.sum(f"_n_{c}")
        out.append(F.when(n >= least, F.sum(f"_sum_{c}") / n).alias(name))
    for c, name in sums.items():
        out.append(F.coalesce(F.sum(f"_sum_{c}"), F.lit(0.0)).alias(name))
    if mode:
        code = F.col(mode[0])
        seen = F.sum(F.when(code.isNotNull(), F.col("_rows")).otherwise(0))
        weight = F.when(code.isNotNull(), F.col("_rows")).otherwise(-1)
        out.append(F.when(seen >= least, top_value(code, weight)).alias(mode[1]))
    return partial.groupBy(*keys).agg(*out)
