"""Pivots, unpivots and the most frequent value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value) of every value of several columns, nulls left out; duplicates go before the shuffle."""
    tagged = F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    return df.select(tagged.alias("pair")).select("pair.*").where("value is not null").distinct()


def distinct_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The sorted values of several columns, as names for the columns of a wide table.

    They come to the driver because column names are part of a plan. A category with very many values belongs in the long form,
    ``long_counts``, which has no such need.
    """
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in category_values(df, columns).toLocalIterator():
        found[row["name"]].append(row["value"])
    return {name: sorted(values) for name, values in found.items()}


def long_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, category, value, count): the counters of a pivot as rows, for any number of values."""
    tagged = F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    return (df.select(key, tagged.alias("pair")).where("pair.value is not null")
            .groupBy(key, "pair.category", "pair.value").agg(F.count("*").alias("count")))


def count_columns(column: str, values: Sequence, prefix: str, suffix: str = "_count") -> list[Column]:
    """One counter per value, for use inside ``agg``."""
    return [
        F.count_if(F.col(column) == F.lit(v)).alias(f"{prefix}_{str(v).lower() if isinstance(v, bool) else v}{suffix}")
        for v in values
    ]


def pivot_first(df: DataFrame, key: str, column: str, values: Sequence, measures: dict[str, str]) -> DataFrame:
    """Spread rows unique per (key, column) over columns; ``measures`` maps a measure to its name pattern.

    Only one row has each value, so ``max`` picks it, and unlike ``first`` it cannot depend on row order.
    """
    picks = [
        F.coalesce(F.max(F.when(F.col(column) == F.lit(v), F.col(m))), F.lit(0)).alias(pattern.format(v))
        for m, pattern in measures.items() for v in values
    ]
    return df.groupBy(key).agg(*picks)


def unpivot_counts(
    df: DataFrame, key: str, prefix: str, suffix: str, label: str, value: str = "count"
) -> DataFrame:
    """Wide counters to (key, label, count), the name stripped of prefix and suffix."""
    wide = counter_names(df.columns, prefix, suffix)
    renamed = df.select(key, *[F.col(f"`{c}`").alias(label_of(c, prefix, suffix)) for c in wide])
    return renamed.unpivot([key], [f"`{label_of(c, prefix, suffix)}`" for c in wide], label, value)


def counter_names(columns: Sequence[str], prefix: str, suffix: str) -> list[str]:
    names = [c for c in columns if c.startswith(prefix) and c.endswith(suffix) and len(c) > len(prefix) + len(suffix)]
    if not names:
        raise ValueError(f"no column named {prefix}...{suffix}")
    return names


def label_of(name: str, prefix: str, suffix: str) -> str:
    return name[len(prefix):len(name) - len(suffix)]


def top_label(df: DataFrame, prefix: str, suffix: str) -> Column:
    """The label of a row's largest counter, the first by name on a tie.

    The counters of a key already share a row, so this needs neither an unpivot nor a window.
    """
    wide = sorted(counter_names(df.columns, prefix, suffix), key=lambda c: label_of(c, prefix, suffix))
    counts = F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint") for c in wide])
    labels = F.array(*[F.lit(label_of(c, prefix, suffix)) for c in wide])
    return F.element_at(labels, F.array_position(counts, F.array_max(counts)).cast("int"))


def top_value(value: Column, weight: Column) -> Column:
    """Aggregate: the value with the largest weight, ties by value with null first."""
    return F.min_by(value, F.struct((-weight).alias("w"), value.alias("v")))
