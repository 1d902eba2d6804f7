"""Binning of numeric readings into labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin edges and labels of the weather categories.
RAIN = ((0.1, 2, 10), ("No Rain", "Slight Rain", "Medium Rain", "Heavy Rain"))
SNOW = ((0.1, 1, 5), ("No Snow", "Slight Snow", "Medium Snow", "Heavy Snow"))
WIND = ((5, 20, 40), ("Calm", "Slight Wind", "Windy", "Heavy Wind"))
TEMPERATURE = (
    (0, 5, 15, 25, 35, 40),
    ("Freezing", "Very Cold", "Cool", "Mild", "Warm", "Hot", "Extreme Heat"),
)
EXTREME_RAIN = ("Medium Rain", "Heavy Rain")
EXTREME_SNOW = ("Medium Snow", "Heavy Snow")
EXTREME_WIND = ("Heavy Wind",)
EXTREME_TEMPERATURE = ("Freezing", "Very Cold", "Hot", "Extreme Heat")


def categorize(
    value: Column,
    bins: Sequence[float],
    labels: Sequence[str],
    closed: str = "right",
    null_label: str | None = "Unknown",
) -> Column:
    """Label a number by ascending edges; ``closed`` names the end of a bin that holds its edge.

    The branches run in order, so each needs only its upper edge. NaN is above every edge.
    """
    if len(labels) != len(bins) + 1:
        raise ValueError("labels must be one longer than bins")
    if closed not in ("right", "left"):
        raise ValueError("closed must be right or left")
    label = F.when(value.isNull(), F.lit(null_label))
    for edge, name in zip(bins, labels):
        label = label.when(value <= edge if closed == "right" else value < edge, F.lit(name))
    return label.otherwise(F.lit(labels[-1]))


def is_weather_extreme(rain: Column, snow: Column, wind: Column, temperature: Column) -> Column:
    return (
        rain.isin(*EXTREME_RAIN)
        | snow.isin(*EXTREME_SNOW)
        | wind.isin(*EXTREME_WIND)
        | temperature.isin(*EXTREME_TEMPERATURE)
    )


def or_unknown(value: Column) -> Column:
    """A group label as text. The cast comes first: ANSI mode would cast the label to a number instead."""
    return F.coalesce(value.cast("string"), F.lit("Unknown"))
