"""Mart inputs built from the given tables, each by the library's own jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.domain import best_weather, cells, view
from tripmart.operators.lookup import settle
from tripmart.plans import boroughs, customers, fares, weather


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with weather and distance."""
    return weather.attach_distance(weather.attach_weather(view(spark, sf, "trips"), best_weather(spark, sf)))


def located(spark: SparkSession, sf: str) -> DataFrame:
    return boroughs.locate_trips(enriched(spark, sf), cells(spark, sf), view(spark, sf, "trip_details"))


def fare_table(spark: SparkSession, sf: str) -> DataFrame:
    return fares.fares(located(spark, sf), view(spark, sf, "trip_details"))


def stored_fares(spark: SparkSession, sf: str) -> DataFrame:
    """The fares mart written once, as the lake keeps it, for marts that read it more than once."""
    return settle(fare_table(spark, sf), "fares")


def rides(spark: SparkSession, sf: str) -> DataFrame:
    return customers.rides(fare_table(spark, sf), view(spark, sf, "trip_details"))


def profile(spark: SparkSession, sf: str, fare: DataFrame | None = None) -> DataFrame:
    return customers.customer_profile(
        view(spark, sf, "customers"), stored_fares(spark, sf) if fare is None else fare, view(spark, sf, "trip_details"))
