"""Rule-based fares as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import lookup
from tripmart.functions.categories import RAIN, SNOW, TEMPERATURE, WIND, categorize
from tripmart.operators.lookup import settle

# The price list.
BASE_FARE = 2.5
PER_KM = {"petrol": 1.75, "diesel": 1.65, "hybrid": 1.55, "ev": 1.45}
PER_MINUTE = 0.35
FUEL_SURCHARGE = {"petrol": 0.25, "diesel": 0.20, "hybrid": 0.15, "ev": 0.05}
YEARLY_INCREASE = 0.03
HALF_YEAR_INCREASE = 0.015
FIRST_YEAR = 2009
WEEKEND_FACTOR = 1.15
LATE_NIGHT_FACTOR = 1.20
RUSH_FACTOR = 1.15
EXTRA_PASSENGER = 0.5
FREE_PASSENGERS = 2
MIN_FARE = 4.0
RAIN_FACTORS = {"No Rain": 1.00, "Slight Rain": 1.05, "Medium Rain": 1.10, "Heavy Rain": 1.20}
SNOW_FACTORS = {"No Snow": 1.00, "Slight Snow": 1.10, "Medium Snow": 1.20, "Heavy Snow": 1.30}
WIND_FACTORS = {"Calm": 1.00, "Slight Wind": 1.03, "Windy": 1.07, "Heavy Wind": 1.12}
TEMPERATURE_FACTORS = {
    "Freezing": 1.15, "Very Cold": 1.10, "Cool": 1.05, "Mild": 1.00, "Warm": 1.03, "Hot": 1.07, "Extreme Heat": 1.12,
}
SHORT_TRIP_KM = 1.5
LONG_TRIP_KM = 30


def is_rush(at: Column) -> Column:
    hour = F.hour(at)
    return hour.between(7, 9) | hour.between(16, 18)


def time_factor(at: Column) -> Column:
    """Weekend (Friday 18:00 to Sunday 23:00), late night (22:00 to 5:00) and rush hours multiply."""
    hour, day = F.hour(at), F.dayofweek(at)
    weekend = ((day == 6) & (hour >= 18)) | (day == 7) | ((day == 1) & (hour < 23))
    late = (hour >= 22) | (hour < 5)
    factor = lambda holds, value: F.when(holds, F.lit(value)).otherwise(F.lit(1.0))
    return factor(weekend, WEEKEND_FACTOR) * factor(late, LATE_NIGHT_FACTOR) * factor(is_rush(at), RUSH_FACTOR)


def inflation(at: Column) -> Column:
    """Yearly and half-yearly increases since the first year, compounded."""
    years = F.year(at) - FIRST_YEAR
    halves = F.floor((years * 12 + F.month(at) - 1) / F.lit(6))
    return F.pow(F.lit(1 + YEARLY_INCREASE), years) * F.pow(F.lit(1 + HALF_YEAR_INCREASE), halves)


def passenger_surcharge(passengers: Column) -> Column:
    """A missing count is one passenger."""
    return F.greatest(F.coalesce(passengers, F.lit(1)) - FREE_PASSENGERS, F.lit(0)) * F.lit(EXTRA_PASSENGER)


def at_least(price: Column) -> Column:
    """The minimum fare holds for a price; a price that cannot be told stays null."""
    return F.when(price.isNotNull(), F.greatest(price, F.lit(MIN_FARE)))


def weather_factor(rain: Column, snow: Column, wind: Column, fahrenheit: Column) -> Column:
    """Product of four category factors; a missing reading counts as ordinary weather.

    Pricing bins hold their lower edge, unlike the mart's, and read the temperature as Fahrenheit.
    """
    factor = lambda factors, label: F.coalesce(lookup(factors, label), F.lit(1.0))
    celsius = (fahrenheit - 32) * 5 / 9
    return (
        factor(RAIN_FACTORS, categorize(rain, *RAIN, closed="left"))
        * factor(SNOW_FACTORS, categorize(snow, *SNOW, closed="left"))
        * factor(WIND_FACTORS, categorize(wind, *WIND, closed="left"))
        * factor(TEMPERATURE_FACTORS, categorize(celsius, *TEMPERATURE))
    )


def metered(km: Column, minutes: Column, fuel: Column, km_factor: Column | None = None,
            minute_factor: Column | None = None) -> Column:
    """Base, distance, time and fuel surcharge before inflation."""
    distance = km * lookup(PER_KM, fuel)
    time = minutes * F.lit(PER_MINUTE)
    distance = distance if km_factor is None else distance * km_factor
    time = time if minute_factor is None else time * minute_factor
    return F.lit(BASE_FARE) + distance + time + lookup(FUEL_SURCHARGE, fuel)


def fare(km: Column, minutes: Column, at: Column, passengers: Column, fuel: Column, weather: Column) -> Column:
    """Honest fare; ``weather`` is the weather factor."""
    full = metered(km, minutes, fuel) * inflation(at) * time_factor(at) * weather + passenger_surcharge(passengers)
    return at_least(full)


def overcharge(km: Column, minutes: Column, at: Column, fuel: Column, km_factor: Column,
               minute_factor: Column) -> Column:
    """Inflated fare: short trips stretch the distance, long ones the time, others both.

    It replaces the whole fare, so time, weather and passenger rules no longer apply.
    """
    one = F.lit(1.0)
    stretched = metered(
        km, minutes, fuel,
        F.when(km > LONG_TRIP_KM, one).otherwise(km_factor), F.when(km < SHORT_TRIP_KM, one).otherwise(minute_factor))
    return at_least(stretched * inflation(at))


def price_trips(trips: DataFrame, weather: DataFrame, overcharged: Column | None = None) -> DataFrame:
    """Add ``fare`` to trips with distance_km, trip_duration_min, fuel_type, passenger_count and pickup_datetime.

    Dates without weather get factor 1. ``overcharged`` marks rows to inflate by their km_factor and minute_factor.
    """
    factor = weather_factor(
        F.col("precipitation"), F.col("avg_snow_fall"), F.col("avg_wind_speed"), F.col("avg_temp"))
    # Stored, the factors have a size Spark knows, and no busy date has to be gathered in one task.
    factors = settle(weather.select(F.col("date").alias("_date"), factor.alias("_weather")), "factors")
    at = F.col("pickup_datetime")
    km, minutes, fuel = F.col("distance_km"), F.col("trip_duration_min"), F.col("fuel_type")
    joined = trips.withColumn("_day", F.to_date(at)).join(factors, F.col("_day") == F.col("_date"), "left")
    honest = ~F.coalesce(overcharged, F.lit(False)) if overcharged is not None else F.lit(True)
    one, zero = F.lit(1.0), F.lit(0.0)
    # One expression for both kinds of fare, as columns of their own: a rate or a price that is written twice is computed twice.
    parts = joined.withColumns({
        "_honest": honest, "_rate": lookup(PER_KM, fuel), "_extra": lookup(FUEL_SURCHARGE, fuel), "_inflation": inflation(at)})
    if overcharged is None:
        stretch = linger = one
    else:
        stretch = F.when(F.col("_honest") | (km > LONG_TRIP_KM), one).otherwise(F.col("km_factor"))
        linger = F.when(F.col("_honest") | (km < SHORT_TRIP_KM), one).otherwise(F.col("minute_factor"))
    meter = F.lit(BASE_FARE) + km * F.col("_rate") * stretch + minutes * F.lit(PER_MINUTE) * linger + F.col("_extra")
    rules = F.when(F.col("_honest"), time_factor(at)).otherwise(one)
    weathered = F.when(F.col("_honest"), F.coalesce("_weather", one)).otherwise(one)
    surcharge = F.when(F.col("_honest"), passenger_surcharge(F.col("passenger_count"))).otherwise(zero)
    priced = parts.withColumn("_price", meter * F.col("_inflation") * rules * weathered + surcharge)
    return priced.withColumn("fare", at_least(F.col("_price"))).select(*trips.columns, "fare")
