"""Reproducible synthetic entities, trips and trip details.

Every value is a hash of the row's key, so rows are made wherever Spark puts them and come out the same each time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.chance import draw, happens, uniform, weighted_choice
from tripmart.functions.sphere import great_circle_km
from tripmart.functions.us_states import STATE_CENTRES
from tripmart.operators.keys import hashed_ids
from tripmart.operators.lookup import settle
from tripmart.operators.unions import active_or_all, pool, stack
from tripmart.plans import pricing

# Categories and their weights.
PAYMENT_METHODS = ("Credit Card", "Debit Card", "Cash", "Digital Wallet", "Corporate Account")
PREFERRED_PAYMENTS = ("Credit Card", "Debit Card", "Digital Wallet", "Cash")
TRIP_STATUSES = {"Completed": 8, "Cancelled": 1, "No Show": 1}
RATINGS = {None: 1, 1.0: 1, 1.5: 1, 2.0: 1, 2.5: 1, 3.0: 2, 3.5: 3, 4.0: 2, 4.5: 1, 5.0: 3}
TRIP_INTENTIONS = {
    "Commute": 250, "Business": 150, "Leisure": 120, "Errand": 100, "Airport Transfer": 80, "Social/Visiting": 70,
    "Dining": 50, "Shopping": 50, "Medical/Healthcare": 40, "School/Education": 30, "Event/Entertainment": 30,
    "Tourism/Sightseeing": 20, "Hotel Transfer": 10, "Ride Pooling/Shared": 10, "Religious": 5,
    "Exercise/Outdoor": 5, "Delivery": 5, "Relocation/Move": 5, "Other": 10,
}
# Words in a location, the intention they suggest, and how often it replaces the drawn one.
INTENTION_RULES = (
    (("Airport",), "Airport Transfer", 0.70),
    (("Hotel",), "Hotel Transfer", 0.60),
    (("Tourism", "Sightseeing"), "Tourism/Sightseeing", 0.65),
    (("Medical", "Healthcare"), "Medical/Healthcare", 0.75),
    (("School", "University"), "School/Education", 0.80),
)
CUSTOMER_TYPES = ("Regular", "Premium", "Corporate", "Student")
MEMBERSHIP = {"Active": 7, "Inactive": 1, "Suspended": 1}
EXPERIENCE = ("Trainee", "Junior", "Senior", "Expert", "Master")
DRIVER_STATUS = {"Active": 10, "On Leave": 1, "Inactive": 1}
VEHICLE_MODELS = (
    "Toyota Camry", "Honda Civic", "Ford F-150", "Chevrolet Silverado", "Tesla Model 3", "Nissan Altima",
    "Hyundai Elantra", "BMW 3 Series", "Audi A4", "Mercedes-Benz C-Class", "Volkswagen Jetta", "Subaru Outback",
    "Mazda CX-5", "Jeep Wrangler", "GMC Sierra", "Ram 1500", "Tesla Model S", "Lexus ES", "Acura TLX",
    "Infiniti Q50", "Toyota Prius", "Nissan NV200", "Ford Transit Connect", "Chevrolet Impala", "Honda Accord",
    "Toyota Sienna", "Chrysler Pacifica", "Ford Escape", "Kia Optima", "Hyundai Sonata", "Lincoln Town Car",
    "Cadillac XTS", "Mercedes-Benz Sprinter",
)
VEHICLE_TYPES = ("Sedan", "SUV", "Hatchback", "Pickup Truck", "Electric", "Luxury", "Minivan", "Van")
FUEL_TYPES = ("Gasoline", "Electric", "Hybrid", "Diesel")
HYBRID_SHARE = 0.2
SEATS = (4, 5, 6, 7, 8)
COLORS = ("White", "Black", "Silver", "Gray", "Blue", "Red", "Green", "Brown", "Yellow")
VEHICLE_STATUS = {"Active": 6, "Maintenance": 1, "Out of Service": 1}
TRIP_FUELS = {"petrol": 35, "diesel": 35, "hybrid": 20, "ev": 10}
PASSENGERS = {1: 60, 2: 25, 3: 8, 4: 4, 5: 2, 6: 1}
SAME_AREA_SHARE = 0.7
FIRST_PICKUP = dt.datetime(2009, 1, 1)
LAST_PICKUP = dt.datetime(2015, 12, 31)
OVERCHARGE_SHARE = 0.015
SHORT_KM_FACTOR = (1.15, 1.8)
LONG_MINUTE_FACTOR = (1.1, 1.6)
MEDIUM_KM_FACTOR = (1.05, 1.3)
MEDIUM_MINUTE_FACTOR = (1.05, 1.4)
# Trips that one task makes up.
IDS_PER_TASK = 20_000


def _one_decimal(key: Column, salt: str, low: float, high: float) -> Column:
    return F.round(uniform(key, salt, low, high), 1)


def _day(key: Column, salt: str, first: dt.date, last: dt.date) -> Column:
    return F.date_add(F.lit(first), draw(key, salt, (last - first).days + 1).cast("int"))


def with_new_ids(rows: DataFrame, existing: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Number new rows from the largest existing id on; ``by`` tells the rows apart."""
    last = existing.select(F.coalesce(F.max(F.col(key).try_cast("bigint")), F.lit(0))).scalar()
    return hashed_ids(rows, by, key, start=last + 1)


def new_customers(ids: DataFrame, as_of: dt.date) -> DataFrame:
    """Attributes for rows of customer_id."""
    key = F.col("customer_id")
    return ids.select(
        "customer_id", F.concat(F.lit("Customer "), key).alias("customer_name"),
        _day(key, "born", as_of.replace(year=as_of.year - 80), as_of.replace(year=as_of.year - 16)).alias("date_of_birth"),
        _day(key, "joined", dt.date(2009, 1, 1), dt.date(2012, 12, 31)).alias("registration_date"),
        weighted_choice(key, "type", CUSTOMER_TYPES).alias("customer_type"),
        weighted_choice(key, "membership", MEMBERSHIP).alias("membership_status"),
        _one_decimal(key, "rating", 3.0, 5.0).alias("rating"),
        weighted_choice(key, "payment", PREFERRED_PAYMENTS).alias("preferred_payment"),
    )


def new_drivers(ids: DataFrame, as_of: dt.date) -> DataFrame:
    """Attributes for rows of driver_id."""
    key = F.col("driver_id")
    return ids.select(
        "driver_id", F.concat(F.lit("Driver "), key).alias("driver_name"),
        _day(key, "born", as_of.replace(year=as_of.year - 65), as_of.replace(year=as_of.year - 21)).alias("date_of_birth"),
        _day(key, "hired", dt.date(2009, 1, 1), dt.date(2012, 12, 31)).alias("hire_date"),
        weighted_choice(key, "experience", EXPERIENCE).alias("experience_level"),
        _one_decimal(key, "rating", 3.5, 5.0).alias("rating"),
        weighted_choice(key, "status", DRIVER_STATUS).alias("status"),
    )


def fuel_for(model: Column, key: Column) -> Column:
    """Teslas are electric; a Prius, and every fifth other car, is a hybrid; the rest draw any fuel."""
    return F.when(model.contains("Tesla"), "Electric").when(
        model.contains("Prius") | happens(key, "hybrid", HYBRID_SHARE), "Hybrid"
    ).otherwise(weighted_choice(key, "fuel", FUEL_TYPES))


def new_vehicles(drivers: DataFrame) -> DataFrame:
    """One vehicle for each driver_id."""
    key = F.col("driver_id")
    modelled = drivers.select("driver_id", weighted_choice(key, "model", VEHICLE_MODELS).alias("model"))
    return modelled.select(
        F.concat(F.lit("V-"), key).alias("vehicle_no"), "driver_id", "model",
        (F.lit(2009) + draw(key, "year", 7)).cast("int").alias("year"),
        weighted_choice(key, "color", COLORS).alias("color"),
        weighted_choice(key, "vehicle", VEHICLE_TYPES).alias("vehicle_type"),
        fuel_for(F.col("model"), key).alias("fuel_type"),
        weighted_choice(key, "seats", SEATS).alias("seating_capacity"),
        (F.lit(15000) + draw(key, "mileage", 185001)).cast("int").alias("mileage"),
        _day(key, "insured", dt.date(2009, 1, 1), dt.date(2015, 12, 31)).alias("insurance_expiry"),
        _day(key, "serviced", dt.date(2012, 1, 1), dt.date(2015, 12, 31)).alias("last_maintenance"),
        weighted_choice(key, "status", VEHICLE_STATUS).alias("status"),
        weighted_choice(key, "state", [name for name, *_ in STATE_CENTRES]).alias("registration_state"),
    )


def assign(trips: DataFrame, pools: dict[str, tuple[DataFrame, str]], trip_key: str = "trip_id") -> DataFrame:
    """Give each trip one active entity of each pool, all equally likely. ``pools``: key column to (entities, status column).

    A pool is numbered from zero, stored, and joined on a number drawn for the trip; all numbers are drawn in one pass. The draw is
    even, so no join has a hot key; a pool small enough goes to the trips, which then stay where they are.
    """
    drawn, slots = trips, {}
    for key, (entities, status) in pools.items():
        pool = settle(hashed_ids(active_or_all(entities, status).select(key), [key], f"_{key}"), "pool")
        size = pool.count()
        if not size:
            raise ValueError(f"no entity to draw {key} from")
        slots[key] = pool
        drawn = drawn.withColumn(f"_{key}", draw(F.col(trip_key), f"assign {key}", size))
    for key, pool in slots.items():
        drawn = drawn.join(pool, f"_{key}").drop(f"_{key}")
    return drawn


def distinct_pair(key: Column, salt: str, choices: dict[str, int]) -> tuple[Column, Column]:
    """Two different labels by weight: the second is drawn from the slots the first does not hold."""
    if len(choices) < 2:
        raise ValueError("two different labels need at least two choices")
    slots = F.array(*[F.lit(label) for label, w in choices.items() for _ in range(w)])
    total = sum(choices.values())
    starts, at = {}, 0
    for label, w in choices.items():
        starts[label], at = at, at + w
    literal = lambda d: F.create_map(*[F.lit(x) for item in d.items() for x in item])
    first = F.element_at(slots, (draw(key, f"{salt} first", total) + 1).cast("int"))
    held, start = literal(choices)[first], literal(starts)[first]
    free = draw(key, f"{salt} second", F.lit(total) - held)
    second = F.element_at(slots, (F.when(free >= start, free + held).otherwise(free) + 1).cast("int"))
    return first, second


def conditioned_intention(pickup: Column, dropoff: Column, key: Column) -> Column:
    """A drawn intention, replaced with some probability where a location suggests another."""
    drawn = weighted_choice(key, "intention", TRIP_INTENTIONS)
    ruled = None
    for n, (words, intention, share) in enumerate(INTENTION_RULES):
        named = F.lit(False)
        for word in words:
            named = named | pickup.contains(word) | dropoff.contains(word)
        value = F.when(happens(key, f"rule {n}", share), F.lit(intention)).otherwise(drawn)
        ruled = F.when(named, value) if ruled is None else ruled.when(named, value)
    return ruled.otherwise(drawn)


def trip_details(
    trip_ids: DataFrame, customers: DataFrame, drivers: DataFrame, vehicles: DataFrame, locations: dict[str, int]
) -> DataFrame:
    """Details for each trip_id, drawn from active customers, drivers and vehicles."""
    key = F.col("trip_id")
    staffed = assign(trip_ids.select("trip_id"), {
        "customer_id": (customers, "membership_status"), "driver_id": (drivers, "status"), "vehicle_no": (vehicles, "status")})
    first, second = distinct_pair(key, "place", locations)
    base = uniform(key, "km", 0.5, 50.0) * uniform(key, "rate", 1.5, 3.0)
    placed = staffed.withColumns({"pickup_location": first, "dropoff_location": second})
    return placed.select(
        "trip_id", "driver_id", "customer_id", "vehicle_no", "pickup_location", "dropoff_location",
        F.round(base * uniform(key, "tip", 0.0, 0.25), 2).alias("tip_amount"),
        weighted_choice(key, "payment", PAYMENT_METHODS).alias("payment_method"),
        weighted_choice(key, "status", TRIP_STATUSES).alias("trip_status"),
        weighted_choice(key, "customer rating", RATINGS).alias("customer_rating"),
        weighted_choice(key, "driver rating", RATINGS).alias("driver_rating"),
        conditioned_intention(F.col("pickup_location"), F.col("dropoff_location"), key).alias("trip_intention"),
    )


class NewPeriod(NamedTuple):
    """What one run adds, each with all columns of its stored table, and the report of the run."""

    customers: DataFrame
    drivers: DataFrame
    vehicles: DataFrame
    details: DataFrame
    report: DataFrame


def like(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The columns of a stored table; what is not made here stays null."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored.schema])


def new_period(
    trips: DataFrame, new_people: DataFrame, new_staff: DataFrame, customers: DataFrame, drivers: DataFrame, vehicles: DataFrame,
    locations: dict[str, int], as_of: dt.date,
) -> NewPeriod:
    """Trip details for new trips, served by those on record and by newcomers.

    ``new_people`` and ``new_staff`` have a row for each customer and driver to add, told apart by their first column. Newcomers are
    numbered from the largest ids on record, each new driver brings a vehicle, and all take part in the draw. The newcomers are
    stored first, so that they are the same wherever they are read.
    """
    person, worker = new_people.columns[0], new_staff.columns[0]
    fresh_people = settle(like(new_customers(
        with_new_ids(new_people.select(person), customers, "customer_id", [person]).select("customer_id"), as_of), customers), "customers")
    hired = with_new_ids(new_staff.select(worker), drivers, "driver_id", [worker]).select("driver_id")
    fresh_staff = settle(like(new_drivers(hired, as_of), drivers), "drivers")
    fresh_vehicles = settle(like(new_vehicles(fresh_staff.select("driver_id")), vehicles), "vehicles")
    of = lambda old, new, *columns: pool(old.select(*columns), new.select(*columns), list(columns))
    details = settle(trip_details(
        trips, of(customers, fresh_people, "customer_id", "membership_status"), of(drivers, fresh_staff, "driver_id", "status"),
        of(vehicles, fresh_vehicles, "vehicle_no", "status"), locations), "details")
    report = stack(*[rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("new_rows")) for name, rows in (
        ("customers", fresh_people), ("drivers", fresh_staff), ("vehicles", fresh_vehicles), ("trip_details", details))])
    return NewPeriod(fresh_people, fresh_staff, fresh_vehicles, details, report)


def usage(details: DataFrame, key: str) -> DataFrame:
    """Trips per entity."""
    return details.groupBy(key).agg(F.count("*").alias("n_trips"))


def usage_totals(details: DataFrame) -> DataFrame:
    return details.agg(
        F.count("*").alias("n_trips"),
        *[F.countDistinct(c).alias(f"n_{c.removesuffix('_id')}s") for c in ("customer_id", "driver_id")])


def generate_trips(
    ids: DataFrame, areas: Sequence[tuple[str, float, float, float, float, int]], weather: DataFrame
) -> DataFrame:
    """Trips for each trip_id in weighted areas (name, lat_min, lat_max, lon_min, lon_max, weight), priced by rule."""
    key = F.col("trip_id")
    # Some twenty hashes a row: a table of bare ids is a few small files, so it is dealt to as many tasks as its rows are worth.
    ids = ids.select("trip_id").repartition(max(1, -(-ids.count() // IDS_PER_TASK)))
    weights = {i: a[5] for i, a in enumerate(areas)}
    boxes = F.array(*[
        F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("lat0", "lat1", "lon0", "lon1"), a[1:5])]) for a in areas
    ])
    start = weighted_choice(key, "pickup area", weights)
    end = F.when(happens(key, "same area", SAME_AREA_SHARE), start).otherwise(weighted_choice(key, "dropoff area", weights))
    seconds = int((LAST_PICKUP - FIRST_PICKUP).total_seconds())
    epoch = int(FIRST_PICKUP.replace(tzinfo=dt.timezone.utc).timestamp())
    within = lambda box, axis, salt: F.round(uniform(key, salt, F.col(box)[f"{axis}0"], F.col(box)[f"{axis}1"]), 6)
    placed = ids.select("trip_id", F.get(boxes, start).alias("_a"), F.get(boxes, end).alias("_b"))
    moved = placed.select(
        "trip_id",
        F.timestamp_seconds(F.lit(epoch) + draw(key, "pickup time", seconds)).alias("pickup_datetime"),
        within("_a", "lon", "pickup lon").alias("pickup_longitude"),
        within("_a", "lat", "pickup lat").alias("pickup_latitude"),
        within("_b", "lon", "dropoff lon").alias("dropoff_longitude"),
        within("_b", "lat", "dropoff lat").alias("dropoff_latitude"),
        weighted_choice(key, "passengers", PASSENGERS).alias("passenger_count"),
        weighted_choice(key, "fuel", TRIP_FUELS).alias("fuel_type"),
    )
    usual = F.when(pricing.is_rush(F.col("pickup_datetime")), 15 + draw(key, "rush minutes", 76)).otherwise(
        5 + draw(key, "minutes", 56))
    km = F.col("distance_km")
    factor = lambda salt, short, long, medium: F.when(
        km < pricing.SHORT_TRIP_KM, uniform(key, salt, *short)).when(
        km > pricing.LONG_TRIP_KM, uniform(key, salt, *long)).otherwise(uniform(key, salt, *medium))
    timed = moved.withColumns({
        "trip_duration_min": F.greatest(F.lit(3), usual + draw(key, "delay", 31) - 10).cast("int"),
        "distance_km": great_circle_km(
            F.col("pickup_latitude"), F.col("pickup_longitude"),
            F.col("dropoff_latitude"), F.col("dropoff_longitude")),
    }).withColumns({
        "km_factor": factor("km factor", SHORT_KM_FACTOR, (1.0, 1.0), MEDIUM_KM_FACTOR),
        "minute_factor": factor("minute factor", (1.0, 1.0), LONG_MINUTE_FACTOR, MEDIUM_MINUTE_FACTOR),
    })
    priced = pricing.price_trips(timed, weather, happens(key, "overcharged", OVERCHARGE_SHARE))
    return priced.select(
        "trip_id", "pickup_datetime",
        F.timestamp_seconds(F.unix_timestamp("pickup_datetime") + F.col("trip_duration_min") * 60).alias("dropoff_datetime"),
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "passenger_count",
        F.round("fare", 2).alias("fare_amount"),
    )
