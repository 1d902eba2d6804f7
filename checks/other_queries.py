"""Queries for pricing, generation, models and streams."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import inputs
from checks.domain import stored_view, table, view
from checks.oracle_views import RAIN, SNOW, TEMP, WIND, bins_sql, haversine_sql
from checks.registry import query
from tripmart.functions import calendar as C
from tripmart.functions.numbers import steady_round
from tripmart.functions.sphere import great_circle_km
from tripmart.functions.us_states import STATE_CENTRES
from tripmart.operators import keyed_store
from tripmart.operators.lookup import settle
from tripmart.operators.upsert import commit_version, latest, versions
from tripmart.plans import generate, model, places, pricing
from tripmart.session import new_path
from tripmart.streaming import ingest

# Pricing --------------------------------------------------------------------------------------------------------

_KM = haversine_sql("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
# Trips before eight are overcharged; fuel and factors follow from the fare.
_PRICED_INPUT = f"""
    select trip_id, date, pickup_datetime, coalesce(passenger_count, 1) as passenger_count,
           {_KM} as distance_km, epoch(dropoff_datetime - pickup_datetime) / 60.0 as trip_duration_min,
           case when fare_amount < 10 then 'petrol' when fare_amount < 20 then 'diesel'
                when fare_amount < 35 then 'hybrid' else 'ev' end as fuel_type,
           1.1 + fare_amount / 100 as km_factor, 1.05 + fare_amount / 200 as minute_factor,
           pickup_hour < 8 as overcharged
    from {{trips}}"""
_FACTORS = """
    (case when (dow = 6 and h >= 18) or dow = 7 or (dow = 1 and h < 23) then 1.15 else 1.0 end
     * case when h >= 22 or h < 5 then 1.2 else 1.0 end
     * case when h in (7, 8, 9, 16, 17, 18) then 1.15 else 1.0 end)"""
_INFLATION = "(pow(1.03, y - 2009) * pow(1.015, floor(((y - 2009) * 12 + m - 1) / cast(6 as double))))"


def _factor_sql(label: str, factors: dict) -> str:
    return f"case {label} " + " ".join(f"when '{n}' then {v}" for n, v in factors.items()) + " else 1.0 end"


_WEATHER_FACTORS = f"""
    select date, cast({_factor_sql(bins_sql('precipitation', *RAIN, closed='left'),
                                   {'No Rain': 1.00, 'Slight Rain': 1.05, 'Medium Rain': 1.10, 'Heavy Rain': 1.20})}
         * {_factor_sql(bins_sql('avg_snow_fall', *SNOW, closed='left'),
                        {'No Snow': 1.00, 'Slight Snow': 1.10, 'Medium Snow': 1.20, 'Heavy Snow': 1.30})}
         * {_factor_sql(bins_sql('avg_wind_speed', *WIND, closed='left'),
                        {'Calm': 1.00, 'Slight Wind': 1.03, 'Windy': 1.07, 'Heavy Wind': 1.12})}
         * {_factor_sql(bins_sql('((avg_temp - 32) * 5 / 9)', *TEMP),
                        {'Freezing': 1.15, 'Very Cold': 1.10, 'Cool': 1.05, 'Mild': 1.00, 'Warm': 1.03, 'Hot': 1.07, 'Extreme Heat': 1.12})}
           as double) as wf
    from {{weather}}"""


@query("X26 J9", f"select date, SR6[[wf]] as weather_factor from ({_WEATHER_FACTORS}) a")
def weather_factors(spark, sf):
    return stored_view(spark, sf, "weather").select("date", steady_round(pricing.weather_factor(
        F.col("precipitation"), F.col("avg_snow_fall"), F.col("avg_wind_speed"), F.col("avg_temp")), 6)
        .alias("weather_factor"))


@query("X23 X24 X25", f"""
    select trip_id, SR6[[cast({_FACTORS} as double)]] as time_factor, SR6[[{_INFLATION}]] as inflation,
           cast(0.5 * greatest(n - 2, 0) as double) as surcharge
    from (select trip_id, hour(pickup_datetime) as h, DOW[[pickup_datetime]] as dow, year(pickup_datetime) as y,
                 month(pickup_datetime) as m, coalesce(passenger_count, 1) as n from {{trips}}) a""")
def pricing_rules(spark, sf):
    at = F.col("pickup_datetime")
    return view(spark, sf, "trips").select(
        "trip_id", steady_round(pricing.time_factor(at), 6).alias("time_factor"),
        steady_round(pricing.inflation(at), 6).alias("inflation"),
        pricing.passenger_surcharge(F.coalesce("passenger_count", F.lit(1))).alias("surcharge"))


_RATES = """case fuel_type when 'petrol' then 1.75 when 'diesel' then 1.65 when 'hybrid' then 1.55 else 1.45 end"""
_EXTRA = """case fuel_type when 'petrol' then 0.25 when 'diesel' then 0.2 when 'hybrid' then 0.15 else 0.05 end"""


@query("X27 X28 J9", f"""
    select trip_id, case when distance_km is not null then SR2[[greatest(4.0, case when overcharged
        then {_INFLATION} * (2.5 + distance_km * cast({_RATES} as double) * case when distance_km > 30 then 1.0 else km_factor end
             + trip_duration_min * 0.35 * case when distance_km < 1.5 then 1.0 else minute_factor end + cast({_EXTRA} as double))
        else {_INFLATION} * (2.5 + distance_km * cast({_RATES} as double) + trip_duration_min * 0.35 + cast({_EXTRA} as double))
             * cast({_FACTORS} as double) * wf + 0.5 * greatest(passenger_count - 2, 0) end)]] end as fare
    from (select p.*, hour(pickup_datetime) as h, DOW[[pickup_datetime]] as dow, year(pickup_datetime) as y,
                 month(pickup_datetime) as m, coalesce(w.wf, 1.0) as wf
          from ({_PRICED_INPUT}) p left join ({_WEATHER_FACTORS}) w on p.date = w.date) a""")
def priced_trips(spark, sf):
    fare = F.col("fare_amount")
    trips = view(spark, sf, "trips").select(
        "trip_id", "pickup_datetime", "passenger_count",
        great_circle_km(F.col("pickup_latitude"), F.col("pickup_longitude"),
                        F.col("dropoff_latitude"), F.col("dropoff_longitude")).alias("distance_km"),
        C.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("trip_duration_min"),
        F.when(fare < 10, "petrol").when(fare < 20, "diesel").when(fare < 35, "hybrid").otherwise("ev").alias("fuel_type"),
        (1.1 + fare / 100).alias("km_factor"), (1.05 + fare / 200).alias("minute_factor"),
        (F.col("pickup_hour") < 8).alias("overcharged"))
    priced = pricing.price_trips(trips, stored_view(spark, sf, "weather"), F.col("overcharged"))
    return priced.select("trip_id", steady_round(F.col("fare"), 2).alias("fare"))


# Generation -----------------------------------------------------------------------------------------------------


def _locations(spark, sf):
    # The nation table has 25 rows; a region's first nations weigh more. A few names carry the words the rules look for.
    names = [r[0] for r in table(spark, sf, "nation").select("n_name").orderBy("n_nationkey").collect()]
    words = ("Airport", "Hotel", "Tourism", "Medical", "School")
    return {(f"{n} {words[i]}" if i < len(words) else n): 35 - i for i, n in enumerate(names)}


def _vehicles(spark, sf):
    return generate.new_vehicles(view(spark, sf, "drivers").select("driver_id"))


def _draw(key: str, salt: str, n) -> str:
    return f"(cast('0x' || substr(md5(concat('{salt}|', {key})), 1, 15) as bigint) % {n})"


def _uniform(key: str, salt: str, low, high) -> str:
    return f"({low} + {_draw(key, salt, 1 << 40)} / cast({1 << 40} as double) * ({high} - {low}))"


def _pick(key: str, salt: str, choices) -> str:
    """The label a draw points to, each standing as often as it weighs."""
    choices = choices if isinstance(choices, dict) else dict.fromkeys(choices, 1)
    slots = [label for label, weight in choices.items() for _ in range(weight)]
    listed = ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else str(x) for x in slots)
    return f"[{listed}][{_draw(key, salt, len(slots))} + 1]"


def _date(key: str, salt: str, first: str, last: str) -> str:
    return f"(date'{first}' + cast({_draw(key, salt, f"(date'{last}' - date'{first}' + 1)")} as int))"


_ROUND1 = "cast(round(cast(cast({} as varchar) as decimal(38,18)), 1) as double)"
_MODELS = (
    "Toyota Camry", "Honda Civic", "Ford F-150", "Chevrolet Silverado", "Tesla Model 3", "Nissan Altima",
    "Hyundai Elantra", "BMW 3 Series", "Audi A4", "Mercedes-Benz C-Class", "Volkswagen Jetta", "Subaru Outback",
    "Mazda CX-5", "Jeep Wrangler", "GMC Sierra", "Ram 1500", "Tesla Model S", "Lexus ES", "Acura TLX",
    "Infiniti Q50", "Toyota Prius", "Nissan NV200", "Ford Transit Connect", "Chevrolet Impala", "Honda Accord",
    "Toyota Sienna", "Chrysler Pacifica", "Ford Escape", "Kia Optima", "Hyundai Sonata", "Lincoln Town Car",
    "Cadillac XTS", "Mercedes-Benz Sprinter",
)


def _vehicles_sql(ids: str) -> str:
    k = "driver_id"
    return f"""
        select concat('V-', {k}) as vehicle_no, {k}, model, cast(2009 + {_draw(k, 'year', 7)} as int) as year,
               {_pick(k, 'color', ('White', 'Black', 'Silver', 'Gray', 'Blue', 'Red', 'Green', 'Brown', 'Yellow'))} as color,
               {_pick(k, 'vehicle', ('Sedan', 'SUV', 'Hatchback', 'Pickup Truck', 'Electric', 'Luxury', 'Minivan', 'Van'))} as vehicle_type,
               case when model like '%Tesla%' then 'Electric'
                    when model like '%Prius%' or {_uniform(k, 'hybrid', 0.0, 1.0)} < 0.2 then 'Hybrid'
                    else {_pick(k, 'fuel', ('Gasoline', 'Electric', 'Hybrid', 'Diesel'))} end as fuel_type,
               cast({_pick(k, 'seats', (4, 5, 6, 7, 8))} as int) as seating_capacity,
               cast(15000 + {_draw(k, 'mileage', 185001)} as int) as mileage,
               {_date(k, 'insured', '2009-01-01', '2015-12-31')} as insurance_expiry,
               {_date(k, 'serviced', '2012-01-01', '2015-12-31')} as last_maintenance,
               {_pick(k, 'status', {'Active': 6, 'Maintenance': 1, 'Out of Service': 1})} as status,
               {_pick(k, 'state', [name for name, *_ in STATE_CENTRES])} as registration_state
        from (select {k}, {_pick(k, 'model', _MODELS)} as model from ({ids}) i) m"""


# Customers on record and as many new ones as there are suppliers, numbered on from the largest id.
_NEW_CUSTOMERS = "select row_number() over (order by s_suppkey) + (select max(customer_id) from {customers}) as customer_id from supplier"
_TOTAL, _FIRST = "(select sum(weight) from places)", "first_slot"
_INTENTIONS = {
    "Commute": 250, "Business": 150, "Leisure": 120, "Errand": 100, "Airport Transfer": 80, "Social/Visiting": 70,
    "Dining": 50, "Shopping": 50, "Medical/Healthcare": 40, "School/Education": 30, "Event/Entertainment": 30,
    "Tourism/Sightseeing": 20, "Hotel Transfer": 10, "Ride Pooling/Shared": 10, "Religious": 5,
    "Exercise/Outdoor": 5, "Delivery": 5, "Relocation/Move": 5, "Other": 10,
}
_RATINGS = {None: 1, 1.0: 1, 1.5: 1, 2.0: 1, 2.5: 1, 3.0: 2, 3.5: 3, 4.0: 2, 4.5: 1, 5.0: 3}
_RULES = ((("Airport",), "Airport Transfer", 0.70), (("Hotel",), "Hotel Transfer", 0.60), (("Tourism", "Sightseeing"), "Tourism/Sightseeing", 0.65),
          (("Medical", "Healthcare"), "Medical/Healthcare", 0.75), (("School", "University"), "School/Education", 0.80))


def _hundredths(weights: dict) -> dict:
    """Weights by their greatest common divisor, as the slots are laid out."""
    common = math.gcd(*weights.values())
    return {label: w // common for label, w in weights.items()}


def _intention() -> str:
    drawn = _pick("trip_id", "intention", _hundredths(_INTENTIONS))
    cases = ""
    for n, (words, intention, share) in enumerate(_RULES):
        named = " or ".join(f"pickup_location like '%{w}%' or dropoff_location like '%{w}%'" for w in words)
        cases += f" when {named} then case when {_uniform('trip_id', f'rule {n}', 0.0, 1.0)} < {share} then '{intention}' else {drawn} end"
    return f"case{cases} else {drawn} end"


_DETAILS_SQL = f"""
    with places as (
        select n_nationkey, 35 - n_nationkey as weight,
               concat(n_name, coalesce(' ' || [ 'Airport', 'Hotel', 'Tourism', 'Medical', 'School'][n_nationkey + 1], '')) as place,
               coalesce(sum(35 - n_nationkey) over (order by n_nationkey rows between unbounded preceding and 1 preceding), 0) as start
        from nation),
    slots as (select place, weight, start, start + unnest(range(0, cast(weight as bigint))) as slot from places),
    riders as (
        select row_number() over (order by customer_id) - 1 as slot, customer_id, count(*) over () as size from (
            select customer_id from {{customers}} where membership_status = 'Active'
            union all select customer_id from ({_NEW_CUSTOMERS}) n where {_pick('customer_id', 'membership', {'Active': 7, 'Inactive': 1, 'Suspended': 1})} = 'Active') a),
    staff as (select row_number() over (order by driver_id) - 1 as slot, driver_id, count(*) over () as size from {{drivers}} where status = 'Active'),
    fleet as (
        select row_number() over (order by vehicle_no) - 1 as slot, vehicle_no, count(*) over () as size
        from ({_vehicles_sql('select driver_id from {drivers}')}) v where status = 'Active'),
    drawn as (
        select trip_id, {_draw('trip_id', 'assign customer_id', '(select max(size) from riders)')} as rider,
               {_draw('trip_id', 'assign driver_id', '(select max(size) from staff)')} as worker,
               {_draw('trip_id', 'assign vehicle_no', '(select max(size) from fleet)')} as car,
               {_draw('trip_id', 'place first', '(select cast(sum(weight) as bigint) from places)')} as place1 from {{trips}}),
    going as (
        select d.*, p.place as pickup_location, p.start, p.weight,
               {_draw('trip_id', 'place second', '((select cast(sum(weight) as bigint) from places) - cast(p.weight as bigint))')} as free
        from drawn d join slots p on p.slot = d.place1),
    coming as (
        select g.*, q.place as dropoff_location
        from going g join slots q on q.slot = case when g.free >= g.start then g.free + g.weight else g.free end)
    select trip_id, driver_id, customer_id, vehicle_no, pickup_location, dropoff_location,
           R2[[{_uniform('trip_id', 'km', 0.5, 50.0)} * {_uniform('trip_id', 'rate', 1.5, 3.0)} * {_uniform('trip_id', 'tip', 0.0, 0.25)}]] as tip_amount,
           {_pick('trip_id', 'payment', ('Credit Card', 'Debit Card', 'Cash', 'Digital Wallet', 'Corporate Account'))} as payment_method,
           {_pick('trip_id', 'status', {'Completed': 8, 'Cancelled': 1, 'No Show': 1})} as trip_status,
           cast({_pick('trip_id', 'customer rating', _RATINGS)} as double) as customer_rating,
           cast({_pick('trip_id', 'driver rating', _RATINGS)} as double) as driver_rating, {_intention()} as trip_intention
    from coming join riders on riders.slot = rider join staff on staff.slot = worker join fleet on fleet.slot = car"""


@query("G2 G3 G4 G5 P10 U3 B15", _DETAILS_SQL)
def generated_details(spark, sf):
    """Details for every order, drawn from the given customers and suppliers and as many new ones."""
    existing = view(spark, sf, "customers").select("customer_id", "customer_name", "membership_status")
    added = generate.with_new_ids(
        table(spark, sf, "supplier").select("s_suppkey"), existing, "customer_id", ["s_suppkey"]).select("customer_id")
    fresh = generate.new_customers(added, C.AS_OF).select("customer_id", "customer_name", "membership_status")
    return generate.trip_details(
        view(spark, sf, "trips"), existing.unionByName(fresh), view(spark, sf, "drivers"), _vehicles(spark, sf),
        _locations(spark, sf))


def _box(end: str, axis: str) -> str:
    low, high = f"{end}.{axis}0", f"{end}.{axis}1"
    side = {"x": "lon", "y": "lat"}[axis]
    name = {"a": "pickup", "b": "dropoff"}[end]
    return f"R6[[{_uniform('trip_id', f'{name} {side}', low, high)}]]"


_AREAS = [n for n in range(25) for _ in range(3 if n < 5 else 1)]
_AREA = lambda salt, slots: f"{slots}[{_draw('trip_id', salt, len(slots))} + 1]"
_STRETCH = lambda salt, short, long, medium: (
    f"case when distance_km < 1.5 then {_uniform('trip_id', salt, *short)} when distance_km > 30 then {_uniform('trip_id', salt, *long)}"
    f" else {_uniform('trip_id', salt, *medium)} end")
def _generated(areas: str, slots: list[int]) -> str:
    """Trips in weighted boxes; ``areas``: n, x0, x1, y0, y1, of which ``slots`` names each as often as it weighs."""
    return f"""
    with areas as ({areas}),
    chosen as (
        select trip_id, {_AREA('pickup area', slots)} as start,
               case when {_uniform('trip_id', 'same area', 0.0, 1.0)} < 0.7 then {_AREA('pickup area', slots)} else {_AREA('dropoff area', slots)} end as stop
        from {{trips}}),
    moved as (
        select trip_id, 1230768000 + {_draw('trip_id', 'pickup time', 220752000)} as secs,
               {_box('a', 'x')} as pickup_longitude, {_box('a', 'y')} as pickup_latitude,
               {_box('b', 'x')} as dropoff_longitude, {_box('b', 'y')} as dropoff_latitude,
               cast({_pick('trip_id', 'passengers', {1: 60, 2: 25, 3: 8, 4: 4, 5: 2, 6: 1})} as int) as passenger_count,
               {_pick('trip_id', 'fuel', {'petrol': 7, 'diesel': 7, 'hybrid': 4, 'ev': 2})} as fuel_type
        from chosen join areas a on a.n = start join areas b on b.n = stop),
    dated as (
        select *, to_timestamp(secs) at time zone 'UTC' as pickup, {_KM} as distance_km from moved),
    parts as (
        select *, hour(pickup) as h, DOW[[pickup]] as dow, year(pickup) as y, month(pickup) as m, cast(pickup as date) as date from dated),
    timed as (
        select *, greatest(3, case when h in (7, 8, 9, 16, 17, 18) then 15 + {_draw('trip_id', 'rush minutes', 76)}
                                   else 5 + {_draw('trip_id', 'minutes', 56)} end + {_draw('trip_id', 'delay', 31)} - 10) as trip_duration_min,
               {_STRETCH('km factor', (1.15, 1.8), (1.0, 1.0), (1.05, 1.3))} as km_factor,
               {_STRETCH('minute factor', (1.0, 1.0), (1.1, 1.6), (1.05, 1.4))} as minute_factor,
               {_uniform('trip_id', 'overcharged', 0.0, 1.0)} < 0.015 as overcharged from parts)
    select trip_id, to_timestamp(secs) as pickup_datetime, to_timestamp(secs + trip_duration_min * 60) as dropoff_datetime, pickup_longitude,
           pickup_latitude, dropoff_longitude, dropoff_latitude, passenger_count, R2[[greatest(4.0, case when overcharged
        then {_INFLATION} * (2.5 + distance_km * cast({_RATES} as double) * case when distance_km > 30 then 1.0 else km_factor end
             + trip_duration_min * 0.35 * case when distance_km < 1.5 then 1.0 else minute_factor end + cast({_EXTRA} as double))
        else {_INFLATION} * (2.5 + distance_km * cast({_RATES} as double) + trip_duration_min * 0.35 + cast({_EXTRA} as double))
             * cast({_FACTORS} as double) * coalesce(w.wf, 1.0) + 0.5 * greatest(passenger_count - 2, 0) end)]] as fare_amount
    from timed t left join ({_WEATHER_FACTORS}) w on w.date = t.date"""


_BOROUGH_AREAS = "select row_number() over (order by borough) - 1 as n, * from {boroughs}"
# In single quotes, so that DuckDB reads doubles.
_DEFAULT_AREAS = "select n, {} from (values {}) v(n, x0, x1, y0, y1)".format(
    ", ".join(f"cast({c} as double) as {c}" for c in ("x0", "x1", "y0", "y1")),
    ", ".join(f"({n}, '{a[3]}', '{a[4]}', '{a[1]}', '{a[2]}')" for n, a in enumerate(places.default_areas())))
_DEFAULT_SLOTS = [n for n, a in enumerate(places.default_areas()) for _ in range(a[5])]


@query("G6 X27 X28", _generated(_BOROUGH_AREAS, _AREAS))
def generated_trips(spark, sf):
    """A trip for every order, in the boxes of the boroughs."""
    areas = [
        (r["borough"], r["y0"], r["y1"], r["x0"], r["x1"], 15 if i < 5 else 5)
        for i, r in enumerate(view(spark, sf, "boroughs").orderBy("borough").collect())
    ]
    return generate.generate_trips(view(spark, sf, "trips"), areas, stored_view(spark, sf, "weather"))


@query("G6 X27 X28", _generated(_DEFAULT_AREAS, _DEFAULT_SLOTS))
def trips_in_default_areas(spark, sf):
    """A trip for every order, in the named areas of the city and the boxes around it."""
    return generate.generate_trips(view(spark, sf, "trips"), places.default_areas(), stored_view(spark, sf, "weather"))


@query("G7 G2", _vehicles_sql("select customer_id as driver_id from {customers}"))
def generated_vehicles(spark, sf):
    """A vehicle for every customer, as if each drove."""
    return generate.new_vehicles(view(spark, sf, "customers").select(F.col("customer_id").alias("driver_id")))


@query("G1 G2", f"""
    select driver_id, concat('Driver ', driver_id) as driver_name, {_date('driver_id', 'born', '1951-01-01', '1995-01-01')} as date_of_birth,
           {_date('driver_id', 'hired', '2009-01-01', '2012-12-31')} as hire_date,
           {_pick('driver_id', 'experience', ('Trainee', 'Junior', 'Senior', 'Expert', 'Master'))} as experience_level,
           {_ROUND1.format(_uniform('driver_id', 'rating', 3.5, 5.0))} as rating,
           {_pick('driver_id', 'status', {'Active': 10, 'On Leave': 1, 'Inactive': 1})} as status
    from (select row_number() over (order by c_custkey) + (select max(driver_id) from {{drivers}}) as driver_id from customer) a""")
def generated_drivers(spark, sf):
    ids = generate.with_new_ids(
        table(spark, sf, "customer").select("c_custkey"), view(spark, sf, "drivers"), "driver_id", ["c_custkey"])
    return generate.new_drivers(ids.select("driver_id"), C.AS_OF)


# Models ---------------------------------------------------------------------------------------------------------


def _training(spark, sf):
    """Rows to fit on, stored: the stages of a pipeline read them several times."""
    located = inputs.located(spark, sf).select("trip_id", F.col("pickup_borough").alias("borough"))
    return settle(model.training_rows(inputs.enriched(spark, sf).join(located, "trip_id").select(
        "trip_id", *model.NUMERIC, "borough", "fare_amount")), "training")


@query("M4", "select trip_id, ((trip_id * 7919) % 10) < 9 as train from {trips}")
def split_rows(spark, sf):
    train, test = model.split(view(spark, sf, "trips").select("trip_id"), "trip_id")
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


_PREDICTED = "select fare_amount as y, R2[[2.5 + coalesce(distance_km, 0) * 0.05]] as p from {enriched}"


def _rule_predictions(spark, sf):
    """A rule of thumb as the model, so that its scores can be checked; a trip without a distance gets the base fare."""
    return inputs.enriched(spark, sf).select(
        "fare_amount", F.round(F.lit(2.5) + F.coalesce("distance_km", F.lit(0.0)) * 0.05, 2).alias(model.PREDICTION))


@query("M7", f"""
    select count(*) as n, SR6[[sqrt(sum((y - p) * (y - p)) / count(*))]] as rmse,
           SR6[[1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))]] as r2 from ({_PREDICTED}) a""")
def prediction_scores(spark, sf):
    return model.scores(_rule_predictions(spark, sf)).select(
        "n", steady_round(F.col("rmse"), 6).alias("rmse"), steady_round(F.col("r2"), 6).alias("r2"))


@query("A26", f"""
    select 'fare_amount' as column, count(y) as count, SR6[[avg(y)]] as mean, SR6[[stddev_samp(y)]] as stddev,
           min(y) as min, max(y) as max from ({_PREDICTED}) a
    union all select 'predicted_fare_amount', count(p), SR6[[avg(p)]], SR6[[stddev_samp(p)]], min(p), max(p)
    from ({_PREDICTED}) b""")
def prediction_summary(spark, sf):
    return model.describe(_rule_predictions(spark, sf)).withColumns({
        c: steady_round(F.col(c), 6) for c in ("mean", "stddev")})


@query("M8", f"""
    select y as "Actual_Fare", R2[[p]] as "Predicted_Fare", R2[[y - p]] as "Error" from ({_PREDICTED}) a""")
def prediction_errors(spark, sf):
    return model.comparison(_rule_predictions(spark, sf))


@query("M1 M2 M5 M8")
def forest_predictions(spark, sf):
    """Forest of 100 trees on nine tenths of the trips, predictions on the rest."""
    train, test = model.split(_training(spark, sf), "trip_id")
    return model.comparison(model.fare_pipeline("keep").fit(train).transform(test))


@query("M1 M2 M3 M8")
def feature_importances(spark, sf):
    """A small forest over indexed features."""
    return model.importances(model.fare_pipeline("keep", index_small=True, trees=20).fit(_training(spark, sf)))


# Streams --------------------------------------------------------------------------------------------------------


def _drops(spark, sf, name: str):
    """A table as dated CSV drops."""
    rows = view(spark, sf, name)
    path = new_path(spark, "drops")
    rows.withColumn("drop_year", F.year("date")).write.partitionBy("drop_year").option("header", True).csv(path)
    return path, rows.schema


@query("T1 S1 S5", "select * from {trips}")
def streamed_trips(spark, sf):
    """Every drop of every year read once."""
    path, schema = _drops(spark, sf, "trips")
    target, checkpoint = new_path(spark, "streamed"), new_path(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(ingest.open_drops(spark, f"{path}/*", schema), target, checkpoint)
    return ingest.stored_rows(spark, target).select(*schema.names)


@query("T2", """
    select * exclude (rn) from (
        select *, row_number() over (partition by l_orderkey order by l_shipdate, l_partkey, l_linenumber) as rn
        from (select l_orderkey, l_partkey, l_linenumber, l_shipdate from lineitem) a) b where rn = 1""")
def streamed_new_keys(spark, sf):
    """Line items as drops; the first line of each order is stored once however often its order comes."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    source = new_path(spark, "drops")
    lines.write.parquet(source)
    target, checkpoint = new_path(spark, "streamed"), new_path(spark, "checkpoint")
    stream = ingest.open_drops(spark, source, lines.schema, "parquet")
    for _ in range(2):
        ingest.ingest_new_keys(stream, target, checkpoint, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_linenumber"])
    return ingest.stored_rows(spark, target).select(*lines.columns)


@query("T3 K5", """
    select t.trip_id, coalesce(s.date, t.date) as date, coalesce(s.pickup_hour, t.pickup_hour) as pickup_hour,
           coalesce(s.fare_amount, t.fare_amount) as fare_amount
    from {trips} t left join {upsert_source} s on t.trip_id = s.trip_id
    union all select * from {upsert_source} where trip_id not in (select trip_id from {trips})""")
def streamed_upserts(spark, sf):
    path, schema = _drops(spark, sf, "upsert_source")
    target, checkpoint = new_path(spark, "changes"), new_path(spark, "checkpoint")
    stream = ingest.open_drops(spark, f"{path}/*", schema, files_per_batch=1)
    ingest.ingest_changes(stream, target, checkpoint, ["trip_id"])
    base = new_path(spark, "folded")
    commit_version(view(spark, sf, "trips").select(*schema.names), base, 1)
    for _ in range(2):  # the second fold finds nothing new
        ingest.fold_changes(spark, base, target, ["trip_id"])
    return latest(versions(spark, base))


@query("T3 K5", """
    select t.trip_id, coalesce(s.date, t.date) as date, coalesce(s.pickup_hour, t.pickup_hour) as pickup_hour,
           coalesce(s.fare_amount, t.fare_amount) as fare_amount
    from {trips} t left join {upsert_source} s on t.trip_id = s.trip_id
    union all select * from {upsert_source} where trip_id not in (select trip_id from {trips})""")
def folded_into_store(spark, sf):
    """The stream's changes folded into a partitioned store, batch after batch."""
    path, schema = _drops(spark, sf, "upsert_source")
    target, checkpoint = new_path(spark, "changes"), new_path(spark, "checkpoint")
    base = new_path(spark, "store")
    store = keyed_store.create_store(view(spark, sf, "trips").select(*schema.names), base, ["trip_id"], 8)
    ingest.ingest_changes(ingest.open_drops(spark, f"{path}/*", schema, files_per_batch=1), target, checkpoint, ["trip_id"])
    for _ in range(2):  # the second fold finds nothing new
        ingest.fold_into_store(spark, base, target)
    return keyed_store.read_store(spark, store)


@query("B14 K5", """
    select customer_id, trip_count + case when customer_id % 3 = 0 then 1 else 0 end as trip_count from (
        select customer_id, count(*) as trip_count from {trip_details} where customer_id % 2 = 0 or customer_id % 3 = 0 group by customer_id) a""")
def refreshed_profile(spark, sf):
    """A first load publishes the even customers, a second one upserts every third."""
    import datetime as dt

    from tripmart.paths import Lake
    from tripmart.plans.refresh import refresh_people

    counts = view(spark, sf, "trip_details").groupBy("customer_id").agg(F.count("*").alias("trip_count"))
    lake = Lake(new_path(spark, "lake"))
    refresh_people(spark, lake, "customer_profile", counts.where("customer_id % 2 = 0"), dt.date(2024, 1, 1))
    later = counts.where("customer_id % 3 = 0").withColumn("trip_count", F.col("trip_count") + 1)
    return refresh_people(spark, lake, "customer_profile", later, dt.date(2024, 1, 2))


@query("B14 K5", """
    select customer_id, trip_count + case when customer_id % 3 = 0 then 1 else 0 end as trip_count from (
        select customer_id, count(*) as trip_count from {trip_details} where customer_id % 2 = 0 or customer_id % 3 = 0 group by customer_id) a""")
def refreshed_in_place(spark, sf):
    """The same two loads into a partitioned store."""
    from tripmart.paths import Lake
    from tripmart.plans.refresh import refresh_in_place

    counts = view(spark, sf, "trip_details").groupBy("customer_id").agg(F.count("*").alias("trip_count"))
    lake = Lake(new_path(spark, "lake"))
    refresh_in_place(spark, lake, "customer_profile", counts.where("customer_id % 2 = 0"), parts=8)
    return refresh_in_place(
        spark, lake, "customer_profile", counts.where("customer_id % 3 = 0").withColumn("trip_count", F.col("trip_count") + 1))


@query("G1 B15", """
    select table_name, new_rows from (
        select 'customers' as table_name, count(*) as new_rows from nation union all select 'drivers', count(*) from region
        union all select 'vehicles', count(*) from region union all select 'trip_details', count(*) from orders) a""")
def new_period_report(spark, sf):
    return _period(spark, sf).report


@query("G4 U3 B15", """
    select o_orderkey as trip_id, true as known_customer, true as known_driver, true as known_vehicle, true as two_places from orders""")
def new_period_details(spark, sf):
    """Each trip has one customer, driver and vehicle of the pools, newcomers among them, and two different places."""
    period = _period(spark, sf)
    of = lambda old, new, key: settle(view(spark, sf, old).select(key).unionByName(new.select(key)).withColumn(f"known_{key}", F.lit(True)), "known")
    return (period.details.join(of("customers", period.customers, "customer_id"), "customer_id", "left")
            .join(of("drivers", period.drivers, "driver_id"), "driver_id", "left")
            .select("trip_id", F.coalesce("known_customer_id", F.lit(False)).alias("known_customer"),
                    F.coalesce("known_driver_id", F.lit(False)).alias("known_driver"), F.col("vehicle_no").startswith("V-").alias("known_vehicle"),
                    (F.col("pickup_location") != F.col("dropoff_location")).alias("two_places")))


def _period(spark, sf):
    return generate.new_period(
        view(spark, sf, "trips"), table(spark, sf, "nation").select("n_nationkey"), table(spark, sf, "region").select("r_regionkey"),
        view(spark, sf, "customers"), view(spark, sf, "drivers"), _vehicles(spark, sf), _locations(spark, sf), C.AS_OF)
