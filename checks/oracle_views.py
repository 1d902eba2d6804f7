"""SQL views of the expected results, for DuckDB alone. They state the semantics in plain SQL, apart from the library."""

from __future__ import annotations


METRICS = [
    "avg_temp", "precipitation", "weather_code", "avg_humidity", "avg_wind_speed", "avg_cloud_cover", "avg_snow_fall",
]
RAIN = ([0.1, 2, 10], ["No Rain", "Slight Rain", "Medium Rain", "Heavy Rain"])
SNOW = ([0.1, 1, 5], ["No Snow", "Slight Snow", "Medium Snow", "Heavy Snow"])
WIND = ([5, 20, 40], ["Calm", "Slight Wind", "Windy", "Heavy Wind"])
TEMP = (
    [0, 5, 15, 25, 35, 40], ["Freezing", "Very Cold", "Cool", "Mild", "Warm", "Hot", "Extreme Heat"])
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]
DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
PERIODS = ["After Midnight", "Early Morning", "Morning Rush", "Midday", "Evening Rush", "Night", "Late Night"]


def bins_sql(column: str, bins, labels, closed: str = "right") -> str:
    low, high = (">", "<=") if closed == "right" else (">=", "<")
    parts = [f"when {column} is null then 'Unknown'", f"when {column} {high} cast({bins[0]} as double) then '{labels[0]}'"]
    for a, b, label in zip(bins, bins[1:], labels[1:]):
        parts.append(f"when {column} {low} cast({a} as double) and {column} {high} cast({b} as double) then '{label}'")
    return f"case {' '.join(parts)} else '{labels[-1]}' end"


def names_sql(column: str, names) -> str:
    return f"case {column} " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(names, 1)) + " end"


def period_sql(h: str) -> str:
    return f"""case when {h} is null then 'Unknown'
        when {h} between 0 and 3 then 'After Midnight' when {h} between 4 and 5 then 'Early Morning'
        when {h} between 6 and 9 then 'Morning Rush' when {h} between 10 and 15 then 'Midday'
        when {h} between 16 and 19 then 'Evening Rush' when {h} between 20 and 21 then 'Night'
        when {h} between 22 and 24 then 'Late Night' else 'InvalidHour' end"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"2 * 6371 * atan2(sqrt({a}), sqrt(1 - {a}))"


def sanitize_sql(c: str) -> str:
    return f"regexp_replace({c}, '[ ,;{{}}()\\n\\t=]', '_', 'g')".replace("{{", "{").replace("}}", "}")


_best = ", ".join(
    f"case when coalesce({', '.join(f'cast(w.{x} as double)' for x in METRICS)}) is not null then w.{m} else b.{m} end as {m}"
    for m in METRICS)
_distance = haversine_sql("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def located_sql(p: str, lon: str, lat: str) -> str:
    return f"{lon} > {p}.x0 and {lon} < {p}.x1 and {lat} > {p}.y0 and {lat} < {p}.y1"


# Spelled out here, so that a wrong name in the library shows: label, column, names of the averages and of the count.
TABLES = {
    "weekday_fares": (
        "weekday", "pickup_day",
        ("avg_weekday_fare_amount", "avg_weekday_trip_duration_min", "avg_fare_per_km_weekday",
         "avg_fare_per_min_weekday"), "weekday_trip_count"),
    "yearly_fares": (
        "yearly", None,
        ("avg_fare_amount_year", "avg_trip_duration_min_year", "avg_fare_per_km_year", "avg_fare_per_min_year"),
        "trip_count_year"),
    "peak_hour": (
        "peak", "pickup_period",
        ("peak_hour_avg_fare_amount", "peak_hour_avg_trip_duration_min", "avg_fare_per_km_peak_hour",
         "avg_fare_per_peak_hour"), "peak_hour_trip_count"),
    "monthly_aggregation": (
        "monthly", "pickup_month",
        ("avg_fare_amount_month", "avg_trip_duration_min_month", "avg_fare_per_km_month", "avg_fare_per_min_month"),
        "trip_count_month"),
    "daily_aggregation": (
        "daily", "pickup_day",
        ("avg_fare_amount_day", "avg_trip_duration_min_day", "avg_fare_per_km_day", "avg_fare_per_min_day"),
        "trip_count_day"),
    "hourly_aggregation": (
        "hourly", "pickup_hour",
        ("avg_fare_amount_hour", "avg_trip_duration_min_hour", "avg_fare_per_km_hour", "avg_fare_per_min_hour"),
        "trip_count_hour"),
    "weekend_fares": (
        "weekend", "pickup_day",
        ("avg_weekend_fare_amount", "avg_weekend_trip_duration_min", "avg_fare_per_km_weekend",
         "avg_fare_per_min_hour_weekend"), "weekend_trip_count"),
    "weekly_fares": (
        "weekly", "pickup_week",
        ("avg_fare_amount_week", "avg_trip_duration_min_week", "avg_fare_per_km_weekly", "avg_fare_per_min_weekly"),
        "trip_count_week"),
    "non_peak_hour": (
        "non_peak", "pickup_period",
        ("non_peak_hour_avg_fare_amount", "non_peak_hour_avg_trip_duration_min", "avg_fare_per_km_non_peak_hour",
         "avg_fare_per_min_non_peak_hour"), "non_peak_hour_trip_count"),
}


def calendar_sql(table: str, wide: bool = False) -> str:
    """One of the nine tables; ``wide`` adds every other column as null, in name order, and the label."""
    label, by, averages, count = TABLES[table]
    where = {
        "weekend": "pickup_day in ('Saturday', 'Sunday')", "weekday": "pickup_day not in ('Saturday', 'Sunday')",
        "peak": "pickup_period in ('Morning Rush', 'Evening Rush')",
        "non_peak": "pickup_period not in ('Morning Rush', 'Evening Rush')",
    }.get(label, "true")
    keys = ["pickup_year"] + ([by] if by else [])
    columns = {k: f"coalesce(cast({k} as varchar), 'Unknown')" for k in keys}
    for name, m in zip(averages, ("fare_amount", "trip_duration_min", "fare_per_km", "fare_per_min")):
        columns[name] = f"SR2[[avg({m})]]"
    columns[count] = "count(trip_id)"
    if wide:
        for _, other, names, n in TABLES.values():
            for c in ("pickup_year", other, *names, n):
                if c:
                    columns.setdefault(c, "null")
        columns["time_period"] = f"'{label}'"
        columns = dict(sorted(columns.items()))
    picked = ", ".join(f"{e} as {n}" for n, e in columns.items())
    return f"select {picked} from {{calendar_fares}} where {where} group by {', '.join(keys)}"


CATEGORY_VALUES = {
    "trip_status": ["Completed", "Cancelled", "No_Show"],
    "trip_intention": [f"intent_{i}" for i in range(7)],
    "pickup_period": [p.replace(" ", "_") for p in PERIODS],
    "pickup_day": DAYS,
    "pickup_month": MONTHS,
}
METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT_SPECIFIED", "5-LOW"]

_payments = ", ".join(
    [f"cast(count(*) filter (payment_method = '{m}') as bigint) as \"cnt_{m}_payment\"" for m in METHODS]
    + [f"coalesce(SR2[[sum(case when payment_method = '{m}' then total_fareamount end)]], 0.0) as \"total_{m}_amount\""
       for m in METHODS])
_counters = ", ".join(
    [f"count(*) filter ({c} = '{v}') as \"{c}_{v}_count\"" for c, values in CATEGORY_VALUES.items() for v in values]
    + [f"count(*) filter (is_weather_extreme = {b}) as weather_extreme_{b}_count" for b in ("true", "false")])


def top_sql(prefix: str, suffix: str, labels, out: str) -> str:
    """Largest counter per customer, first label on a tie."""
    rows = " union all ".join(
        f"select customer_id, '{v}' as label, \"{prefix}{v}{suffix}\" as n from {{customer_profile}}" for v in labels)
    return f"""select customer_id, label as {out} from (
        select *, row_number() over (partition by customer_id order by n desc, label) as rn from ({rows}) a) b
        where rn = 1"""


def usual_sql(column: str, out: str) -> str:
    return f"""select customer_id, {column} as {out} from (
        select customer_id, {column}, row_number() over (
            partition by customer_id order by count(*) desc, {column} nulls first) as rn
        from {{ride_rows}} group by customer_id, {column}) a where rn = 1"""


ORACLE_VIEWS = {
    "best_weather": f"""
        select coalesce(w.date, b.date) as date, {_best}
        from {{weather}} w full join {{weather_backup}} b on w.date = b.date""",
    "enriched": f"""
        select t.*, {', '.join('w.' + m for m in METRICS)}, R2[[{_distance}]] as distance_km
        from {{trips}} t left join {{best_weather}} w on t.date = w.date""",
    "shaped": f"""
        select e.date, e.trip_id, e.dropoff_datetime, e.pickup_datetime, e.fare_amount, e.passenger_count, e.pickup_hour,
               e.pickup_day, e.pickup_month, R2[[avg_temp]] as temperature, R2[[precipitation]] as precipitation,
               R2[[avg_humidity]] as humidity, R2[[avg_wind_speed]] as wind_speed, R2[[avg_snow_fall]] as snow_fall,
               e.distance_km, p.borough as pickup_borough, d.borough as dropoff_borough
        from {{enriched}} e
        left join {{boroughs}} p on {located_sql('p', 'e.pickup_longitude', 'e.pickup_latitude')}
        left join {{boroughs}} d on {located_sql('d', 'e.dropoff_longitude', 'e.dropoff_latitude')}""",
    # The four cases spelled out.
    "located_trips": """
        select s.*, 'features' as pickupboroughsource, 'features' as dropoffboroughsource
        from {shaped} s where pickup_borough is not null and dropoff_borough is not null
        union all by name
        select s.* replace (t.pickup_location as pickup_borough), 'tripdetails' as pickupboroughsource,
               'features' as dropoffboroughsource
        from {shaped} s join {trip_details} t on s.trip_id = t.trip_id
        where pickup_borough is null and dropoff_borough is not null
        union all by name
        select s.* replace (t.dropoff_location as dropoff_borough), 'features' as pickupboroughsource,
               'tripdetails' as dropoffboroughsource
        from {shaped} s join {trip_details} t on s.trip_id = t.trip_id
        where pickup_borough is not null and dropoff_borough is null
        union all by name
        select s.* replace (t.pickup_location as pickup_borough, t.dropoff_location as dropoff_borough),
               'tripdetails' as pickupboroughsource, 'tripdetails' as dropoffboroughsource
        from {shaped} s join {trip_details} t on s.trip_id = t.trip_id
        where pickup_borough is null and dropoff_borough is null""",
    "labelled": f"""
        select l.*, d.tip_amount, epoch(dropoff_datetime - pickup_datetime) / 60.0 as trip_duration_min,
               {bins_sql('precipitation', *RAIN)} as rain_intensity, {bins_sql('snow_fall', *SNOW)} as snow_intensity,
               {bins_sql('wind_speed', *WIND)} as wind_intensity,
               {bins_sql('temperature', *TEMP)} as temperature_intensity
        from {{located_trips}} l join {{trip_details}} d on l.trip_id = d.trip_id""",
    "fares": f"""
        select trip_id, date, pickup_datetime, dropoff_datetime, distance_km, trip_duration_min, fare_amount, tip_amount,
               case when distance_km > 0 then R2[[fare_amount / distance_km]] end as fare_per_km,
               case when trip_duration_min > 0 then R2[[fare_amount / trip_duration_min]] end as fare_per_min,
               case when fare_amount + tip_amount <> 0
                    then R2[[tip_amount / (fare_amount + cast(1e-9 as double)) * 100]] end as tip_pct,
               R2[[fare_amount + tip_amount]] as total_fareamount,
               {names_sql('pickup_month', MONTHS)} as pickup_month, {names_sql('pickup_day', DAYS)} as pickup_day,
               {period_sql('pickup_hour')} as pickup_period,
               rain_intensity, snow_intensity, wind_intensity, temperature_intensity,
               (rain_intensity in ('Heavy Rain', 'Medium Rain') or snow_intensity in ('Heavy Snow', 'Medium Snow')
                or wind_intensity = 'Heavy Wind'
                or temperature_intensity in ('Extreme Heat', 'Freezing', 'Very Cold', 'Hot')) as is_weather_extreme,
               pickup_borough, dropoff_borough, pickupboroughsource, dropoffboroughsource
        from {{labelled}}""",
    "route_baseline": """
        select pickup_borough, dropoff_borough, pickup_period, SR2[[avg(fare_amount)]] as expected_fare_amount,
               SR2[[avg(trip_duration_min)]] as expected_trip_duration_min
        from {fares} where is_weather_extreme = false group by all""",
    "impact_rows": """
        select f.*, e.expected_fare_amount, e.expected_trip_duration_min, t.trip_status, t.driver_rating,
               case when is_weather_extreme and fare_amount > expected_fare_amount
                    then fare_amount - expected_fare_amount else 0.0 end as fd,
               case when is_weather_extreme and trip_duration_min > expected_trip_duration_min
                    then trip_duration_min - expected_trip_duration_min else 0.0 end as td
        from {fares} f join {trip_details} t on f.trip_id = t.trip_id
        left join {route_baseline} e on f.pickup_borough = e.pickup_borough
             and f.dropoff_borough = e.dropoff_borough and f.pickup_period = e.pickup_period""",
    "calendar_fares": """
        select f.*, t.pickup_hour, year(f.date) as pickup_year, week(f.date) as pickup_week
        from {fares} f join {trips} t on f.trip_id = t.trip_id""",
    "rides": f"""
        select f.trip_id, t.customer_id, t.customer_rating, f.distance_km, f.trip_duration_min, f.tip_amount,
               f.total_fareamount, f.tip_pct, f.pickup_month, f.pickup_day, f.is_weather_extreme,
               {sanitize_sql('f.pickup_period')} as pickup_period, {sanitize_sql('t.payment_method')} as payment_method,
               {sanitize_sql('t.trip_status')} as trip_status, {sanitize_sql('t.trip_intention')} as trip_intention
        from {{fares}} f join {{trip_details}} t on f.trip_id = t.trip_id""",
    "customer_statistics": f"""
        select customer_id, SR2[[sum(total_fareamount)]] as total_fareamount,
               SR2[[sum(tip_amount)]] as total_tip_amount, SR2[[avg(tip_pct)]] as avg_tip_pct,
               SR2[[sum(distance_km)]] as total_distance_km, sum(trip_duration_min) as total_trip_duration_min,
               count(trip_id) as total_trip_count, SR2[[avg(customer_rating)]] as avg_customer_rating,
               {_payments}, {_counters}
        from {{rides}} group by customer_id""",
    "aged_customers": """
        select customer_id, customer_name, email, phone_no, address, date_of_birth, registration_date, customer_type,
               membership_status,
               R2[[datediff('day', date_of_birth, date'2016-01-01') / cast(365.25 as double)]] as age,
               R2[[datediff('day', registration_date, date'2016-01-01') / cast(365.25 as double)]] as tenure
        from {customers}""",
    "customer_profile": """
        select c.*, s.* exclude (customer_id) from {aged_customers} c
        join {customer_statistics} s on c.customer_id = s.customer_id""",
    "ride_rows": """
        select t.customer_id, t.driver_rating, u.passenger_count, f.pickup_borough, f.dropoff_borough
        from {trip_details} t join {trips} u on t.trip_id = u.trip_id join {fares} f on t.trip_id = f.trip_id""",
    "usual_pickup": usual_sql("pickup_borough", "preferred_pickup_borough"),
    "usual_dropoff": usual_sql("dropoff_borough", "preferred_dropoff_borough"),
    "ride_averages": """
        select customer_id, SR0[[avg(passenger_count)]] as preferred_avg_passenger_count,
               SR2[[avg(driver_rating)]] as preferred_avg_driver_rating
        from {ride_rows} group by customer_id""",
    "top_payment": top_sql("cnt_", "_payment", METHODS, "preferred_payment_method"),
    "top_intention": top_sql("trip_intention_", "_count", CATEGORY_VALUES["trip_intention"], "preferred_trip_intention"),
    "top_period": top_sql("pickup_period_", "_count", CATEGORY_VALUES["pickup_period"], "preferred_pickup_period"),
    "top_day": top_sql("pickup_day_", "_count", DAYS, "preferred_pickup_day"),
    "top_month": top_sql("pickup_month_", "_count", MONTHS, "preferred_pickup_month"),
    "cleaned_trips": """
        select trip_id, pickup_datetime, dropoff_datetime, pickup_longitude, pickup_latitude, dropoff_longitude,
               dropoff_latitude, passenger_count, fare_amount, cast(pickup_datetime as date) as date,
               cast(hour(pickup_datetime) as int) as pickup_hour, cast(DOW[[pickup_datetime]] as int) as pickup_day,
               cast(month(pickup_datetime) as int) as pickup_month
        from (select * replace (coalesce(passenger_count, 1) as passenger_count), row_number() over (
                  partition by trip_id order by pickup_datetime nulls first, dropoff_datetime, pickup_longitude,
                  pickup_latitude, dropoff_longitude, dropoff_latitude, coalesce(passenger_count, 1), fare_amount) as rn
              from {raw_trips} where dropoff_longitude is not null) a
        where rn = 1 and fare_amount > 2.5 and pickup_datetime is not null""",
    "first_details": """
        select * exclude (rn) from (
            select *, row_number() over (partition by driver_id order by trip_id) as rn from {trip_details}) a
        where rn = 1""",
}
