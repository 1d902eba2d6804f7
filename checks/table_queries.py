"""Queries for sources, sinks, upserts, checks and plain operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import inputs
from checks.domain import stored_view, table, view
from checks.registry import query
from tripmart import sinks
from tripmart.functions import calendar as C
from tripmart.functions import text
from tripmart.operators import key_filter, keyed_store, keys, paging, quality, unions
from tripmart.operators import upsert as U
from tripmart.session import new_path
from tripmart.sources import readers, spine

CHECKED_AT = dt.datetime(2024, 1, 1)

# Sources -------------------------------------------------------------------------------------------------------


@query("S2", "select * from orders")
def read_parquet(spark, sf):
    return readers.load(spark, f"{sf}/orders.parquet", "parquet")


@query("S7 A18", """
    select o_orderpriority, count(distinct o_custkey) as n_customers, count(*) as n_orders, count(o_totalprice) as n_prices
    from orders group by o_orderpriority""")
def sql_over_files(spark, sf):
    return readers.sql_over_files(spark, """
        SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers, count(*) AS n_orders,
               count(o_totalprice) AS n_prices
        FROM {orders} GROUP BY o_orderpriority""", orders=f"{sf}/orders.parquet")


def _spine(spark, sf):
    start = spine.first_missing_day(view(spark, sf, "current_trips"), "delta")
    end = view(spark, sf, "trips").agg(F.max("date")).first()[0]
    return spine.date_spine(spark, start, end)


_SPINE = """select cast(d as date) as date from generate_series(
    (select max(date) + 1 from {current_trips}), (select max(date) from {trips}), interval 1 day) g(d)"""


@query("S9 X4", _SPINE)
def date_spine(spark, sf):
    return _spine(spark, sf)


def _batches_sql(days: str) -> str:
    return f"""
        select cast((place - 1) // 30 as int) as batch, min(date) as start_date, max(date) as end_date, count(*) as n_dates,
               string_agg(cast(date as varchar), ',' order by date) as dates
        from (select date, row_number() over (order by date) as place from (select distinct date from ({days}) a) b) c group by 1"""


def _listed(batches):
    return batches.withColumn("dates", F.array_join(F.transform("dates", lambda d: d.cast("string")), ","))


@query("S10", _batches_sql(_SPINE))
def spine_batches(spark, sf):
    return _listed(spine.spine_batches(_spine(spark, sf)))


@query("S10", _batches_sql("select date from {weather} where day(date) % 2 = 1"))
def spine_batches_with_gaps(spark, sf):
    """Every second day but the 17ths: a batch has 30 days, however far apart."""
    return _listed(spine.spine_batches(view(spark, sf, "weather").where("day(date) % 2 = 1").select("date")))


@query("W4", "select distinct date from {trips}")
def trip_dates(spark, sf):
    return view(spark, sf, "trips").select("date").distinct().orderBy("date")


# Sinks and versions ---------------------------------------------------------------------------------------------

_FARE_COLUMNS = ["trip_id", "date", "pickup_hour", "fare_amount"]


@query("K5", """
    select t.trip_id, coalesce(s.date, t.date) as date, coalesce(s.pickup_hour, t.pickup_hour) as pickup_hour,
           coalesce(s.fare_amount, t.fare_amount) as fare_amount
    from {trips} t left join {upsert_source} s on t.trip_id = s.trip_id
    union all select * from {upsert_source} where trip_id not in (select trip_id from {trips})""")
def upserted_trips(spark, sf):
    return U.upsert(view(spark, sf, "trips").select(*_FARE_COLUMNS), view(spark, sf, "upsert_source"), ["trip_id"])


@query("K5", """
    select t.trip_id, t.date, t.pickup_hour, coalesce(s.fare_amount, t.fare_amount) as fare_amount
    from {trips} t left join {upsert_source} s on t.trip_id = s.trip_id
    union all select * from {upsert_source} where trip_id not in (select trip_id from {trips})""")
def upserted_fares_only(spark, sf):
    shifted = view(spark, sf, "upsert_source")
    target = view(spark, sf, "trips").select(*_FARE_COLUMNS)
    return U.upsert(target, shifted, ["trip_id"], ["fare_amount"])


def _trip_store(spark, sf, parts: int = 16):
    return keyed_store.create_store(
        view(spark, sf, "trips").select(*_FARE_COLUMNS), new_path(spark, "store"), ["trip_id"], parts)


@query("K5", """
    select t.trip_id, coalesce(s.date, t.date) as date, coalesce(s.pickup_hour, t.pickup_hour) as pickup_hour,
           coalesce(s.fare_amount, t.fare_amount) as fare_amount
    from {trips} t left join {upsert_source} s on t.trip_id = s.trip_id
    union all select * from {upsert_source} where trip_id not in (select trip_id from {trips})""")
def upserted_partitions(spark, sf):
    """The upsert of a partitioned store: first the batch of 1997, which touches all partitions, then the new copies of 1998."""
    store, source = _trip_store(spark, sf), view(spark, sf, "upsert_source")
    for year in (1997, 1998):
        keyed_store.upsert_store(spark, store, source.where(F.year("date") == year))
    return keyed_store.read_store(spark, store)


@query("K5", """
    select t.trip_id, t.date, t.pickup_hour, coalesce(s.fare_amount, t.fare_amount) as fare_amount
    from {trips} t left join (select * from {upsert_source} where trip_id % 1000 = 1) s on t.trip_id = s.trip_id
    union all select * from {upsert_source} where trip_id % 1000 = 1 and trip_id not in (select trip_id from {trips})""")
def upserted_fares_in_store(spark, sf):
    store = _trip_store(spark, sf)
    keyed_store.upsert_store(spark, store, view(spark, sf, "upsert_source").where("trip_id % 1000 = 1"), ["fare_amount"])
    return keyed_store.read_store(spark, store)


@query("K5 J1", "select trip_id, date, pickup_hour, fare_amount from {trips} where trip_id % 500 = 3")
def found_in_store(spark, sf):
    """Point lookups: only partitions that can hold a key are read."""
    wanted = view(spark, sf, "trips").where("trip_id % 500 = 3").select("trip_id")
    return keyed_store.find_keys(spark, _trip_store(spark, sf), wanted.unionByName(wanted.select(F.col("trip_id") + 10**9)
                                                                                   .toDF("trip_id")))


def _versions(spark, sf):
    path = new_path(spark, "versions")
    for version, year in enumerate((1997, 1999, 9999), 1):
        U.commit_version(view(spark, sf, "trips").where(F.year("date") < year), path, version)
    return path


@query("K6", "select version, count(*) as record_count from {snapshots} group by version")
def version_history(spark, sf):
    return U.history(U.versions(spark, _versions(spark, sf)))


@query("K7", "select * from {trips} where year(date) < 1997")
def restored_version(spark, sf):
    path = _versions(spark, sf)
    U.restore(spark, path, 1)
    return U.latest(U.versions(spark, path))


_BATCHES = """
    select *, date'2024-01-01' + cast((row_number() over (order by trip_id) - 1) // 1000 as int) as batch_date from {trips}"""


@query("K8", _BATCHES)
def dated_batches(spark, sf):
    return sinks.dated_batches(view(spark, sf, "trips"), "trip_id", dt.date(2024, 1, 1), rows=1000)


@query("K9", f"""
    select case when grouping(f) = 1 then 'TOTAL' else f end as file, count(*) as records,
           case when grouping(f) = 1 then '' else 'Success' end as status,
           case when grouping(f) = 1 then concat(count(distinct f), ' files generated')
                else concat('Created with ', count(*), ' records') end as message
    from (select concat('trips_', cast(batch_date as varchar), '.csv') as f from ({_BATCHES}) a) b group by rollup (f)""")
def write_report(spark, sf):
    batches = sinks.dated_batches(view(spark, sf, "trips"), "trip_id", dt.date(2024, 1, 1), rows=1000)
    name = F.concat(F.lit("trips_"), F.col("batch_date").cast("string"), F.lit(".csv"))
    return sinks.write_report(batches.select(name.alias("file")), "file")


# Reconciliation -------------------------------------------------------------------------------------------------

_BALANCE = """select '{name}' as table_name, e as expected_count, a as actual_count, e - a as difference,
    case when e = a then 'Pass' else 'Fail' end as result, timestamptz '2024-01-01 00:00:00+00' as date
    from (select ({source}) as e, ({target}) as a)"""


@query("Q1 A18", _BALANCE.replace("{name}", "trips").replace(
    "{source}", "select count(distinct trip_id) from {raw_trips}").replace(
    "{target}", "select count(*) from {cleaned_trips}"))
def balance_trips(spark, sf):
    from tripmart.plans.clean import clean_trips

    raw = view(spark, sf, "raw_trips")
    return quality.balance_suite(
        spark, {"trips_file": raw, "trips": clean_trips(raw)}, CHECKED_AT.replace(tzinfo=dt.timezone.utc), ["trips"])


def _check(name: str, source: str, target: str) -> str:
    return _BALANCE.replace("{name}", name).replace("{source}", source).replace("{target}", target)


@query("Q2 U1 A18", " union all ".join([
    _check("trips", "select count(distinct trip_id) from {trips}", "select count(*) from {trips}"),
    _check("trip_details", "select count(distinct trip_id) from {trip_details}", "select count(*) from {trip_details}"),
    _check("customers", "select count(distinct customer_id) from {customers}", "select count(*) from {customers}"),
    _check("drivers", "select count(distinct driver_id) from {drivers}", "select count(*) from {drivers}"),
    _check("vehicles", "select count(distinct driver_id) from {drivers}", "select count(*) from {first_details}"),
    _check("fares", "select count(l.trip_id) from {located_trips} l join {trip_details} d on l.trip_id = d.trip_id",
           "select count(*) from {fares}"),
    _check("located_trips", "select count(trip_id) from {trips}", "select count(*) from {located_trips}"),
    _check("weather_impact", "select count(f.trip_id) from {fares} f join {trip_details} d on f.trip_id = d.trip_id",
           "select count(*) from {impact_rows}"),
    _check("weather_trips", "select count(trip_id) from {trips}", "select count(*) from {enriched}"),
    _check("customer_profile", "select count(*) from {customers} where customer_id in (select customer_id from {rides})",
           "select count(*) from {customer_profile}"),
    _check("customer_preference",
           "select count(*) from {customer_profile} where customer_id in (select customer_id from {ride_rows})",
           "select count(*) from {top_payment}"),
]))
def balance_suite(spark, sf):
    """All eleven checks, each mart built and stored once as the lake holds it."""
    from checks.mart_queries import clean, customers, fares
    from tripmart.operators.lookup import settle

    details = view(spark, sf, "trip_details")
    trips = view(spark, sf, "trips")
    located = settle(inputs.located(spark, sf), "located")
    fare_table = settle(fares.fares(located, details), "fares")
    profile = settle(customers.customer_profile(view(spark, sf, "customers"), fare_table, details), "profile")
    tables = {
        "trips": trips, "trip_details": details, "customers": view(spark, sf, "customers"),
        "drivers": view(spark, sf, "drivers"), "vehicles": clean.clean_dimension(details, "vehicles"),
        "located_trips": located, "fares": fare_table, "weather_trips": inputs.enriched(spark, sf),
        "weather_impact": fares.weather_impact(fare_table, details), "customer_profile": profile,
        "customer_preference": customers.customer_preference(profile, fare_table, details, trips),
    }
    tables |= {f"{t}_file": tables[t] for t in ("trips", "trip_details", "customers", "drivers")}
    return quality.balance_suite(spark, tables, CHECKED_AT.replace(tzinfo=dt.timezone.utc))


# Plain operators ------------------------------------------------------------------------------------------------


@query("P10", "select * from {customers} where membership_status = 'Active'")
def active_customers(spark, sf):
    return unions.active_or_all(view(spark, sf, "customers"), "membership_status")


@query("P10", "select * from {customers}")
def all_when_none_active(spark, sf):
    return unions.active_or_all(view(spark, sf, "customers"), "membership_status", active="Retired")


@query("A22", """
    select (select max(try_cast(regexp_extract(c_name, '[1-9][0-9]*$') as bigint)) from customer) as max_id,
           (select max(date) from {trips}) as last_date""")
def watermarks(spark, sf):
    names = table(spark, sf, "customer").select(F.regexp_extract("c_name", r"[1-9][0-9]*$", 0).alias("id"))
    last = view(spark, sf, "trips").select(F.max("date")).scalar()
    return keys.max_id(names, "id").select("max_id", last.alias("last_date"))


@query("A27", "select driver_id, count(*) as n_trips from {trip_details} group by driver_id")
def driver_usage(spark, sf):
    from tripmart.plans.generate import usage

    return usage(view(spark, sf, "trip_details"), "driver_id")


@query("A27", """
    select count(*) as n_trips, count(distinct customer_id) as n_customers, count(distinct driver_id) as n_drivers
    from {trip_details}""")
def usage_totals(spark, sf):
    from tripmart.plans.generate import usage_totals as totals

    return totals(view(spark, sf, "trip_details"))


@query("W2", "select trip_id, fare_amount from {trips} order by fare_amount, trip_id limit 100 offset 300")
def third_page(spark, sf):
    trips = view(spark, sf, "trips").select("trip_id", "fare_amount")
    return paging.page(trips, ["fare_amount", "trip_id"], 3, 100)


@query("W2", "select trip_id, fare_amount from {trips} where trip_id > 250 order by trip_id limit 50")
def page_after_key(spark, sf):
    return paging.page_after(view(spark, sf, "trips").select("trip_id", "fare_amount"), "trip_id", 250, 50)


@query("W2", "select trip_id, fare_amount from {trips} order by fare_amount, trip_id limit 100 offset (select count(*) // 200 * 100 from {trips})")
def middle_page(spark, sf):
    """A page in the middle of the table by its rank index: of sixteen ranges one or two are read."""
    trips = view(spark, sf, "trips").select("trip_id", "fare_amount")
    index = paging.rank_index(trips, ["fare_amount", "trip_id"], new_path(spark, "ranks"), ranges=16)
    return paging.indexed_page(spark, index, index.rows // 200, 100)


@query("J1", "select * from {trips} where trip_id not in (select trip_id from {current_trips})")
def new_trips_by_filter(spark, sf):
    """The stored trips are asked only about keys that the Bloom filters of their partitions let through."""
    known = view(spark, sf, "current_trips").select("trip_id")
    store = keyed_store.create_store(known, new_path(spark, "store"), ["trip_id"], 16)
    filt = key_filter.create_filter(spark, store, known.where("trip_id % 2 = 0"), new_path(spark, "filter"), 2000)
    key_filter.add_keys(filt, known.where("trip_id % 2 = 1"), 1)
    return key_filter.new_rows_by_filter(spark, view(spark, sf, "trips"), store, filt)


@query("W3 A28", """
    select trip_id from {trips} where trip_id not in (select trip_id from {current_trips}) order by trip_id limit 5""")
def first_new_keys(spark, sf):
    return paging.first_new_keys(
        keys.new_rows(view(spark, sf, "trips"), view(spark, sf, "current_trips"), ["trip_id"]), "trip_id")


@query("U3", """
    select driver_id, driver_name, status from {drivers}
    union all select s_suppkey + 1000000, concat('New ', s_name), 'Active' from supplier""")
def driver_pool(spark, sf):
    added = table(spark, sf, "supplier").selectExpr(
        "s_suppkey + 1000000 as driver_id", "concat('New ', s_name) as driver_name", "'Active' as status")
    return unions.pool(view(spark, sf, "drivers"), added, ["driver_id", "driver_name", "status"])


@query("G1", """
    select row_number() over () + (select max(driver_id) from {drivers}) as driver_id from customer""")
def new_ids(spark, sf):
    from tripmart.plans.generate import with_new_ids

    rows = table(spark, sf, "customer").select("c_custkey")
    return with_new_ids(rows, view(spark, sf, "drivers"), "driver_id", ["c_custkey"]).select("driver_id")


# Scalar functions -----------------------------------------------------------------------------------------------


@query("X1 X2 X5 X6", """
    select trip_id, cast(date as varchar) as day_text, cast(year(date) as int) as year, cast(week(date) as int) as week,
           cast(month(date) as int) as month, cast(DOW[[date]] as int) as day, cast(hour(pickup_datetime) as int) as hour,
           epoch(dropoff_datetime - pickup_datetime) / 60.0 as minutes, monthname(date) as month_name,
           dayname(date) as day_name,
           case when pickup_hour <= 3 then 'After Midnight' when pickup_hour <= 5 then 'Early Morning'
                when pickup_hour <= 9 then 'Morning Rush' when pickup_hour <= 15 then 'Midday'
                when pickup_hour <= 19 then 'Evening Rush' when pickup_hour <= 21 then 'Night' else 'Late Night' end as period,
           case when pickup_hour - 1 >= 0 then cast(null as varchar) else 'InvalidHour' end as before
    from {trips}""")
def date_parts(spark, sf):
    d, hour = F.col("date"), F.col("pickup_hour")
    return view(spark, sf, "trips").select(
        "trip_id", F.date_format(d, "yyyy-MM-dd").alias("day_text"), F.year(d).alias("year"),
        F.weekofyear(d).alias("week"), F.month(d).alias("month"), F.dayofweek(d).alias("day"),
        F.hour("pickup_datetime").alias("hour"),
        C.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("minutes"),
        C.month_name(F.col("pickup_month")).alias("month_name"), C.day_name(F.col("pickup_day")).alias("day_name"),
        C.pickup_period(hour).alias("period"),
        F.when(hour - 1 < 0, C.pickup_period(hour - 1)).alias("before"))


@query("X4", "select event_id, cast(ts as date) as day from events")
def iso_dates(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return table(spark, sf, "events").select("event_id", C.iso_text_date(iso).alias("day"))


@query("X20", r"select o_orderkey, regexp_replace(concat(o_orderpriority, ';(x)=', o_orderstatus),"
              r" '[ ,;{}()\n\t=]', '_', 'g') as clean from orders")
def sanitized_labels(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", text.sanitize(F.concat("o_orderpriority", F.lit(";(x)="), "o_orderstatus")).alias("clean"))


@query("X21", """
    select o_orderkey, try_cast(left(o_orderpriority, 1) as bigint) as level, try_cast(o_orderpriority as double) as none,
           try_cast(cast(o_totalprice as varchar) as double) as price, try_cast(o_orderstatus as int) as no_int
    from orders""")
def tolerant_casts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", text.to_number(F.substring("o_orderpriority", 1, 1), "bigint").alias("level"),
        text.to_number(F.col("o_orderpriority"), "double").alias("none"),
        text.to_number(F.col("o_totalprice").cast("string"), "double").alias("price"),
        text.to_number(F.col("o_orderstatus"), "int").alias("no_int"))
