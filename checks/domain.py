"""The trip domain as views over the given tables, from one SQL text for Spark and DuckDB.

``NAME[[x]]`` is a macro with a spelling per engine. A view may name base tables and earlier views in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.lookup import settle
from tripmart.operators.spatial import Cells
from tripmart.plans import weather
from tripmart.plans.boroughs import borough_cells

MACROS = {
    "HOURS": ("make_dt_interval(0, cast({} as int))", "to_hours(cast({} as bigint))"),
    "MINUTES": ("make_dt_interval(0, 0, cast({} as int))", "to_minutes(cast({} as bigint))"),
    "DOW": ("dayofweek({})", "(dayofweek({}) + 1)"),
    "DAYNO": ("datediff({}, date'1995-01-01')", "datediff('day', date'1995-01-01', {})"),
    # Oracle only: half-up rounding of a double's shortest decimal form, as Spark rounds.
    "R0": ("", "cast(round(cast(cast({} as varchar) as decimal(38,18)), 0) as double)"),
    "R1": ("", "cast(round(cast(cast({} as varchar) as decimal(38,18)), 1) as double)"),
    "R2": ("", "cast(round(cast(cast({} as varchar) as decimal(38,18)), 2) as double)"),
    "R6": ("", "cast(round(cast(cast({} as varchar) as decimal(38,18)), 6) as double)"),
    # The same for sums and averages, whose last bits depend on the order of addition.
    "SR0": ("", "cast(round(round(cast(cast({} as varchar) as decimal(38,18)), 9), 0) as double)"),
    "SR6": ("", "cast(round(round(cast(cast({} as varchar) as decimal(38,18)), 9), 6) as double)"),
    "SR2": ("", "cast(round(round(cast(cast({} as varchar) as decimal(38,18)), 9), 2) as double)"),
    "ADDDAYS": ("date_add(date'1995-01-01', cast({} as int))", "(date'1995-01-01' + cast({} as int))"),
}

BASE = {
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
}

VIEWS = {
    # Trips with calendar columns; some lack a dropoff position or a passenger count.
    "trips": """
        select o_orderkey as trip_id,
               cast(o_orderdate as date) as date,
               o_orderdate + HOURS[[o_orderkey % 24]] as pickup_datetime,
               o_orderdate + HOURS[[o_orderkey % 24]] + MINUTES[[5 + o_orderkey % 56]] as dropoff_datetime,
               cast(o_orderkey % 24 as int) as pickup_hour,
               cast(DOW[[o_orderdate]] as int) as pickup_day,
               cast(month(o_orderdate) as int) as pickup_month,
               (o_orderkey * 7919 % 5300) / cast(1000 as double) as pickup_longitude,
               (o_orderkey * 104729 % 5300) / cast(1000 as double) as pickup_latitude,
               case when o_orderkey % 29 = 0 then null
                    else (o_orderkey * 611953 % 5300) / cast(1000 as double) end as dropoff_longitude,
               case when o_orderkey % 29 = 0 then null
                    else (o_orderkey * 3571 % 5300) / cast(1000 as double) end as dropoff_latitude,
               case when o_orderkey % 11 = 0 then null else cast(o_orderkey % 6 + 1 as int) end as passenger_count,
               o_totalprice / cast(10000 as double) as fare_amount
        from {orders}""",
    # Details are missing for the cheapest trips.
    "trip_details": """
        select o_orderkey as trip_id,
               o_orderkey % 97 as driver_id,
               o_custkey as customer_id,
               p.n_name as pickup_location,
               d.n_name as dropoff_location,
               (o_orderkey * 31 % 500) / cast(100 as double) as tip_amount,
               o_orderpriority as payment_method,
               case o_orderstatus when 'F' then 'Completed' when 'O' then 'Cancelled' else 'No Show' end as trip_status,
               case when o_orderkey % 16 = 0 then null
                    else (o_orderkey % 9) / cast(2 as double) + 1 end as customer_rating,
               case when o_orderkey % 15 = 0 then null
                    else (o_orderkey % 7) / cast(2 as double) + 1 end as driver_rating,
               concat('intent ', cast(o_orderkey % 7 as varchar(4))) as trip_intention
        from {orders}
        join {nation} p on p.n_nationkey = o_orderkey % 25
        join {nation} d on d.n_nationkey = (o_orderkey * 3 + 1) % 25
        where o_totalprice >= 40000""",
    # Raw details: some lack a key, most trips have several.
    "raw_details": """
        select case when l_linenumber = 7 then null else l_orderkey end as trip_id,
               case when l_partkey % 41 = 0 then null else l_suppkey end as driver_id,
               case when l_partkey % 43 = 0 then null else l_partkey % 150 + 1 end as customer_id,
               concat('place ', cast(l_partkey % 25 as varchar(4))) as pickup_location,
               (l_orderkey * 31 % 500) / cast(100 as double) as tip_amount,
               l_returnflag as payment_method
        from {lineitem}""",
    "weather_all": """
        select d as date,
               (dn * 37 % 600) / cast(10 as double) - 12 as avg_temp,
               (dn * 13 % 160) / cast(10 as double) as precipitation,
               cast(dn % 4 as int) as weather_code,
               (dn * 19 % 1000) / cast(10 as double) as avg_humidity,
               (dn * 11 % 500) / cast(10 as double) as avg_wind_speed,
               (dn * 23 % 1000) / cast(10 as double) as avg_cloud_cover,
               (dn * 7 % 80) / cast(10 as double) as avg_snow_fall
        from (select d, DAYNO[[d]] as dn from (select distinct cast(o_orderdate as date) as d from {orders}) x) y""",
    # No report on the 17th of a month; a second source has those days but for June.
    "weather": "select * from {weather_all} where day(date) <> 17",
    "weather_backup": "select * from {weather_all} where not (day(date) = 17 and month(date) = 6)",
    "weather_hourly": """
        select cast(ts as date) as date,
               user_id % 30 as station,
               cast(hour(ts) as int) as hour,
               case when event_id % 5 = 0 then null else value end as temperature_2m,
               value / cast(10 as double) as precipitation,
               case when event_id % 7 = 0 then null else cast(cast(floor(value) as bigint) % 4 as int) end as weather_code,
               value * 2 as relative_humidity_2m,
               case when event_type = 'error' then null else value / cast(4 as double) end as wind_speed_10m,
               value + 1 as cloudcover,
               case when event_type = 'view' then value / cast(8 as double) end as snowfall
        from {events}""",
    "boroughs": """
        select n_name as borough,
               cast(n_nationkey % 5 as double) as x0, cast(n_nationkey % 5 + 1 as double) as x1,
               cast(floor(n_nationkey / cast(5 as double)) as double) as y0,
               cast(floor(n_nationkey / cast(5 as double)) + 1 as double) as y1
        from {nation}""",
    "customers": """
        select c_custkey as customer_id,
               c_name as customer_name,
               concat(lower(c_name), '@example.org') as email,
               concat('+1', cast(c_custkey + 1000000000 as varchar(12))) as phone_no,
               concat('Street ', cast(c_nationkey as varchar(4))) as address,
               ADDDAYS[[c_custkey * 53 % 15000 - 20000]] as date_of_birth,
               ADDDAYS[[c_custkey * 7 % 2000]] as registration_date,
               c_mktsegment as customer_type,
               case when c_custkey % 5 = 0 then 'Suspended' else 'Active' end as membership_status
        from {customer}""",
    "drivers": """
        select s_suppkey as driver_id, s_name as driver_name,
               case when s_suppkey % 6 = 0 then 'On Leave' else 'Active' end as status,
               s_acctbal / cast(2000 as double) as rating
        from {supplier}""",
    # Raw trips: several line items share a trip id, and some lack a position, a time or a passenger count.
    "raw_trips": """
        select l_orderkey as trip_id,
               case when l_partkey % 101 = 0 then null
                    else l_shipdate + HOURS[[l_partkey % 24]] end as pickup_datetime,
               l_shipdate + HOURS[[l_partkey % 24]] + MINUTES[[5 + l_suppkey % 56]] as dropoff_datetime,
               (l_partkey * 7919 % 5300) / cast(1000 as double) as pickup_longitude,
               (l_partkey * 104729 % 5300) / cast(1000 as double) as pickup_latitude,
               case when l_suppkey % 29 = 0 then null
                    else (l_partkey * 611953 % 5300) / cast(1000 as double) end as dropoff_longitude,
               (l_suppkey * 3571 % 5300) / cast(1000 as double) as dropoff_latitude,
               case when l_linenumber = 3 then null else cast(l_quantity as int) % 6 + 1 end as passenger_count,
               l_extendedprice / cast(10000 as double) as fare_amount
        from {lineitem}""",
    # Trips loaded before 1998; the rest are new.
    "current_trips": "select * from {trips} where date < date'1998-01-01'",
    # Updates of the trips of 1997 and new copies of those of 1998.
    "upsert_source": """
        select trip_id, date, pickup_hour, fare_amount + 1 as fare_amount from {trips} where year(date) = 1997
        union all
        select trip_id + 1000000000 as trip_id, date, pickup_hour, fare_amount from {trips} where year(date) = 1998""",
    # A table that grows: each version adds years.
    "snapshots": """
        select *, 1 as version from {trips} where year(date) < 1997
        union all select *, 2 as version from {trips} where year(date) < 1999
        union all select *, 3 as version from {trips}""",
}

_NAME = re.compile(r"\{(\w+)\}")
_MACRO = re.compile(r"(\w+)\[\[((?:(?!\[\[|\]\]).)*)\]\]", re.S)


def _spell(sql: str, engine: int) -> str:
    while _MACRO.search(sql):
        sql = _MACRO.sub(lambda m: MACROS[m.group(1)][engine].format(m.group(2)), sql)
    return sql


def _needs(name: str, views: dict[str, str], seen: list[str]) -> None:
    for other in _NAME.findall(views[name]):
        if other in views:
            _needs(other, views, seen)
    if name not in seen:
        seen.append(name)


def duck(sql: str, more: dict[str, str] | None = None) -> str:
    """A DuckDB query: views named in braces become CTEs in front of it, base tables stay as they are."""
    views = VIEWS | (more or {})
    order: list[str] = []
    for name in _NAME.findall(sql):
        if name in views:
            _needs(name, views, order)
    ctes = [f"{n} as ({_NAME.sub(r'\1', _spell(views[n], 1)).strip()})" for n in order]
    body = _NAME.sub(r"\1", _spell(sql, 1)).strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body


_STORED: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """Plans and paths made once per session and folder; the rows are read anew by every query."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _once(spark, sf_dir, f"table {name}", lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Spark view of the trip domain."""
    def make():
        sql = _spell(VIEWS[name], 0)
        used = {n: view(spark, sf_dir, n) if n in VIEWS else table(spark, sf_dir, n) for n in set(_NAME.findall(sql))}
        return spark.sql(sql, **used)

    return _once(spark, sf_dir, f"view {name}", make)


def stored_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A small view written out once per session, as the lake keeps its weather table; joins then see its real size."""
    return _once(spark, sf_dir, f"stored {name}", lambda: settle(view(spark, sf_dir, name), name))


def best_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather table after its refill, stored once per session as the lake keeps it."""
    return _once(spark, sf_dir, "best weather", lambda: settle(weather.best_weather(
        view(spark, sf_dir, "weather"), view(spark, sf_dir, "weather_backup")), "weather"))


def cells(spark: SparkSession, sf_dir: str) -> Cells:
    """The grid cells of the boroughs, prepared once per session as a boundary load does."""
    return _once(spark, sf_dir, "cells", lambda: borough_cells(box_shapes(spark, sf_dir)))


def box_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boroughs with their boxes as multipolygons."""
    ring = "array(array(x0, y0), array(x1, y0), array(x1, y1), array(x0, y1), array(x0, y0))"
    return view(spark, sf_dir, "boroughs").selectExpr("borough", f"array(array({ring})) as shape")
