"""Column layouts of the source tables, looked up by table name."""

from __future__ import annotations

from pyspark.sql import types as T


# The column names and types of the source files.
_LAYOUTS = {
    "trips": """
        trip_id STRING NOT NULL, pickup_datetime TIMESTAMP NOT NULL, dropoff_datetime TIMESTAMP NOT NULL,
        pickup_longitude DOUBLE NOT NULL, pickup_latitude DOUBLE NOT NULL,
        dropoff_longitude DOUBLE, dropoff_latitude DOUBLE,
        passenger_count INT, fare_amount DOUBLE NOT NULL""",
    "trip_details": """
        trip_id STRING NOT NULL, driver_id STRING NOT NULL, customer_id STRING NOT NULL,
        pickup_location STRING, dropoff_location STRING, tip_amount DOUBLE,
        payment_method STRING, trip_status STRING NOT NULL,
        customer_rating DOUBLE, driver_rating DOUBLE, trip_intention STRING""",
    "drivers": """
        driver_id STRING NOT NULL, driver_name STRING NOT NULL, license_no STRING NOT NULL, phone_no STRING NOT NULL,
        email STRING NOT NULL, address STRING, date_of_birth DATE, hire_date DATE,
        experience_level STRING, rating DOUBLE, status STRING, emergency_contact STRING""",
    "customers": """
        customer_id STRING NOT NULL, customer_name STRING NOT NULL, phone_no STRING NOT NULL, email STRING NOT NULL,
        address STRING, date_of_birth DATE, registration_date DATE, customer_type STRING,
        membership_status STRING, rating DOUBLE, preferred_payment STRING""",
    "vehicles": """
        vehicle_no STRING NOT NULL, driver_id STRING NOT NULL, model STRING, year INT, color STRING,
        vehicle_type STRING, fuel_type STRING, seating_capacity INT, mileage INT,
        insurance_expiry DATE, last_maintenance DATE, status STRING, registration_state STRING""",
    "weather": """
        date DATE, avg_temp DOUBLE, precipitation DOUBLE, weather_code INT,
        avg_humidity DOUBLE, avg_wind_speed DOUBLE, avg_cloud_cover DOUBLE, avg_snow_fall DOUBLE""",
    "balance_results": """
        table_name STRING NOT NULL, expected_count BIGINT NOT NULL, actual_count BIGINT NOT NULL,
        difference BIGINT NOT NULL, result STRING NOT NULL, date TIMESTAMP NOT NULL""",
}

# Coordinates stay text here, so Polygon and MultiPolygon files both fit.
_BOUNDARIES = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("cartodb_id", T.IntegerType()),
            T.StructField("created_at", T.StringType()),
            T.StructField("updated_at", T.StringType()),
        ])),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])

TABLES = (*_LAYOUTS, "boundaries")


def schema_for(table: str) -> T.StructType:
    if table == "boundaries":
        return _BOUNDARIES
    if table not in _LAYOUTS:
        raise ValueError(f"no schema for table {table!r}; known: {', '.join(TABLES)}")
    return T.StructType.fromDDL(_LAYOUTS[table])
