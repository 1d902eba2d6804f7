"""Reading tables: files with fixed schemas, dated drops, databases, and whole mart inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.paths import Lake
from tripmart.schemas import schema_for

# Tables each mart reads, and the layer each table is kept in.
MART_SOURCES = {
    "fares": ["located_trips", "trip_details"],
    "weather_impact": ["fares", "trip_details"],
    "time_series": ["fares", "trips"],
    "customer_profile": ["customers", "fares", "trip_details"],
    "customer_preference": ["customer_profile", "fares", "trip_details", "trips"],
}
TABLE_LAYERS = {
    "trips": "raw", "trip_details": "raw", "customers": "raw", "drivers": "raw", "vehicles": "raw",
    "weather": "raw", "boundaries": "raw", "weather_trips": "enrich", "located_trips": "enrich", "fares": "enrich",
    "weather_impact": "enrich", "time_series": "enrich", "customer_profile": "enrich",
    "customer_preference": "enrich", "balance_results": "system",
}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header. A schema binds by position, since a file may name its key differently."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", True)
    return reader.csv(path)


def read_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per file; a feature collection is one JSON document."""
    return spark.read.option("multiLine", True).schema(schema_for("boundaries")).json(path)


# Between two features stands this word in quotes; the word in the collection's own type is a longer one.
_FEATURE = '"Feature"'


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """One row ``f`` per feature, also where one file holds all of them: the file is split between features and read by many tasks.

    A feature must begin with its type, as GeoJSON writers have it. A file whose features do not, or whose values hold the word "Feature", ends the load
    with an error; ``read_geojson`` takes such files whole.
    """
    pieces = spark.read.option("lineSep", _FEATURE).text(path)
    # What stands before the first feature of a file opens the collection; each other piece goes on with a comma or a brace.
    rest = F.ltrim("value")
    opens = r'[\[,]\s*\{\s*"type"\s*:\s*$'
    sound = F.col("value").rlike(opens) | F.col("value").rlike(r"\}\s*$")
    checked = F.when(sound, F.col("value")).otherwise(F.raise_error(F.lit("a feature does not begin with its type; read the file with read_geojson")))
    feature = schema_for("boundaries")["features"].dataType.elementType
    body = F.concat(F.lit('{"type": "Feature"'), F.regexp_replace(checked, opens, ""))
    return (pieces.where(rest.startswith(",") | rest.startswith("}") | ~sound).select(F.from_json(body, feature).alias("f")))


def read_days(spark: SparkSession, path: str, first: dt.date, last: dt.date, date: str = "date") -> DataFrame:
    """The days of a table that ``sinks.publish_days`` wrote; folders of other days are not read."""
    return read_columns(spark, path).where(F.col(date).between(F.lit(first), F.lit(last)))


def jdbc_options(
    url: str, table: str, properties: dict[str, str] | None = None,
    partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column the read is split over several connections."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a split read needs partition_column, lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()


def load(
    spark: SparkSession, path: str, kind: str, schema: StructType | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """One entry for every file kind."""
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind in ("parquet", "delta", "orc"):
        return read_columns(spark, path, kind)
    if kind == "geojson":
        return read_geojson(spark, path)
    if kind == "jdbc":
        return spark.read.format("jdbc").options(dbtable=path, **(options or {})).load()
    raise ValueError(f"unknown table kind {kind!r}")


def read_drop(
    spark: SparkSession, lake: Lake, table: str, loadtype: str, date: dt.date | str | None = None,
) -> DataFrame:
    """CSV drops of a table, each row with the date of the folder it came from."""
    raw = read_csv(spark, lake.drop(table, loadtype, date), schema_for(table))
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/", 1)
    return raw.select(*raw.columns, folder.try_cast("date").alias("drop_date"))


def load_mart_sources(
    spark: SparkSession, lake: Lake, mart: str, fmt: str = "parquet", layers: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Every table a mart reads, by name."""
    if mart not in MART_SOURCES:
        raise ValueError(f"no mart named {mart!r}")
    return load_tables(spark, lake, MART_SOURCES[mart], fmt, layers)


def load_tables(
    spark: SparkSession, lake: Lake, tables: Iterable[str], fmt: str = "parquet", layers: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    layers = layers or TABLE_LAYERS
    return {t: read_columns(spark, lake.current(t, layers[t], fmt), fmt) for t in tables}


def sql_over_files(spark: SparkSession, query: str, fmt: str = "parquet", **paths: str) -> DataFrame:
    """SQL straight over files: each ``{name}`` in the query becomes fmt.`path`."""
    return spark.sql(query.format(**{name: f"{fmt}.`{path}`" for name, path in paths.items()}))
