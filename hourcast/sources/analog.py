"""Energy-shaped views over the driver's TPC-H-style tables.

The driver tables hold no energy data, so each of the seven source tables is
derived from one of them (whole table, no sampling): the hourly fact from
``events``, daily capacity from ``orders``, hourly prices from ``customer``,
daily gas prices from ``part``, weather grid points from ``supplier`` and
forecast / observed weather from ``lineitem``. All dates start at 2024-01-01
and span 30 days (720 hours).

The views return raw types; :func:`hourcast.operators.conform.conform` casts
them to the declared schemas, as it would for CSV input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalar import add_hours, hour_floor
from ..operators.conform import conform_table
from ..schemas import SCHEMAS

ORIGIN_TS = "2024-01-01 00:00:00"
ORIGIN_DATE = "2024-01-01"
N_DAYS = 30
N_HOURS = 720

DRIVER_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is inferred once per path and then passed
    explicitly, so later reads start no footer-reading job."""
    path = f"{sf_dir}/{name}.parquet"
    known = _SCHEMAS.get(path)
    if known is not None:
        return spark.read.schema(known).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[path] = df.schema
    return df


def _origin_ts() -> Column:
    return F.lit(ORIGIN_TS).cast("timestamp_ntz")


def _origin_date() -> Column:
    return F.lit(ORIGIN_DATE).cast("date")


def _grid(key: Column) -> tuple[Column, Column]:
    """Grid point of a station id: 32 columns of 0.25 degree."""
    lat = (F.lit(57) + F.floor(key / 32) / 4).cast("float")
    lon = (F.lit(21) + (key % 32) / 4).cast("float")
    return lat, lon


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly fact: 12 series (6 units x consumption flag), sum of event values."""
    ev = table(spark, sf_dir, "events")
    unit = F.col("user_id") % 6
    return (
        ev.groupBy(
            hour_floor("ts").alias("datetime"),
            unit.alias("prediction_unit_id"),
            F.col("event_type").isin("click", "view", "signup").alias("is_consumption"),
            unit.alias("county"),
            (unit % 2 == 0).alias("is_business"),
            (unit % 4).alias("product_type"),
        )
        .agg(F.min("event_id").alias("row_id"), F.sum("value").alias("target"))
    )


def client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily installed capacity per county segment; county 5 never appears."""
    o = table(spark, sf_dir, "orders")
    county = F.col("o_custkey") % 5
    return o.groupBy(
        F.date_add(_origin_date(), (F.col("o_orderkey") % N_DAYS).cast("int")).alias("date"),
        county.alias("county"),
        (county % 2 == 0).alias("is_business"),
        (county % 4).alias("product_type"),
    ).agg((F.avg("o_totalprice") / 1000).alias("installed_capacity"))


def electricity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly prices with holes (every 13th hour slot has no price) and
    negatives; every customer row is read, a hole is a null price."""
    c = table(spark, sf_dir, "customer")
    slot = F.col("c_custkey") % N_HOURS
    return c.groupBy(add_hours(_origin_ts(), slot).alias("forecast_date")).agg(
        F.avg(F.when(slot % 13 != 0, F.col("c_acctbal"))).alias("euros_per_mwh")
    )


def gas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily low / high gas price (30 rows); the date arrives as text."""
    p = table(spark, sf_dir, "part")
    day = F.date_add(_origin_date(), (F.col("p_partkey") % N_DAYS).cast("int"))
    return p.groupBy(F.date_format(day, "yyyy-MM-dd").alias("forecast_date")).agg(
        F.min("p_retailprice").alias("lowest_price_per_mwh"),
        F.max("p_retailprice").alias("highest_price_per_mwh"),
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid point -> county for every supplier; grid points of nations with
    key % 6 = 5 belong to no county (null), like an unmapped point."""
    s = table(spark, sf_dir, "supplier")
    lat, lon = _grid(F.col("s_suppkey"))
    county = F.when(F.col("s_nationkey") % 6 != 5, F.col("s_nationkey") % 6)
    return s.select(county.alias("county"), lat.alias("latitude"), lon.alias("longitude"))


def forecast_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast per line item: hours_ahead 8..56, cloud above and below the cap,
    negative direct radiation."""
    li = table(spark, sf_dir, "lineitem")
    lat, lon = _grid(F.col("l_suppkey"))
    slot = (F.col("l_orderkey") * 7 + F.col("l_partkey")) % N_HOURS
    return li.select(
        lat.alias("latitude"),
        lon.alias("longitude"),
        add_hours(_origin_ts(), slot).alias("forecast_datetime"),
        (F.col("l_linenumber") * 8).alias("hours_ahead"),
        F.col("l_quantity").alias("temperature"),
        (F.col("l_discount") * 20).alias("cloudcover_total"),
        (F.col("l_tax") / 100).alias("total_precipitation"),
        (F.col("l_quantity") / 5 - 5).alias("10_metre_u_wind_component"),
        (F.col("l_discount") * 100 - 5).alias("10_metre_v_wind_component"),
        (F.col("l_extendedprice") / 100 - 100).alias("direct_solar_radiation"),
        (F.col("l_quantity") * 10).alias("surface_solar_radiation_downwards"),
    )


def historical_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed weather: one observation per line item, at another hour."""
    li = table(spark, sf_dir, "lineitem")
    lat, lon = _grid(F.col("l_suppkey"))
    slot = (F.col("l_orderkey") * 11 + F.col("l_partkey")) % N_HOURS
    return li.select(
        add_hours(_origin_ts(), slot).alias("datetime"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.col("l_quantity").alias("temperature"),
        (F.col("l_extendedprice") / 100).alias("surface_pressure"),
        F.col("l_tax").alias("rain"),
        F.col("l_discount").alias("snowfall"),
        (F.col("l_discount") * 1000).alias("cloudcover_total"),
        (F.col("l_quantity") / 10).alias("windspeed_10m"),
        (F.col("l_partkey") % 360).alias("winddirection_10m"),
        (F.col("l_extendedprice") / 1000).alias("direct_solar_radiation"),
        (F.col("l_quantity") * 2).alias("diffuse_radiation"),
    )


BUILDERS = {
    "power": power,
    "client": client,
    "electricity": electricity,
    "gas": gas,
    "forecast_weather": forecast_weather,
    "historical_weather": historical_weather,
    "mapping": mapping,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven tables conformed to their declared schemas."""
    return {name: conform_table(df, name, SCHEMAS[name]) for name, df in raw_tables(spark, sf_dir).items()}
