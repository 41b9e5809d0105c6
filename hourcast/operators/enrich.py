"""Enrichment: the star join of the hourly fact with capacity, prices and weather.

Join strategy. Every join here is a left equi-join of the large fact with a
table keyed by time (and county). Those tables grow with the time span, not
with the fact. ``star_merge`` writes each of them once, and Spark plans the join
from the written size: a table under the session's broadcast threshold is
broadcast, a larger one is a shuffle join. Only the filled weather is hinted, and
only after its written input was found below that threshold.

Weather is aggregated to (county, datetime) *before* the join, so the fact
never meets the raw per-grid-point rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import abs_scaled, add_hours, floor_at_zero, mid_price, safe_divide, scale_and_cap
from ..schemas import (
    CLIENT_JOIN_KEYS,
    FORECAST_WEATHER_MEASURES,
    FW_OUTPUT,
    HISTORICAL_WEATHER_MEASURES,
    HW_AGGREGATED,
    MERGED_COLUMNS,
    WEATHER_JOIN_KEYS,
)
from ..session import fits_broadcast, materialize
from .series import join_same


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """Opt-in check that ``keys`` identify rows (one aggregate job)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: duplicate key {dup[0].asDict()} on {list(keys)}")
    return df


def join_capacity(fact: DataFrame, client: DataFrame, keys: Sequence[str] = CLIENT_JOIN_KEYS) -> DataFrame:
    """Attach the day's installed capacity of the fact row's client segment."""
    with_date = fact if "date" in fact.columns else fact.withColumn("date", F.to_date("datetime"))
    return with_date.join(client.select(*keys, "installed_capacity"), list(keys), "left")


def join_price(
    fact: DataFrame,
    prices: DataFrame,
    price_ts: str,
    price_col: str,
    out_col: str,
    absolute: bool = False,
    check_unique: bool = False,
) -> DataFrame:
    """Left join an hourly price on ``datetime``.

    A repeated price timestamp fans the fact row out, as in a plain join;
    ``check_unique=True`` raises instead.
    """
    p = prices.select(F.col(price_ts).alias("datetime"), F.col(price_col))
    if check_unique:
        assert_unique(p, ["datetime"], "prices")
    value = F.abs(F.col(price_col)) if absolute else F.col(price_col)
    return fact.join(p.select("datetime", value.alias(out_col)), "datetime", "left")


def gas_hourly(gas: DataFrame, ts_col: str = "forecast_date") -> DataFrame:
    """Daily gas price -> 24 hourly rows at the mid price.

    ``explode(sequence(0, 23))`` is a generator inside the scan's stage: no join
    and no shuffle.
    """
    return gas.select(
        F.col(ts_col).alias("_day"),
        mid_price("lowest_price_per_mwh", "highest_price_per_mwh").alias("gas_price"),
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"),
    ).select(add_hours("_day", F.col("_h")).alias("datetime"), "gas_price")


GRID_UNITS = 10_000  # whole units of a degree: about ten metres


def grid_key(axis: str) -> Column:
    """A coordinate as a whole number, so that points meet whatever the rounding
    of their last float digit."""
    return F.round(F.col(axis).cast("double") * GRID_UNITS).cast("long")


def map_to_county(weather: DataFrame, mapping: DataFrame) -> DataFrame:
    """Grid point -> county (left: unmapped points keep a null county)."""
    keys = {"_lat": grid_key("latitude"), "_lon": grid_key("longitude")}
    points = mapping.withColumns(keys).select(*keys, "county")
    return weather.withColumns(keys).join(points, list(keys), "left").drop(*keys)


def grouped_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str) -> DataFrame:
    """Mean of each column by key, named ``prefix + column`` (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(*[F.avg(F.col(f"`{c}`")).alias(f"{prefix}{c}") for c in cols])


def forecast_weather_by_county(
    forecast_weather: DataFrame, mapping: DataFrame, max_hours_ahead: int = 24, compat_cloud: bool = False
) -> DataFrame:
    """Forecast weather per (county, datetime) with the derived columns.

    cloud cover in percent capped at 100 (``compat_cloud`` keeps the raw
    fraction), absolute direct radiation, diffuse = |surface| - |direct|
    floored at 0, precipitation in mm.
    """
    fw = forecast_weather.filter(F.col("hours_ahead") <= max_hours_ahead).withColumnRenamed(
        "forecast_datetime", "datetime"
    )
    agg = grouped_mean(map_to_county(fw, mapping), WEATHER_JOIN_KEYS, FORECAST_WEATHER_MEASURES, "fw_")
    surface = F.abs(F.col("fw_surface_solar_radiation_downwards"))
    direct = F.abs(F.col("fw_direct_solar_radiation"))
    derived = {
        "fw_direct_solar_radiation": direct,
        "fw_diffuse_solar_radiation": floor_at_zero(surface - direct),
        "fw_total_precipitation": abs_scaled("fw_total_precipitation", 1000),
    }
    if not compat_cloud:
        derived["fw_cloudcover_total"] = scale_and_cap("fw_cloudcover_total", 100, 100)
    return agg.withColumns(derived).select(*WEATHER_JOIN_KEYS, *FW_OUTPUT)


def observed_weather_by_county(historical_weather: DataFrame, mapping: DataFrame) -> DataFrame:
    """Observed weather per (county, datetime); total precipitation = rain + snowfall."""
    agg = grouped_mean(
        map_to_county(historical_weather, mapping), WEATHER_JOIN_KEYS, HISTORICAL_WEATHER_MEASURES, "hw_"
    )
    return agg.withColumn("hw_total_precipitation", F.col("hw_rain") + F.col("hw_snowfall")).select(
        *WEATHER_JOIN_KEYS, *HW_AGGREGATED
    )


def join_weather_with_median_fill(
    fact: DataFrame,
    weather: DataFrame | Sequence[tuple[DataFrame, Sequence[str]]],
    cols: Sequence[str] | None = None,
    keys: Sequence[str] = WEATHER_JOIN_KEYS,
    by: str = "datetime",
    materialize_medians: bool = True,
) -> DataFrame:
    """Left join per-county weather, then fill each missing value with the
    median of that column over all fact rows at the same ``by`` instant.

    ``weather`` is one table (with ``cols``) or a list of (table, cols): all
    of them are joined first and their medians come from one aggregate.

    Scale: both the joined values and the medians depend on the fact only
    through how many rows stand at each (``keys``). The fact is first reduced to
    those counts (a partial aggregate); the weather is joined to that small
    table, the median is a percentile weighted by the counts, and one join brings
    the filled values to the fact, which is read once more but never sorted or
    shuffled by instant. With ``materialize_medians`` the small joined table, which
    the medians and the fill both read, is written once; the filled rows are as
    many, so they are broadcast if that table's size is below Spark's threshold,
    and otherwise joined as Spark plans it.
    """
    tables = [(weather, list(cols or []))] if isinstance(weather, DataFrame) else [(w, list(c)) for w, c in weather]
    places = list(dict.fromkeys([*keys, by]))
    joined = fact.groupBy(*places).agg(F.count(F.lit(1)).alias("_rows"))
    all_cols: list[str] = []
    for w, wcols in tables:
        joined = joined.join(w.select(*keys, *wcols), list(keys), "left")
        all_cols += wcols
    if materialize_medians:
        joined = materialize(joined)
    medians = joined.groupBy(by).agg(*[F.percentile(c, 0.5, F.col("_rows")).alias(f"_med_{c}") for c in all_cols])
    filled = join_same(joined, medians, [by])
    filled = filled.select(*places, *[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) for c in all_cols])
    if materialize_medians and fits_broadcast(joined):
        filled = F.broadcast(filled)
    return join_same(fact, filled, places)


def lookup_names(df: DataFrame, names: DataFrame, key: str = "county") -> DataFrame:
    """Code -> name; a code table is small, and Spark broadcasts it by its size."""
    return df.join(names, key, "left")


def star_merge(
    tables: dict[str, DataFrame],
    compat_cloud: bool = False,
    check_unique: bool = False,
    materialize_dims: bool = True,
) -> DataFrame:
    """The 27-column merged frame: fact + capacity + prices + weather + capacity factor.

    ``materialize_dims`` writes the tables the fact is joined with (daily
    capacity, hourly electricity and gas prices, and both weathers at the fact's
    places) once, as concurrent jobs. Spark plans each join from the written
    table's real size: a small one is broadcast, a large one is shuffled.
    ``check_unique`` refuses any of the five with a repeated key, which would
    multiply fact rows.
    """
    fact = tables["power"].withColumnRenamed("target", "power")
    client = tables["client"].select(*CLIENT_JOIN_KEYS, "installed_capacity")
    electricity = tables["electricity"].select(
        F.col("forecast_date").alias("datetime"), F.abs(F.col("euros_per_mwh")).alias("electricity_price"))
    gas = gas_hourly(tables["gas"])
    fw = forecast_weather_by_county(tables["forecast_weather"], tables["mapping"], compat_cloud=compat_cloud)
    hw = observed_weather_by_county(tables["historical_weather"], tables["mapping"])
    # Fill values depend only on the joined rows at each instant, so both weather
    # tables share one median aggregate.
    weather = partial(join_weather_with_median_fill, weather=[(fw, FW_OUTPUT), (hw, HW_AGGREGATED)])
    if check_unique:
        for table, keys in ((client, CLIENT_JOIN_KEYS), (fw, WEATHER_JOIN_KEYS), (hw, WEATHER_JOIN_KEYS)):
            assert_unique(table, keys)
    df = fact
    if materialize_dims:
        # Independent small jobs: run them concurrently from driver threads.
        with ThreadPoolExecutor(max_workers=4) as pool:
            joined = pool.submit(weather, fact)
            client, electricity, gas = pool.map(materialize, (client, electricity, gas))
            df = joined.result()
    df = join_capacity(df, client)
    df = join_price(df, electricity, "datetime", "electricity_price", "electricity_price", check_unique=check_unique)
    df = join_price(df, gas, "datetime", "gas_price", "gas_price", check_unique=check_unique)
    if not materialize_dims:
        df = weather(df, materialize_medians=False)
    df = df.withColumn("capacity_factor", safe_divide("power", "installed_capacity"))
    return df.select(*MERGED_COLUMNS)
