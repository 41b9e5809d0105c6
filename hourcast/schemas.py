"""Declared table schemas, column lists and fixed values.

The seven source tables of an hourly energy forecast: the fact ``power`` (one
row per series and hour), daily installed capacity per client segment, hourly
electricity prices, daily gas prices, forecast and observed weather per grid
point, and a grid-point-to-county map.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DoubleType,
    FloatType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)


def make_schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


POWER_SCHEMA = make_schema(
    ("row_id", LongType()),
    ("datetime", TimestampNTZType()),
    ("prediction_unit_id", ShortType()),
    ("is_consumption", BooleanType()),
    ("county", ByteType()),
    ("is_business", BooleanType()),
    ("product_type", ByteType()),
    ("target", DoubleType()),
)

CLIENT_SCHEMA = make_schema(
    ("date", DateType()),
    ("county", ByteType()),
    ("is_business", BooleanType()),
    ("product_type", ByteType()),
    ("installed_capacity", DoubleType()),
)

ELECTRICITY_SCHEMA = make_schema(
    ("forecast_date", TimestampNTZType()),
    ("euros_per_mwh", DoubleType()),
)

GAS_SCHEMA = make_schema(
    ("forecast_date", TimestampNTZType()),
    ("lowest_price_per_mwh", DoubleType()),
    ("highest_price_per_mwh", DoubleType()),
)

FORECAST_WEATHER_MEASURES = [
    "temperature",
    "cloudcover_total",
    "total_precipitation",
    "10_metre_u_wind_component",
    "10_metre_v_wind_component",
    "direct_solar_radiation",
    "surface_solar_radiation_downwards",
]

FORECAST_WEATHER_SCHEMA = make_schema(
    ("latitude", FloatType()),
    ("longitude", FloatType()),
    ("forecast_datetime", TimestampNTZType()),
    ("hours_ahead", ByteType()),
    *[(c, FloatType()) for c in FORECAST_WEATHER_MEASURES],
)

HISTORICAL_WEATHER_MEASURES = [
    "temperature",
    "surface_pressure",
    "rain",
    "snowfall",
    "cloudcover_total",
    "windspeed_10m",
    "winddirection_10m",
    "direct_solar_radiation",
    "diffuse_radiation",
]

HISTORICAL_WEATHER_SCHEMA = make_schema(
    ("datetime", TimestampNTZType()),
    ("latitude", FloatType()),
    ("longitude", FloatType()),
    *[(c, FloatType()) for c in HISTORICAL_WEATHER_MEASURES],
)

MAPPING_SCHEMA = make_schema(
    ("county", ByteType()),
    ("latitude", FloatType()),
    ("longitude", FloatType()),
)

SCHEMAS: dict[str, StructType] = {
    "power": POWER_SCHEMA,
    "client": CLIENT_SCHEMA,
    "electricity": ELECTRICITY_SCHEMA,
    "gas": GAS_SCHEMA,
    "forecast_weather": FORECAST_WEATHER_SCHEMA,
    "historical_weather": HISTORICAL_WEATHER_SCHEMA,
    "mapping": MAPPING_SCHEMA,
}

# Keep-last keys of each table (newest version of a row wins).
TABLE_KEYS: dict[str, list[str]] = {
    "power": ["datetime", "prediction_unit_id", "is_consumption", "county", "is_business", "product_type"],
    "client": ["date", "county", "is_business", "product_type"],
    "electricity": ["forecast_date"],
    "gas": ["forecast_date"],
    "forecast_weather": ["latitude", "longitude", "forecast_datetime", "hours_ahead"],
    "historical_weather": ["datetime", "latitude", "longitude"],
    "mapping": ["latitude", "longitude"],
}

# Text formats of the source files.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

SERIES_KEYS = ["prediction_unit_id", "is_consumption"]
CLIENT_JOIN_KEYS = ["product_type", "county", "is_business", "date"]
WEATHER_JOIN_KEYS = ["county", "datetime"]

# Forecast weather after aggregation: the surface radiation becomes the diffuse part.
FW_OUTPUT = [
    "fw_temperature",
    "fw_cloudcover_total",
    "fw_total_precipitation",
    "fw_10_metre_u_wind_component",
    "fw_10_metre_v_wind_component",
    "fw_direct_solar_radiation",
    "fw_diffuse_solar_radiation",
]

HW_AGGREGATED = [f"hw_{c}" for c in HISTORICAL_WEATHER_MEASURES] + ["hw_total_precipitation"]

HW_OUTPUT = [
    "hw_temperature",
    "hw_surface_pressure",
    "hw_cloudcover_total",
    "hw_total_precipitation",
    "hw_windspeed_10m",
    "hw_winddirection_10m",
    "hw_direct_solar_radiation",
    "hw_diffuse_radiation",
]

# Column order of the merged frame (27 columns).
MERGED_COLUMNS = [
    "row_id",
    "datetime",
    "prediction_unit_id",
    "is_consumption",
    "county",
    "is_business",
    "product_type",
    "capacity_factor",
    "power",
    "installed_capacity",
    "electricity_price",
    "gas_price",
    *FW_OUTPUT,
    *HW_OUTPUT,
]

CALENDAR_FLAGS = [
    "is_holiday",
    "is_day_before_holiday",
    "is_dst_spring_forward",
    "is_dst_fall_backward",
]

CYCLIC_COLUMNS = [
    f"{part}_{fn}" for part in ("hour", "day", "day_of_week", "month", "year") for fn in ("sin", "cos")
]

# Fixed values that must equal the reference for the same features.
# Lag periods in hours and the eleven lagged columns.
DEFAULT_LAGS = [12, 24, 168, 720]
LAG_COLUMNS = [
    "capacity_factor",
    "electricity_price",
    "gas_price",
    "hw_temperature",
    "hw_surface_pressure",
    "hw_cloudcover_total",
    "hw_total_precipitation",
    "hw_windspeed_10m",
    "hw_winddirection_10m",
    "hw_direct_solar_radiation",
    "hw_diffuse_radiation",
]
# Periods of the cyclic encodings: hour/24, day/31, weekday/7, month/12, year/2023.
CYCLIC_PERIODS = {"hour": 24, "day": 31, "day_of_week": 7, "month": 12, "year": 2023}
# Closed range dropped from training rows.
EXCLUDED_RANGE = ("2021-09-01 00:00:00", "2021-09-02 23:59:59")
# Years covered by the holiday and DST calendars.
CALENDAR_YEARS = (2021, 2026)
# County code -> name.
COUNTY_NAMES = {
    0: "HARJUMAA",
    1: "HIIUMAA",
    2: "IDA-VIRUMAA",
    3: "JÄRVAMAA",
    4: "JÕGEVAMAA",
    5: "LÄÄNE-VIRUMAA",
    6: "LÄÄNEMAA",
    7: "PÄRNUMAA",
    8: "PÕLVAMAA",
    9: "RAPLAMAA",
    10: "SAAREMAA",
    11: "TARTUMAA",
    12: "UNKNOWN",
    13: "VALGAMAA",
    14: "VILJANDIMAA",
    15: "VÕRUMAA",
}
# Learner: seed, categorical columns, search space, folds and trials.
RANDOM_SEED = 3112
CATEGORICAL_FEATURES = [
    "prediction_unit_id",
    "is_consumption",
    "county",
    "is_business",
    "product_type",
    "is_holiday",
    "is_day_before_holiday",
    "is_dst_spring_forward",
    "is_dst_fall_backward",
]
DEFAULT_CV_SPLITS = 3
DEFAULT_TRIALS = 10
# Columns that are never model features.
NON_FEATURES = ["datetime", "capacity_factor", "row_id"]

MODES = ("train", "retrain", "test")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got: {mode!r}")
    return mode


def lag_name(col: str, lag: int) -> str:
    return f"{col}_lag_{lag}"


def feature_columns(lags: list[int] | None = None) -> list[str]:
    """Columns of the feature frame, in order (84 with the default lags)."""
    lags = lags or DEFAULT_LAGS
    base = [c for c in MERGED_COLUMNS if c != "power"]
    return base + CALENDAR_FLAGS + CYCLIC_COLUMNS + [lag_name(c, n) for c in LAG_COLUMNS for n in lags]
