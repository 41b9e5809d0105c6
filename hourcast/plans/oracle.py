"""DuckDB SQL for each driver query: the independent oracle.

Only the base driver tables are registered in DuckDB, so every query carries
the energy-shaped views it needs as CTEs, written here in DuckDB's dialect
with the same casts as the declared schemas. Doubles are rounded to 6 places on
both sides.
"""

from __future__ import annotations

from ..schemas import (
    COUNTY_NAMES,
    CYCLIC_PERIODS,
    EXCLUDED_RANGE,
    FORECAST_WEATHER_MEASURES,
    FW_OUTPUT,
    HISTORICAL_WEATHER_MEASURES,
    HW_AGGREGATED,
    HW_OUTPUT,
    LAG_COLUMNS,
    MERGED_COLUMNS,
    lag_name,
)

T0 = "timestamp '2024-01-01 00:00:00'"
D0 = "date '2024-01-01'"


def q(name: str) -> str:
    return f'"{name}"'


def grid(key: str) -> tuple[str, str]:
    return (
        f"cast(57 + floor({key} / 32) / 4 as float)",
        f"cast(21 + ({key} % 32) / 4 as float)",
    )


_LAT_S, _LON_S = grid("s_suppkey")
_LAT_L, _LON_L = grid("l_suppkey")

BASE = {
    "power": f"""
  select cast(min(event_id) as bigint) as row_id,
         date_trunc('hour', ts) as datetime,
         cast(user_id % 6 as smallint) as prediction_unit_id,
         event_type in ('click', 'view', 'signup') as is_consumption,
         cast(user_id % 6 as tinyint) as county,
         (user_id % 6) % 2 = 0 as is_business,
         cast((user_id % 6) % 4 as tinyint) as product_type,
         sum(value) as target
  from events group by 2, 3, 4, 5, 6, 7""",
    "client": f"""
  select {D0} + cast(o_orderkey % 30 as integer) as date,
         cast(o_custkey % 5 as tinyint) as county,
         (o_custkey % 5) % 2 = 0 as is_business,
         cast((o_custkey % 5) % 4 as tinyint) as product_type,
         avg(o_totalprice) / 1000 as installed_capacity
  from orders group by 1, 2, 3, 4""",
    "electricity": f"""
  select {T0} + to_hours(cast(c_custkey % 720 as integer)) as forecast_date,
         avg(case when (c_custkey % 720) % 13 <> 0 then c_acctbal end) as euros_per_mwh
  from customer group by 1""",
    "gas": f"""
  select cast({D0} + cast(p_partkey % 30 as integer) as timestamp) as forecast_date,
         min(p_retailprice) as lowest_price_per_mwh,
         max(p_retailprice) as highest_price_per_mwh
  from part group by 1""",
    "mapping": f"""
  select cast(case when s_nationkey % 6 <> 5 then s_nationkey % 6 end as tinyint) as county,
         {_LAT_S} as latitude, {_LON_S} as longitude
  from supplier""",
    "forecast_weather": f"""
  select {_LAT_L} as latitude, {_LON_L} as longitude,
         {T0} + to_hours(cast((l_orderkey * 7 + l_partkey) % 720 as integer)) as forecast_datetime,
         cast(l_linenumber * 8 as tinyint) as hours_ahead,
         cast(l_quantity as float) as temperature,
         cast(l_discount * 20 as float) as cloudcover_total,
         cast(l_tax / 100 as float) as total_precipitation,
         cast(l_quantity / 5 - 5 as float) as "10_metre_u_wind_component",
         cast(l_discount * 100 - 5 as float) as "10_metre_v_wind_component",
         cast(l_extendedprice / 100 - 100 as float) as direct_solar_radiation,
         cast(l_quantity * 10 as float) as surface_solar_radiation_downwards
  from lineitem""",
    "historical_weather": f"""
  select {T0} + to_hours(cast((l_orderkey * 11 + l_partkey) % 720 as integer)) as datetime,
         {_LAT_L} as latitude, {_LON_L} as longitude,
         cast(l_quantity as float) as temperature,
         cast(l_extendedprice / 100 as float) as surface_pressure,
         cast(l_tax as float) as rain,
         cast(l_discount as float) as snowfall,
         cast(l_discount * 1000 as float) as cloudcover_total,
         cast(l_quantity / 10 as float) as windspeed_10m,
         cast(l_partkey % 360 as float) as winddirection_10m,
         cast(l_extendedprice / 1000 as float) as direct_solar_radiation,
         cast(l_quantity * 2 as float) as diffuse_radiation
  from lineitem""",
}

_fw_means = ",\n         ".join(f"avg({q(c)}) as {q('fw_' + c)}" for c in FORECAST_WEATHER_MEASURES)
_hw_means = ",\n         ".join(f"avg({q(c)}) as {q('hw_' + c)}" for c in HISTORICAL_WEATHER_MEASURES)

DERIVED = {
    "fact": """
  select row_id, datetime, prediction_unit_id, is_consumption, county, is_business, product_type,
         target as power, cast(datetime as date) as date
  from power""",
    "with_capacity": """
  select f.*, c.installed_capacity
  from fact f left join client c
    on f.product_type = c.product_type and f.county = c.county
   and f.is_business = c.is_business and f.date = c.date""",
    "elec": "\n  select forecast_date as datetime, abs(euros_per_mwh) as electricity_price from electricity",
    "gas_h": """
  select forecast_date + to_hours(cast(h.range as integer)) as datetime,
         (lowest_price_per_mwh + highest_price_per_mwh) / 2 as gas_price
  from gas cross join range(24) h""",
    "fw_agg": f"""
  select m.county, w.forecast_datetime as datetime,
         {_fw_means}
  from forecast_weather w left join mapping m
    on w.latitude = m.latitude and w.longitude = m.longitude
  where w.hours_ahead <= 24
  group by 1, 2""",
    "fw": """
  select county, datetime, fw_temperature,
         case when fw_cloudcover_total * 100 > 100 then 100.0 else fw_cloudcover_total * 100 end
           as fw_cloudcover_total,
         abs(fw_total_precipitation * 1000) as fw_total_precipitation,
         fw_10_metre_u_wind_component, fw_10_metre_v_wind_component,
         abs(fw_direct_solar_radiation) as fw_direct_solar_radiation,
         case when abs(fw_surface_solar_radiation_downwards) - abs(fw_direct_solar_radiation) < 0 then 0.0
              else abs(fw_surface_solar_radiation_downwards) - abs(fw_direct_solar_radiation) end
           as fw_diffuse_solar_radiation
  from fw_agg""",
    "hw_agg": f"""
  select m.county, w.datetime,
         {_hw_means}
  from historical_weather w left join mapping m
    on w.latitude = m.latitude and w.longitude = m.longitude
  group by 1, 2""",
    "hw": "\n  select *, hw_rain + hw_snowfall as hw_total_precipitation from hw_agg",
    "s1": """
  select w.*, e.electricity_price from with_capacity w left join elec e on w.datetime = e.datetime""",
    "s2": """
  select s.*, g.gas_price from s1 s left join gas_h g on s.datetime = g.datetime""",
    "s3": "\n  select s.*, "
    + ", ".join(f"fw.{c}" for c in FW_OUTPUT)
    + "\n  from s2 s left join fw on s.county = fw.county and s.datetime = fw.datetime",
    "s4": "\n  select * replace ("
    + ",\n    ".join(f"coalesce({c}, median({c}) over (partition by datetime)) as {c}" for c in FW_OUTPUT)
    + ")\n  from s3",
    "s5": "\n  select s.*, "
    + ", ".join(f"hw.{c}" for c in HW_AGGREGATED)
    + "\n  from s4 s left join hw on s.county = hw.county and s.datetime = hw.datetime",
    "s6": "\n  select * replace ("
    + ",\n    ".join(f"coalesce({c}, median({c}) over (partition by datetime)) as {c}" for c in HW_AGGREGATED)
    + ")\n  from s5",
    "merged": "\n  select "
    + ", ".join("power / nullif(installed_capacity, 0) as capacity_factor" if c == "capacity_factor" else c
                for c in MERGED_COLUMNS)
    + "\n  from s6",
}

ORDER = [
    "power", "client", "electricity", "gas", "mapping", "forecast_weather", "historical_weather",
    "fact", "with_capacity", "elec", "gas_h", "fw_agg", "fw", "hw_agg", "hw",
    "s1", "s2", "s3", "s4", "s5", "s6", "merged",
]
DEPS = {
    "fact": ["power"],
    "with_capacity": ["fact", "client"],
    "elec": ["electricity"],
    "gas_h": ["gas"],
    "fw_agg": ["forecast_weather", "mapping"],
    "fw": ["fw_agg"],
    "hw_agg": ["historical_weather", "mapping"],
    "hw": ["hw_agg"],
    "s1": ["with_capacity", "elec"],
    "s2": ["s1", "gas_h"],
    "s3": ["s2", "fw"],
    "s4": ["s3"],
    "s5": ["s4", "hw"],
    "s6": ["s5"],
    "merged": ["s6"],
}
VIEWS = {**BASE, **DERIVED}


def _closure(names: list[str]) -> set[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(DEPS.get(n, []))
    return need


def with_views(views: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """``with`` clause holding the named views (and their dependencies) + extra CTEs."""
    need = _closure(views)
    ctes = [f"{n} as ({VIEWS[n]}\n)" for n in ORDER if n in need]
    ctes += [f"{n} as ({sql}\n)" for n, sql in extra]
    return "with " + ",\n".join(ctes) + "\n" + body


def r6(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) as {q(alias or expr)}"


# Fixed values, taken from calendars and not from the code under test: Easter
# Sundays, and the last Sundays of March and October, of the years in the data.
EASTER = """1992-04-19 1993-04-11 1994-04-03 1995-04-16 1996-04-07 1997-03-30 1998-04-12 1999-04-04 2000-04-23
2001-04-15 2002-03-31 2021-04-04 2022-04-17 2023-04-09 2024-03-31 2025-04-20 2026-04-05""".split()
SPRING = """1992-03-29 1993-03-28 1994-03-27 1995-03-26 1996-03-31 1997-03-30 1998-03-29 1999-03-28 2000-03-26
2001-03-25 2002-03-31 2021-03-28 2022-03-27 2023-03-26 2024-03-31 2025-03-30 2026-03-29""".split()
FALL = """1992-10-25 1993-10-31 1994-10-30 1995-10-29 1996-10-27 1997-10-26 1998-10-25 1999-10-31 2000-10-29
2001-10-28 2002-10-27 2021-10-31 2022-10-30 2023-10-29 2024-10-27 2025-10-26 2026-10-25""".split()
FIXED_DAYS = "01-01 02-24 05-01 06-23 06-24 08-20 12-24 12-25 12-26".split()


def _holiday(date: str) -> str:
    easter = ", ".join(f"date '{d}' + {k}" for d in EASTER for k in (-2, 0, 49))
    fixed = ", ".join(f"'{d}'" for d in FIXED_DAYS)
    return f"(strftime({date}, '%m-%d') in ({fixed}) or cast({date} as date) in ({easter}))"


def _at_three(days: list[str]) -> str:
    return ", ".join(f"timestamp '{d} 03:00:00'" for d in days)


def calendar_select(prefix: str = "") -> list[str]:
    dt = f"{prefix}datetime"
    parts = {
        "hour": f"hour({dt})",
        "day": f"day({dt})",
        "day_of_week": f"isodow({dt})",
        "month": f"month({dt})",
        "year": f"year({dt})",
    }
    out = [
        f"{_holiday(f'cast({dt} as date)')} as is_holiday",
        f"{_holiday(f'(cast({dt} as date) + 1)')} as is_day_before_holiday",
        f"{dt} in ({_at_three(SPRING)}) as is_dst_spring_forward",
        f"{dt} in ({_at_three(FALL)}) as is_dst_fall_backward",
    ]
    for name, period in CYCLIC_PERIODS.items():
        for fn in ("sin", "cos"):
            out.append(f"{fn}(2 * pi() * {parts[name]} / {period}) as {name}_{fn}")
    return out


FILL_SERIES = ["installed_capacity", *FW_OUTPUT, *HW_OUTPUT]
SERIES_W = "partition by prediction_unit_id, is_consumption order by datetime"


def feature_ctes(lags: list[int], mode_train: bool = True) -> list[tuple[str, str]]:
    """CTEs from ``merged`` to ``feat`` (train mode), same steps as build_features."""
    cal = "\n  select *, " + ",\n    ".join(calendar_select()) + "\n  from merged"
    dst0 = """
  select * replace (case when (is_dst_spring_forward or is_dst_fall_backward) and power is null
                         then 0.0 else power end as power)
  from cal"""
    lo, hi = EXCLUDED_RANGE
    kept = f"""
  select * from dst0
  where power is not null
    and not (datetime between timestamp '{lo}' and timestamp '{hi}')"""
    fills = [
        f"last_value({c} ignore nulls) over (order by datetime rows between unbounded preceding and current row) as {c}"
        for c in ("electricity_price", "gas_price")
    ] + [
        f"last_value({c} ignore nulls) over ({SERIES_W} rows between unbounded preceding and current row) as {c}"
        for c in FILL_SERIES
    ]
    filled = "\n  select * replace (" + ",\n    ".join(fills) + ")\n  from kept"
    ratio = """
  select * replace (case when capacity_factor is null and installed_capacity > 0
                         then power / installed_capacity else capacity_factor end as capacity_factor)
  from filled"""
    lag_exprs = [f"lag({c}, {n}) over ({SERIES_W}) as {lag_name(c, n)}" for c in LAG_COLUMNS for n in lags]
    lagged = "\n  select *, " + ",\n    ".join(lag_exprs) + "\n  from ratio"
    return [("cal", cal), ("dst0", dst0), ("kept", kept), ("filled", filled), ("ratio", ratio), ("lagged", lagged)]


def feature_output_columns(lags: list[int]) -> tuple[list[str], list[str]]:
    """(all feature columns without power, the double-typed ones)."""
    from ..schemas import CALENDAR_FLAGS, CYCLIC_COLUMNS

    base = [c for c in MERGED_COLUMNS if c != "power"]
    lag_cols = [lag_name(c, n) for c in LAG_COLUMNS for n in lags]
    cols = base + CALENDAR_FLAGS + CYCLIC_COLUMNS + lag_cols
    non_double = {"row_id", "datetime", "prediction_unit_id", "is_consumption", "county", "is_business",
                  "product_type", *CALENDAR_FLAGS}
    return cols, [c for c in cols if c not in non_double]


def test_features_sql(lags: list[int], horizon: str) -> str:
    """Test mode: rows from ``horizon`` on have no target; no DST zero, no row
    drops, no ratio recompute; lags over history + rows; trimmed to the rows."""
    cols, doubles = feature_output_columns(lags)
    masked = ("\n  select * replace (case when datetime >= " + horizon + " then null else power end as power,"
              "\n    case when datetime >= " + horizon + " then null else capacity_factor end as capacity_factor)"
              "\n  from merged")
    ctes = dict(feature_ctes(lags))
    cal = ctes["cal"].replace("from merged", "from masked")
    filled = ctes["filled"].replace("from kept", "from cal")
    lagged = ctes["lagged"].replace("from ratio", "from filled")
    sel = ", ".join(r6(c) if c in doubles else c for c in cols)
    body = f"select {sel}\nfrom lagged\nwhere datetime >= {horizon}"
    return with_views(["merged"], body, [("masked", masked), ("cal", cal), ("filled", filled), ("lagged", lagged)])


def features_sql(lags: list[int], where: str = "") -> str:
    cols, doubles = feature_output_columns(lags)
    not_null = " and ".join(f"{c} is not null" for c in [*cols, "power"])
    sel = ", ".join(r6(c) if c in doubles else c for c in cols)
    body = f"select {sel}\nfrom lagged\nwhere {not_null}{(' and ' + where) if where else ''}"
    return with_views(["merged"], body, feature_ctes(lags))


def county_names_values() -> str:
    rows = ", ".join(f"({k}, '{v}')" for k, v in sorted(COUNTY_NAMES.items()))
    return f"select cast(col0 as tinyint) as county, col1 as county_name from (values {rows})"


# ---------------------------------------------------------------- per-query SQL

SPLIT = "timestamp '2024-01-25 00:00:00'"
POWER_COLS = "row_id, datetime, prediction_unit_id, is_consumption, county, is_business, product_type"
LAGS3 = [12, 24, 168]


def _lag(c: str, n: int, w: str = SERIES_W) -> str:
    return f"lag({c}, {n}) over ({w})"


def build_oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    o["conform_orders"] = """
select o_orderkey as row_id, o_orderdate as datetime, cast(o_orderdate as date) as date,
       cast(o_custkey % 16 as tinyint) as county, o_orderstatus = 'F' as is_business,
       cast(o_custkey % 4 as tinyint) as product_type, round(o_totalprice, 6) as installed_capacity
from orders"""
    o["parse_ts_text"] = """
select o_orderkey as row_id,
       strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as datetime,
       cast(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') as date) as date,
       cast(cast(o_orderdate as date) as timestamp) as day_start
from orders"""
    o["csv_conformed"] = """
select o_orderkey as row_id, o_orderdate as datetime, cast(o_orderdate as date) as date,
       cast(o_custkey % 16 as tinyint) as county, o_orderstatus = 'F' as is_business,
       cast(o_custkey % 4 as tinyint) as product_type,
       case when o_orderkey % 5 <> 0 then round(o_totalprice, 6) end as installed_capacity
from orders
where o_orderkey % 7 <> 0 and o_orderkey % 19 <> 0 and o_orderkey % 11 <> 0 and o_orderkey % 17 <> 0 and o_orderkey % 13 <> 0"""
    o["csv_rejected"] = """
select row_id, reasons from (
  select o_orderkey as row_id, case when o_orderkey % 13 = 0 then 'malformed record' else concat_ws('; ',
         case when o_orderkey % 7 = 0 then 'datetime: not a timestamp_ntz' end,
         case when o_orderkey % 19 = 0 then 'date: missing' end,
         case when o_orderkey % 11 = 0 then 'county: not a tinyint' end,
         case when o_orderkey % 17 = 0 then 'is_business: not a boolean' end) end as reasons
  from orders) r
where reasons <> ''"""
    o["epoch_to_ts"] = """
select event_id, epoch_us(ts) as epoch_us,
       make_timestamp(epoch_us(ts)) as ts_from_ns,
       make_timestamp((epoch_us(ts) // 1000) * 1000) as ts_from_ms,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) as ts_from_s
from events"""
    o["align_union"] = with_views(["power"], f"""
select {POWER_COLS}, round(target, 6) as target from power where datetime < {SPLIT}
union all
select {POWER_COLS}, cast(null as double) as target from power where datetime >= {SPLIT}""")
    o["horizon_filter"] = with_views(["forecast_weather"], "select * from forecast_weather where hours_ahead <= 24")
    o["exclude_range"] = with_views(["power"], f"""
select {POWER_COLS}, round(target, 6) as target from power
where target is not null
  and not (datetime between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-11 23:59:59')""")
    o["since_batch_min"] = with_views(["power", "electricity"], f"""
select {POWER_COLS}, round(target, 6) as target from power
where datetime >= (select min(forecast_date) from electricity where euros_per_mwh < 0)""")
    o["capacity_join"] = with_views(["with_capacity"], """
select row_id, datetime, prediction_unit_id, is_consumption, county, date,
       round(installed_capacity, 6) as installed_capacity, round(power, 6) as power,
       round(power / nullif(installed_capacity, 0), 6) as capacity_factor
from with_capacity""")
    o["price_join"] = with_views(["fact", "elec"], """
select f.row_id, f.datetime, round(e.electricity_price, 6) as electricity_price
from fact f left join elec e on f.datetime = e.datetime""")
    o["gas_hourly"] = with_views(["gas_h"], "select datetime, round(gas_price, 6) as gas_price from gas_h")
    o["station_county_mean"] = with_views(["hw_agg"], "select county, datetime, "
        + ", ".join(r6("hw_" + c) for c in HISTORICAL_WEATHER_MEASURES) + " from hw_agg")
    o["weather_derived"] = with_views(["fw"], "select county, datetime, "
        + ", ".join(r6(c) for c in FW_OUTPUT) + " from fw")
    o["weather_observed"] = with_views(["hw"], "select county, datetime, "
        + ", ".join(r6(c) for c in HW_AGGREGATED) + " from hw")
    o["weather_join_median"] = with_views(["fact", "fw"], "select row_id, datetime, county, "
        + ", ".join(r6(f"coalesce({c}, median({c}) over (partition by datetime))", c) for c in FW_OUTPUT)
        + "\nfrom (select f.row_id, f.datetime, f.county, "
        + ", ".join(f"w.{c}" for c in FW_OUTPUT)
        + " from fact f left join fw w on f.county = w.county and f.datetime = w.datetime) j")
    o["name_lookup"] = with_views(["fact"], """
select f.row_id, f.county, n.county_name from fact f left join names n on f.county = n.county""",
        [("names", county_names_values())])
    o["upsert_keep_last"] = with_views(["power"], f"""
select {POWER_COLS}, round(target, 6) as target from (
  select *, 0 as src from power
  union all
  select {POWER_COLS}, case when target > 100 then null else target * 2 end as target, 1 as src
  from power where datetime >= timestamp '2024-01-28 00:00:00')
qualify row_number() over (
  partition by datetime, prediction_unit_id, is_consumption, county, is_business, product_type
  order by src desc, row_id desc) = 1""")
    o["calendar_parts"] = with_views(["power"], """
select row_id, datetime, cast(year(datetime) as integer) as year, cast(month(datetime) as integer) as month,
       cast(day(datetime) as integer) as day, cast(isodow(datetime) as integer) as day_of_week,
       cast(hour(datetime) as integer) as hour, cast(datetime as date) as date
from power""")
    cyc = [e.rsplit(" as ", 1) for e in calendar_select()[4:]]
    o["cyclic"] = with_views(["power"], "select row_id, " + ", ".join(r6(e, a) for e, a in cyc) + " from power")
    flags = calendar_select()[:4]
    days = """with days as (select o_orderkey as row_id, cast(o_orderdate as timestamp) + to_hours(cast(o_orderkey % 24 as integer)) as datetime,
  case when o_orderkey % 3 <> 0 then o_totalprice end as power from orders)
"""
    o["holiday_flags"] = f"{days}select row_id, datetime, {flags[0]}, {flags[1]} from days"
    o["dst_flags"] = f"{days}select row_id, datetime, {flags[2]}, {flags[3]} from days"
    o["dst_power_zero"] = f"""{days}
select row_id, round(case when ({flags[2].rsplit(' as ', 1)[0]} or {flags[3].rsplit(' as ', 1)[0]})
                           and power is null then 0.0 else power end, 6) as power
from days"""
    lag_sel = ", ".join(
        f"{_lag(c, n)} as {lag_name(c, n)}" for c in ("capacity_factor", "power") for n in LAGS3)
    lag_cols = [lag_name(c, n) for c in ("capacity_factor", "power") for n in LAGS3]
    o["lag_features"] = with_views(["with_capacity"], f"""
select row_id, datetime, prediction_unit_id, is_consumption, round(power, 6) as power,
       round(capacity_factor, 6) as capacity_factor, {', '.join(r6(c) for c in lag_cols)}, idx
from (select row_id, datetime, prediction_unit_id, is_consumption, power,
             power / nullif(installed_capacity, 0) as capacity_factor, {lag_sel},
             row_number() over ({SERIES_W}) - 1 as idx
      from (select *, power / nullif(installed_capacity, 0) as capacity_factor from with_capacity) x) t
where {' and '.join(c + ' is not null' for c in ['row_id', 'datetime', 'prediction_unit_id', 'is_consumption', 'power', 'capacity_factor', *lag_cols])}""")
    joins = "\n".join(
        f"left join fact l{n} on l{n}.prediction_unit_id = f.prediction_unit_id"
        f" and l{n}.is_consumption = f.is_consumption and l{n}.datetime = f.datetime - to_hours({n})"
        for n in LAGS3)
    o["time_lag"] = with_views(["fact"], "select f.row_id, f.datetime, f.prediction_unit_id, f.is_consumption, "
        "round(f.power, 6) as power, " + ", ".join(f"round(l{n}.power, 6) as power_lag_{n}" for n in LAGS3)
        + f"\nfrom fact f\n{joins}")
    cf = "power / nullif(installed_capacity, 0)"
    o["current_or_lag"] = with_views(["with_capacity"], "select row_id, " + ", ".join(
        r6(f"coalesce(cf, {_lag('cf', n)})", f"capacity_factor_lag_{n}") for n in (12, 24))
        + f" from (select *, {cf} as cf from with_capacity) x")
    o["ffill_series"] = with_views(["with_capacity", "elec"], f"""
select row_id,
  round(last_value(installed_capacity ignore nulls) over ({SERIES_W} rows between unbounded preceding and current row), 6) as installed_capacity,
  round(last_value(electricity_price ignore nulls) over ({SERIES_W} rows between unbounded preceding and current row), 6) as electricity_price
from (select w.*, e.electricity_price from with_capacity w left join elec e on w.datetime = e.datetime) x""")
    o["ffill_global"] = with_views(["fact", "elec"], """
select row_id, datetime,
  round(last_value(electricity_price ignore nulls) over (order by datetime rows between unbounded preceding and current row), 6) as electricity_price
from (select f.row_id, f.datetime, e.electricity_price from fact f left join elec e on f.datetime = e.datetime) x""")
    mcols, mdoubles = MERGED_COLUMNS, {"capacity_factor", "power", "installed_capacity", "electricity_price",
                                       "gas_price", *FW_OUTPUT, *HW_OUTPUT}
    o["star_merge"] = with_views(["merged"], "select " + ", ".join(r6(c) if c in mdoubles else c for c in mcols)
                                 + " from merged")
    o["train_features"] = features_sql(LAGS3)
    o["retrain_features"] = features_sql(LAGS3, f"datetime >= {SPLIT}")
    naive = f"""
  select row_id, datetime, is_consumption, power,
         case when coalesce(l168, l24, l12) * installed_capacity is null then null
              else greatest(coalesce(l168, l24, l12) * installed_capacity, 0) end as target
  from (select *, {_lag('cf', 168)} as l168, {_lag('cf', 24)} as l24, {_lag('cf', 12)} as l12
        from (select *, power / nullif(installed_capacity, 0) as cf from with_capacity) x) y"""
    o["seasonal_naive_mae"] = with_views(["with_capacity"], """
select round(avg(abs(target - power)), 6) as mae, count(*) as n_rows
from naive where power is not null and target is not null""", [("naive", naive)])
    folds = """
  select *, case when t > 0 and pos >= first then (pos - first) // t end as test_fold
  from (select *, n_rows // 4 as t, n_rows - 3 * (n_rows // 4) as first
        from (select *, row_number() over (partition by is_consumption order by datetime, row_id) - 1 as pos,
                     count(*) over (partition by is_consumption) as n_rows
              from {src}) a) b"""
    o["retrain_state"] = o["retrain_features"]
    day = "cast(datetime as date) = date '2024-01-26'"
    merged2 = f"""
  select * replace (
    case when {day} then power * 2 else power end as power,
    case when {day} then null else capacity_factor end as capacity_factor,
    case when {day} and prediction_unit_id % 3 = 0 then null else installed_capacity end as installed_capacity)
  from merged"""
    cols, doubles = feature_output_columns(LAGS3)
    corrected = dict(feature_ctes(LAGS3))
    corrected["cal"] = corrected["cal"].replace("from merged", "from merged2")
    o["retrain_state_corrected"] = with_views(["merged"], "select " + ", ".join(r6(c) if c in doubles else c for c in cols)
        + "\nfrom lagged\nwhere datetime >= timestamp '2024-01-26 00:00:00' and " + " and ".join(
            f"{c} is not null" for c in [*cols, "power"]), [("merged2", merged2), *corrected.items()])
    o["ts_split"] = with_views(["fact"], """
select row_id, is_consumption, pos, n_rows, test_fold,
       case when t <= 0 then null when pos < first then 0 when test_fold + 1 < 3 then test_fold + 1 end
         as train_from_fold
from folds""", [("folds", folds.format(src="fact"))])
    o["cv_summary"] = with_views(["with_capacity"], """
select case when grouping(is_consumption) = 1 then 'all'
            when is_consumption then 'consumption' else 'production' end as group_name,
       round(avg(mae), 6) as mean_mae, round(stddev_pop(mae), 6) as std_mae, count(*) as n_folds
from (select is_consumption, test_fold, avg(abs(target - power)) as mae
      from folds where test_fold is not null and power is not null and target is not null
      group by 1, 2) s
group by grouping sets ((is_consumption), ())""", [("naive", naive), ("folds", folds.format(src="naive"))])
    o["group_order"] = """
select user_id, first_seq, row_number() over (order by first_seq) - 1 as position
from (select user_id, min(event_id) as first_seq from events group by 1) g"""
    o["top_sample"] = with_views(["fact"], """
select row_id, datetime, round(power, 6) as power from fact order by power desc, row_id asc limit 10""")
    o["param_rows"] = """
with t as (select p_partkey as run_id, cast(p_size as varchar) as p_size,
                  cast(p_retailprice as varchar) as p_retailprice, p_name, p_brand from part),
u as (unpivot t on p_size, p_retailprice, p_name, p_brand into name param value value_text)
select run_id,
       regexp_replace(regexp_replace(param, '^p_', 'param.'), '[^0-9A-Za-z_.]', '_', 'g') as metric,
       round(try_cast(value_text as double), 6) as value
from u where try_cast(value_text as double) is not null"""
    from ..sources.analog import DRIVER_TABLES
    o["source_audit"] = "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in DRIVER_TABLES)
    o["recursive_forecast"] = with_views(["fact"], f"""
select t.row_id, t.datetime, t.prediction_unit_id, t.is_consumption, round(s.power, 6) as prediction
from steps t left join idx s
  on s.prediction_unit_id = t.prediction_unit_id and s.is_consumption = t.is_consumption
 and s.idx = t.idx - 12 * (t.step // 12 + 1)
where t.step >= 0""", [
        ("idx", f"""
  select row_id, datetime, prediction_unit_id, is_consumption, power,
         row_number() over ({SERIES_W}) - 1 as idx from fact"""),
        ("first_h", """
  select prediction_unit_id, is_consumption, min(idx) as i0 from idx
  where datetime >= timestamp '2024-01-29 00:00:00' group by 1, 2"""),
        ("steps", """
  select i.*, i.idx - h.i0 as step from idx i
  join first_h h on i.prediction_unit_id = h.prediction_unit_id and i.is_consumption = h.is_consumption"""),
    ])
    o["incremental_days"] = with_views(["fact"], f"""
select row_id, datetime, round(coalesce(lag(power, 24) over ({SERIES_W}), 0.0), 6) as prediction
from fact
qualify datetime >= timestamp '2024-01-28 00:00:00'""")
    o["test_features"] = test_features_sql(LAGS3, "timestamp '2024-01-29 00:00:00'")
    o["ffill_by_slices"] = o["ffill_series"]
    o["train_features_long"] = o["train_features"]
    o["lag_by_join"] = with_views(["with_capacity"], f"""
select row_id, datetime, prediction_unit_id, is_consumption, round(power, 6) as power,
       {', '.join(f"round({_lag('power', n)}, 6) as power_lag_{n}" for n in LAGS3)}
from with_capacity""")
    o["lags_by_user"] = f"""
with f as (
  select date_trunc('hour', ts) as datetime, user_id as prediction_unit_id, event_type in ('click', 'view', 'signup') as is_consumption,
         min(event_id) as row_id, max(value) as power from events group by 1, 2, 3),
g as (
  select * replace (last_value(case when power < 150 then power end ignore nulls) over (
           {SERIES_W} rows between unbounded preceding and current row) as power) from f)
select datetime, prediction_unit_id, is_consumption, row_id, round(power, 6) as power,
       {', '.join(f"round({_lag('power', n)}, 6) as power_lag_{n}" for n in (1, 2, 24))} from g"""
    o["bucketed_lags"] = o["lag_by_join"]
    o["incremental_replay"] = o["incremental_days"]
    o["late_corrections"] = with_views(["fact"], f"""
select row_id, datetime, round(coalesce(({_lag('power', 24)} + {_lag('power', 240)}) / 2, 0.0), 6) as prediction
from fact
qualify datetime >= timestamp '2024-01-28 00:00:00'""")
    days = ["2024-01-28", "2024-01-29"]
    logged = ["select 'merged' as stage, 'merged' as step, 'rows' as metric, cast(count(*) as double) as value from merged"]
    logged += [f"select 'merged', 'merged', 'nulls.{c}', cast(count(*) filter (where {c} is null) as double) from merged" for c in ("power", "installed_capacity")]
    cols, _ = feature_output_columns(LAGS3)
    logged += ["select 'features', 'features', 'rows', cast(count(*) as double) from lagged where " + " and ".join(f"{c} is not null" for c in [*cols, "power"]),
               "select 'features', 'features', 'nulls.capacity_factor', 0.0",
               "select 'stream', 'batch 0', 'input_rows', 2.0"]
    logged += [f"select '{d}', 'forecasts', '{m}', {v} from fact where cast(datetime as date) = date '{d}'" for d in days
               for m, v in (("rows", "cast(count(*) as double)"), ("nulls.prediction", "0.0 * count(*)"))]
    logged += [f"select 'revealed {days[0]}', 'rows', 'rows', cast(count(*) as double) from fact where cast(datetime as date) = date '{days[0]}'"]
    o["run_log"] = with_views(["merged", "fact"], "\nunion all\n".join(logged), feature_ctes(LAGS3))
    o["snapshot_tiers"] = with_views(["client"], f"""
select date, county, is_business, product_type, round(case
         when (date - {D0}) // 3 = 8 then installed_capacity * 2
         when (date - {D0}) // 3 = 6 then (installed_capacity + 1) * 2
         when (date - {D0}) // 3 < 8 then installed_capacity + 1
         else installed_capacity end, 6) as installed_capacity
from client""")
    nulled = [("nulled", "select * replace (case when prediction_unit_id <> 5 then prediction_unit_id end as prediction_unit_id) from with_capacity")]
    o["null_key_folds"] = with_views(["with_capacity"], """
select row_id, prediction_unit_id, row_number() over (partition by prediction_unit_id order by datetime, row_id) - 1 as pos,
       count(*) over (partition by prediction_unit_id) as n_rows from nulled""", nulled)
    o["null_key_lags"] = with_views(["with_capacity"], f"""
select row_id, datetime, prediction_unit_id, is_consumption, round(power, 6) as power,
       {', '.join(f"round({_lag('power', n)}, 6) as power_lag_{n}" for n in LAGS3)} from nulled""", nulled)
    o["null_key_fill"] = with_views(["with_capacity"], f"""
select row_id, round(last_value(installed_capacity ignore nulls) over (
  {SERIES_W} rows between unbounded preceding and current row), 6) as installed_capacity from nulled""", nulled)
    o["upsert_null_keys"] = with_views(["with_capacity"], """
select row_id, datetime, prediction_unit_id, is_consumption,
       round(power + case when datetime >= timestamp '2024-01-28 00:00:00' then 2 else 0 end, 6) as power,
       case when datetime >= timestamp '2024-01-28 00:00:00' then 2 else -1 end as v from nulled""", nulled)
    facts = """
select count(*) as n_rows, count(*) filter (where is_consumption) as n_consumption, cast(sum(row_id) as bigint) as row_id_sum,
       count(*) filter (where power is not null and target is not null) as n_scored,
       round(avg(abs(target - power)), 6) as naive_mae,
       true as never_negative{more} from naive where datetime >= timestamp '2024-01-29 00:00:00'"""
    o["gbt_facts"] = with_views(["with_capacity"], facts.format(more=", true as beats_naive"), [("naive", naive)])
    o["recursive_gbt_facts"] = with_views(["with_capacity"], facts.format(more=""), [("naive", naive)])
    cols, _ = feature_output_columns(LAGS3)
    rows = "\n  select is_consumption, datetime, row_id from lagged where " + " and ".join(
        f"{c} is not null" for c in [*cols, "power"])
    ctes = dict(feature_ctes(LAGS3))
    ctes["cal"] = ctes["cal"].replace("from merged", "from merged where datetime < timestamp '2024-01-29 00:00:00'")
    o["search_facts"] = with_views(["merged"], """
select case when is_consumption then 'consumption' else 'production' end as side,
       count(*) - 2 * (count(*) // 3) as n_train_0, count(*) // 3 as n_test_0,
       count(*) - count(*) // 3 as n_train_1, count(*) // 3 as n_test_1,
       true as best_is_least, true as refits_agree
from kept_rows group by is_consumption""", [*ctes.items(), ("kept_rows", rows)])
    before = "over (partition by {c} order by hour range between unbounded preceding and interval 1 microsecond preceding)"
    o["category_means"] = "select event_id, " + ", ".join(
        f"round((coalesce(sum(value) {w}, 0) + 0.5) / (count(value) {w} + 1), 6) as {c}_mean"
        for c in ("user_id", "event_type") for w in [before.format(c=c)]) + "\nfrom (select event_id, user_id, event_type, value / 79.19 as value, date_trunc('hour', ts) as hour from events) e"
    return o


ORACLE = build_oracle()
