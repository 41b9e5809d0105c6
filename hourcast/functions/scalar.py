"""Scalar column helpers.

All of them are built-in expressions, so they stay inside whole-stage codegen.
Null handling follows the fact table's rules: a null input stays null unless
the helper says otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num: ColumnOrName, den: ColumnOrName, compat_inf: bool = False) -> Column:
    """``num / den`` that never raises: null for a zero divisor.

    ``compat_inf=True`` gives IEEE results instead (+-Infinity, NaN for 0/0).
    """
    n, d = _c(num).cast("double"), _c(den).cast("double")
    if not compat_inf:
        return F.try_divide(n, d)
    ieee = (
        F.when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(d == 0, ieee).otherwise(F.try_divide(n, d))


def mid_price(low: ColumnOrName, high: ColumnOrName) -> Column:
    return (_c(low) + _c(high)) / 2


def scale_and_cap(x: ColumnOrName, factor: float = 100, cap: float = 100) -> Column:
    """``x * factor`` capped at ``cap``; null stays null."""
    scaled = _c(x) * factor
    return F.when(scaled > cap, F.lit(float(cap))).otherwise(scaled)


def floor_at_zero(x: ColumnOrName) -> Column:
    """Negative values become 0; null stays null."""
    v = _c(x)
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def abs_scaled(x: ColumnOrName, factor: float) -> Column:
    return F.abs(_c(x) * factor)


def positive_part(x: ColumnOrName) -> Column:
    """``max(x, 0)`` that keeps null as null and NaN as NaN."""
    v = _c(x)
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(v, F.lit(0.0)))


def null_to_zero(x: ColumnOrName) -> Column:
    return F.coalesce(_c(x), F.lit(0.0))


def iso_weekday(ts: ColumnOrName) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return F.weekday(_c(ts)) + 1


HOUR_US = 3_600_000_000


def wall_clock_us(ts: ColumnOrName) -> Column:
    """Microseconds of a ``TIMESTAMP_NTZ`` since 1970 on its own clock. Built from
    its fields: a difference of timestamps would pass through the session zone."""
    t = _c(ts)
    seconds = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return F.unix_date(t.cast("date")).cast("long") * (24 * HOUR_US) + F.hour(t).cast("long") * HOUR_US + F.minute(t).cast("long") * 60_000_000 + seconds


def hour_floor(ts: ColumnOrName) -> Column:
    """Truncate a ``TIMESTAMP_NTZ`` to the hour, staying NTZ.

    Pure wall-clock arithmetic (``date_trunc`` would pass through the
    session time zone), so the result is the same in every session zone.
    """
    t = _c(ts)
    return F.timestamp_add("MICROSECOND", -F.pmod(wall_clock_us(t), F.lit(HOUR_US)), t)


def add_hours(ts: ColumnOrName, hours: ColumnOrName | int) -> Column:
    h = F.lit(hours) if isinstance(hours, int) else _c(hours)
    return _c(ts) + F.make_dt_interval(hours=h.cast("int"))


def floor_div(x: ColumnOrName, k: ColumnOrName | int) -> Column:
    """Exact floor division of longs: subtract the remainder, then divide an
    exact multiple in decimal (no rounding through double)."""
    a = _c(x).cast("long")
    b = F.lit(k) if isinstance(k, int) else _c(k).cast("long")
    multiple = (a - F.pmod(a, b)).cast("decimal(38,0)")
    return (multiple / b.cast("decimal(38,0)")).cast("long")


EPOCH_UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1, "ns": None}


def epoch_to_timestamp(x: ColumnOrName, unit: str) -> Column:
    """Epoch number in an explicit unit to ``TIMESTAMP_NTZ`` (no guessing)."""
    if unit not in EPOCH_UNITS:
        raise ValueError(f"unit must be one of {sorted(EPOCH_UNITS)}, got {unit!r}")
    v = _c(x).cast("long")
    micros = floor_div(v, 1000) if unit == "ns" else v * EPOCH_UNITS[unit]
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def timestamp_to_epoch(ts: ColumnOrName, unit: str = "us") -> Column:
    """``TIMESTAMP_NTZ`` to an epoch number in ``unit`` (wall clock read as UTC)."""
    if unit not in EPOCH_UNITS:
        raise ValueError(f"unit must be one of {sorted(EPOCH_UNITS)}, got {unit!r}")
    micros = wall_clock_us(ts)
    if unit == "ns":
        return micros * 1000
    return floor_div(micros, EPOCH_UNITS[unit]) if unit != "us" else micros


def cyclic(x: ColumnOrName, period: float, fn: str) -> Column:
    angle = F.lit(2 * math.pi) * _c(x) / period
    return F.sin(angle) if fn == "sin" else F.cos(angle)


def numeric_or_null(text: ColumnOrName) -> Column:
    """Text to double where it parses, else null."""
    return _c(text).try_cast("double")


def clean_name(name: ColumnOrName, pattern: str = r"[^0-9A-Za-z_.]", replacement: str = "_") -> Column:
    return F.regexp_replace(_c(name), pattern, replacement)
