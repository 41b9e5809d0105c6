"""Calendar features: holidays, the eve of a holiday, DST hours and cyclic parts.

The holiday calendar is a rule (fixed dates plus Easter offsets) written as
column arithmetic, so it holds in every year, inside codegen: no date list, no
join and no shuffle. All comparisons are wall-clock arithmetic and don't depend
on the session zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CALENDAR_YEARS, CYCLIC_PERIODS
from .scalar import HOUR_US, cyclic, iso_weekday, timestamp_to_epoch

# National public holidays (Estonia).
# Same date every year, as (month, day): New Year's Day, Independence Day,
# Spring Day, Victory Day, Midsummer Day, Restoration of Independence Day,
# Christmas Eve, Christmas Day, Boxing Day.
FIXED_HOLIDAYS = [(1, 1), (2, 24), (5, 1), (6, 23), (6, 24), (8, 20), (12, 24), (12, 25), (12, 26)]
# Days relative to Easter Sunday: Good Friday, Easter Sunday, Whit Sunday.
EASTER_OFFSETS = [-2, 0, 49]
# DST changes happen on the last Sunday of March and October; the flagged
# local hour is 03:00.
DST_HOUR = 3


def easter_sunday(year: int) -> dt.date:
    """Gregorian Easter Sunday (anonymous Gregorian computus)."""
    a = year % 19
    b, c = divmod(year, 100)
    d, e = divmod(b, 4)
    f = (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * l_) // 451
    month, day = divmod(h + l_ - 7 * m + 114, 31)
    return dt.date(year, month, day + 1)


def holiday_dates(years: tuple[int, int] = CALENDAR_YEARS) -> list[dt.date]:
    out: set[dt.date] = set()
    for y in range(years[0], years[1] + 1):
        out.update(dt.date(y, m, d) for m, d in FIXED_HOLIDAYS)
        easter = easter_sunday(y)
        out.update(easter + dt.timedelta(days=k) for k in EASTER_OFFSETS)
    return sorted(out)


def _within(ts: Column, years: tuple[int, int] | None) -> Column:
    """The rules hold for every year; ``years`` restricts them on request."""
    return F.lit(True) if years is None else F.year(ts).between(*years)


def easter_day(date: Column) -> Column:
    """Easter Sunday of a date's year, as a column (the same computus)."""
    y = F.year(date)
    div = lambda a, b: F.floor(a / b).cast("int")
    a, b = y % 19, div(y, 100)
    c, d, e = y % 100, div(b, 4), b % 4
    g = div(b - div(b + 8, 25) + 1, 3)
    h = (a * 19 + b - d - g + 15) % 30
    i, k = div(c, 4), c % 4
    l_ = (e * 2 + i * 2 + 32 - h - k) % 7
    m = div(a + h * 11 + l_ * 22, 451)
    days = h + l_ - m * 7 + 114
    return F.make_date(y, div(days, 31), days % 31 + 1)


def _is_holiday_date(date: Column) -> Column:
    fixed = (F.month(date) * 100 + F.dayofmonth(date)).isin([100 * m + d for m, d in FIXED_HOLIDAYS])
    return fixed | F.datediff(date, easter_day(date)).isin(EASTER_OFFSETS)


def is_holiday(ts: Column, years: tuple[int, int] | None = None) -> Column:
    return _is_holiday_date(F.to_date(ts)) & _within(ts, years)


def is_day_before_holiday(ts: Column, years: tuple[int, int] | None = None) -> Column:
    after = F.date_add(F.to_date(ts), 1)
    return _is_holiday_date(after) & _within(after, years)


def _last_sunday_at(ts: Column, month: int, years: tuple[int, int] | None) -> Column:
    # The last Sunday of a 31-day month falls on day 25..31. The instant is
    # compared in microseconds of the wall clock: a cast would pass through the
    # session zone, in which the spring hour does not exist.
    into_day = F.pmod(timestamp_to_epoch(ts, "us"), F.lit(24 * HOUR_US))
    return (
        (F.month(ts) == month)
        & (F.dayofmonth(ts) >= 25)
        & (F.dayofweek(ts) == 1)
        & (into_day == DST_HOUR * HOUR_US)
        & _within(ts, years)
    )


def is_dst_spring_forward(ts: Column, years: tuple[int, int] | None = None) -> Column:
    return _last_sunday_at(ts, 3, years)


def is_dst_fall_backward(ts: Column, years: tuple[int, int] | None = None) -> Column:
    return _last_sunday_at(ts, 10, years)


def dst_instants(years: tuple[int, int] = CALENDAR_YEARS) -> dict[str, list[dt.datetime]]:
    """The flagged instants, for inspection and tests."""

    def last_sunday(y: int, m: int) -> dt.datetime:
        d = dt.date(y, m, 31)
        d -= dt.timedelta(days=(d.weekday() + 1) % 7)
        return dt.datetime(d.year, d.month, d.day, DST_HOUR)

    rng = range(years[0], years[1] + 1)
    return {"spring": [last_sunday(y, 3) for y in rng], "fall": [last_sunday(y, 10) for y in rng]}


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": iso_weekday(ts),
        "hour": F.hour(ts),
    }


def cyclic_columns(ts: Column) -> dict[str, Column]:
    parts = calendar_parts(ts)
    out: dict[str, Column] = {}
    for name, period in CYCLIC_PERIODS.items():
        for fn in ("sin", "cos"):
            out[f"{name}_{fn}"] = cyclic(parts[name], period, fn)
    return out


def calendar_flags(ts: Column, years: tuple[int, int] | None = None) -> dict[str, Column]:
    return {
        "is_holiday": is_holiday(ts, years),
        "is_day_before_holiday": is_day_before_holiday(ts, years),
        "is_dst_spring_forward": is_dst_spring_forward(ts, years),
        "is_dst_fall_backward": is_dst_fall_backward(ts, years),
    }


def add_calendar_features(
    df: DataFrame, ts_col: str = "datetime", years: tuple[int, int] | None = None
) -> DataFrame:
    """Four flags and ten cyclic encodings in one projection."""
    ts = F.col(ts_col)
    cols = {**calendar_flags(ts, years), **cyclic_columns(ts)}
    return df.withColumns(cols)
