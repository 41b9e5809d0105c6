import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourcast.functions import calendar as cal

# The 12 flagged DST instants of 2021-2026.
SPRING = ["2021-03-28 03:00:00", "2022-03-27 03:00:00", "2023-03-26 03:00:00",
          "2024-03-31 03:00:00", "2025-03-30 03:00:00", "2026-03-29 03:00:00"]
FALL = ["2021-10-31 03:00:00", "2022-10-30 03:00:00", "2023-10-29 03:00:00",
        "2024-10-27 03:00:00", "2025-10-26 03:00:00", "2026-10-25 03:00:00"]


def test_easter_and_holidays():
    assert [str(cal.easter_sunday(y)) for y in range(2021, 2027)] == [
        "2021-04-04", "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20", "2026-04-05"]
    days = cal.holiday_dates()
    assert len(days) == 72 and len(set(days)) == 72
    assert dt.date(2024, 1, 1) in days and dt.date(2024, 3, 29) in days and dt.date(2024, 5, 19) in days


def test_dst_instants_equal_list():
    inst = cal.dst_instants()
    assert [f"{d:%Y-%m-%d %H:%M:%S}" for d in inst["spring"]] == SPRING
    assert [f"{d:%Y-%m-%d %H:%M:%S}" for d in inst["fall"]] == FALL


def test_flags_on_rows(spark):
    rows = [(t,) for t in SPRING + FALL + ["2022-03-27 02:00:00", "2022-03-27 03:30:00", "2020-03-29 03:00:00",
                                           "2024-01-01 10:00:00", "2023-12-31 10:00:00", "2024-01-02 10:00:00"]]
    df = spark.createDataFrame(rows, "s string").select(F.to_timestamp_ntz("s").alias("datetime"), "s")
    out = {r["s"]: r for r in cal.add_calendar_features(df).collect()}
    for t in SPRING:
        assert out[t]["is_dst_spring_forward"] and not out[t]["is_dst_fall_backward"]
    for t in FALL:
        assert out[t]["is_dst_fall_backward"] and not out[t]["is_dst_spring_forward"]
    for t in ["2022-03-27 02:00:00", "2022-03-27 03:30:00"]:
        assert not out[t]["is_dst_spring_forward"]
    assert out["2024-01-01 10:00:00"]["is_holiday"] and not out["2024-01-02 10:00:00"]["is_holiday"]
    assert out["2023-12-31 10:00:00"]["is_day_before_holiday"]
    assert not out["2024-01-02 10:00:00"]["is_day_before_holiday"]


def test_iso_weekday_and_cyclic(spark):
    df = spark.createDataFrame([("2024-01-01 06:00:00",), ("2024-01-07 06:00:00",)], "s string").select(
        F.to_timestamp_ntz("s").alias("datetime"))
    parts = df.select(*[v.alias(k) for k, v in cal.calendar_parts(F.col("datetime")).items()]).collect()
    assert [r["day_of_week"] for r in parts] == [1, 7]
    cyc = df.select(*[v.alias(k) for k, v in cal.cyclic_columns(F.col("datetime")).items()]).first()
    assert abs(cyc["hour_sin"] - 1.0) < 1e-12 and abs(cyc["hour_cos"]) < 1e-12


def test_hour_floor_any_zone(spark):
    from hourcast.functions.scalar import hour_floor

    df = spark.createDataFrame([("2024-03-31 02:37:05.123456",), ("2024-01-01 23:59:59",)], "s string").select(
        F.to_timestamp_ntz("s").alias("t"))
    try:
        for zone in ("UTC", "Asia/Kolkata", "Europe/Tallinn", "Australia/Adelaide"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [str(r[0]) for r in df.select(hour_floor("t")).collect()]
            assert got == ["2024-03-31 02:00:00", "2024-01-01 23:00:00"], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "Europe/Tallinn", "America/New_York"])
def test_flags_and_parsing_in_any_zone(spark, zone):
    from hourcast.operators.conform import parse_timestamp

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = spark.createDataFrame([(t,) for t in [*SPRING, *FALL, "2024-03-10 02:30:00", "no time"]], "s string")
        df = text.select("s", parse_timestamp(F.col("s"), lenient=True).alias("datetime"))
        out = {r["s"]: r for r in cal.add_calendar_features(df).withColumn("back", F.col("datetime").cast("string")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(out[t]["is_dst_spring_forward"] for t in SPRING) and all(out[t]["is_dst_fall_backward"] for t in FALL)
    assert all(r["back"] == s for s, r in out.items() if s != "no time") and out["no time"]["datetime"] is None


def test_the_rules_hold_in_every_year(spark):
    days = spark.sql("select explode(sequence(date'1990-01-01', date'2060-12-31')) as d").select(F.col("d").cast("timestamp_ntz").alias("t"))
    got = {str(r[0].date()) for r in days.filter(cal.is_holiday(F.col("t"))).collect()}
    assert got == {str(d) for d in cal.holiday_dates((1990, 2060))}
    assert days.filter(cal.is_day_before_holiday(F.col("t"), (2021, 2021))).filter(F.year("t") > 2021).count() == 0
