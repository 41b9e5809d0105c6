import statistics

import pytest
from pyspark.sql import functions as F

from hourcast.operators.enrich import (
    forecast_weather_by_county,
    gas_hourly,
    join_price,
    join_weather_with_median_fill,
)
from hourcast.schemas import FORECAST_WEATHER_SCHEMA, MAPPING_SCHEMA


def _ts(c):
    return F.to_timestamp_ntz(F.col(c))


def test_gas_hourly(spark):
    gas = spark.createDataFrame([("2024-01-05 00:00:00", 10.0, 20.0)], "d string, lo double, hi double").select(
        _ts("d").alias("forecast_date"), F.col("lo").alias("lowest_price_per_mwh"),
        F.col("hi").alias("highest_price_per_mwh"))
    rows = gas_hourly(gas).orderBy("datetime").collect()
    assert len(rows) == 24 and {r["gas_price"] for r in rows} == {15.0}
    assert str(rows[0]["datetime"]) == "2024-01-05 00:00:00" and str(rows[-1]["datetime"]) == "2024-01-05 23:00:00"


def _weather(spark, rows):
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FORECAST_WEATHER_SCHEMA.fields)
    df = spark.createDataFrame(rows, cols.replace("timestamp_ntz", "string"))
    return df.withColumn("forecast_datetime", _ts("forecast_datetime"))


def test_cloud_cap_and_diffuse(spark):
    t = "2024-01-01 00:00:00"
    w = _weather(spark, [
        (1.0, 1.0, t, 24, 5.0, 0.3, 0.001, 1.0, 1.0, -30.0, 10.0),
        (2.0, 2.0, t, 24, 5.0, 1.7, 0.001, 1.0, 1.0, 5.0, 10.0),
        (3.0, 3.0, t, 25, 5.0, 0.3, 0.001, 1.0, 1.0, 5.0, 10.0),
    ])
    m = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 2.0), (2, 3.0, 3.0)], MAPPING_SCHEMA)
    out = {r["county"]: r for r in forecast_weather_by_county(w, m).collect()}
    assert set(out) == {1, 2}  # hours_ahead 25 dropped
    assert out[1]["fw_cloudcover_total"] == pytest.approx(30.0, rel=1e-6)
    assert out[2]["fw_cloudcover_total"] == 100.0
    assert out[1]["fw_direct_solar_radiation"] == pytest.approx(30.0)
    assert out[1]["fw_diffuse_solar_radiation"] == 0.0
    assert out[2]["fw_diffuse_solar_radiation"] == pytest.approx(5.0)
    assert out[1]["fw_total_precipitation"] == pytest.approx(1.0, rel=1e-5)
    compat = {r["county"]: r for r in forecast_weather_by_county(w, m, compat_cloud=True).collect()}
    assert compat[2]["fw_cloudcover_total"] == pytest.approx(1.7, rel=1e-6)


def test_duplicate_price_key(spark):
    fact = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "row_id long, d string").select(
        "row_id", _ts("d").alias("datetime"))
    prices = spark.createDataFrame([("2024-01-01 00:00:00", -5.0), ("2024-01-01 00:00:00", 7.0)],
                                   "d string, euros_per_mwh double").select(
        _ts("d").alias("forecast_date"), "euros_per_mwh")
    fanned = join_price(fact, prices, "forecast_date", "euros_per_mwh", "electricity_price", absolute=True)
    assert sorted(r["electricity_price"] for r in fanned.collect()) == [5.0, 7.0]
    with pytest.raises(ValueError, match="duplicate key"):
        join_price(fact, prices, "forecast_date", "euros_per_mwh", "p", check_unique=True)


def test_weighted_median_equals_row_median(spark):
    # county 12 (unknown) has 3 fact rows per hour: the median is weighted by rows.
    fact_rows, weather_rows = [], []
    rid = 0
    for h in range(3):
        t = f"2024-01-01 0{h}:00:00"
        for county, n in [(0, 1), (1, 2), (12, 3), (5, 1)]:
            for _ in range(n):
                fact_rows.append((rid, t, county))
                rid += 1
        if h < 2:  # hour 2 has no weather at all
            weather_rows += [(0, t, 1.0 + h), (1, t, 4.0), (12, t, 10.0 * (h + 1))]
    fact = spark.createDataFrame(fact_rows, "row_id long, d string, county int").select(
        "row_id", _ts("d").alias("datetime"), "county")
    weather = spark.createDataFrame(weather_rows, "county int, d string, x double").select(
        "county", _ts("d").alias("datetime"), "x")
    out = {r["row_id"]: r["x"] for r in join_weather_with_median_fill(fact, weather, ["x"]).collect()}
    by_hour = {}
    for (rid, t, county) in fact_rows:
        v = {(c, tt): x for c, tt, x in weather_rows}.get((county, t))
        by_hour.setdefault(t, []).append((rid, v))
    for t, items in by_hour.items():
        present = [v for _, v in items if v is not None]
        med = statistics.median(present) if present else None
        for rid, v in items:
            assert out[rid] == (v if v is not None else med)
    # an hour without any weather stays null
    assert all(out[rid] is None for rid, _ in by_hour["2024-01-01 02:00:00"])


def test_median_even_count(spark):
    fact = spark.createDataFrame([(1, 0, "2024-01-01 00:00:00"), (2, 1, "2024-01-01 00:00:00"),
                                  (3, 2, "2024-01-01 00:00:00")], "row_id long, county int, d string").select(
        "row_id", "county", _ts("d").alias("datetime"))
    w = spark.createDataFrame([(0, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:00:00", 3.0)],
                              "county int, d string, x double").select("county", _ts("d").alias("datetime"), "x")
    out = {r["row_id"]: r["x"] for r in join_weather_with_median_fill(fact, w, ["x"]).collect()}
    assert out == {1: 1.0, 2: 3.0, 3: 2.0}


def test_points_meet_over_float_rounding(spark):
    from hourcast.operators.enrich import map_to_county

    weather = spark.createDataFrame([(57.6, 21.7, 1), (57.3, -0.0, 2), (None, 21.7, 3), (57.0, 21.0, 4)], "latitude float, longitude float, id int")
    mapping = spark.createDataFrame([(57.6, 21.7, 3), (57.3, 0.0, 4), (None, 21.7, 5)], "latitude double, longitude double, county int")
    got = {r["id"]: r["county"] for r in map_to_county(weather, mapping).collect()}
    assert got == {1: 3, 2: 4, 3: None, 4: None}
    assert map_to_county(weather, mapping).columns == ["latitude", "longitude", "id", "county"]
