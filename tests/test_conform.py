import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourcast.operators.conform import align_to, conform, conform_table, require_columns, union_aligned
from hourcast.schemas import CLIENT_SCHEMA, GAS_SCHEMA, POWER_SCHEMA
from hourcast.sources.files import text_schema


def _power_text(spark, rows):
    return spark.createDataFrame(rows, text_schema(POWER_SCHEMA))


def test_missing_column_raises(spark):
    df = spark.createDataFrame([(1, 2)], "row_id int, datetime int")
    with pytest.raises(ValueError, match="Missing columns: prediction_unit_id"):
        conform(df, POWER_SCHEMA)
    with pytest.raises(ValueError):
        require_columns(df, ["a"])


def test_bad_timestamp_and_overflow_raise(spark):
    bad_ts = _power_text(spark, [("1", "xx", "1", "1", "0", "1", "1", "2.5")])
    with pytest.raises(PySparkException):
        conform(bad_ts, POWER_SCHEMA).collect()
    overflow = _power_text(spark, [("1", "2021-03-28 03:00:00", "1", "1", "300", "1", "1", "2.5")])
    with pytest.raises(PySparkException):
        conform(overflow, POWER_SCHEMA).collect()
    lenient = conform(overflow, POWER_SCHEMA, lenient=True).first()
    assert lenient["county"] is None and lenient["target"] == 2.5


def test_timestamps_stay_local(spark):
    df = _power_text(spark, [("1", "2021-03-28 03:00:00", "1", "1", "0", "0", "1", "")])
    for zone in ("UTC", "Europe/Tallinn", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        r = conform(df, POWER_SCHEMA).select(F.hour("datetime").alias("h"), "is_business", "target").first()
        assert r["h"] == 3 and r["is_business"] is False and r["target"] is None
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert conform(df, POWER_SCHEMA).schema == POWER_SCHEMA


def test_gas_date_text_and_client(spark):
    gas = spark.createDataFrame([("2024-01-05", "10", "20")], text_schema(GAS_SCHEMA))
    r = conform_table(gas, "gas", GAS_SCHEMA).first()
    assert str(r["forecast_date"]) == "2024-01-05 00:00:00"
    client = spark.createDataFrame([("2024-01-05", "3", "true", "1", "12.5")], text_schema(CLIENT_SCHEMA))
    assert conform(client, CLIENT_SCHEMA).first()["installed_capacity"] == 12.5


def test_align_and_union(spark):
    hist = spark.createDataFrame([(1, 2.0)], "row_id long, target double")
    new = spark.createDataFrame([(2, "x")], "row_id long, extra string")
    out = union_aligned([hist, new]).orderBy("row_id").collect()
    assert [tuple(r) for r in out] == [(1, 2.0), (2, None)]
    assert align_to(new, hist.schema).columns == ["row_id", "target"]


def test_rows_are_conformed_or_rejected(spark, tmp_path):
    from hourcast.operators.conform import CORRUPT_COL, MALFORMED, REASONS_COL, conform_or_reject
    from hourcast.sources.files import read_csv_to_judge

    lines = ["date,county,is_business,product_type,installed_capacity",
             "2024-01-05,3,true,1,12.5", "2024-01-06,3,false,1,", "05.01.2024,3,true,1,1", "2024-01-07,300,perhaps,1,x", ",3,true,1,1",
             "2024-01-08,3,true", "2024-01-09,3,true,1,1,more", '2024-01-10,3,"true",1,"2.5"']
    path = tmp_path / "client.csv"
    path.write_text("\n".join(lines) + "\n")
    raw = read_csv_to_judge(spark, str(path), CLIENT_SCHEMA)
    good, rejected = conform_or_reject(raw, CLIENT_SCHEMA, required=["date"])
    assert good.schema == CLIENT_SCHEMA
    assert sorted((str(r["date"]), r["installed_capacity"]) for r in good.collect()) == [("2024-01-05", 12.5), ("2024-01-06", None), ("2024-01-10", 2.5)]
    found = sorted((r[REASONS_COL], r[CORRUPT_COL]) for r in rejected.collect())
    assert found == sorted([
        (["date: not a date"], None), (["county: not a tinyint", "is_business: not a boolean", "installed_capacity: not a double"], None),
        (["date: missing"], None), ([MALFORMED], lines[6]), ([MALFORMED], lines[7])], key=lambda r: r[0])
    typed = spark.createDataFrame([(None, 3), (7, 400)], "date int, county int").selectExpr("cast(null as date) date", "county", "true is_business", "1 product_type", "2.0 installed_capacity")
    good, rejected = conform_or_reject(typed, CLIENT_SCHEMA)
    assert good.count() == 1 and rejected.first()[REASONS_COL] == ["county: not a tinyint"]
    good, rejected = conform_or_reject(raw.filter("false"), CLIENT_SCHEMA)
    assert good.count() == rejected.count() == 0
