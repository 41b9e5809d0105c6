"""Physical-plan properties the design relies on (checked with explain output)."""

import os
import re

from pyspark.sql import functions as F

from hourcast.functions.calendar import add_calendar_features
from hourcast.operators.enrich import forecast_weather_by_county, join_price
from hourcast.operators.series import add_positional_lags
from hourcast.plans.features import build_features, missing_value_policy
from hourcast.schemas import DEFAULT_LAGS, LAG_COLUMNS, MERGED_COLUMNS
from hourcast.sources import analog
from tests.conftest import SF_SMALL


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _merged_on_disk(spark, tmp_out):
    """A merged frame read from Parquet, as a stage output would be."""
    from hourcast.operators.enrich import star_merge

    path = os.path.join(tmp_out, "merged")
    star_merge(analog.source_tables(spark, SF_SMALL)).write.parquet(path)
    return spark.read.parquet(path)


def test_all_lags_in_one_window_and_one_exchange(spark, tmp_out):
    merged = _merged_on_disk(spark, tmp_out)
    lagged = add_positional_lags(merged, LAG_COLUMNS, DEFAULT_LAGS)
    plan = _physical(lagged)
    assert len(re.findall(r"\bWindow \[", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(prediction_unit_id#\d+, is_consumption#\d+", plan)) == 1
    assert len([c for c in lagged.columns if "_lag_" in c]) == 44


def test_features_plan_shuffles_the_fact_once(spark, tmp_out):
    merged = _merged_on_disk(spark, tmp_out)
    plan = _physical(build_features(merged, "train", lags=[12, 24]))
    # The per-instant price table was written and broadcast after a size check:
    # the fact is neither shuffled by instant nor gathered in one partition.
    assert "Exchange SinglePartition" not in plan
    assert not re.search(r"Exchange hashpartitioning\(datetime#\d+", plan)
    assert "BroadcastHashJoin" in plan
    # Series fill and lags share the only fact exchange.
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(prediction_unit_id#\d+, is_consumption#\d+", plan)) == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_out):
    tables = analog.source_tables(spark, SF_SMALL)
    fw_path, el_path = os.path.join(tmp_out, "fw"), os.path.join(tmp_out, "el")
    tables["forecast_weather"].write.parquet(fw_path)
    tables["electricity"].write.parquet(el_path)
    fw = spark.read.parquet(fw_path)
    plan = _physical(forecast_weather_by_county(fw, tables["mapping"]))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(hours_ahead,24\)", plan)
    fact = tables["power"].withColumnRenamed("target", "power").select("row_id", "datetime")
    joined = join_price(fact, spark.read.parquet(el_path), "forecast_date", "euros_per_mwh", "p")
    scan = [l for l in _physical(joined).split("\n") if el_path in l or "ReadSchema: struct<forecast_date" in l]
    assert any("ReadSchema: struct<forecast_date:timestamp_ntz,euros_per_mwh:double>" in l for l in scan)


def test_zero_and_missing_capacity(spark):
    rows = [(i, f"2024-01-01 0{i}:00:00", cap, 5.0) for i, cap in enumerate([0.0, None, 10.0, None])]
    df = spark.createDataFrame(rows, "row_id long, d string, installed_capacity double, power double").select(
        "row_id", F.to_timestamp_ntz("d").alias("datetime"), "installed_capacity", "power")
    full = df
    for c in MERGED_COLUMNS:
        if c not in full.columns:
            full = full.withColumn(c, F.lit(None).cast("double"))
    full = full.withColumns({"prediction_unit_id": F.lit(1).cast("short"), "is_consumption": F.lit(True),
                             "county": F.lit(0).cast("byte"), "is_business": F.lit(False),
                             "product_type": F.lit(1).cast("byte"),
                             "capacity_factor": F.try_divide(F.col("power"), F.col("installed_capacity"))})
    out = {r["row_id"]: r for r in missing_value_policy(add_calendar_features(full), "train").collect()}
    assert out[0]["capacity_factor"] is None  # zero capacity: no error, null ratio
    assert out[1]["installed_capacity"] == 0.0 and out[1]["capacity_factor"] is None
    assert out[2]["capacity_factor"] == 0.5
    assert out[3]["installed_capacity"] == 10.0 and out[3]["capacity_factor"] == 0.5  # filled cap -> ratio


def test_bucketed_series_need_no_exchange(spark, tmp_out):
    from hourcast.operators.series import forward_fill, keep_last
    from hourcast.schemas import SERIES_KEYS, TABLE_KEYS
    from hourcast.sources.files import write_bucketed

    power = analog.source_tables(spark, SF_SMALL)["power"]
    fact = write_bucketed(power, "bucketed_fact", os.path.join(tmp_out, "fact"), SERIES_KEYS, ["datetime", "row_id"], 4)
    try:
        plain = {"lags": lambda d: add_positional_lags(d, ["target"], [12, 24], order=["datetime", "row_id"]),
                 "fill": lambda d: forward_fill(d, ["target"], order=["datetime", "row_id"]),
                 "last": lambda d: keep_last(d, TABLE_KEYS["power"], ["row_id"])}
        for build in plain.values():
            assert "Exchange" not in _physical(build(fact)) and "Exchange" in _physical(build(power))
            assert sorted(map(tuple, build(fact).collect()), key=str) == sorted(map(tuple, build(power).collect()), key=str)
        assert len(fact.inputFiles()) <= 4
    finally:
        spark.sql("drop table bucketed_fact")


def test_recursion_rounds_have_no_exchange(spark):
    from hourcast.plans.forecast import block_recursive_forecast, column_model
    from hourcast.schemas import SERIES_KEYS

    f = analog.source_tables(spark, SF_SMALL)["power"].withColumnRenamed("target", "power").select("row_id", "datetime", *SERIES_KEYS, "power")
    cut = F.col("datetime") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    out = block_recursive_forecast(f.filter(~cut), f.filter(cut), "power", column_model(lambda: F.col("power_lag_3")), [3])
    plan = _physical(out)
    # More than one round, one shuffle by series before them, no window and no join.
    assert plan.count("Generate posexplode") > 3
    assert len(re.findall(r"Exchange", plan)) == 1 and "Window" not in plan and "Join" not in plan
    assert out.filter("prediction is not null").count() > 0


def test_models_score_rows_without_a_union(spark):
    from hourcast.plans.model import SideModels

    df = spark.range(40).selectExpr("id % 2 = 0 as is_consumption", "cast(id % 7 as double) as x", "cast(id % 5 as double) as capacity_factor")
    params = {"maxIter": 1, "maxDepth": 1}
    models = SideModels(["x"], {"consumption": params, "production": params}).fit(df)
    plan = _physical(models.transform(df.repartition(3, "x")))
    assert "Union" not in plan and plan.count("Exchange") == 1
