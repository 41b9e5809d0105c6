from pyspark.sql import functions as F

from hourcast.functions.scalar import null_to_zero, positive_part
from hourcast.operators.split import assign_folds, fold_frames
from hourcast.plans.forecast import block_recursive_forecast


def test_folds_n10_k3(spark):
    df = spark.range(10).select(F.col("id").alias("row_id"), F.col("id").alias("t"))
    out = {r["row_id"]: r for r in assign_folds(df, 3, order=["t", "row_id"], groups=[]).collect()}
    tests = {k: sorted(i for i, r in out.items() if r["test_fold"] == k) for k in range(3)}
    assert tests == {0: [4, 5], 1: [6, 7], 2: [8, 9]}
    folded = assign_folds(df, 3, order=["t", "row_id"], groups=[])
    train, test = fold_frames(folded, 1)
    assert sorted(r["row_id"] for r in train.collect()) == list(range(6))
    assert sorted(r["row_id"] for r in test.collect()) == [6, 7]


def test_block_recursion_equals_row_recursion(spark):
    # 3 series x (40 history + 30 horizon) hours, lags 12 and 24, linear stand-in model.
    a, b, c = 0.5, 0.3, 1.0
    hist, horizon, expected = [], [], {}
    rid = 0
    for s in range(3):
        values = [float((i * (s + 2)) % 17) for i in range(40)]
        for i, v in enumerate(values):
            hist.append((rid, s, True, i, v)); rid += 1
        series = list(values)
        for i in range(40, 70):
            pred = a * series[i - 12] + b * series[i - 24] + c
            series.append(pred)
            horizon.append((rid, s, True, i, None)); expected[rid] = pred; rid += 1
    schema = "row_id long, prediction_unit_id int, is_consumption boolean, h int, power double"

    def frame(rows):
        return spark.createDataFrame(rows, schema).withColumn(
            "datetime", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp_ntz")))

    model = lambda df: df.withColumn("_pred", a * F.col("power_lag_12") + b * F.col("power_lag_24") + c)  # noqa
    out = block_recursive_forecast(frame(hist), frame(horizon).drop("power"), "power", model, [12, 24])
    got = {r["row_id"]: r["prediction"] for r in out.collect()}
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert abs(got[k] - v) < 1e-9
    sliced = block_recursive_forecast(frame(hist), frame(horizon).drop("power"), "power", model, [12, 24],
                                      long_series=True)
    assert {r["row_id"]: r["prediction"] for r in sliced.collect()} == got
    # a null key is a series like any other
    nulled = lambda df: df.withColumn("prediction_unit_id", F.nullif("prediction_unit_id", F.lit(1)))
    for long in (False, True):
        out = block_recursive_forecast(nulled(frame(hist)), nulled(frame(horizon).drop("power")), "power", model,
                                       [12, 24], long_series=long)
        assert {r["row_id"]: r["prediction"] for r in out.collect()} == got


def test_back_transform_guards(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (float("nan"),), (2.0,)], "x double")
    rows = df.select(positive_part("x").alias("p"), null_to_zero(positive_part("x")).alias("z")).collect()
    assert rows[0]["p"] == 0.0 and rows[1]["p"] is None and rows[1]["z"] == 0.0
    assert rows[2]["p"] != rows[2]["p"] and rows[3]["p"] == 2.0
