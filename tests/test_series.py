from pyspark.sql import Window
from pyspark.sql import functions as F

from hourcast.operators.series import (
    add_positional_lags,
    add_time_lags,
    distributed_row_number,
    drop_rows_with_null,
    exclude_range,
    forward_fill,
    forward_fill_global,
    keep_last,
    positional_lags_by_join,
    upsert,
)


def _series(spark, rows):
    return spark.createDataFrame(rows, "row_id long, prediction_unit_id int, is_consumption boolean, h int, v double") \
        .withColumn("datetime", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))


def test_lags_per_series_and_gaps(spark):
    rows = [(i, 1, True, h, float(h)) for i, h in enumerate([0, 1, 2, 5, 6])]
    rows += [(10 + h, 2, True, h, 100.0 + h) for h in range(5)]
    df = _series(spark, rows)
    pos = {r["row_id"]: r["v_lag_2"] for r in add_positional_lags(df, ["v"], [2]).collect()}
    exact = {r["row_id"]: r["v_lag_2"] for r in add_time_lags(df, ["v"], [2]).collect()}
    assert pos[0] is None and pos[1] is None and pos[2] == 0.0
    assert pos[3] == 1.0 and pos[4] == 2.0  # positional: 2 rows back
    assert exact[3] is None and exact[4] is None  # exact time: nothing at h=3, 4
    assert pos[10] is None and pos[12] == 100.0  # no leak between series
    cur = {r["row_id"]: r["v_lag_2"] for r in add_positional_lags(
        df.withColumn("v", F.when(F.col("row_id") == 4, None).otherwise(F.col("v"))), ["v"], [2],
        mode="current_or_lag").collect()}
    assert cur[3] == 5.0 and cur[4] == 2.0
    joined = {r["row_id"]: r["v_lag_2"] for r in positional_lags_by_join(df, ["v"], [2]).collect()}
    assert joined == pos


def test_forward_fills(spark):
    rows = [(0, 1, True, 0, None), (1, 1, True, 1, 3.0), (2, 1, True, 2, None), (3, 1, True, 30, None),
            (4, 2, True, 0, 7.0), (5, 2, True, 1, None), (6, 2, True, 50, 9.0), (7, 2, True, 51, None)]
    df = _series(spark, rows)
    ff = {r["row_id"]: r["v"] for r in forward_fill(df, ["v"]).collect()}
    assert ff == {0: None, 1: 3.0, 2: 3.0, 3: 3.0, 4: 7.0, 5: 7.0, 6: 9.0, 7: 9.0}
    # global: one value per instant, filled in time order across days
    g = spark.createDataFrame([(i, h, p) for i, (h, p) in enumerate(
        [(0, None), (1, 2.0), (1, 2.0), (5, None), (26, None), (27, 4.0), (50, None), (75, None)])],
        "row_id long, h int, p double").withColumn(
        "datetime", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    two_phase = {r["row_id"]: r["p"] for r in forward_fill_global(g, ["p"]).collect()}
    naive_w = Window.orderBy("datetime", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    naive = {r["row_id"]: r["p"] for r in g.select("row_id", F.last("p", True).over(naive_w).alias("p")).collect()}
    assert two_phase == naive
    assert two_phase[0] is None and two_phase[4] == 2.0 and two_phase[7] == 4.0


def test_keep_last_and_upsert(spark):
    hist = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    new = spark.createDataFrame([(1, "a2", None), (3, "c", 3.0)], "k int, s string, v double")
    out = {r["k"]: (r["s"], r["v"]) for r in upsert(hist, new, ["k"], seq=["s"]).collect()}
    assert out == {1: ("a2", None), 2: ("b", 2.0), 3: ("c", 3.0)}
    dup = spark.createDataFrame([(1, 5, "x"), (1, 9, "y"), (1, 7, "z")], "k int, seq int, s string")
    assert keep_last(dup, ["k"], ["seq"]).first()["s"] == "y"


def test_row_filters(spark):
    df = spark.createDataFrame(
        [("2021-08-31 23:00:00",), ("2021-09-01 00:00:00",), ("2021-09-02 23:00:00",), ("2021-09-03 00:00:00",)],
        "s string").select(F.to_timestamp_ntz("s").alias("datetime"), "s")
    kept = [r["s"] for r in exclude_range(df, "2021-09-01 00:00:00", "2021-09-02 23:59:59").collect()]
    assert sorted(kept) == ["2021-08-31 23:00:00", "2021-09-03 00:00:00"]
    nan = spark.createDataFrame([(1, float("nan")), (2, None)], "a int, b double")
    assert [r["a"] for r in drop_rows_with_null(nan).collect()] == [1]


def test_distributed_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5000).alias("o"))
    ours = distributed_row_number(df, ["o"], ["g"], "pos", num_partitions=7)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert sorted(map(tuple, ours.select("g", "o", "pos").collect())) == sorted(
        map(tuple, ref.select("g", "o", "pos").collect()))
    # one hot group split over many partitions
    hot = spark.range(0, 3000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    got = distributed_row_number(hot, ["o"], ["g"], num_partitions=5).filter("pos != o").count()
    assert got == 0


def test_forward_fill_by_slices_equals_window(spark):
    from hourcast.operators.series import forward_fill_by_slices

    rows = []
    for s in range(3):
        for h in range(400):
            v = None if (h % 7 and h % 11) else float(h * (s + 1))
            rows.append((s * 1000 + h, s, True, h, v))
    rows.append((9999, 9, True, 0, None))
    df = _series(spark, rows)
    want = {r["row_id"]: r["v"] for r in forward_fill(df, ["v"]).collect()}
    got = {r["row_id"]: r["v"] for r in forward_fill_by_slices(df, ["v"], num_partitions=9).collect()}
    assert got == want


def test_upsert_unique_history_equals_keep_last(spark):
    from hourcast.operators.series import upsert_unique_history

    hist = spark.createDataFrame([(k, f"h{k}", float(k), 0) for k in range(50)], "k int, s string, v double, seq int")
    new = spark.createDataFrame([(3, "n3a", None, 1), (3, "n3b", 7.0, 2), (60, "n60", 1.0, 1), (10, "n10", 2.0, 5)],
                                "k int, s string, v double, seq int")
    want = {tuple(r) for r in upsert(hist, new, ["k"], seq=["seq"]).collect()}
    got = {tuple(r) for r in upsert_unique_history(hist, new, ["k"], seq=["seq"]).collect()}
    assert got == want and (3, "n3b", 7.0, 2) in got and len(got) == 51


def test_null_keys_equal_the_window_forms(spark):
    from hourcast.operators.series import forward_fill_by_slices, positional_lags_by_join, upsert_unique_history

    rows = [(i, None if i % 3 == 0 else i % 3, None if i % 2 else True, i, None if i % 5 else float(i)) for i in range(60)]
    df = _series(spark, rows)
    as_rows = lambda d: {r["row_id"]: r.asDict() for r in d.collect()}
    assert as_rows(positional_lags_by_join(df, ["v"], [1, 3])) == as_rows(add_positional_lags(df, ["v"], [1, 3]))
    assert as_rows(forward_fill_by_slices(df, ["v"], num_partitions=5)) == as_rows(forward_fill(df, ["v"]))
    pos = distributed_row_number(df, ["datetime"], ["prediction_unit_id", "is_consumption"], num_partitions=5)
    assert pos.count() == 60
    hist = spark.createDataFrame([(None, 1, "a"), (2, 1, "b")], "k int, seq int, s string")
    new = spark.createDataFrame([(None, 2, "c"), (None, 3, "d"), (3, 1, "e")], "k int, seq int, s string")
    got = sorted(map(tuple, upsert_unique_history(hist, new, ["k"], seq=["seq"]).collect()), key=str)
    assert got == sorted(map(tuple, upsert(hist, new, ["k"], seq=["seq"]).collect()), key=str)
    assert got == [(2, 1, "b"), (3, 1, "e"), (None, 3, "d")]


def test_versions_need_an_order(spark):
    import pytest

    from hourcast.operators.series import upsert_unique_history

    df = spark.createDataFrame([(1, "a")], "k int, s string")
    for f in (upsert, upsert_unique_history):
        with pytest.raises(ValueError, match="seq"):
            f(df, df, ["k"], [])


def test_time_lags_take_one_exchange(spark):
    from hourcast.operators.series import add_time_lags

    df = _series(spark, [(i, 1, True, h, float(h)) for i, h in enumerate([0, 1, 2, 5, 6, 26, 30])])
    out = add_time_lags(df, ["v"], [1, 24])
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {r["v"]: (r["v_lag_1"], r["v_lag_24"]) for r in out.collect()}
    assert got == {0: (None, None), 1: (0, None), 2: (1, None), 5: (None, None), 6: (5, None), 26: (None, 2), 30: (None, 6)}
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_global_fill_has_no_single_task_sort(spark):
    df = _series(spark, [(i, i % 2, True, i // 2, float(i) if i % 7 == 0 else None) for i in range(40)])
    plan = forward_fill_global(df, ["v"], materialize_instants=False)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
