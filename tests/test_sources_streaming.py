import os

from pyspark.sql import functions as F

from hourcast.operators.evaluate import cv_summary, run_record
from hourcast.schemas import POWER_SCHEMA
from hourcast.sources import analog
from hourcast.sources.files import (
    county_names,
    read_csv,
    read_json_record,
    source_audit,
    write_csv,
    write_json_record,
    write_parquet,
)
from hourcast.streaming.incremental import DailyLoop

from tests.conftest import SF_SMALL


def test_csv_parquet_json_round_trip(spark, tmp_out):
    power = analog.source_tables(spark, SF_SMALL)["power"]
    write_csv(power, os.path.join(tmp_out, "csv"))
    back = read_csv(spark, os.path.join(tmp_out, "csv"), POWER_SCHEMA)
    assert back.schema == POWER_SCHEMA and back.exceptAll(power).count() == 0
    write_parquet(power.withColumn("day", F.to_date("datetime")), os.path.join(tmp_out, "pq"), ["day"])
    assert spark.read.parquet(os.path.join(tmp_out, "pq")).count() == power.count()
    write_json_record(spark, {"mae": 1.5, "n": 3}, os.path.join(tmp_out, "js"))
    assert read_json_record(spark, os.path.join(tmp_out, "js")) == {"mae": 1.5, "n": 3}


def test_source_audit_and_names(spark):
    tables = {t: analog.table(spark, SF_SMALL, t) for t in ["region", "nation"]}
    rows = {r["table_name"]: r for r in source_audit(spark, tables, ["region", "nation", "absent"]).collect()}
    assert rows["region"]["n_rows"] == 5 and rows["region"]["n_files"] == 1 and rows["region"]["n_bytes"] > 0
    assert rows["absent"]["present"] is False and rows["nation"]["present"] is True
    assert county_names(spark).count() == 16


def test_cv_summary_and_run_record(spark):
    scores = spark.createDataFrame([(True, 0, 1.0), (True, 1, 3.0), (False, 0, 2.0), (False, 1, 2.0)],
                                   "side boolean, fold int, mae double")
    out = {r["group_name"]: r for r in cv_summary(scores, "side", {True: "c", False: "p"}).collect()}
    assert out["c"]["mean_mae"] == 2.0 and out["c"]["std_mae"] == 1.0 and out["p"]["std_mae"] == 0.0
    assert out["all"]["n_folds"] == 4
    rec = run_record(spark, "r1", {"a": 1, "b": None}, {"mae": 2.0, "name": "x"}, [{"fold": 0, "mae": 1.0}])
    assert rec.count() == 3


def test_stream_equals_batch_and_replay(spark, tmp_out):
    from pyspark.sql import Window
    fact = analog.source_tables(spark, SF_SMALL)["power"].withColumnRenamed("target", "power").select(
        "row_id", "datetime", "prediction_unit_id", "is_consumption", "power")
    days = ["2024-01-28", "2024-01-29", "2024-01-30"]
    loop = DailyLoop(spark, fact, "power", lags=[24], root=os.path.join(tmp_out, "loop"))
    loop.seed_history(days[0])
    got = {r["row_id"]: r["prediction"] for r in loop.run(days).collect()}
    w = Window.partitionBy("prediction_unit_id", "is_consumption").orderBy("datetime")
    batch = fact.withColumn("p", F.coalesce(F.lag("power", 24).over(w), F.lit(0.0))).filter(
        F.col("datetime") >= F.lit("2024-01-28 00:00:00").cast("timestamp_ntz"))
    want = {r["row_id"]: r["p"] for r in batch.collect()}
    assert got == want
    # replaying a batch id rewrites its partition only: the output is unchanged
    loop._process(spark.createDataFrame([(days[1], 1, days[0])], "day string, seq long, reveal string"), 1)
    again = {r["row_id"]: r["prediction"] for r in spark.read.parquet(loop.output).collect()}
    assert again == want


def test_stream_with_feature_hook_equals_batch(spark, tmp_out):
    from hourcast.operators.enrich import star_merge
    from hourcast.plans.features import build_features
    from hourcast.plans.forecast import seasonal_naive, to_power
    from hourcast.session import materialize

    merged = materialize(star_merge(analog.source_tables(spark, SF_SMALL)))
    hidden = ["power", "capacity_factor"]

    def features(history, rows):
        return build_features(rows, "test", history=history, lags=[12, 24])

    def model(df):
        return to_power(seasonal_naive("capacity_factor", [24, 12]))

    days = ["2024-01-29", "2024-01-30"]
    seen = []

    def watched(history, rows):
        seen.append(sorted(str(r[0]) for r in history.select(F.to_date("datetime")).distinct().collect()))
        return features(history, rows)

    loop = DailyLoop(spark, merged, "power", model=model, features=watched, hidden=hidden, history_days=20,
                     root=os.path.join(tmp_out, "loop2"))
    loop.seed_history(days[0])
    got = {r["row_id"]: r["prediction"] for r in loop.run(days).collect()}
    want = {}
    for day in days:
        start = F.lit(day).cast("timestamp_ntz")
        rows = merged.filter((F.col("datetime") >= start) & (F.col("datetime") < F.date_add(start, 1).cast(
            "timestamp_ntz"))).withColumns({c: F.lit(None).cast("double") for c in hidden})
        feats = features(merged.filter(F.col("datetime") < start), rows)
        want.update({r["row_id"]: r["p"] for r in feats.select(
            "row_id", F.coalesce(model(feats), F.lit(0.0)).alias("p")).collect()})
    assert len(got) > 0 and got == want
    assert [(s[0], s[-1]) for s in seen] == [("2024-01-09", "2024-01-28"), ("2024-01-10", "2024-01-29")]


def small_fact(spark, seed=1, days=10):
    """Series with gaps: 6 to 20 rows a day, one series that ends and one that starts late."""
    import random

    rng, rows = random.Random(seed), []
    for unit in range(3):
        for day in range(1, days + 1):
            if (unit == 1 and day > 6) or (unit == 2 and day < 5):
                continue
            for hour in sorted(rng.sample(range(24), rng.randint(6, 20))):
                rows.append((len(rows), f"2024-02-{day:02d} {hour:02d}:00:00", unit, True, float(rng.randrange(100))))
    df = spark.createDataFrame(rows, "row_id long, at string, prediction_unit_id int, is_consumption boolean, power double")
    return df.withColumn("datetime", F.to_timestamp_ntz("at")).drop("at").cache()


def test_corrections_redo_the_days_that_read_them(spark, tmp_out, monkeypatch):
    lags = [3, 40]
    value = lambda df: F.coalesce("power_lag_3", F.lit(0.0)) + 1000 * F.coalesce("power_lag_40", F.lit(0.0))
    right = small_fact(spark)
    days = [f"2024-02-{d:02d}" for d in range(7, 11)]
    day = F.date_format("datetime", "yyyy-MM-dd")

    def replay(fact, root):
        loop = DailyLoop(spark, fact, "power", lags=lags, model=value, root=os.path.join(tmp_out, root))
        loop.seed_history(days[0])
        return loop, {r["row_id"]: r["prediction"] for r in loop.run(days).collect()}

    def reads(c):  # by the rows: is a row of day c among the last 40 of its series before the day?
        rows = [(r["prediction_unit_id"], str(r["datetime"])[:10]) for r in right.orderBy("datetime").collect()]
        out = {c} & set(days)
        for d in days:
            for unit in range(3):
                tail = [x for u, x in rows if u == unit and x < d][-40:]
                if d > c and c in tail:
                    out.add(d)
        return sorted(out)

    _, want = replay(right, "fresh")
    for k, (name, wrong) in enumerate({
        "2024-02-05": right.withColumn("power", F.when(day == "2024-02-05", 7.0).otherwise(F.col("power"))),  # changed, in the seed
        "2024-02-08": right.filter((day != "2024-02-08") | (F.col("row_id") % 2 == 0)),  # rows came late
    }.items()):
        loop, first = replay(wrong, f"loop{k}")
        assert first != want and loop.corrections() == []
        loop.fact = right.withColumn("_day", day)
        assert loop.corrections() == [name] and loop.corrections("2024-02-09") == []
        redone, one_day = [], loop._one_day
        monkeypatch.setattr(loop, "_one_day", lambda d, good: (redone.append(d), one_day(d, good)))
        got = {r["row_id"]: r["prediction"] for r in loop.correct().collect()}
        assert got == want
        assert redone == reads(name) and loop.corrections() == []


def test_a_day_is_withdrawn(spark, tmp_out):
    right = small_fact(spark)
    days = [f"2024-02-{d:02d}" for d in range(7, 10)]
    day = F.date_format("datetime", "yyyy-MM-dd")
    without = right.filter(day != "2024-02-07")
    out = {}
    for name, fact, run in (("whole", right, days), ("without", without, days[1:])):
        loop = DailyLoop(spark, fact, "power", lags=[5], root=os.path.join(tmp_out, name))
        loop.seed_history(days[0])
        out[name] = {r["row_id"]: r["prediction"] for r in loop.run(run).collect()}
        if name == "whole":
            first = loop
    first.fact = without.withColumn("_day", day)
    assert first.corrections() == ["2024-02-07"]
    assert {r["row_id"]: r["prediction"] for r in first.correct().collect()} == out["without"]


def test_digests_tell_nulls_and_rows_apart(spark):
    from hourcast.streaming.incremental import day_digests

    one = [("d", 1, None, "x"), ("d", None, 1, "x"), ("d", 1, None, "x")]
    digest = lambda rows: tuple(day_digests(spark.createDataFrame(rows, "_day string, a int, b int, c string").repartition(2)).first())
    assert digest(one) == digest(one[::-1])
    for other in (one[:2], [one[0], one[0], one[1], one[1]], [one[0], one[0], one[0]], [("d", 1, None, "y"), *one[1:]]):
        assert digest(other) != digest(one)
