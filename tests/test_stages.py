import os

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from hourcast.operators.evaluate import observe_rows
from hourcast.operators.enrich import star_merge
from hourcast.plans.stages import FeatureStage, SideModelsEstimator, run_feature_engineering
from hourcast.sources import analog
from hourcast.sources.snapshots import read_snapshot, write_snapshot
from hourcast.streaming.incremental import group_frames, group_order
from tests.conftest import SF_SMALL


def test_pipeline_of_stages(spark):
    merged = star_merge(analog.source_tables(spark, SF_SMALL))
    params = {"maxIter": 2, "maxDepth": 2}
    pipe = Pipeline(stages=[FeatureStage("train", [12, 24]),
                            SideModelsEstimator(params={"consumption": params, "production": params})])
    model = pipe.fit(merged)
    out = model.transform(merged)
    assert "_pred" in out.columns
    assert out.count() == run_feature_engineering(merged, lags=[12, 24]).count()


def test_snapshots_keep_last_and_replay(spark, tmp_out):
    a = spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("2024-01-01 01:00:00", 2.0)], "d string, euros_per_mwh double")
    a = a.select(F.to_timestamp_ntz("d").alias("forecast_date"), "euros_per_mwh")
    b = spark.createDataFrame([("2024-01-01 01:00:00", None)], "d string, euros_per_mwh double").select(
        F.to_timestamp_ntz("d").alias("forecast_date"), "euros_per_mwh")
    root = os.path.join(tmp_out, "snap")
    write_snapshot({"electricity": a}, root, 0)
    write_snapshot({"electricity": b}, root, 1)
    write_snapshot({"electricity": b}, root, 1)  # replay
    got = {str(r["forecast_date"]): r["euros_per_mwh"] for r in read_snapshot(spark, root, "electricity").collect()}
    assert got == {"2024-01-01 00:00:00": 1.0, "2024-01-01 01:00:00": None}


def test_group_replay_and_observe(spark):
    df = spark.createDataFrame([(1, 7), (2, 3), (3, 7), (4, 5)], "seq long, gid int")
    order = [r["gid"] for r in group_order(df, "gid", "seq").orderBy("position").collect()]
    assert order == [7, 3, 5]
    frames = group_frames({"a": df, "b": df.withColumn("x", F.lit(1))}, "gid", 7)
    assert frames["a"].count() == 2 and "gid" not in frames["b"].columns
    observed, obs = observe_rows(df, "shape")
    observed.collect()
    assert obs.get["rows"] == 4


def test_saved_pipeline_predicts_the_same(spark, tmp_out):
    from pyspark.ml import PipelineModel

    merged = star_merge(analog.source_tables(spark, SF_SMALL))
    params = {"maxIter": 2, "maxDepth": 2}
    model = Pipeline(stages=[FeatureStage("train", [12, 24]),
                             SideModelsEstimator(params={"consumption": params, "production": params})]).fit(merged)
    path = os.path.join(tmp_out, "pipeline")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    rows = lambda m: sorted(tuple(r) for r in m.transform(merged).select("row_id", "_pred").collect())
    assert rows(loaded) == rows(model)


def test_runs_are_appended_once(spark, tmp_out):
    from hourcast.operators.evaluate import append_run, run_record

    path = os.path.join(tmp_out, "runs")
    for run in ("a", "b", "a"):
        append_run(run_record(spark, run, {"x": 1}, {"mae": 2.0}), path)
    got = {r["run_id"]: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert got == {"a": 2, "b": 2}


def test_folder_manifest_reports_a_missing_file(spark, tmp_out):
    from hourcast.sources.files import folder_manifest

    spark.range(3).coalesce(1).write.csv(os.path.join(tmp_out, "client.csv"))
    got = {r["name"]: r for r in folder_manifest(spark, tmp_out, ["client.csv", "train.csv"]).collect()}
    assert got["client.csv"]["present"] and got["client.csv"]["n_bytes"] == 6
    assert not got["train.csv"]["present"] and got["train.csv"]["n_files"] is None
    assert [r["present"] for r in folder_manifest(spark, os.path.join(tmp_out, "none"), ["x"]).collect()] == [False]


def test_saved_stages_keep_their_history(spark, tmp_out):
    from pyspark.ml import PipelineModel

    merged = star_merge(analog.source_tables(spark, SF_SMALL)).cache()
    cut = F.col("datetime") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    history, new = merged.filter(~cut), merged.filter(cut)
    stored = os.path.join(tmp_out, "stored")
    history.write.parquet(stored)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    for k, (mode, how) in enumerate([("retrain", {"history": history}), ("test", {"history": history}), ("retrain", {"history_path": stored})]):
        model = PipelineModel([FeatureStage(mode, [12, 24], **how)])
        path = os.path.join(tmp_out, f"saved{k}")
        model.write().overwrite().save(path)
        want = rows(model.transform(new))
        assert want and rows(PipelineModel.load(path).transform(new)) == want
        # A reference is not a copy.
        assert bool([f for f in os.listdir(f"{path}/stages") if os.path.exists(f"{path}/stages/{f}/history")]) == ("history" in how)


def test_a_stage_is_logged_once(spark, tmp_out):
    from hourcast.operators.runlog import RunLog

    log = RunLog(spark, os.path.join(tmp_out, "runs"), "r1")
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, None)], "a int, b double")
    assert log.stage("s", df, ["a", "b"]).count() == 3
    log.stage("s", df.filter("a < 3"), ["a", "b"])
    log.stage("empty", df.filter("false"), ["b"])
    RunLog(spark, os.path.join(tmp_out, "runs"), "r2").note("s", {"x": {"m": 1}})
    got = {(r["run_id"], r["stage"], r["metric"]): r["value"] for r in log.read().collect() if r["metric"] != "seconds"}
    assert got == {("r1", "s", "rows"): 2, ("r1", "s", "nulls.a"): 0, ("r1", "s", "nulls.b"): 1,
                   ("r1", "empty", "rows"): 0, ("r1", "empty", "nulls.b"): 0, ("r2", "s", "m"): 1}
