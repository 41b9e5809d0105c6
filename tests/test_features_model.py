import os

import pytest
from pyspark.sql import functions as F

from hourcast.plans.driver import DRIVER_LAGS
from hourcast.plans.features import build_features, missing_value_policy
from hourcast.plans.model import SideModels, feature_list, random_search
from hourcast.operators.enrich import star_merge
from hourcast.schemas import feature_columns
from hourcast.sources import analog

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def merged(spark):
    return star_merge(analog.source_tables(spark, SF_SMALL)).cache()


def test_feature_columns(merged):
    f = build_features(merged, "train", lags=DRIVER_LAGS)
    assert f.columns == feature_columns(DRIVER_LAGS)
    assert len(feature_columns()) == 84


def test_dst_zero_and_null_drop(spark, merged):
    rows = merged.limit(3).collect()
    base = spark.createDataFrame(rows, merged.schema)
    times = ["2022-03-27 03:00:00", "2022-10-30 03:00:00", "2022-06-01 12:00:00"]
    df = base.withColumns({
        "datetime": F.when(F.col("row_id") == rows[0]["row_id"], F.lit(times[0]))
        .when(F.col("row_id") == rows[1]["row_id"], F.lit(times[1])).otherwise(F.lit(times[2])).cast("timestamp_ntz"),
        "power": F.lit(None).cast("double")})
    from hourcast.functions.calendar import add_calendar_features
    out = missing_value_policy(add_calendar_features(df), "train").collect()
    assert sorted(str(r["datetime"]) for r in out) == times[:2]
    assert all(r["power"] == 0.0 for r in out)


def test_retrain_equals_train_on_new_days(spark, merged):
    split = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    train = build_features(merged, "train", lags=[12, 24]).filter(F.col("datetime") >= split)
    retrain = build_features(merged.filter(F.col("datetime") >= split), "retrain",
                             history=merged.filter(F.col("datetime") < split), lags=[12, 24])
    assert train.count() > 0
    assert train.exceptAll(retrain).count() == 0 and retrain.exceptAll(train).count() == 0


def test_models_fit_predict_save_load(spark, merged, tmp_out):
    train = build_features(merged, "train", lags=[12, 24])
    params = {"maxIter": 3, "maxDepth": 3}
    m = SideModels(params={"consumption": params, "production": params}).fit(train)
    scored = m.transform(train)
    assert scored.count() == train.count() and "_pred" in scored.columns
    assert m.features == feature_list(train) and "power" not in m.features
    path = os.path.join(tmp_out, "models")
    m.save(path)
    again = SideModels.load(path)
    a = {r["row_id"]: r["_pred"] for r in scored.select("row_id", "_pred").collect()}
    b = {r["row_id"]: r["_pred"] for r in again.transform(train).select("row_id", "_pred").collect()}
    assert a == b
    with pytest.raises(RuntimeError):
        SideModels().transform(train)
    with pytest.raises(FileNotFoundError):
        SideModels.load(os.path.join(tmp_out, "absent"))


def test_random_search_rows(spark, merged):
    train = build_features(merged, "train", lags=[12])
    best, table = random_search(train, n_trials=2, n_splits=2,
                                space={"maxIter": (2, 3, "int"), "maxDepth": (2, 3, "int")})
    assert set(best) == {"consumption", "production"}
    assert table.count() == 4


def test_long_series_path_equals_default(merged):
    default = build_features(merged, "train", lags=[12, 24])
    sliced = build_features(merged, "train", lags=[12, 24], long_series=True)
    assert sliced.columns == default.columns
    assert default.exceptAll(sliced).count() == 0 and sliced.exceptAll(default).count() == 0


def test_fit_with_a_thousand_units(spark):
    from hourcast.plans.model import SideModels

    df = spark.range(4000).select(
        (F.col("id") % 1000).cast("int").alias("prediction_unit_id"), (F.col("id") % 2 == 0).alias("is_consumption"),
        (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11 / 11).alias("capacity_factor"))
    fast = {"maxIter": 1, "maxDepth": 2}
    models = SideModels(["prediction_unit_id", "x"], {"consumption": fast, "production": fast}).fit(df)
    assert models.transform(df).count() == 4000


def model_rows(spark, n=400):
    """Rows of both sides with a label that depends on x and the unit."""
    return spark.range(n).select(
        "id", F.col("id").alias("row_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,cast(id as int))").alias("datetime"),
        (F.col("id") % 5).cast("int").alias("prediction_unit_id"), (F.col("id") % 2 == 0).alias("is_consumption"),
        (F.col("id") % 17).cast("double").alias("x"),
        (F.sin(F.col("id") % 17) + F.col("id") % 5 + F.rand(5) / 9).alias("capacity_factor"))


FEATURES = ["prediction_unit_id", "x"]


def test_one_fit_scores_every_number_of_trees(spark):
    from hourcast.operators.split import assign_folds, fold_frames
    from hourcast.plans.model import LABEL, PREDICTION, build_pipeline, error_curve, prepare

    space = {"maxIter": (2, 4, "int"), "maxDepth": (2, 3, "int"), "stepSize": (0.2, 0.5, "linear")}
    df = model_rows(spark).cache()
    best, table = random_search(df, n_trials=1, n_splits=2, space=space, features=FEATURES)
    for side, flag in {"consumption": True, "production": False}.items():
        rows = prepare(df.filter(F.col("is_consumption") == flag), FEATURES)
        folds = [fold_frames(assign_folds(rows, 2, groups=[]), k) for k in range(2)]
        found = []
        for trial in table.filter(F.col("side") == side).orderBy("trial").collect():
            params = eval(trial["params"])  # noqa: S307 - a JSON object of numbers
            for count in range(2, 5):  # brute force: a fit for each number of trees
                maes = []
                for train, test in folds:
                    scored = build_pipeline(FEATURES, {**params, "maxIter": count}).fit(train).transform(test)
                    maes.append(scored.agg(F.avg(F.abs(F.col(PREDICTION) - F.col(LABEL)))).first()[0])
                found.append((sum(maes) / 2, trial["trial"], count, {**params, "maxIter": count}, maes))
            mine = min((f for f in found if f[1] == trial["trial"]), key=lambda f: (round(f[0], 12), f[2]))
            assert params["maxIter"] == mine[2] and abs(trial["mean_mae"] - mine[0]) < 1e-9
            assert all(abs(a - b) < 1e-9 for a, b in zip(trial["fold_mae"], mine[4]))
        assert best[side] == min(found, key=lambda f: (round(f[0], 12), f[1], f[2]))[3]
    curve = error_curve(*folds[0], FEATURES, {"maxIter": 4, "maxDepth": 2})
    assert len(curve) == 4 and curve[0] > curve[-1]


def test_best_count_of_curves():
    import math

    from hourcast.plans.model import best_count

    assert best_count([[5.0, 2.0, 2.0, 3.0], [1.0, 2.0, 2.0, 9.0]], 1) == (2, 2.0, [2.0, 2.0])
    assert best_count([[5.0, 2.0, 3.0]], 3) == (3, 3.0, [3.0])
    count, mean, folds = best_count([], 4)
    assert count == 4 and math.isnan(mean) and folds == []


def test_predictions_follow_the_trees(spark):
    """A small fit against its trees, read from their text in plain Python."""
    import re

    df = model_rows(spark, 120)
    params = {"maxIter": 4, "maxDepth": 2, "stepSize": 0.3}
    models = SideModels(FEATURES, {"consumption": params, "production": params}).fit(df)
    scored = models.transform(df).collect()
    for side, flag in (("consumption", True), ("production", False)):
        indexer, _, gbt = models.models[side].stages
        labels = [float(v) for v in indexer.labelsArray[0]]

        def walk(lines, row, depth=0):
            for i, line in enumerate(lines):
                text = line.strip()
                if text.startswith("Predict:"):
                    return float(text.removeprefix("Predict:"))
                feature, how, value = re.match(r"(?:If|Else) \(feature (\d+) (<=|>|not in|in) (.*)\)", text).groups()
                got = row[int(feature)]
                if how in ("in", "not in"):
                    met = (got in {float(v) for v in value.strip("{}").split(",")}) == (how == "in")
                else:
                    met = got <= float(value) if how == "<=" else got > float(value)
                if met:
                    return walk(lines[i + 1 :], row)
                rest = len(line) - len(line.lstrip())
                k = next(j for j in range(i + 1, len(lines)) if len(lines[j]) - len(lines[j].lstrip()) == rest)
                return walk(lines[k:], row)

        for r in scored:
            if r["is_consumption"] != flag:
                continue
            features = [float(labels.index(float(r["prediction_unit_id"]))), r["x"]]
            total = sum(w * walk(t.toDebugString.splitlines()[1:], features) for w, t in zip(gbt.treeWeights, gbt.trees))
            assert abs(total - r["_pred"]) < 1e-9


def test_a_side_without_rows(spark, tmp_out):
    from hourcast.plans.forecast import submission

    one = model_rows(spark, 60).filter("is_consumption")
    params = {"maxIter": 2, "maxDepth": 2}
    models = SideModels(FEATURES, {"consumption": params, "production": params}).fit(one)
    both = model_rows(spark, 60)
    for m in (models, SideModels.load(models.save(os.path.join(tmp_out, "one")))):
        nulls = {r[0]: r[1] for r in m.transform(both).groupBy("is_consumption").agg(F.count_if(F.col("_pred").isNull())).collect()}
        assert nulls == {True: 0, False: 30}
    assert submission(models.transform(both), F.col("_pred")).filter("target = 0").count() >= 30
    with pytest.raises(ValueError, match="production"):
        SideModels(FEATURES).fit(one, strict=True)
    none = SideModels(FEATURES).fit(one.filter("false"))
    assert none.transform(both).filter("_pred is not null").count() == 0
    best, table = random_search(one, n_trials=2, n_splits=2, space={"maxIter": (2, 3, "int"), "maxDepth": (2, 2, "int")}, features=FEATURES)
    assert [r["mean_mae"] == r["mean_mae"] for r in table.orderBy("side", "trial").collect()] == [True, True, False, False]
    assert best["production"]["maxIter"] == 2
    assert random_search(one.filter("false"), 1, 2, features=FEATURES)[1].count() == 2


def test_validation_rows_choose_the_trees(spark):
    df = model_rows(spark).withColumn("held", F.col("id") >= 300)
    params = {"maxIter": 30, "maxDepth": 3, "stepSize": 1.0, "validationTol": 0.0}
    models = SideModels(FEATURES, {"consumption": params, "production": params}).fit(df, validation="held")
    assert all(m.stages[-1].getNumTrees <= 30 for m in models.models.values())
    assert min(m.stages[-1].getNumTrees for m in models.models.values()) < 30
    assert "held" not in models.features


def test_categories_of_any_number(spark, tmp_out):
    df = spark.range(60_000).select(
        F.col("id").alias("row_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int))").alias("datetime"),
        (F.col("id") % 20_000).cast("int").alias("prediction_unit_id"), (F.col("id") % 2 == 0).alias("is_consumption"),
        (F.col("id") % 20_000 % 50 / 50).alias("capacity_factor"))
    params = {"maxIter": 2, "maxDepth": 3}
    models = SideModels(["prediction_unit_id"], {"consumption": params, "production": params}).fit(df)
    assert models.encoded == ["prediction_unit_id"]
    new = df.filter("row_id < 200").withColumn("capacity_factor", F.lit(None).cast("double"))
    again = SideModels.load(models.save(os.path.join(tmp_out, "many")))
    a, b = ({r["row_id"]: r["_pred"] for r in m.transform(new).collect()} for m in (models, again))
    assert a == b and len(a) == 200 and not any(c.endswith("_mean") for c in models.transform(new).columns)
    truth = {i: i % 50 / 50 for i in range(200)}
    assert sum(abs(a[i] - truth[i]) for i in a) / 200 < 0.2  # 0.25 for a constant
