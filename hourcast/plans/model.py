"""Two gradient-boosted regressors (consumption / production) on Spark ML,
time-series cross-validated random search, save / load.

The learner is MLlib's ``GBTRegressor`` with absolute loss. Categorical
columns of up to ``max_categories`` values are indexed (``StringIndexer``, unseen
values kept) so the trees split on categories; those of more values become
time-ordered target means (:mod:`hourcast.operators.encode`), so that the number
of bins is bounded whatever the data. Every other feature is numeric. Missing
feature values (only possible in test mode) are filled with a sentinel before
assembly, identically in fit and transform.

A side without training rows has no trees: its predictions are null, which a
submission writes as 0. ``fit(..., strict=True)`` raises instead.
"""

from __future__ import annotations

import json
import math
import os
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..operators.encode import apply_target_means, category_sums, encoded_name, ordered_target_means
from ..operators.split import assign_folds, fold_frames
from ..schemas import CATEGORICAL_FEATURES, DEFAULT_CV_SPLITS, DEFAULT_TRIALS, NON_FEATURES, RANDOM_SEED
from ..session import materialize

SIDES = {"consumption": True, "production": False}
SIDE_COL = "is_consumption"
LABEL = "capacity_factor"
PREDICTION = "_pred"
FILL_VALUE = -999.0
INSTANT = "datetime"
MAX_CATEGORIES = 1000

# Search space: (low, high, scale); integers where both bounds are ints.
DEFAULT_SPACE: dict[str, tuple] = {
    "maxIter": (100, 1000, "int"),
    "maxDepth": (4, 12, "int"),
    "stepSize": (0.01, 0.3, "log"),
    "subsamplingRate": (0.5, 1.0, "linear"),
    "minInstancesPerNode": (1, 20, "int"),
}


def feature_list(df: DataFrame, exclude: Sequence[str] = NON_FEATURES, extra_exclude: Sequence[str] = ("power",)) -> list[str]:
    """Every column except time, label and id, sorted by name."""
    drop = set(exclude) | set(extra_exclude)
    return sorted(c for c in df.columns if c not in drop)


def draw_params(rng: random.Random, space: Mapping[str, tuple]) -> dict:
    out = {}
    for name, (lo, hi, scale) in space.items():
        if scale == "int":
            out[name] = rng.randint(int(lo), int(hi))
        elif scale == "log":
            out[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        else:
            out[name] = rng.uniform(lo, hi)
    return out


def _fcol(name: str) -> str:
    return f"_f_{name}"


def prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model copies ``_f_<name>`` of the features: booleans -> 0/1, numbers ->
    double, nulls -> sentinel. The original columns stay untouched."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    for name in features:
        c = F.col(f"`{name}`")
        c = F.when(c, 1.0).when(~c, 0.0) if isinstance(types[name], BooleanType) else c.cast("double")
        cols[_fcol(name)] = F.coalesce(c, F.lit(FILL_VALUE))
    return df.withColumns(cols)


def _drop_model_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_f_", "_ix_")) or c == "_features"])


def category_counts(df: DataFrame, features: Sequence[str]) -> dict[str, int]:
    """Distinct values of each categorical feature, a null counting as one."""
    cats = [c for c in features if c in CATEGORICAL_FEATURES]
    if not cats:
        return {}
    counts = df.agg(*[F.count_distinct(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))) for c in cats]).first()
    return dict(zip(cats, counts))


def bins_for(counts: Mapping[str, int], least: int) -> int:
    """Bins a tree needs: one for each indexed category and one for unseen ones."""
    return max([least, *(n + 2 for n in counts.values())])


def build_pipeline(
    features: Sequence[str], params: Mapping[str, object], seed: int = RANDOM_SEED, max_bins: int = 32,
    label: str = LABEL, validation: str | None = None,
) -> Pipeline:
    """Indexing, assembly and boosting. Rows whose ``validation`` column is true
    are the evaluation set: boosting stops when their error no longer falls
    (``validationTol``) and the best number of trees stays."""
    cats = [_fcol(c) for c in features if c in CATEGORICAL_FEATURES]
    nums = [_fcol(c) for c in features if c not in CATEGORICAL_FEATURES]
    stages = []
    cat_out = [f"_ix_{c}" for c in cats]
    if cats:
        stages.append(StringIndexer(inputCols=cats, outputCols=cat_out, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
    stages.append(VectorAssembler(inputCols=cat_out + nums, outputCol="_features", handleInvalid="keep"))
    gbt = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol=PREDICTION, lossType="absolute",
                       seed=seed, maxBins=max_bins)
    gbt = gbt.setParams(**{k: v for k, v in params.items() if gbt.hasParam(k)})
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    stages.append(gbt)
    return Pipeline(stages=stages)


class SideModels:
    """One fitted pipeline per side, routed by ``is_consumption``."""

    def __init__(
        self,
        features: Sequence[str] | None = None,
        params: Mapping[str, Mapping[str, object]] | None = None,
        seed: int = RANDOM_SEED,
        max_bins: int = 32,
        max_categories: int = MAX_CATEGORIES,
    ):
        self.features = list(features) if features else None
        self.params = {s: dict((params or {}).get(s, {})) for s in SIDES}
        self.seed = seed
        self.max_bins = max_bins
        self.max_categories = max_categories
        self.models: dict[str, PipelineModel | None] = {}  # None: a side without rows
        self.encoded: list[str] = []  # categorical features that are target means
        self.sums: DataFrame | None = None  # their label sums

    def set_features(self, features: Sequence[str]) -> SideModels:
        self.features = list(features)
        return self

    def _inputs(self) -> list[str]:
        return [encoded_name(c) if c in self.encoded else c for c in self.features]

    def fit(self, df: DataFrame, strict: bool = False, validation: str | None = None) -> SideModels:
        """Fit both sides as concurrent jobs. ``validation`` names a boolean
        column: its true rows choose the number of trees and are not trained on."""
        self.features = self.features or feature_list(df, extra_exclude=("power", *([validation] if validation else [])))
        if not self.features:
            raise RuntimeError("no feature columns")
        counts = category_counts(df, self.features)
        self.encoded = sorted(c for c, n in counts.items() if n > self.max_categories)
        bins = bins_for({c: n for c, n in counts.items() if c not in self.encoded}, self.max_bins)
        if self.encoded:
            train_rows = df.filter(~F.col(validation)) if validation else df
            self.sums = materialize(category_sums(train_rows, self.encoded, LABEL, [SIDE_COL]))
            label = F.when(~F.col(validation), F.col(LABEL)) if validation else F.col(LABEL)
            df = ordered_target_means(df.withColumn("_known", label), self.encoded, "_known", INSTANT, [SIDE_COL])
        inputs = self._inputs()
        # Fitting reads its input several times (indexers, every boosting
        # round): only the model columns, written once.
        cols = [SIDE_COL, LABEL, *([validation] if validation else []), *[_fcol(c) for c in inputs]]
        prepared = materialize(prepare(df, inputs).select(*cols))
        trains = F.count_if(~F.col(validation)) if validation else F.count(F.lit(1))
        rows = {r[0]: r[1] for r in prepared.groupBy(SIDE_COL).agg(trains).collect()}
        without = [s for s, flag in SIDES.items() if not rows.get(flag)]
        if strict and without:
            raise ValueError(f"No training rows: {', '.join(without)}")

        def fit_side(side: str) -> PipelineModel | None:
            if side in without:
                return None
            part = prepared.filter(F.col(SIDE_COL) == F.lit(SIDES[side]))
            return build_pipeline(inputs, self.params[side], self.seed, bins, validation=validation).fit(part)

        with ThreadPoolExecutor(max_workers=len(SIDES)) as pool:
            self.models = dict(zip(SIDES, pool.map(fit_side, SIDES)))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Input rows with a ``_pred`` column (capacity factor), null for a row
        without a side."""
        if set(self.models) != set(SIDES):
            raise RuntimeError("fit() or load() the models first")
        if not self.features:
            raise RuntimeError("the models have no feature list")
        present = set(df.columns)
        missing = [c for c in self.features if c not in present]
        if missing:
            raise ValueError(f"Missing feature columns: {', '.join(missing)}")
        if self.encoded:
            df = apply_target_means(df, self.sums, self.encoded, [SIDE_COL])
        out = prepare(df, self._inputs()).drop(*[encoded_name(c) for c in self.encoded])
        # Both sides' trees over one plan: the rows are read once and stay in
        # their partitions, which a union of two filtered plans wouldn't allow.
        names = {side: f"_pred_{side}" for side in SIDES}
        for side, model in self.models.items():
            if model is None:
                out = out.withColumn(names[side], F.lit(None).cast("double"))
            else:
                scored = model.transform(out).withColumnRenamed(PREDICTION, names[side])
                out = scored.drop(*[c for c in scored.columns if c.startswith("_ix_") or c == "_features"])
        chosen = F.lit(None).cast("double")
        for side, flag in SIDES.items():
            chosen = F.when(F.col(SIDE_COL) == F.lit(flag), F.col(names[side])).otherwise(chosen)
        return _drop_model_columns(out.withColumn(PREDICTION, chosen).drop(*names.values()))

    def save(self, path: str) -> str:
        if set(self.models) != set(SIDES):
            raise RuntimeError("fit() the models before saving them")
        for side, model in self.models.items():
            if model is not None:
                model.write().overwrite().save(os.path.join(path, side))
        spark = SparkSession.getActiveSession()
        if self.encoded:
            self.sums.write.mode("overwrite").parquet(os.path.join(path, "category_sums"))
        meta = {"features": self.features, "params": self.params, "seed": self.seed, "max_bins": self.max_bins,
                "max_categories": self.max_categories, "encoded": self.encoded,
                "fitted": [s for s, m in self.models.items() if m is not None]}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
            os.path.join(path, "metadata"))
        return path

    @classmethod
    def load(cls, path: str) -> SideModels:
        spark = SparkSession.getActiveSession()
        meta_path = os.path.join(path, "metadata")
        try:
            meta = json.loads(spark.read.json(meta_path).first()["meta"])
        except AnalysisException as e:  # no such folder
            raise FileNotFoundError(f"no model metadata at {meta_path}") from e
        obj = cls(meta["features"], meta["params"], meta["seed"], meta["max_bins"], meta.get("max_categories", MAX_CATEGORIES))
        fitted = meta.get("fitted", list(SIDES))
        obj.models = {side: PipelineModel.load(os.path.join(path, side)) if side in fitted else None for side in SIDES}
        obj.encoded = meta.get("encoded", [])
        if obj.encoded:
            obj.sums = spark.read.parquet(os.path.join(path, "category_sums"))
        return obj


def error_curve(
    train: DataFrame, test: DataFrame, features: Sequence[str], params: Mapping[str, object],
    seed: int = RANDOM_SEED, max_bins: int = 32,
) -> list[float]:
    """Mean absolute error on ``test`` of the first 1, 2, ... trees of one fit.

    Boosting adds trees one after another, so the first k trees of a long fit
    are the fit of k trees: one fit and one pass over ``test`` score every
    number of trees up to ``maxIter``."""
    *prepare, trees = build_pipeline(features, params, seed, max_bins).fit(train).stages
    for stage in prepare:
        test = stage.transform(test)
    return list(trees.evaluateEachIteration(test, "absolute"))


def best_count(curves: Sequence[Sequence[float]], least: int) -> tuple[int, float, list[float]]:
    """(number of trees, mean error, error of each fold) where the mean over the
    folds is least; the smaller number among equals. No folds: (least, nan, [])."""
    if not curves:
        return least, float("nan"), []
    means = {k: sum(c[k - 1] for c in curves) / len(curves) for k in range(least, min(map(len, curves)) + 1)}
    k = min(means, key=lambda k: (math.isnan(means[k]), means[k], k))
    return k, means[k], [c[k - 1] for c in curves]


def random_search(
    df: DataFrame,
    n_trials: int = DEFAULT_TRIALS,
    n_splits: int = DEFAULT_CV_SPLITS,
    space: Mapping[str, tuple] = DEFAULT_SPACE,
    seed: int = RANDOM_SEED,
    max_bins: int = 32,
    parallelism: int = 2,
    features: Sequence[str] | None = None,
    max_categories: int = MAX_CATEGORIES,
) -> tuple[dict[str, dict], DataFrame]:
    """Seeded random search per side, scored by mean MAE over expanding-window
    folds. The fold's test block is the evaluation set: one fit of the most trees
    in ``space["maxIter"]`` gives the error of every number of trees in that range
    (:func:`error_curve`), so the number of trees is chosen exactly and isn't
    drawn. Folded rows are written once per side and read by every trial; the two
    sides, and ``parallelism`` trials within a side, run as concurrent Spark jobs.

    A fold without training or test rows is left out; a side with no fold left
    scores NaN and keeps its first draw. Returns (best params per side, one row
    per side and trial).
    """
    spark = df.sparkSession
    features = list(features) if features else feature_list(df)
    counts = category_counts(df, features)
    encoded = sorted(c for c, n in counts.items() if n > max_categories)
    bins = bins_for({c: n for c, n in counts.items() if c not in encoded}, max_bins)
    # Earlier rows only, so a fold's test rows never reach its training rows.
    df = ordered_target_means(df, encoded, LABEL, INSTANT, [SIDE_COL])
    features = [encoded_name(c) if c in encoded else c for c in features]
    # Written once: both sides' folds sample and read the features, not their plan.
    prepared = materialize(prepare(df, features).select(INSTANT, "row_id", SIDE_COL, LABEL, *[_fcol(c) for c in features]))
    rng = random.Random(seed)
    least, most, _ = space.get("maxIter", (20, 20, "int"))
    trials = [draw_params(rng, {k: v for k, v in space.items() if k != "maxIter"}) for _ in range(n_trials)]

    def search_side(side: str) -> list[tuple[int, float, list[float]]]:
        side_rows = prepared.filter(F.col(SIDE_COL) == F.lit(SIDES[side])).select(
            INSTANT, "row_id", LABEL, *[_fcol(c) for c in features])
        folded = materialize(assign_folds(side_rows, n_splits, groups=[]))
        frames = [fold_frames(folded, k) for k in range(n_splits)]
        sizes = folded.agg(*[F.count_if(c) for k in range(n_splits) for c in (
            F.col("train_from_fold") <= k, F.col("test_fold") == k)]).first()
        usable = [f for k, f in enumerate(frames) if sizes[2 * k] and sizes[2 * k + 1]]

        def score(params):
            longest = {**params, "maxIter": int(most)}
            return best_count([error_curve(tr, te, features, longest, seed, bins) for tr, te in usable], int(least))

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            return list(pool.map(score, trials))

    # Sides are independent searches: run them concurrently too.
    with ThreadPoolExecutor(max_workers=len(SIDES)) as sides_pool:
        by_side = dict(zip(SIDES, sides_pool.map(search_side, SIDES)))
    rows, best = [], {}
    for side, results in by_side.items():
        chosen = [{**params, "maxIter": count} for params, (count, _, _) in zip(trials, results)]
        for i, (params, (_, mean_mae, maes)) in enumerate(zip(chosen, results)):
            rows.append((side, i, json.dumps(params, sort_keys=True), float(mean_mae), [float(m) for m in maes]))
        j = min(range(len(trials)), key=lambda i: (math.isnan(results[i][1]), results[i][1]))
        best[side] = chosen[j]
    table = spark.createDataFrame(rows, "side string, trial int, params string, mean_mae double, fold_mae array<double>")
    return best, table
