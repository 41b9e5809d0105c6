"""Spark ML stages and entry functions around the library (X2-X5).

``FeatureStage`` is a ``Transformer`` (merged frame -> feature frame) and
``SideModelsEstimator`` an ``Estimator`` whose model routes rows to one GBT per
side, so ``Pipeline([FeatureStage(), SideModelsEstimator()])`` is the whole
training path. ``run_*`` are the four stage entry points as plain functions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from ..operators.conform import conform_table
from ..operators.enrich import star_merge
from ..schemas import DEFAULT_CV_SPLITS, DEFAULT_LAGS, DEFAULT_TRIALS, SCHEMAS, check_mode
from .features import build_features
from .model import SideModels, random_search


class _FeatureStageWriter(MLWriter):
    """Parameters, and the history as a Parquet table of the stage, if it has one."""

    def __init__(self, instance: FeatureStage):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        history = self.instance.history
        if history is not None and not self.instance.getOrDefault(self.instance.historyPath):
            history.write.mode("overwrite").parquet(f"{path}/history")


class _FeatureStageReader(MLReader):
    def load(self, path: str) -> FeatureStage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = FeatureStage()._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        where = stage.getOrDefault(stage.historyPath)
        try:
            stage.history = self.sparkSession.read.parquet(where or f"{path}/history")
        except AnalysisException:  # saved without a history
            if where:
                raise
        return stage


class FeatureStage(Transformer, MLReadable, MLWritable):
    """Merged frame -> feature frame for one mode. ``history`` is the merged rows
    before the frame (modes ``retrain`` and ``test``): a DataFrame is saved with
    the stage as a table; ``history_path`` names a stored table, of which the
    stage saves the name only and reads what it holds when the stage is loaded."""

    mode = Param(Params._dummy(), "mode", "train, retrain or test", TypeConverters.toString)
    lags = Param(Params._dummy(), "lags", "lag periods in hours", TypeConverters.toListInt)
    historyPath = Param(Params._dummy(), "historyPath", "folder of a stored history", TypeConverters.toString)  # noqa: N815 - a Spark ML param

    def __init__(self, mode: str = "train", lags=None, history: DataFrame | None = None, history_path: str = ""):
        super().__init__()
        self._setDefault(mode="train", lags=list(DEFAULT_LAGS), historyPath="")
        self._set(mode=check_mode(mode), lags=list(lags or DEFAULT_LAGS), historyPath=history_path)
        if history is None and history_path:
            history = SparkSession.getActiveSession().read.parquet(history_path)
        self.history = history

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return build_features(dataset, self.getOrDefault(self.mode), history=self.history,
                              lags=self.getOrDefault(self.lags))

    def write(self) -> MLWriter:
        return _FeatureStageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FeatureStageReader()


class _SideModelsWriter(MLWriter):
    def __init__(self, instance: SideModelsModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.side_models.save(f"{path}/sides")


class _SideModelsReader(MLReader):
    def load(self, path: str) -> SideModelsModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return SideModelsModel(SideModels.load(f"{path}/sides"))._resetUid(metadata["uid"])


class SideModelsModel(Model, MLReadable, MLWritable):
    """Fitted models of both sides; saved and loaded as a pipeline stage."""

    def write(self) -> MLWriter:
        return _SideModelsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SideModelsReader()

    def __init__(self, models: SideModels | None = None):
        super().__init__()
        self.side_models = models

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.side_models.transform(dataset)


class SideModelsEstimator(Estimator):
    """Random search (optional) + one GBT per side."""

    trials = Param(Params._dummy(), "trials", "search trials per side (0: no search)", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "expanding-window folds", TypeConverters.toInt)

    def __init__(self, trials: int = 0, folds: int = DEFAULT_CV_SPLITS, params=None):
        super().__init__()
        self._setDefault(trials=0, folds=DEFAULT_CV_SPLITS)
        self._set(trials=trials, folds=folds)
        self.params_by_side = params or {}

    def _fit(self, dataset: DataFrame) -> SideModelsModel:
        params = self.params_by_side
        if self.getOrDefault(self.trials) > 0:
            params, _ = random_search(dataset, self.getOrDefault(self.trials), self.getOrDefault(self.folds))
        return SideModelsModel(SideModels(params=params).fit(dataset))


def run_preprocessing(raw: dict[str, DataFrame], mode: str = "train") -> dict[str, DataFrame]:
    check_mode(mode)
    return {name: conform_table(df, name, SCHEMAS[name]) for name, df in raw.items()}


def run_merging(tables: dict[str, DataFrame], mode: str = "train") -> DataFrame:
    check_mode(mode)
    return star_merge(tables)


def run_feature_engineering(merged: DataFrame, mode: str = "train", history: DataFrame | None = None,
                            lags=DEFAULT_LAGS) -> DataFrame:
    return build_features(merged, mode, history=history, lags=list(lags))


def run_modelling(features: DataFrame, n_trials: int = DEFAULT_TRIALS, n_splits: int = DEFAULT_CV_SPLITS,
                  **search) -> SideModels:
    best, _ = random_search(features, n_trials, n_splits, **search)
    return SideModels(params=best).fit(features)
