"""Evaluation: MAE, per-fold scores, CV summaries and run records."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clean_name, numeric_or_null


def mae(
    actual: DataFrame,
    predicted: DataFrame,
    key: str = "row_id",
    actual_col: str = "power",
    predicted_col: str = "target",
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean absolute error of ``predicted`` against ``actual`` joined on ``key``
    (left join from the actuals; rows missing either value are skipped)."""
    joined = actual.select(key, actual_col, *by).join(predicted.select(key, predicted_col), key, "left")
    valid = joined.filter(F.col(actual_col).isNotNull() & F.col(predicted_col).isNotNull())
    return valid.groupBy(*by).agg(
        F.avg(F.abs(F.col(predicted_col) - F.col(actual_col))).alias("mae"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def fold_scores(
    scored: DataFrame, fold_col: str = "test_fold", by: Sequence[str] = (), actual: str = "power",
    predicted: str = "target",
) -> DataFrame:
    """MAE per fold (and group) over rows that carry a test fold."""
    valid = scored.filter(
        F.col(fold_col).isNotNull() & F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    )
    return valid.groupBy(*by, fold_col).agg(F.avg(F.abs(F.col(predicted) - F.col(actual))).alias("mae"))


def cv_summary(scores: DataFrame, group: str, labels: Mapping[object, str], overall: str = "all") -> DataFrame:
    """Mean and population standard deviation of fold scores per group, plus an
    overall line, in one pass (rollup; ``grouping()`` tells the overall row
    from a null group)."""
    agg = scores.rollup(group).agg(
        F.avg("mae").alias("mean_mae"),
        F.stddev_pop("mae").alias("std_mae"),
        F.count(F.lit(1)).alias("n_folds"),
        F.grouping(group).alias("_g"),
    )
    name = F.lit(overall)
    for value, label in labels.items():
        name = F.when(F.col(group) == F.lit(value), F.lit(label)).otherwise(name)
    return agg.select(
        F.when(F.col("_g") == 1, F.lit(overall)).otherwise(name).alias("group_name"),
        "mean_mae",
        "std_mae",
        "n_folds",
    )


def numeric_params(params: DataFrame, key: str = "param", value: str = "value_text") -> DataFrame:
    """(key, text) rows -> (metric, value) for values that parse as numbers;
    names cleaned to ``[0-9A-Za-z_.]``."""
    out = params.select(
        "*", clean_name(F.col(key)).alias("metric"), numeric_or_null(F.col(value)).alias("value")
    )
    return out.filter(F.col("value").isNotNull())


def run_record(
    spark: SparkSession,
    run_id: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    fold_metrics: Sequence[Mapping[str, object]] = (),
) -> DataFrame:
    """One run as rows: params as JSON text, numeric metrics, fold scores.
    Append it to a ``runs`` table instead of a tracking server."""
    clean = {k: v for k, v in params.items() if v is not None}
    rows = [(run_id, "params", json.dumps(clean, default=str, sort_keys=True), None, None)]
    rows += [(run_id, "metric", k, float(v), None) for k, v in metrics.items() if isinstance(v, (int, float))]
    rows += [(run_id, "fold", json.dumps(dict(f), default=str, sort_keys=True), float(f.get("mae", "nan")),
              int(f["fold"]) if "fold" in f else None) for f in fold_metrics]
    df = spark.createDataFrame(rows, "run_id string, kind string, name string, value double, fold int")
    return df.withColumn("recorded_at", F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast(
        "timestamp_ntz"))


def append_run(record: DataFrame, path: str) -> None:
    """Append a run's rows to the runs table at ``path``, a partition per run;
    appending the same run again replaces it."""
    (record.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))


def observe_rows(df: DataFrame, name: str, *extra):
    """Row count (and extra aggregate columns) collected as a side metric of the
    next action on ``df``: no extra job. Returns (df, observation); read
    ``observation.get`` after the action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs
