"""Forecasts: seasonal-naive baseline, back-transform, and block recursion.

Block recursion. A forecast for step ``s`` of a series may read lag features
that point at earlier *forecast* steps. With ``b`` = the smallest lag, steps
``[r*b, (r+1)*b)`` only read steps before ``r*b``, so a whole block of every
series is predicted at once: ``ceil(H / b)`` rounds for a horizon ``H`` (4 for
48 hours with lag 12), independent of the number of series.

The state is one row per series: the array of its rows, from ``max lag`` before
the horizon to its end, and the array of their values. A lag is an element of the
array, so a round unfolds a block of the rows, predicts them and folds the
predictions back by series, all inside the partition that the series lies in:
after one shuffle by series no round has an exchange or a window. Every
``ROUNDS_A_TABLE`` rounds the state is written to the session's shared folder,
which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import null_to_zero, positive_part
from ..operators.series import distributed_row_number, join_same, row_index
from ..schemas import SERIES_KEYS, lag_name
from ..session import materialize


ROUNDS_A_TABLE = 8


def seasonal_naive(col: str = "capacity_factor", lags: Sequence[int] = (168, 24, 12)) -> Column:
    """First available lag in preference order: the baseline the lag features encode."""
    return F.coalesce(*[F.col(lag_name(col, n)) for n in lags])


def to_power(prediction: Column, capacity: str = "installed_capacity") -> Column:
    """Capacity factor back to power, floored at 0 (null stays null)."""
    return positive_part(prediction * F.col(capacity))


def submission(df: DataFrame, target: Column, key: str = "row_id") -> DataFrame:
    """(row_id, target) with a missing forecast written as 0."""
    return df.select(key, null_to_zero(target).alias("target"))


def column_model(expr: Callable[[], Column], out: str = "_pred") -> Callable[[DataFrame], DataFrame]:
    """Wrap a column expression (e.g. :func:`seasonal_naive`) as a model."""
    return lambda df: df.withColumn(out, expr())


def block_recursive_forecast(
    history: DataFrame,
    horizon: DataFrame,
    value_col: str,
    predict: Callable[[DataFrame], DataFrame],
    lags: Sequence[int],
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "datetime",
    out_col: str = "prediction",
    pred_col: str = "_pred",
    long_series: bool = False,
) -> DataFrame:
    """Forecast ``value_col`` for the ``horizon`` rows, feeding predictions back
    into the value's positional lags.

    ``predict`` receives the rows of one block with ``{value_col}_lag_{n}``
    columns (plus every other column of the rows) and returns them with a
    ``pred_col`` column: a fitted Spark ML model's ``transform`` or
    :func:`column_model`. Returns the horizon rows with ``out_col``.

    ``long_series=True`` numbers the rows with a distributed row number (a
    long series is split over many tasks) instead of a per-series window;
    the rounds then work on the bounded state only. A null key is a series.
    """
    keys = list(keys)
    lags = sorted(set(lags))
    block = lags[0]
    max_lag = lags[-1]
    lag_cols = [lag_name(value_col, n) for n in lags]
    h = history.withColumn("_is_h", F.lit(False))
    z = horizon.withColumn(value_col, F.lit(None).cast("double")).withColumn("_is_h", F.lit(True))
    union = h.unionByName(z, allowMissingColumns=True)
    if long_series:
        tiebreak = ["row_id"] if "row_id" in union.columns else []
        both = distributed_row_number(union, [order, *tiebreak], keys, "_idx")
    else:
        both = row_index(union, keys, order, "_idx")
    first = both.filter("_is_h").groupBy(*keys).agg(F.min("_idx").alias("_i0"))
    # Bounded state: the last max_lag history rows of each series plus its horizon.
    state = join_same(both, first, keys, "inner").withColumn("_step", F.col("_idx") - F.col("_i0"))
    state = state.filter(F.col("_step") >= -max_lag)
    rest = [c for c in state.columns if c not in (*keys, *lag_cols, "_idx", "_i0", "_step", "_is_h", value_col)]
    # History rows bring their value only; steps are distinct in a series.
    row = F.struct("_step", "_is_h", F.col(value_col).cast("double").alias("_value"),
                   F.when(F.col("_is_h"), F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_rest"))
    series = state.groupBy(*keys).agg(F.array_sort(F.collect_list(row), lambda x, y: (x["_step"] - y["_step"]).cast("int")).alias("_rows"))
    series = materialize(series.select(*keys, "_rows", F.transform("_rows", lambda x: x["_value"]).alias("_values"),
                                       F.size(F.filter("_rows", lambda x: x["_step"] < 0)).alias("_p0")))
    steps = series.agg(F.max(F.size("_rows") - F.col("_p0"))).first()[0]
    rounds = 0 if steps is None else -(-steps // block)
    for r in range(rounds):
        if r % ROUNDS_A_TABLE == 0:
            # From here on every round stays where its series is.
            series = (materialize(series) if r else series).repartition(*keys)
        series = _round(series, r * block, block, predict, keys, value_col, lags, rest, pred_col)
    rows = series.select(*keys, F.posexplode("_rows").alias("_at", "_row"), "_values")
    done = F.get(F.col("_values"), F.col("_at"))
    return rows.filter(F.col("_row._is_h")).select(*keys, "_row._rest.*", done.alias(value_col), done.alias(out_col))


def _round(
    series: DataFrame, start: int, block: int, predict: Callable[[DataFrame], DataFrame], keys: Sequence[str],
    value_col: str, lags: Sequence[int], rest: Sequence[str], pred_col: str,
) -> DataFrame:
    """One block of every series: unfold its rows, predict, fold back. Known rows
    between the horizon's keep their values. A series that ends before the block
    has one empty row, so that it stays."""
    first = F.col("_p0") + start
    part = series.select("*", F.posexplode_outer(F.slice("_rows", first + 1, F.lit(block))).alias("_at", "_row"))
    at = first + F.col("_at")
    once = F.coalesce(F.col("_at"), F.lit(0)) == 0  # the arrays travel with one row of the block
    feats = part.select(
        *keys, F.col("_row._rest.*"), F.col("_row._is_h").alias("_is_h"), F.lit(None).cast("double").alias(value_col),
        *[F.get(F.col("_values"), at - n).alias(lag_name(value_col, n)) for n in lags],
        F.col("_at"), *[F.when(once, F.col(c)).alias(c) for c in ("_rows", "_values", "_p0")],
    )
    predicted = predict(feats)
    told = F.when(F.col("_at").isNotNull(), F.struct("_at", F.col(pred_col).cast("double").alias("_p")))
    folded = predicted.groupBy(*keys).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("_rows", "_values", "_p0")],
        F.transform(F.array_sort(F.collect_list(told)), lambda x: x["_p"]).alias("_block"))
    place = lambda i: i - F.col("_p0") - start
    inside = lambda i: (place(i) >= 0) & (place(i) < F.size("_block")) & F.get(F.col("_rows"), i)["_is_h"]
    values = F.transform("_values", lambda v, i: F.when(inside(i), F.get(F.col("_block"), place(i))).otherwise(v))
    return folded.select(*keys, "_rows", values.alias("_values"), "_p0")
