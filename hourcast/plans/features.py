"""Feature frames for the three modes.

train    merged history -> calendar -> missing-value policy -> lags -> trim
retrain  new merged rows on top of the merged history (keep-last), same steps,
         trimmed to the new rows
test     rows to predict (no target) on top of the history; nothing dropped

The per-instant fills are written as small tables while the frame is built; the
rest is a lazy plan. The history keeps ``power`` (the label) so a
later retrain can recompute lags; it is dropped only from the model features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import add_calendar_features
from ..functions.scalar import safe_divide
from ..operators.conform import align_to
from ..operators.series import (
    add_positional_lags,
    drop_rows_with_null,
    exclude_range,
    forward_fill,
    forward_fill_by_slices,
    forward_fill_global,
    join_same,
    keep_last,
    positional_lags_by_join,
    since_min_of,
    upsert_unique_history,
)
from ..schemas import (
    DEFAULT_LAGS,
    EXCLUDED_RANGE,
    FW_OUTPUT,
    HW_OUTPUT,
    LAG_COLUMNS,
    SERIES_KEYS,
    TABLE_KEYS,
    check_mode,
    feature_columns,
    lag_name,
)

PRICE_COLUMNS = ["electricity_price", "gas_price"]
ROW_ORDER = ["datetime", "row_id"]  # rows of one hour keep one order in every run
SERIES_FILL_COLUMNS = ["installed_capacity", *FW_OUTPUT, *HW_OUTPUT]


def zero_power_at_dst(df: DataFrame) -> DataFrame:
    """The clock hour that does not exist (or repeats) has no reading: 0, not null."""
    dst = F.col("is_dst_spring_forward") | F.col("is_dst_fall_backward")
    return df.withColumn(
        "power", F.when(dst & F.col("power").isNull(), F.lit(0.0)).otherwise(F.col("power"))
    )


@dataclass
class Carry:
    """What earlier rows bring into a frame that starts later: the last filled
    rows of each series (``tail``, for the lags), the last known value of each
    filled column per series (``levels``) and of each price (``prices``)."""

    tail: DataFrame
    levels: DataFrame
    prices: Mapping[str, float | None]

    def fill(self, df: DataFrame) -> DataFrame:
        """What the frame's own rows leave null is filled from before them."""
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast("double")) for c, v in self.prices.items()})
        known = self.levels.withColumnsRenamed({c: f"_level_{c}" for c in SERIES_FILL_COLUMNS})
        out = join_same(df, known, SERIES_KEYS)
        return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_level_{c}")) for c in SERIES_FILL_COLUMNS}).select(*df.columns)


def missing_value_policy(
    df: DataFrame,
    mode: str = "train",
    excluded: tuple[str, str] | None = EXCLUDED_RANGE,
    long_series: bool = False,
    carry: Carry | None = None,
) -> DataFrame:
    check_mode(mode)
    if mode != "test":
        df = zero_power_at_dst(df)
    if mode == "train":
        df = df.filter(F.col("power").isNotNull())
        if excluded:
            df = exclude_range(df, *excluded)
    df = forward_fill_global(df, PRICE_COLUMNS)
    if long_series:
        df = forward_fill_by_slices(df, SERIES_FILL_COLUMNS, SERIES_KEYS, ROW_ORDER)
    else:
        df = forward_fill(df, SERIES_FILL_COLUMNS, order=ROW_ORDER)
    if carry is not None:
        df = carry.fill(df)
    if mode != "test":
        ratio = safe_divide("power", "installed_capacity")
        df = df.withColumn(
            "capacity_factor",
            F.when(F.col("capacity_factor").isNull() & (F.col("installed_capacity") > 0), ratio).otherwise(
                F.col("capacity_factor")
            ),
        )
    return df


def with_lags(
    df: DataFrame, mode: str, lags: Sequence[int], lag_cols: Sequence[str], lag_mode: str | None = None,
    long_series: bool = False, carry: Carry | None = None,
) -> DataFrame:
    """The lags of a filled frame, over the carried rows before it if there are any."""
    if carry is not None:
        old = carry.tail.withColumn("_old", F.lit(True))
        df = df.withColumn("_old", F.lit(False)).unionByName(old, allowMissingColumns=True)
    mode_of_lags = lag_mode or ("lag" if mode == "train" else "fill")
    if long_series and mode_of_lags in ("lag", "fill") and not any(
        lag_name(c, n) in df.columns for c in lag_cols for n in lags
    ):
        df = positional_lags_by_join(df, list(lag_cols), lags, SERIES_KEYS, ROW_ORDER)
    else:
        df = add_positional_lags(df, lag_cols, lags, SERIES_KEYS, ROW_ORDER, mode_of_lags)
    return df.filter(~F.col("_old")).drop("_old") if carry is not None else df


def finish(df: DataFrame, mode: str, lags: Sequence[int], keep_power: bool = False) -> DataFrame:
    """Rows without a null (but for rows to predict), columns in feature order."""
    if mode != "test":
        df = drop_rows_with_null(df)
    ordered = feature_columns(list(lags))
    extra = [c for c in df.columns if c not in ordered and c != "power"]
    return df.select(*ordered, *extra, *(["power"] if keep_power else []))


def merge_history(
    history: DataFrame,
    new: DataFrame,
    seq: str = "row_id",
    history_unique: bool = False,
) -> DataFrame:
    """[history, new] with the newest version of each fact key.

    ``history_unique=True`` (the history is an earlier upsert's output, one
    row per key) replaces the keep-last shuffle over the whole history with
    an anti-join against the new batch's keys (:func:`upsert_unique_history`).
    """
    if history_unique:
        return upsert_unique_history(history, new, TABLE_KEYS["power"], [seq])
    h = history.withColumn("_src", F.lit(0))
    n = align_to(new, history.schema).withColumn("_src", F.lit(1))
    return keep_last(h.unionByName(n), TABLE_KEYS["power"], ["_src", seq]).drop("_src")


def build_features(
    merged: DataFrame,
    mode: str = "train",
    history: DataFrame | None = None,
    lags: Sequence[int] = DEFAULT_LAGS,
    lag_cols: Sequence[str] = LAG_COLUMNS,
    lag_mode: str | None = None,
    excluded: tuple[str, str] | None = EXCLUDED_RANGE,
    years: tuple[int, int] | None = None,
    keep_power: bool = False,
    long_series: bool = False,
    history_unique: bool = False,
) -> DataFrame:
    """The feature frame: merged columns (+ flags, cyclic parts, lags).

    ``lag_mode`` defaults to plain lags in ``train`` and to ``fill`` (keep an
    existing lag, compute the rest) otherwise; ``current_or_lag`` reproduces
    the alternative reading where a present value is its own lag.

    ``long_series=True`` swaps the per-series windows for their sliced forms
    (:func:`forward_fill_by_slices`, :func:`positional_lags_by_join`), which
    split a series over many tasks; same result, more shuffles. Use it when a
    single series may not fit one task. It supports the ``lag`` mode.
    """
    check_mode(mode)
    df = merged
    if mode != "train" and history is not None:
        df = merge_history(history, merged, history_unique=history_unique)
    df = add_calendar_features(df, "datetime", years)
    df = missing_value_policy(df, mode, excluded, long_series)
    df = with_lags(df, mode, lags, lag_cols, lag_mode, long_series)
    if mode != "train":
        df = since_min_of(df, merged)
    return finish(df, mode, lags, keep_power)


def labels(features_with_power: DataFrame) -> DataFrame:
    """(row_id, power): the label file kept beside the features."""
    return features_with_power.select("row_id", "power")
