"""Expanding-window time-series cross-validation folds.

For ``n`` rows of a group in time order and ``k`` folds, the fold size is
``t = n // (k + 1)``; test block ``i`` covers positions
``[n - (k - i) * t, n - (k - i - 1) * t)`` and its training set is every
earlier position. Positions come from :func:`distributed_row_number`, so no
group is ever ranked inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import floor_div
from .series import distributed_row_number


def assign_folds(
    df: DataFrame,
    n_splits: int = 3,
    order: Sequence[str] = ("datetime", "row_id"),
    groups: Sequence[str] = ("is_consumption",),
) -> DataFrame:
    """Add ``pos``, ``n_rows``, ``test_fold`` (fold whose test block holds the
    row, or null) and ``train_from_fold`` (first fold that trains on the row,
    or null when none does). ``order`` must be a total order."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    groups = list(groups)
    # Positions and group sizes come from one distributed numbering: no join of
    # the rows with a per-group table (which would hash them on a few keys).
    out = distributed_row_number(df, list(order), groups, name="pos", count_col="n_rows")
    t = floor_div("n_rows", n_splits + 1)
    first = F.col("n_rows") - t * n_splits
    in_test = (t > 0) & (F.col("pos") >= first)
    test_fold = F.when(in_test, floor_div(F.col("pos") - first, t))
    train_from = F.when(t <= 0, F.lit(None).cast("long")).when(F.col("pos") < first, F.lit(0).cast("long")).otherwise(
        test_fold + 1
    )
    return out.withColumns(
        {"test_fold": test_fold, "train_from_fold": F.when(train_from < n_splits, train_from)}
    )


def fold_frames(folded: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of one fold from :func:`assign_folds` output."""
    train = folded.filter(F.col("train_from_fold").isNotNull() & (F.col("train_from_fold") <= fold))
    test = folded.filter(F.col("test_fold") == fold)
    return train, test
