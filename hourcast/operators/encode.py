"""Categories of any number as numbers: time-ordered target means.

A row's value is the mean label of the *earlier* rows of its category, so that
no row sees its own label or one of the same instant. The label sums per
(category, instant) are reduced first, map-side; their running sums are a
segmented scan over range slices (:func:`running_before`), so a category with a
third of all rows is split over many tasks. Rows to predict get the mean of all
training rows of their category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .series import join_same, numbered_slices

PRIOR = 0.5  # the value of a category that nothing is known of
PRIOR_WEIGHT = 1.0  # rows that the prior counts for


def smoothed_mean(total: Column, n: Column, prior: float = PRIOR, weight: float = PRIOR_WEIGHT) -> Column:
    """Mean of ``n`` labels and of the prior, which counts for ``weight`` rows;
    unknown sums are those of no rows."""
    return (F.coalesce(total, F.lit(0.0)) + prior * weight) / (F.coalesce(n, F.lit(0)) + weight)


def running_before(
    df: DataFrame, sums: Sequence[str], groups: Sequence[str], order: Sequence[str], num_partitions: int | None = None
) -> DataFrame:
    """``df`` with ``_before_<c>``: the sum of ``c`` over the earlier rows of the
    group (null for the first one). ``order`` must be a total order in a group;
    null group keys are one group.

    Rows are cut into range slices of (group, order) and written; sums run inside
    each slice; what earlier slices of the group hold in all is added from a
    table with one row per (slice, group).
    """
    groups, sums = list(groups), list(sums)
    rows = numbered_slices(df, groups, list(order), num_partitions)
    inside = Window.partitionBy("_part", *groups).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    rows_before = rows.withColumns({f"_in_{c}": F.sum(c).over(inside) for c in sums})
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy("_part", *groups).agg(*[F.sum(c).alias(f"_all_{c}") for c in sums])
    carry = whole.select("_part", *groups, *[F.sum(f"_all_{c}").over(earlier).alias(f"_carry_{c}") for c in sums])
    # One row per (slice, group), written once: Spark sees its size.
    out = join_same(rows_before, materialize(carry), ["_part", *groups])
    both = {f"_before_{c}": F.when(F.coalesce(f"_in_{c}", f"_carry_{c}").isNotNull(),
                                   F.coalesce(F.col(f"_in_{c}"), F.lit(0)) + F.coalesce(F.col(f"_carry_{c}"), F.lit(0))) for c in sums}
    return out.withColumns(both).drop("_part", "_mid", *[f"_{k}_{c}" for k in ("in", "carry") for c in sums])


def encoded_name(col: str) -> str:
    return f"{col}_mean"


def _categories(cats: Sequence[str]) -> Column:
    """One row per categorical column: (column, category as text)."""
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("category")) for c in cats]))


def category_sums(df: DataFrame, cats: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """(*by, column, category, total, n) of the known labels: one pass for all
    columns. Null and NaN labels count for nothing."""
    known = F.when(~F.isnan(F.col(label).cast("double")), F.col(label).cast("double"))
    long = df.select(*by, known.alias("_label"), _categories(cats).alias("_of"))
    return long.groupBy(*by, "_of.column", "_of.category").agg(F.sum("_label").alias("total"), F.count("_label").alias("n"))


def _with_means(df: DataFrame, sums: DataFrame, cats: Sequence[str], keys: Sequence[str], prior: float, weight: float) -> DataFrame:
    for c in cats:
        mine = sums.filter(F.col("column") == c).select(*keys, F.col("category").alias("_category"), F.col("total").alias("_total"), F.col("n").alias("_n"))
        joined = join_same(df.withColumn("_category", F.col(f"`{c}`").cast("string")), mine, ["_category", *keys])
        df = joined.withColumn(encoded_name(c), smoothed_mean(F.col("_total"), F.col("_n"), prior, weight)).drop("_category", "_total", "_n")
    return df


def ordered_target_means(
    df: DataFrame, cats: Sequence[str], label: str, instant: str = "datetime", by: Sequence[str] = (),
    prior: float = PRIOR, weight: float = PRIOR_WEIGHT, num_partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``<c>_mean`` for each of ``cats``: the smoothed mean label of
    the rows of the same category (and the same ``by`` columns) at earlier
    instants.

    A null category is one like any other; a null or NaN label counts for
    nothing; a row without an instant sees nothing and is seen by none.
    """
    cats, by = list(cats), list(by)
    if not cats:
        return df
    sums = category_sums(df.filter(F.col(instant).isNotNull()), cats, label, [*by, instant])
    before = running_before(sums, ["total", "n"], [*by, "column", "category"], [instant], num_partitions)
    before = materialize(before.select(*by, "column", "category", instant, F.col("_before_total").alias("total"), F.col("_before_n").alias("n")))
    return _with_means(df, before, cats, [*by, instant], prior, weight)


def apply_target_means(
    df: DataFrame, state: DataFrame, cats: Sequence[str], by: Sequence[str] = (), prior: float = PRIOR, weight: float = PRIOR_WEIGHT
) -> DataFrame:
    """``df`` with ``<c>_mean`` from the sums of all training rows (the output of
    :func:`category_sums`); an unknown category has the prior."""
    return _with_means(df, state, cats, list(by), prior, weight)
