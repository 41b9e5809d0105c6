"""Per-series time operators: lags, forward fills, keep-last upsert, row index,
row trimming.

Row order. Spark has no row order, so every operator names its ordering key.
A series is (``prediction_unit_id``, ``is_consumption``) ordered by
``datetime``; keep-last upserts order versions by an explicit source rank and a
sequence column.

Partitioning. Per-series windows shuffle once by the series key and sort by
time; all lags and fills of one spec go into one projection, which plans to a
single Window / Exchange / Sort. After keep-last a series holds at most one row
per hour, so a series' partition is bounded by the length of its time span,
not by data volume. For inputs that break that bound (one enormous series),
:func:`positional_lags_by_join` computes the same lags from a distributed row
number and an equi-join, which splits a series over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import HOUR_US, timestamp_to_epoch
from ..schemas import SERIES_KEYS, lag_name
from ..session import materialize


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which a null key equals a null key, as it does in
    ``groupBy`` and in window partitions. The right side's keys are dropped."""
    mine = {k: f"_same_{k}" for k in keys}
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`{r}`")) for k, r in mine.items()])
    return left.join(right.withColumnsRenamed(mine), same, how).drop(*mine.values())


def series_window(keys: Sequence[str] = SERIES_KEYS, order: Sequence[str] | str = "datetime") -> Window:
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def lag_columns(
    cols: Iterable[str],
    lags: Iterable[int],
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] | str = "datetime",
    mode: str = "lag",
    existing: Sequence[str] = (),
) -> dict[str, Column]:
    """Positional lag expressions ``{col}_lag_{n}``.

    mode ``lag``            plain ``lag(col, n)``;
    mode ``fill``           keep an existing lag value, compute only where it is null;
    mode ``current_or_lag`` ``coalesce(col, lag(col, n))`` (value itself when present).
    """
    w = series_window(keys, order)
    out = {}
    for c in cols:
        for n in lags:
            name = lag_name(c, n)
            lagged = F.lag(F.col(c), n).over(w)
            if mode == "lag":
                out[name] = lagged
            elif mode == "fill":
                out[name] = F.coalesce(F.col(name), lagged) if name in existing else lagged
            elif mode == "current_or_lag":
                out[name] = F.coalesce(F.col(c), lagged)
            else:
                raise ValueError(f"unknown lag mode {mode!r}")
    return out


def add_positional_lags(
    df: DataFrame,
    cols: Iterable[str],
    lags: Iterable[int],
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] | str = "datetime",
    mode: str = "lag",
) -> DataFrame:
    """All lags in one projection (one window, one shuffle, one sort)."""
    return df.withColumns(lag_columns(cols, lags, keys, order, mode, existing=df.columns))


def add_time_lags(
    df: DataFrame,
    cols: Sequence[str],
    lags: Iterable[int],
    keys: Sequence[str] = SERIES_KEYS,
    ts_col: str = "datetime",
) -> DataFrame:
    """Exact-time lags: the value at ``ts - n hours`` of the same series, null over gaps.

    One window per series, ordered by the instant in microseconds, with a RANGE
    frame of exactly ``n`` hours before: all lags share one exchange and one
    sort, and no join is needed. Among several rows of one instant the greatest
    value is taken; a row without an instant has no lags.
    """
    w = Window.partitionBy(*keys).orderBy(timestamp_to_epoch(ts_col, "us"))
    known = F.col(ts_col).isNotNull()
    out = {}
    for n in lags:
        frame = w.rangeBetween(-n * HOUR_US, -n * HOUR_US)
        out.update({lag_name(c, n): F.when(known, F.max(c).over(frame)) for c in cols})
    return df.withColumns(out)


def forward_fill(
    df: DataFrame,
    cols: Iterable[str],
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] | str = "datetime",
) -> DataFrame:
    """Last non-null value so far, per series."""
    w = series_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


def forward_fill_global(
    df: DataFrame, cols: Sequence[str], ts_col: str = "datetime", materialize_instants: bool = True
) -> DataFrame:
    """Forward fill across all series in time order, for columns that are a
    function of the instant (prices joined on ``datetime``).

    The fill runs on the per-instant table, never on the fact: (1) one value
    per instant (a partial aggregate, so a busy instant is reduced map-side);
    (2) the last non-null value in time order, by slices of the time line
    (:func:`forward_fill_by_slices` without keys), so no task holds the whole
    line; (3) join back on the instant. The filled table is written once, and
    Spark picks the join from its real size.
    """
    cols = list(cols)
    per_ts = df.groupBy(ts_col).agg(*[F.max(c).alias(f"_ff_{c}") for c in cols])
    per_ts = forward_fill_by_slices(per_ts, [f"_ff_{c}" for c in cols], [], [ts_col])
    if materialize_instants:
        per_ts = materialize(per_ts)
    out = join_same(df, per_ts, [ts_col])
    return out.withColumns({c: F.col(f"_ff_{c}") for c in cols}).select(*[F.col(f"`{c}`") for c in df.columns])


def keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    ``max_by`` over a struct is a plain aggregate with map-side partial
    aggregation, so a hot key is reduced in every task before the shuffle.
    A null payload value in the winning row is kept.
    """
    keys, order = list(keys), list(order)
    payload = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in payload]), F.struct(*[F.col(c) for c in order])).alias("_row")
    )
    return agg.select(*keys, *[F.col("_row").getField(c).alias(c) for c in payload]).select(*df.columns)


def upsert(
    history: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    rank_col: str = "_src",
) -> DataFrame:
    """Union by name, then keep the newest version per key (new beats history;
    within one source the greatest ``seq`` wins). ``seq`` must tell the versions
    of a key in one source apart; without it the winner would be arbitrary."""
    from .conform import align_to

    if not seq:
        raise ValueError("seq is required: it orders the versions of a key")

    h = history.withColumn(rank_col, F.lit(0))
    n = align_to(new, history.schema).withColumn(rank_col, F.lit(1))
    kept = keep_last(h.unionByName(n), keys, [rank_col, *seq])
    return kept.drop(rank_col)


def upsert_unique_history(
    history: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
) -> DataFrame:
    """Same result as :func:`upsert` when ``history`` has unique keys (it is
    the output of earlier upserts), without shuffling the history.

    The new batch is de-duplicated on its own (keep-last by ``seq``) and written
    once. History rows whose key appears in the batch are removed with a
    null-safe left-anti join, then the batch is appended. Spark broadcasts the
    batch's keys if the written table is small, and then scans the history once
    with no exchange; otherwise the join shuffles as usual.
    """
    from .conform import align_to

    if not seq:
        raise ValueError("seq is required: it orders the versions of a key")
    keys = list(keys)
    batch = materialize(align_to(keep_last(new, keys, list(seq)), history.schema))
    # An anti-join only tests existence: repeated keys need no distinct pass.
    kept = join_same(history, batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch)


def drop_rows_with_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Keep rows where every listed column is not null (NaN counts as a value)."""
    cols = list(cols) if cols is not None else df.columns
    if not cols:
        return df
    return df.filter(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in cols]))


def since_min_of(df: DataFrame, batch: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """Rows at or after the first instant of ``batch`` (a scalar subquery,
    evaluated once and pushed into the scan filter)."""
    first = batch.agg(F.min(ts_col)).scalar()
    return df.filter(F.col(ts_col) >= first)


def exclude_range(df: DataFrame, start: str, end: str, ts_col: str = "datetime") -> DataFrame:
    """Drop rows inside the closed range [start, end]."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return df.filter(~F.col(ts_col).between(lo, hi))


def row_index(
    df: DataFrame, keys: Sequence[str] = SERIES_KEYS, order: Sequence[str] | str = "datetime", name: str = "idx"
) -> DataFrame:
    """0-based position of each row within its series."""
    return df.withColumn(name, (F.row_number().over(series_window(keys, order)) - 1).cast("long"))


def distributed_row_number(
    df: DataFrame,
    order: Sequence[str],
    groups: Sequence[str] = (),
    name: str = "pos",
    num_partitions: int | None = None,
    count_col: str | None = None,
) -> DataFrame:
    """0-based position of each row within its group in ``order``, without a
    single-task window. ``count_col`` also attaches the group's row count
    (from the same slice table, no extra join).

    1. Range-partition on (groups, order) and sort inside each partition: a
       hot group is split over many partitions.
    2. ``monotonically_increasing_id`` = (partition << 33) + row index in
       partition order.
    3. Per (partition, group): row count and first index, a table of at most
       partitions + groups rows; a running sum over partitions gives each
       slice's offset in its group.
    4. Position = offset + index - first index.

    ``order`` must be a total order (add a unique tiebreak). Null group keys are
    one group. Range bounds are sampled from the input, so the numbered rows are
    written once (a table in the shared folder) before the slice table is derived
    from them: both sides of the final join see the same numbers, also after an
    executor loss.
    """
    groups, order = list(groups), list(order)
    ids = numbered_slices(df, groups, order, num_partitions)
    slices = ids.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    slices = slices.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).cast("long"))
    extra = []
    if count_col:
        whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
        slices = slices.withColumn(count_col, F.sum("_cnt").over(whole).cast("long"))
        extra = [count_col]
    # At most partitions + groups rows, written once: Spark sees its size.
    slices = materialize(slices.select("_part", *groups, "_off", "_first", *extra))
    out = join_same(ids, slices, ["_part", *groups], "inner")
    return out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long")).drop(
        "_mid", "_part", "_off", "_first"
    )


def numbered_slices(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], num_partitions: int | None = None
) -> DataFrame:
    """``df`` cut into range slices of (groups, order) and written, with the
    slice (``_part``) and a number that rises with the order (``_mid``)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *groups, *order).sortWithinPartitions(*groups, *order)
    ids = ranged.withColumn("_mid", F.monotonically_increasing_id())
    return materialize(ids.withColumn("_part", F.shiftright(F.col("_mid"), 33)))


def positional_lags_by_join(
    df: DataFrame,
    cols: Sequence[str],
    lags: Iterable[int],
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("datetime",),
) -> DataFrame:
    """Same values as :func:`add_positional_lags`, for series too long for one
    task: a distributed row index, then one equi-join per lag on (series, index).
    A null key is a series of its own, as in a window."""
    keys = list(keys)
    indexed = materialize(distributed_row_number(df, list(order), keys, name="_idx"))
    base = indexed.select(*keys, "_idx", *cols)
    out = indexed
    for n in lags:
        shifted = base.select(
            *keys, (F.col("_idx") + n).alias("_idx"), *[F.col(c).alias(lag_name(c, n)) for c in cols]
        )
        out = join_same(out, shifted, [*keys, "_idx"])
    return out.drop("_idx")


def forward_fill_by_slices(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("datetime",),
    num_partitions: int | None = None,
) -> DataFrame:
    """Same values as :func:`forward_fill`, for series too long for one task
    (a segmented scan).

    1. Range-partition on (series, order), number the rows and write them once:
       a long series is cut into slices, one per partition.
    2. Fill inside each (slice, series): a window over at most one
       partition's rows.
    3. Each slice's last value after the fill is its tail; the carry into a
       slice is the last non-null tail of the earlier slices of the same series
       (a window over at most partitions-many rows per series).
    4. Join the carry back on (slice, series) and fill what is still null.
    ``order`` must be a total order within a series. Null keys are one series;
    without ``keys`` the whole table is one.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    ids = numbered_slices(df, keys, order, num_partitions)
    in_slice = Window.partitionBy("_part", *keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    filled = ids.withColumns({c: F.last(F.col(c), ignorenulls=True).over(in_slice) for c in cols})
    tails = filled.groupBy("_part", *keys).agg(*[F.max_by(F.col(c), F.col("_mid")).alias(f"_t_{c}") for c in cols])
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = series.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(
        "_part", *keys, *[F.last(F.col(f"_t_{c}"), ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols]
    )
    # One row per (slice, series), written once: Spark sees its size.
    out = join_same(filled, materialize(carry), ["_part", *keys])
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_c_{c}")) for c in cols})
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
