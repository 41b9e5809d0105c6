"""Driver queries: each library operator run over the energy-shaped views of
the driver tables (whole tables), paired with DuckDB SQL in ``oracle.py``.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal the oracle's; queries whose operators write stage tables start jobs
when they are built. Doubles are rounded to 6 places.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import calendar as cal
from ..functions.scalar import add_hours, epoch_to_timestamp, timestamp_to_epoch
from ..operators.conform import CORRUPT_COL, REASONS_COL, conform, conform_or_reject, union_aligned
from ..operators.enrich import (
    forecast_weather_by_county,
    gas_hourly,
    grouped_mean,
    join_capacity,
    join_price,
    join_weather_with_median_fill,
    lookup_names,
    map_to_county,
    observed_weather_by_county,
    star_merge,
)
from ..operators.series import (
    add_positional_lags,
    add_time_lags,
    distributed_row_number,
    drop_rows_with_null,
    exclude_range,
    forward_fill,
    forward_fill_by_slices,
    forward_fill_global,
    positional_lags_by_join,
    row_index,
    since_min_of,
    upsert,
    upsert_unique_history,
)
from ..operators.runlog import RunLog, StreamLog
from ..operators.evaluate import cv_summary, fold_scores, mae, numeric_params
from ..operators.split import assign_folds, fold_frames
from ..operators.encode import ordered_target_means
from ..plans.features import build_features, zero_power_at_dst
from ..plans.forecast import block_recursive_forecast, column_model, seasonal_naive, submission, to_power
from ..plans.state import RetrainState
from ..plans.model import SIDES, SideModels, bins_for, category_counts, error_curve, feature_list, prepare, random_search
from ..streaming.incremental import DailyLoop
from ..schemas import (
    FW_OUTPUT,
    HISTORICAL_WEATHER_MEASURES,
    SCHEMAS,
    SERIES_KEYS,
    TABLE_KEYS,
    make_schema,
)
from ..session import materialize, scratch_path
from ..sources import analog
from ..sources.files import county_names, read_csv_to_judge, source_audit, write_bucketed
from ..sources.snapshots import read_snapshot, write_snapshot

# Lags that fit the 30-day driver data (720 h would leave no row).
DRIVER_LAGS = [12, 24, 168]
# Start of the "new" days in the incremental queries.
SPLIT_TS = "2024-01-25 00:00:00"
# First day that the daily loop replays; it goes on to the last day there is.
FIRST_LIVE_DAY = "2024-01-28"
# Start of the forecast horizon in the recursion query (last 48 hours).
HORIZON_TS = "2024-01-29 00:00:00"


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), places)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return analog.source_tables(spark, sf)


def _power(spark, sf) -> DataFrame:
    return _tables(spark, sf)["power"]


def _fact(spark, sf) -> DataFrame:
    return _power(spark, sf).withColumnRenamed("target", "power")


def _with_capacity(spark, sf) -> DataFrame:
    t = _tables(spark, sf)
    return join_capacity(t["power"].withColumnRenamed("target", "power"), t["client"]).withColumn(
        "capacity_factor", F.try_divide(F.col("power"), F.col("installed_capacity"))
    )


# ---------------------------------------------------------------- conformance

ORDERS_AS_CLIENT = make_schema(
    *[(f.name, f.dataType) for f in SCHEMAS["power"].fields[:2]],
    ("date", SCHEMAS["client"]["date"].dataType),
    *[(f.name, f.dataType) for f in SCHEMAS["client"].fields[1:]],
)


def conform_orders(spark, sf):
    o = analog.table(spark, sf, "orders")
    renamed = o.withColumnsRenamed({"o_orderkey": "row_id", "o_totalprice": "installed_capacity"})
    derived = renamed.withColumns(
        {
            "datetime": F.col("o_orderdate"),
            "date": F.to_date("o_orderdate"),
            "county": F.col("o_custkey") % 16,
            "is_business": F.col("o_orderstatus") == "F",
            "product_type": F.col("o_custkey") % 4,
        }
    )
    return round_doubles(conform(derived, ORDERS_AS_CLIENT))


def _orders_as_csv(spark, sf) -> DataFrame:
    """The orders written as CSV lines and read again: some with an unknown time,
    a county that doesn't fit, a flag that is none, no capacity, no date, or a
    field too many."""
    o = analog.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    odd = lambda n, bad, good: F.when(k % n == 0, F.lit(bad)).otherwise(good.cast("string"))
    fields = [
        k.cast("string"), odd(7, "xx", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        odd(19, "", F.date_format("o_orderdate", "yyyy-MM-dd")), odd(11, "300", F.col("o_custkey") % 16),
        odd(17, "maybe", F.col("o_orderstatus") == "F"), (F.col("o_custkey") % 4).cast("string"), odd(5, "", F.col("o_totalprice")),
        F.when(k % 13 == 0, F.lit("more")),
    ]
    path = scratch_path(spark, "csv", uuid.uuid4().hex)
    lines = o.select(F.concat_ws(",", *fields).alias("line"))
    lines.write.text(path)
    return read_csv_to_judge(spark, path, ORDERS_AS_CLIENT, header="false")


def _judged(spark, sf) -> tuple[DataFrame, DataFrame]:
    return conform_or_reject(_orders_as_csv(spark, sf), ORDERS_AS_CLIENT, required=["row_id", "date"])


def csv_conformed(spark, sf):
    return round_doubles(_judged(spark, sf)[0])


def csv_rejected(spark, sf):
    rejected = _judged(spark, sf)[1]
    line = F.substring_index(F.col(CORRUPT_COL), ",", 1)
    return rejected.select(F.coalesce(line, F.col("row_id")).cast("long").alias("row_id"), F.array_join(REASONS_COL, "; ").alias("reasons"))


PARSED = make_schema(
    ("row_id", SCHEMAS["power"]["row_id"].dataType),
    ("datetime", SCHEMAS["power"]["datetime"].dataType),
    ("date", SCHEMAS["client"]["date"].dataType),
    ("day_start", SCHEMAS["gas"]["forecast_date"].dataType),
)


def parse_ts_text(spark, sf):
    o = analog.table(spark, sf, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("row_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_start"),
    )
    return conform(text, PARSED, formats={"day_start": "yyyy-MM-dd"})


def epoch_to_ts(spark, sf):
    ev = analog.table(spark, sf, "events")
    us = timestamp_to_epoch("ts", "us")
    return ev.select(
        "event_id",
        us.alias("epoch_us"),
        epoch_to_timestamp(us * 1000, "ns").alias("ts_from_ns"),
        epoch_to_timestamp(timestamp_to_epoch("ts", "ms"), "ms").alias("ts_from_ms"),
        epoch_to_timestamp(timestamp_to_epoch("ts", "s"), "s").alias("ts_from_s"),
    )


def align_union(spark, sf):
    p = _power(spark, sf)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    history = p.filter(F.col("datetime") < split)
    batch = p.filter(F.col("datetime") >= split).drop("target")
    return round_doubles(union_aligned([history, batch], SCHEMAS["power"]))


def horizon_filter(spark, sf):
    return _tables(spark, sf)["forecast_weather"].filter(F.col("hours_ahead") <= 24)


def exclude_range_q(spark, sf):
    p = _power(spark, sf).filter(F.col("target").isNotNull())
    return round_doubles(exclude_range(p, "2024-01-10 00:00:00", "2024-01-11 23:59:59"))


def since_batch_min(spark, sf):
    t = _tables(spark, sf)
    batch = t["electricity"].filter(F.col("euros_per_mwh") < 0).withColumnRenamed("forecast_date", "datetime")
    return round_doubles(since_min_of(t["power"], batch))


# ---------------------------------------------------------------- joins


def capacity_join(spark, sf):
    df = _with_capacity(spark, sf)
    return round_doubles(
        df.select("row_id", "datetime", "prediction_unit_id", "is_consumption", "county", "date",
                  "installed_capacity", "power", "capacity_factor")
    )


def price_join(spark, sf):
    t = _tables(spark, sf)
    df = join_price(_fact(spark, sf), t["electricity"], "forecast_date", "euros_per_mwh", "electricity_price",
                    absolute=True)
    return round_doubles(df.select("row_id", "datetime", "electricity_price"))


def gas_hourly_q(spark, sf):
    return round_doubles(gas_hourly(_tables(spark, sf)["gas"]))


def station_county_mean(spark, sf):
    t = _tables(spark, sf)
    mapped = map_to_county(t["historical_weather"], t["mapping"])
    return round_doubles(grouped_mean(mapped, ["county", "datetime"], HISTORICAL_WEATHER_MEASURES, "hw_"))


def weather_derived(spark, sf):
    t = _tables(spark, sf)
    return round_doubles(forecast_weather_by_county(t["forecast_weather"], t["mapping"]))


def weather_observed(spark, sf):
    t = _tables(spark, sf)
    return round_doubles(observed_weather_by_county(t["historical_weather"], t["mapping"]))


def weather_join_median(spark, sf):
    t = _tables(spark, sf)
    fw = forecast_weather_by_county(t["forecast_weather"], t["mapping"])
    df = join_weather_with_median_fill(_fact(spark, sf), fw, FW_OUTPUT)
    return round_doubles(df.select("row_id", "datetime", "county", *FW_OUTPUT))


def name_lookup(spark, sf):
    df = lookup_names(_fact(spark, sf), county_names(spark), "county")
    return df.select("row_id", "county", "county_name")


def upsert_keep_last(spark, sf):
    p = _power(spark, sf)
    newer = p.filter(F.col("datetime") >= F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")).withColumn(
        "target", F.when(F.col("target") > 100, F.lit(None).cast("double")).otherwise(F.col("target") * 2)
    )
    return round_doubles(upsert(p, newer, TABLE_KEYS["power"], seq=["row_id"]))


# ---------------------------------------------------------------- calendar


def calendar_parts_q(spark, sf):
    p = _power(spark, sf)
    parts = cal.calendar_parts(F.col("datetime"))
    return p.select("row_id", "datetime", *[v.cast("int").alias(k) for k, v in parts.items()],
                    F.to_date("datetime").alias("date"))


def cyclic_q(spark, sf):
    p = _power(spark, sf)
    return round_doubles(p.select("row_id", *[v.alias(k) for k, v in cal.cyclic_columns(F.col("datetime")).items()]))


def _calendar_rows(spark, sf) -> DataFrame:
    """Seven years of hours from the order dates, a third without power."""
    o = analog.table(spark, sf, "orders")
    hour = F.col("o_orderkey") % 24
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        add_hours(F.col("o_orderdate").cast("timestamp_ntz"), hour).alias("datetime"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("power"),
    )


def holiday_flags(spark, sf):
    ts = F.col("datetime")
    return _calendar_rows(spark, sf).select(
        "row_id", "datetime", cal.is_holiday(ts).alias("is_holiday"),
        cal.is_day_before_holiday(ts).alias("is_day_before_holiday"))


def dst_flags(spark, sf):
    ts = F.col("datetime")
    return _calendar_rows(spark, sf).select(
        "row_id", "datetime", cal.is_dst_spring_forward(ts).alias("is_dst_spring_forward"),
        cal.is_dst_fall_backward(ts).alias("is_dst_fall_backward"))


def dst_power_zero(spark, sf):
    f = cal.add_calendar_features(_calendar_rows(spark, sf))
    return round_doubles(zero_power_at_dst(f).select("row_id", "power"))


# ---------------------------------------------------------------- windows


def lag_features(spark, sf):
    df = _with_capacity(spark, sf).select(
        "row_id", "datetime", "prediction_unit_id", "is_consumption", "power", "capacity_factor"
    )
    df = row_index(add_positional_lags(df, ["capacity_factor", "power"], DRIVER_LAGS))
    return round_doubles(drop_rows_with_null(df))


def time_lag(spark, sf):
    df = _fact(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    return round_doubles(add_time_lags(df, ["power"], DRIVER_LAGS))


def bucketed_lags(spark, sf):
    """The lags of ``lag_by_join`` over the fact bucketed by series: no exchange."""
    df = _with_capacity(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    name = f"fact_{uuid.uuid4().hex}"
    fact = write_bucketed(df, name, scratch_path(spark, "bucketed", name), SERIES_KEYS, ["datetime", "row_id"], 8)
    return round_doubles(add_positional_lags(fact, ["power"], DRIVER_LAGS, order=["datetime", "row_id"]))


def lags_by_user(spark, sf):
    """Lags and fills over a fact whose series grow with the data: one for each
    user and kind of use, hours without an event missing."""
    ev = analog.table(spark, sf, "events")
    fact = ev.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz").alias("datetime"),
                      F.col("user_id").alias("prediction_unit_id"), F.col("event_type").isin("click", "view", "signup").alias("is_consumption"),
                      ).agg(F.min("event_id").alias("row_id"), F.max("value").alias("power"))
    known = fact.withColumn("power", F.when(F.col("power") < 150, F.col("power")))
    filled = forward_fill(known, ["power"], order=["datetime", "row_id"])
    return round_doubles(add_positional_lags(filled, ["power"], [1, 2, 24], order=["datetime", "row_id"]))


def current_or_lag(spark, sf):
    df = _with_capacity(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "capacity_factor")
    df = add_positional_lags(df, ["capacity_factor"], [12, 24], mode="current_or_lag")
    return round_doubles(df.select("row_id", "capacity_factor_lag_12", "capacity_factor_lag_24"))


def ffill_series(spark, sf):
    t = _tables(spark, sf)
    df = join_price(_with_capacity(spark, sf), t["electricity"], "forecast_date", "euros_per_mwh",
                    "electricity_price", absolute=True)
    df = forward_fill(df, ["installed_capacity", "electricity_price"])
    return round_doubles(df.select("row_id", "installed_capacity", "electricity_price"))


def ffill_global(spark, sf):
    t = _tables(spark, sf)
    df = join_price(_fact(spark, sf), t["electricity"], "forecast_date", "euros_per_mwh", "electricity_price",
                    absolute=True)
    df = forward_fill_global(df, ["electricity_price"])
    return round_doubles(df.select("row_id", "datetime", "electricity_price"))


# ---------------------------------------------------------------- composites


def star_merge_q(spark, sf):
    return round_doubles(star_merge(_tables(spark, sf)))


def _merged(spark, sf) -> DataFrame:
    """The merged stage output, written once: the feature steps read it from
    several branches (fills per instant, history and new rows)."""
    return materialize(star_merge(_tables(spark, sf)))


def training_frame(spark, sf, lags=DRIVER_LAGS):
    merged = _merged(spark, sf)
    return round_doubles(build_features(merged, "train", lags=list(lags)))


def train_features(spark, sf):
    return training_frame(spark, sf, DRIVER_LAGS)


def retrain_features(spark, sf):
    merged = _merged(spark, sf)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    history = merged.filter(F.col("datetime") < split)
    new = merged.filter(F.col("datetime") >= split)
    # The history is a stored merged frame (one row per key): upsert by anti-join.
    return round_doubles(build_features(new, "retrain", history=history, lags=DRIVER_LAGS, history_unique=True))


def _retrain_state(spark, sf) -> tuple[RetrainState, DataFrame]:
    """A state over the rows before SPLIT_TS, and all merged rows."""
    merged = _merged(spark, sf)
    state = RetrainState(spark, scratch_path(spark, "retrain", uuid.uuid4().hex), DRIVER_LAGS)
    state.seed(merged.filter(F.col("datetime") < F.lit(SPLIT_TS).cast("timestamp_ntz")))
    return state, merged


def retrain_state(spark, sf):
    """The features of ``retrain_features``, from the stored state: the batch
    reads none of the history's rows."""
    state, merged = _retrain_state(spark, sf)
    return round_doubles(state.retrain(merged.filter(F.col("datetime") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))))


def retrain_state_corrected(spark, sf):
    """Three batches: new days, a correction of one of them (doubled power, some
    capacities unknown), and the rest; the features of all since the correction."""
    state, merged = _retrain_state(spark, sf)
    at = lambda day: F.col("datetime") >= F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz")
    state.retrain(merged.filter(at(25) & ~at(29)))
    unknown = F.col("prediction_unit_id") % 3 == 0
    corrected = merged.filter(at(26) & ~at(27)).withColumns({
        "power": F.col("power") * 2, "capacity_factor": F.lit(None).cast("double"),
        "installed_capacity": F.when(~unknown, F.col("installed_capacity"))})
    since = state.retrain(corrected)
    return round_doubles(since.unionByName(state.retrain(merged.filter(at(29)))))


# ---------------------------------------------------------------- evaluation and ordering


def ts_split(spark, sf):
    df = _fact(spark, sf).select("row_id", "datetime", "is_consumption")
    folded = assign_folds(df, 3, order=["datetime", "row_id"], groups=["is_consumption"])
    return folded.select("row_id", "is_consumption", "pos", "n_rows", "test_fold", "train_from_fold")


def _naive_scored(spark, sf) -> DataFrame:
    """Capacity-factor lags -> seasonal naive -> power forecast (row_id, target)."""
    df = add_positional_lags(_with_capacity(spark, sf), ["capacity_factor"], DRIVER_LAGS)
    return df.withColumn("target", to_power(seasonal_naive("capacity_factor", [168, 24, 12])))


def seasonal_naive_mae(spark, sf):
    scored = _naive_scored(spark, sf)
    return round_doubles(mae(_fact(spark, sf), scored, "row_id", "power", "target"))


def cv_summary_q(spark, sf):
    scored = _naive_scored(spark, sf)
    folded = assign_folds(scored, 3, order=["datetime", "row_id"], groups=["is_consumption"])
    scores = fold_scores(folded, "test_fold", ["is_consumption"])
    return round_doubles(cv_summary(scores, "is_consumption", {True: "consumption", False: "production"}))


def group_order(spark, sf):
    ev = analog.table(spark, sf, "events")
    first = ev.groupBy("user_id").agg(F.min("event_id").alias("first_seq"))
    return distributed_row_number(first, ["first_seq"], [], name="position")


def top_sample(spark, sf):
    f = _fact(spark, sf)
    return round_doubles(f.orderBy(F.desc("power"), F.asc("row_id")).limit(10).select("row_id", "datetime", "power"))


def param_rows(spark, sf):
    part = analog.table(spark, sf, "part")
    names = ["p_size", "p_retailprice", "p_name", "p_brand"]
    text = part.select(F.col("p_partkey").alias("run_id"), *[F.col(c).cast("string").alias(c) for c in names])
    long = text.unpivot(["run_id"], names, "param", "value_text").withColumn(
        "param", F.regexp_replace("param", "^p_", "param."))
    return round_doubles(numeric_params(long).select("run_id", "metric", "value"))


def source_audit_q(spark, sf):
    tables = {t: analog.table(spark, sf, t) for t in analog.DRIVER_TABLES}
    return source_audit(spark, tables, analog.DRIVER_TABLES).select("table_name", "n_rows")


# ---------------------------------------------------------------- forecasting


def recursive_forecast(spark, sf):
    f = _fact(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    cut = F.col("datetime") >= F.lit(HORIZON_TS).cast("timestamp_ntz")
    out = block_recursive_forecast(
        f.filter(~cut), f.filter(cut), "power", column_model(lambda: F.col("power_lag_12")), [12],
    )
    return round_doubles(out.select("row_id", "datetime", *SERIES_KEYS, "prediction"))


def _train_test_features(spark, sf):
    return _train_test_history(spark, sf)[:2]


def _train_test_history(spark, sf):
    merged = _merged(spark, sf)
    cut = F.col("datetime") >= F.lit(HORIZON_TS).cast("timestamp_ntz")
    history, future = merged.filter(~cut), merged.filter(cut)
    train = build_features(history, "train", lags=DRIVER_LAGS)
    test = build_features(future.withColumn("power", F.lit(None).cast("double"))
                          .withColumn("capacity_factor", F.lit(None).cast("double")),
                          "test", history=history, lags=DRIVER_LAGS)
    return train, test, history


def gbt_predict(spark, sf):
    train, test = _train_test_features(spark, sf)
    params = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1}
    models = SideModels(params={"consumption": params, "production": params}).fit(train)
    scored = models.transform(test)
    return submission(scored, to_power(F.col("_pred")))


def param_search(spark, sf):
    train, _ = _train_test_features(spark, sf)
    space = {"maxIter": (5, 15, "int"), "maxDepth": (2, 4, "int"), "stepSize": (0.05, 0.3, "log")}
    _, table = random_search(train, n_trials=2, n_splits=2, space=space)
    return table.select("side", "trial", "params", "mean_mae")


def _loop(spark, sf, lags=(24,), value=None) -> tuple[DailyLoop, list[str]]:
    # The fact is a stored table in the daily loop, by day: write the view so.
    f = _fact(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    path = scratch_path(spark, uuid.uuid4().hex)
    f.withColumn("_day", F.date_format("datetime", "yyyy-MM-dd")).write.partitionBy("_day").parquet(path)
    stored = spark.read.parquet(path).withColumn("_day", F.col("_day").cast("string"))
    late = stored.filter(F.col("_day") >= FIRST_LIVE_DAY).select("_day").distinct().orderBy("_day")
    loop = DailyLoop(spark, stored, "power", lags=list(lags), model=value, root=scratch_path(spark, "daily", uuid.uuid4().hex))
    return loop, [r["_day"] for r in late.collect()]  # one name per day


def incremental_days(spark, sf):
    loop, days = _loop(spark, sf)
    loop.seed_history(FIRST_LIVE_DAY)
    return round_doubles(loop.run(days).select("row_id", "datetime", "prediction"))


def incremental_replay(spark, sf):
    """The same forecasts after all days were run twice (in one batch each time)
    and the history of the first day had been spoilt before it was corrected."""
    loop, days = _loop(spark, sf)
    loop.seed_history(FIRST_LIVE_DAY)
    spoilt, fact = loop.fact.withColumn("power", F.col("power") + 1000), loop.fact
    loop.fact = spoilt
    loop.run(days[:2])
    loop.fact = fact
    loop.run(days)
    return round_doubles(loop.run(days).select("row_id", "datetime", "prediction"))


# The corrected day is ten days before one of the replayed ones, and in reach of
# the longer lag (positions, not hours).
LATE_DAY = "2024-01-19"
LATE_LAGS = [24, 240]


def late_corrections(spark, sf):
    """Forecasts after a day of the seeded history and a replayed day were
    corrected when everything had been forecast from their first versions."""
    loop, days = _loop(spark, sf, LATE_LAGS, lambda df: (F.col("power_lag_24") + F.col("power_lag_240")) / 2)
    right = loop.fact
    wrong = F.col("_day").isin(LATE_DAY, days[0])
    loop.fact = right.filter(~wrong | (F.col("row_id") % 5 != 0)).withColumn("power", F.when(wrong, F.col("power") * 3).otherwise(F.col("power")))
    loop.seed_history(FIRST_LIVE_DAY)
    loop.run(days)
    loop.fact = right
    return round_doubles(loop.correct().select("row_id", "datetime", "prediction"))


def run_log(spark, sf):
    """What the log of a run knows afterwards: rows and unknown values of the
    merged frame and of its features, and of each replayed day."""
    log = RunLog(spark, scratch_path(spark, "runs", uuid.uuid4().hex), "run")
    merged = log.stage("merged", star_merge(_tables(spark, sf)), ["power", "installed_capacity"])
    log.stage("features", build_features(merged, "train", lags=DRIVER_LAGS), ["capacity_factor"])
    loop, days = _loop(spark, sf)
    loop.log = log
    loop.seed_history(FIRST_LIVE_DAY)
    progress = StreamLog(log)
    spark.streams.addListener(progress)
    try:
        loop.run(days[:2])
    finally:
        progress.flush()
        spark.streams.removeListener(progress)
    known = log.read().filter(~F.col("metric").isin("seconds", "milliseconds"))
    return known.select("stage", "step", "metric", "value")


def snapshot_tiers(spark, sf):
    """The newest capacities after ten batches of three days in tiers of three:
    each batch sends its days and, one higher, those of two batches before; then
    batch 8 is sent again, doubled."""
    client = materialize(_tables(spark, sf)["client"])
    block = F.floor(F.datediff("date", F.lit("2024-01-01").cast("date")) / 3)
    root = scratch_path(spark, "snapshots", uuid.uuid4().hex)

    def batch(k: int) -> DataFrame:
        again = client.filter(block == k - 2).withColumn("installed_capacity", F.col("installed_capacity") + 1)
        return client.filter(block == k).unionByName(again)

    for k in range(10):
        write_snapshot({"client": batch(k)}, root, k, fan=3)
    write_snapshot({"client": batch(8).withColumn("installed_capacity", F.col("installed_capacity") * 2)}, root, 8, fan=3)
    return round_doubles(read_snapshot(spark, root, "client"))


def test_features(spark, sf):
    _, test = _train_test_features(spark, sf)
    return round_doubles(test)


def lag_by_join(spark, sf):
    df = _with_capacity(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    return round_doubles(positional_lags_by_join(df, ["power"], DRIVER_LAGS))


def recursive_gbt(spark, sf):
    """The trained per-side models drive the block recursion on capacity factor."""
    train, test, history = _train_test_history(spark, sf)
    params = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1}
    models = SideModels(params={"consumption": params, "production": params}).fit(train)
    # The merged history, not the trimmed training rows: lags are positional.
    history = history.select("row_id", "datetime", *SERIES_KEYS, "capacity_factor")
    out = block_recursive_forecast(history, test, "capacity_factor", models.transform, DRIVER_LAGS)
    return submission(out, to_power(F.col("prediction")))


def ffill_by_slices(spark, sf):
    t = _tables(spark, sf)
    df = join_price(_with_capacity(spark, sf), t["electricity"], "forecast_date", "euros_per_mwh",
                    "electricity_price", absolute=True)
    df = forward_fill_by_slices(df, ["installed_capacity", "electricity_price"], SERIES_KEYS, ["datetime", "row_id"])
    return round_doubles(df.select("row_id", "installed_capacity", "electricity_price"))


def train_features_long(spark, sf):
    """The training frame through the sliced (long-series) operators."""
    merged = _merged(spark, sf)
    return round_doubles(build_features(merged, "train", lags=DRIVER_LAGS, long_series=True))


# ---------------------------------------------------------------- facts about the models


def _forecast_facts(spark, sf, forecast: DataFrame) -> DataFrame:
    """Which rows a forecast covers, whether it is sound, what the seasonal naive
    one errs on the rows that both cover, and whether the forecast errs less."""
    fact = _fact(spark, sf).select("row_id", "is_consumption", "power")
    naive = _naive_scored(spark, sf).select("row_id", F.col("target").alias("naive"))
    both = forecast.join(fact, "row_id").join(naive, "row_id", "left")
    scored = both.withColumn("usable", F.col("power").isNotNull() & F.col("naive").isNotNull())
    error = lambda c: F.avg(F.when(F.col("usable"), F.abs(F.col(c) - F.col("power"))))
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count_if("is_consumption").alias("n_consumption"),
        F.sum("row_id").alias("row_id_sum"),
        F.count_if("usable").alias("n_scored"),
        error("naive").alias("naive_mae"),
        F.bool_and(F.col("target") >= 0).alias("never_negative"),
        (error("target") < error("naive")).alias("beats_naive"),
    )


def gbt_facts(spark, sf):
    return round_doubles(_forecast_facts(spark, sf, materialize(gbt_predict(spark, sf))))


def recursive_gbt_facts(spark, sf):
    return round_doubles(_forecast_facts(spark, sf, materialize(recursive_gbt(spark, sf))).drop("beats_naive"))


SEARCH_SPACE = {"maxIter": (3, 12, "int"), "maxDepth": (2, 4, "int"), "stepSize": (0.05, 0.3, "log")}


def search_facts(spark, sf):
    """Per side: the rows of the search's two folds, and whether the chosen
    parameters have the least error and refitting each fold with the chosen
    number of trees gives the error that the search reported."""
    merged = _merged(spark, sf)
    history = merged.filter(F.col("datetime") < F.lit(HORIZON_TS).cast("timestamp_ntz"))
    train = materialize(build_features(history, "train", lags=DRIVER_LAGS))
    best, table = random_search(train, n_trials=2, n_splits=2, space=SEARCH_SPACE)
    trials = {(r["side"], r["trial"]): r for r in table.collect()}
    features = feature_list(train)
    bins, rows = bins_for(category_counts(train, features), 32), []
    for side, flag in SIDES.items():
        side_rows = prepare(train.filter(F.col("is_consumption") == flag), features)
        folded = materialize(assign_folds(side_rows, 2, groups=[]))
        mine = [trials[side, k] for k in range(2)]
        chosen = min(mine, key=lambda r: (r["mean_mae"], r["trial"]))
        refit = [error_curve(*fold_frames(folded, k), features, best[side], max_bins=bins)[-1] for k in range(2)]
        sizes = [n for k in range(2) for n in (folded.filter(F.col("train_from_fold") <= k).count(), folded.filter(F.col("test_fold") == k).count())]
        rows.append((side, *sizes, json.loads(chosen["params"]) == best[side],
                     all(abs(a - b) < 1e-9 for a, b in zip(refit, chosen["fold_mae"]))))
    return spark.createDataFrame(rows, "side string, n_train_0 long, n_test_0 long, n_train_1 long, n_test_1 long, best_is_least boolean, refits_agree boolean")


def category_means(spark, sf):
    """Time-ordered target means of categories of any number: the events' users
    and kinds, each row seeing earlier instants only."""
    ev = analog.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # In a unit that leaves no mean halfway between two rounded values.
    hour = ev.withColumn("value", F.col("value") / 79.19).withColumn("hour", F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz"))
    out = ordered_target_means(hour, ["user_id", "event_type"], "value", "hour")
    return round_doubles(out.select("event_id", "user_id_mean", "event_type_mean"))


# ---------------------------------------------------------------- null keys


def _null_unit(spark, sf) -> DataFrame:
    """The fact with one unit's key null: a series of its own."""
    unit = F.when(F.col("prediction_unit_id") != 5, F.col("prediction_unit_id"))
    return _with_capacity(spark, sf).withColumn("prediction_unit_id", unit)


def null_key_folds(spark, sf):
    folded = assign_folds(_null_unit(spark, sf).select("row_id", "datetime", "prediction_unit_id"), 3,
                          order=["datetime", "row_id"], groups=["prediction_unit_id"])
    return folded.select("row_id", "prediction_unit_id", "pos", "n_rows")


def null_key_lags(spark, sf):
    df = _null_unit(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    return round_doubles(positional_lags_by_join(df, ["power"], DRIVER_LAGS))


def null_key_fill(spark, sf):
    df = forward_fill_by_slices(_null_unit(spark, sf), ["installed_capacity"], SERIES_KEYS, ["datetime", "row_id"])
    return round_doubles(df.select("row_id", "installed_capacity"))


def upsert_null_keys(spark, sf):
    """A batch with null keys and with three versions of each row."""
    p = _null_unit(spark, sf).select("row_id", "datetime", *SERIES_KEYS, "power")
    late = p.filter(F.col("datetime") >= F.lit("2024-01-28 00:00:00").cast("timestamp_ntz"))
    versions = late.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2))))
    batch = versions.select(F.col("row_id"), "datetime", *SERIES_KEYS, (F.col("power") + F.col("v")).alias("power"), "v")
    return round_doubles(upsert_unique_history(p.withColumn("v", F.lit(-1)), batch, ["datetime", *SERIES_KEYS], ["v"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_orders": conform_orders,
    "parse_ts_text": parse_ts_text,
    "csv_conformed": csv_conformed,
    "csv_rejected": csv_rejected,
    "epoch_to_ts": epoch_to_ts,
    "align_union": align_union,
    "horizon_filter": horizon_filter,
    "exclude_range": exclude_range_q,
    "since_batch_min": since_batch_min,
    "capacity_join": capacity_join,
    "price_join": price_join,
    "gas_hourly": gas_hourly_q,
    "station_county_mean": station_county_mean,
    "weather_derived": weather_derived,
    "weather_observed": weather_observed,
    "weather_join_median": weather_join_median,
    "name_lookup": name_lookup,
    "upsert_keep_last": upsert_keep_last,
    "calendar_parts": calendar_parts_q,
    "cyclic": cyclic_q,
    "holiday_flags": holiday_flags,
    "dst_flags": dst_flags,
    "dst_power_zero": dst_power_zero,
    "lag_features": lag_features,
    "time_lag": time_lag,
    "current_or_lag": current_or_lag,
    "bucketed_lags": bucketed_lags,
    "lags_by_user": lags_by_user,
    "ffill_series": ffill_series,
    "ffill_global": ffill_global,
    "star_merge": star_merge_q,
    "train_features": train_features,
    "retrain_features": retrain_features,
    "retrain_state": retrain_state,
    "retrain_state_corrected": retrain_state_corrected,
    "ts_split": ts_split,
    "seasonal_naive_mae": seasonal_naive_mae,
    "cv_summary": cv_summary_q,
    "group_order": group_order,
    "top_sample": top_sample,
    "param_rows": param_rows,
    "source_audit": source_audit_q,
    "recursive_forecast": recursive_forecast,
    "gbt_predict": gbt_predict,
    "param_search": param_search,
    "incremental_days": incremental_days,
    "test_features": test_features,
    "lag_by_join": lag_by_join,
    "recursive_gbt": recursive_gbt,
    "ffill_by_slices": ffill_by_slices,
    "train_features_long": train_features_long,
    "incremental_replay": incremental_replay,
    "late_corrections": late_corrections,
    "snapshot_tiers": snapshot_tiers,
    "run_log": run_log,
    "null_key_folds": null_key_folds,
    "null_key_lags": null_key_lags,
    "null_key_fill": null_key_fill,
    "upsert_null_keys": upsert_null_keys,
    "gbt_facts": gbt_facts,
    "recursive_gbt_facts": recursive_gbt_facts,
    "search_facts": search_facts,
    "category_means": category_means,
}
