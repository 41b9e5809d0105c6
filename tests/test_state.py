"""Retraining on a stored state equals retraining over the whole history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourcast.plans.features import build_features
from hourcast.plans.state import RetrainState
from hourcast.schemas import LAG_COLUMNS, MERGED_COLUMNS, POWER_SCHEMA

from tests.parity import normalise

START = dt.datetime(2024, 1, 1)


def merged_rows(seed: int, days: range, units=(0, 1, None), hole: float = 0.2):
    """Hourly merged rows with gaps, null values, a null key and series that
    start or end inside the span."""
    rng = random.Random(seed)
    rows = []
    for u in units:
        for side in (True, False):
            for day in days:
                if (u == 1 and day < 4) or (u == 0 and not side and day > 6):
                    continue
                for hour in range(24):
                    if rng.random() < hole:
                        continue
                    at = START + dt.timedelta(days=day, hours=hour)
                    row = {"row_id": rng.randrange(1 << 40), "datetime": at, "prediction_unit_id": u, "is_consumption": side,
                           "county": 3, "is_business": True, "product_type": 1, "capacity_factor": None if rng.random() < 0.3 else rng.random(),
                           "power": rng.choice([None, rng.random() * 9])}
                    price = random.Random(f"{at}{seed // 10}")  # a price belongs to the hour
                    for c in ("electricity_price", "gas_price"):
                        row[c] = None if price.random() < 0.5 else price.random()
                    for c in MERGED_COLUMNS:
                        row.setdefault(c, None if rng.random() < 0.4 else rng.random())
                    rows.append(tuple(row[c] for c in MERGED_COLUMNS))
    return rows


@pytest.fixture(scope="module")
def schema(spark):
    kinds = {f.name: f.dataType.simpleString() for f in POWER_SCHEMA.fields}
    return ", ".join(f"{c} {kinds.get(c, 'double')}" for c in MERGED_COLUMNS)


def rows_of(df):
    return normalise(df.columns, [tuple(r) for r in df.collect()])


LAGS = [5, 30]
COLS = LAG_COLUMNS


def whole(history, batch):
    """The same batch over the whole history."""
    return build_features(batch, "retrain", history=history, lags=LAGS, lag_cols=COLS)


def test_batches_equal_the_whole_history(spark, schema, tmp_out):
    frame = lambda rows: spark.createDataFrame(rows, schema)
    state = RetrainState(spark, f"{tmp_out}/state", LAGS, COLS)
    history = frame(merged_rows(1, range(0, 5)))
    state.seed(history)
    # New days, a correction of old ones, a correction before the first state, and a gap.
    batches = [merged_rows(2, range(5, 7)), merged_rows(4, range(5, 6), units=(0,)),
               merged_rows(5, range(2, 3), units=(None,)), merged_rows(6, range(9, 10))]
    some = 0
    for rows in batches:
        batch = frame(rows)
        want = rows_of(whole(history, batch))  # before the stored rows change
        assert rows_of(state.retrain(batch)) == want
        some += len(want[1])
        history = state.history()
    assert some > 0
    assert [b for b in (state.base("2024-01-11"), state.base("2024-01-01"))] == [(4, "2024-01-11"), None]
    assert state.base("2024-01-09") is None or state.base("2024-01-09")[1] <= "2024-01-09"
    assert state.retrain(frame([])).count() == 0 and len(state._ledger()) == 10


def test_a_batch_of_new_days_reads_no_old_partition(spark, schema, tmp_out):
    state = RetrainState(spark, f"{tmp_out}/state", LAGS, COLS)
    state.seed(spark.createDataFrame(merged_rows(1, range(0, 4)), schema))
    batch, as_of = state.base("2024-01-05")
    assert (batch, as_of) == (0, "2024-01-05")
    since = state.history(as_of)
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan and ">= 2024-01-05)]" in plan
    assert since.inputFiles() and since.count() == 0


def test_a_failed_batch_is_run_again(spark, schema, tmp_out, monkeypatch):
    state = RetrainState(spark, f"{tmp_out}/state", LAGS, COLS)
    history = spark.createDataFrame(merged_rows(1, range(0, 5)), schema)
    state.seed(history)
    batch = spark.createDataFrame(merged_rows(7, range(3, 6)), schema)
    want = rows_of(whole(history, batch))
    put = state._put
    monkeypatch.setattr(state, "_put", lambda rows: (put(rows), (_ for _ in ()).throw(OSError("killed"))))
    with pytest.raises(OSError):
        state.retrain(batch)
    monkeypatch.setattr(state, "_put", put)
    assert state.base("2024-01-06") is None  # the failed batch may have overtaken the first state
    assert rows_of(state.retrain(batch)) == want
    assert state.base("2024-01-08")[1] == "2024-01-07"
