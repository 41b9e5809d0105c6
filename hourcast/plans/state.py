"""Retraining features on a stored state: a batch touches its own days only.

Under ``root``, a folder shared by the driver and all executors:

history   the merged rows, one per key, partitioned by day
states    per committed batch, what the rows before a day (``as_of``) bring into
          later ones: the last ``max(lags)`` filled rows of each series, the last
          known value of each filled column per series, and the last prices
ledger    one row per step of a batch: its first day when it begins, the day of
          its state when it is done

A batch starts from the latest state that is not after its first day and that no
later batch has undercut; it reads the history of the days since then (a
partition filter), puts the new rows over it, and computes fills and lags with
the state as the part before. So the usual batch of new days reads almost no
history, and a correction of old rows reads what lies after them. The result is
that of ``build_features(new, "retrain", history=...)`` over the whole history.

A batch that fails is run again: its first ledger row already keeps states that
its rows may have overtaken from being used, and writing the same rows again
changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.calendar import add_calendar_features
from ..operators.conform import align_to
from ..operators.series import keep_last, since_min_of, upsert_unique_history
from ..schemas import DEFAULT_LAGS, LAG_COLUMNS, SERIES_KEYS, TABLE_KEYS
from ..session import materialize
from .features import PRICE_COLUMNS, ROW_ORDER, SERIES_FILL_COLUMNS, Carry, finish, missing_value_policy, with_lags

DAY = "_day"
LEDGER = "batch long, first_day string, as_of string"


def day_of(ts: str = "datetime"):
    return F.date_format(F.col(ts), "yyyy-MM-dd")


class RetrainState:
    """Retrain features batch by batch; see the module docstring. One writer."""

    def __init__(
        self, spark: SparkSession, root: str, lags: Sequence[int] = DEFAULT_LAGS, lag_cols: Sequence[str] = LAG_COLUMNS,
        keys: Sequence[str] = TABLE_KEYS["power"], seq: str = "row_id",
    ):
        self.spark, self.lags, self.lag_cols, self.keys, self.seq = spark, list(lags), list(lag_cols), list(keys), seq
        root = root.rstrip("/")
        self.history_path, self.states_path, self.ledger_path = (f"{root}/{part}" for part in ("history", "states", "ledger"))

    # ------------------------------------------------------------ stored tables

    def history(self, since: str | None = None) -> DataFrame:
        """The stored rows, from the day ``since`` on (only those folders are read)."""
        plain = self.spark.read.parquet(self.history_path).schema  # the footer of one file
        named = StructType([StructField(DAY, StringType()) if f.name == DAY else f for f in plain.fields])
        rows = self.spark.read.schema(named).parquet(self.history_path)
        return (rows if since is None else rows.filter(F.col(DAY) >= since)).drop(DAY)

    def _put(self, rows: DataFrame) -> None:
        rows.withColumn(DAY, day_of()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(self.history_path)

    def _ledger(self) -> list[tuple[int, str, str | None]]:
        """One record per step of a batch (never data rows)."""
        try:
            rows = self.spark.read.schema(LEDGER).json(self.ledger_path).collect()
        except AnalysisException:  # nothing committed yet
            return []
        return sorted(((r["batch"], r["first_day"], r["as_of"]) for r in rows), key=lambda r: (r[0], r[2] is not None))

    def _note(self, batch: int, first_day: str, as_of: str | None) -> None:
        self.spark.createDataFrame([(batch, first_day, as_of)], LEDGER).coalesce(1).write.mode("append").json(self.ledger_path)

    def base(self, first_day: str) -> tuple[int, str] | None:
        """(batch, as_of) of the latest usable state: not after ``first_day``, and
        no later batch began before its day."""
        steps = self._ledger()
        usable = [(as_of, batch) for batch, _, as_of in steps if as_of is not None and as_of <= first_day
                  and all(b <= batch or first >= as_of for b, first, _ in steps)]
        return max(usable)[::-1] if usable else None

    def carry(self, batch: int) -> Carry:
        at = f"{self.states_path}/batch={batch}"
        prices = self.spark.read.parquet(f"{at}/prices").first()
        return Carry(self.spark.read.parquet(f"{at}/tail"), self.spark.read.parquet(f"{at}/levels"), prices.asDict())

    # ------------------------------------------------------------ steps

    def _filled(self, rows: DataFrame, carry: Carry | None) -> DataFrame:
        """Calendar and fills of merged rows, written once: features and state read it."""
        return materialize(missing_value_policy(add_calendar_features(rows, "datetime"), "retrain", carry=carry))

    def _write_state(self, batch: int, filled: DataFrame, carry: Carry | None) -> None:
        """The state after all of ``filled``, in the batch's own folder."""
        at = f"{self.states_path}/batch={batch}"
        rows = filled.select(*SERIES_KEYS, *ROW_ORDER, *self.lag_cols)
        if carry is not None:
            rows = rows.unionByName(carry.tail)
        newest = Window.partitionBy(*SERIES_KEYS).orderBy(*[F.desc(c) for c in ROW_ORDER])
        tail = rows.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= max(self.lags)).drop("_n")
        tail.write.mode("overwrite").parquet(f"{at}/tail")
        # Filled columns: a series' last row holds the last known values.
        last = F.max_by(F.struct(*SERIES_FILL_COLUMNS), F.struct(F.col("_new"), *ROW_ORDER))
        levels = filled.select(*SERIES_KEYS, *ROW_ORDER, *SERIES_FILL_COLUMNS, F.lit(1).alias("_new"))
        if carry is not None:
            before = carry.levels.withColumns({"datetime": F.lit(None).cast("timestamp_ntz"), "row_id": F.lit(None).cast("long"), "_new": F.lit(0)})
            levels = levels.unionByName(before)
        levels.groupBy(*SERIES_KEYS).agg(last.alias("_last")).select(*SERIES_KEYS, "_last.*").write.mode("overwrite").parquet(f"{at}/levels")
        prices = filled.agg(*[F.max_by(F.col(c), F.col("datetime")).alias(c) for c in PRICE_COLUMNS])
        prices.write.mode("overwrite").parquet(f"{at}/prices")

    def _after(self, rows: DataFrame) -> str:
        """The day after the last one of ``rows``."""
        return str(rows.agg(F.max("datetime")).first()[0].date() + dt.timedelta(days=1))

    def seed(self, merged: DataFrame) -> None:
        """The first batch: its rows are the history. Its state is computed over all of it."""
        rows = keep_last(merged, self.keys, [self.seq])
        first = rows.agg(F.min("datetime")).first()[0]
        if first is None:
            raise ValueError("no rows to start from")
        self._note(0, str(first.date()), None)
        self._put(rows)
        stored = self.history()
        self._write_state(0, self._filled(stored, None), None)
        self._note(0, str(first.date()), self._after(stored))

    def retrain(self, new: DataFrame) -> DataFrame:
        """Features of ``new`` merged rows over the stored ones, from the batch's
        first instant on (a written table); history, state and ledger move on.
        A batch without rows gives no features and changes nothing."""
        new = materialize(new)
        first = new.agg(F.min("datetime")).first()[0]
        if first is None:
            return finish(with_lags(self._filled(new, None), "retrain", self.lags, self.lag_cols), "retrain", self.lags)
        first_day = str(first.date())
        base = self.base(first_day)
        batch = 1 + max((b for b, _, _ in self._ledger()), default=-1)
        self._note(batch, first_day, None)
        carry, since = (self.carry(base[0]), base[1]) if base else (None, None)
        old = self.history(since)
        live = materialize(upsert_unique_history(old, align_to(new, old.schema), self.keys, [self.seq]))
        filled = self._filled(live, carry)
        features = since_min_of(with_lags(filled, "retrain", self.lags, self.lag_cols, carry=carry), new)
        features = materialize(finish(features, "retrain", self.lags))
        self._write_state(batch, filled, carry)
        days = new.select(day_of().alias(DAY)).distinct()
        self._put(live.withColumn(DAY, day_of()).join(days, DAY, "left_semi").drop(DAY))
        self._note(batch, first_day, self._after(live))
        return features
