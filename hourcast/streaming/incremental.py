"""The daily loop as a Structured Streaming query.

Days arrive through a *manifest* stream, one record per day, and each
micro-batch takes the days it holds in order. For every day it

1. writes the actuals revealed since (the previous day's rows) into the history
   table, whose partition of that day is replaced as a whole, and the day's rows
   of the side tables into their snapshots;
2. builds the day's features over the history before it;
3. predicts, and replaces the day's partition of the forecasts.

Everything is keyed by day, so a batch or a whole run that is repeated changes
nothing, and several days in one batch are each written. A day before the last
committed one is refused unless it was committed itself (then it is redone). The
data never pass through the stream source: a day's rows are read from the fact,
which should be stored by day. History, forecasts, the manifest and the stream's
checkpoint lie under ``root``, a shared folder, so a restarted query resumes.

Positional lags need only the last ``max(lags)`` rows of each series: these are
kept as a table of their own per day, so a day's work grows with the day and the
number of series, not with the history.

Corrections of any day. A ledger holds a digest of every day as it was revealed:
its rows and two 64-bit hash sums, which don't depend on the order of the rows.
:meth:`DailyLoop.correct` compares the fact with it, reveals the days that differ
again, and redoes the days whose forecasts read them. A day reads another one if,
for one of that day's series, fewer than ``max(lags)`` later rows stand before it
(with a ``features`` function, every later day does).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.runlog import RunLog, observed
from ..operators.series import add_positional_lags, join_same
from ..schemas import SERIES_KEYS, lag_name
from ..sources.snapshots import read_snapshot, write_snapshot

# A day to forecast (null: none), its place, the days whose rows are revealed
# before it, and the last day whose tail is surely good.
MANIFEST_SCHEMA = "day string, seq long, reveal string, reveals array<string>, since string"
LEDGER_SCHEMA = "n long, sum_a decimal(38,0), sum_b decimal(38,0), _day string"


def write_manifest(spark: SparkSession, folder: str, day_ids: Sequence[str]) -> None:
    """One small JSON file of all given days. Each record has its place in the
    run (``seq``) and the day whose actuals it reveals (the one before it); the
    order comes from the records, never from file times."""
    rows = [(day, i, day_ids[i - 1] if i else None, None, None) for i, day in enumerate(day_ids)]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(folder)


def day_digests(df: DataFrame) -> DataFrame:
    """(n, sum_a, sum_b, _day): the rows of each day and two exact sums of their
    64-bit hashes over all columns. A null differs from every value."""
    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns) if c != "_day"]
    total = lambda *seed: F.sum(F.xxhash64(*seed, *cols).cast("decimal(20,0)")).cast("decimal(38,0)")
    return df.groupBy("_day").agg(F.count(F.lit(1)).alias("n"), total().alias("sum_a"), total(F.lit(1)).alias("sum_b")).select(
        "n", "sum_a", "sum_b", "_day")


def naive_day_ahead(value_col: str = "power", lag: int = 24) -> Callable[[DataFrame], Column]:
    """Stand-in model: the value ``lag`` positions back in the series."""
    return lambda df: F.col(lag_name(value_col, lag))


class DailyLoop:
    """Replays days through a streaming query; see the module docstring."""

    def __init__(
        self,
        spark: SparkSession,
        fact: DataFrame,
        value_col: str = "power",
        ts_col: str = "datetime",
        keys: Sequence[str] = SERIES_KEYS,
        lags: Sequence[int] = (24,),
        model: Callable[[DataFrame], Column] | None = None,
        *,
        root: str,
        features: Callable[..., DataFrame] | None = None,
        hidden: Sequence[str] | None = None,
        side_tables: Callable[[str], Mapping[str, DataFrame]] | None = None,
        log: RunLog | None = None,
        history_days: int | None = None,
    ):
        """``root`` is a folder that the driver and all executors share.
        ``features(history, day_rows)`` builds the rows to score (e.g. test-mode
        :func:`hourcast.plans.features.build_features`); by default the value's
        positional lags. With ``side_tables(day)`` (the day's rows of each side
        table) it is called as ``features(history, day_rows, tables)``, where
        ``tables(name)`` reads the newest version of every key so far.
        ``hidden`` columns are unknown for the day's rows and set to null
        (default: the value). ``history_days`` is how many days back ``features``
        reads; older partitions are then not read (default: all are). With ``log`` every day's revealed rows and forecasts
        are counted as they are written, in a stage named by the day."""
        self.spark = spark
        self.fact = fact if "_day" in fact.columns else fact.withColumn("_day", F.date_format(F.col(ts_col), "yyyy-MM-dd"))
        self.value_col, self.ts_col, self.keys = value_col, ts_col, list(keys)
        self.lags = list(lags)
        self.model = model or naive_day_ahead(value_col, min(self.lags))
        self.root = root.rstrip("/")
        self.history, self.output, self.manifest, self.checkpoint, self.sides, self.tails, self.ledger = (
            f"{self.root}/{part}" for part in ("history", "predictions", "manifest", "checkpoint", "sides", "tails", "ledger"))
        self.features = features
        self.hidden = list(hidden) if hidden is not None else [value_col]
        self.side_tables = side_tables
        self._gone: list[str] | None = None
        self.log = log
        self.history_days = history_days

    def seed_history(self, before_day: str) -> None:
        """History = every fact row before the first replayed day."""
        rows = self.fact.filter(F.col("_day") < before_day)
        self._put(rows, self.history)
        self._put(day_digests(rows), self.ledger)

    def _reveal(self, days: Sequence[str]) -> None:
        """The days' rows become history as they are now, and the ledger says so
        (one row per day). A day without rows is withdrawn."""
        rows = self.fact.filter(F.col("_day").isin(list(days)))
        self._put(rows, self.history)
        found = {r["_day"]: tuple(r) for r in day_digests(rows).collect()}
        ledger = [found.get(day, (0, None, None, day)) for day in days]
        self._put(self.spark.createDataFrame(ledger, LEDGER_SCHEMA), self.ledger)
        self._gone = sorted({*self._withdrawn(), *days} - found.keys())
        if self.log is not None:
            for day in days:
                self.log.note(f"revealed {day}", {"rows": {"rows": found[day][0] if day in found else 0}})

    def _revealed(self) -> DataFrame:
        """The ledger: one row per revealed day."""
        if not self._days(self.ledger):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger)

    def _withdrawn(self) -> list[str]:
        """Revealed days that have no rows any more: one name per day, read once."""
        if self._gone is None:
            self._gone = [r["_day"] for r in self._revealed().filter("n = 0").select("_day").collect()]
        return self._gone

    def _put(self, df: DataFrame, folder: str) -> None:
        """Replace the day partitions that ``df`` holds."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day").parquet(folder)

    def _days(self, folder: str) -> list[str]:
        """The days that a folder holds, by the names of its partitions."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(n.removeprefix("_day=") for n in names if n.startswith("_day="))

    def _read(self, folder: str) -> DataFrame:
        if not self._days(folder):  # nothing written yet
            empty = self.spark.createDataFrame([], self.fact.schema)
            return empty.withColumn("_of", F.col("_day")) if folder == self.tails else empty
        df = self.spark.read.parquet(folder)
        df = df.withColumn("_day", F.col("_day").cast("string"))
        gone = self._withdrawn() if folder in (self.history, self.output) else []
        return df.filter(~F.col("_day").isin(gone)) if gone else df

    def _tail(self, day: str, good: str | None) -> DataFrame:
        """The last ``max(lags)`` rows of each series before ``day``: from an
        earlier day's tail, not after ``good``, and the history since, which holds
        what was revealed or corrected. Written as the tail of ``day``."""
        since = [d for d in self._days(self.tails) if d < day and (good is None or d <= good)]
        history = self._read(self.history).filter(F.col("_day") < day)
        if since:
            kept = self._tail_of(since[-1])
            history = kept.unionByName(history.filter(F.col("_day") >= since[-1]))
        newest = Window.partitionBy(*self.keys).orderBy(F.desc(self.ts_col), F.desc("row_id"))
        tail = history.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= max(self.lags)).drop("_n")
        # Only this day's partition is replaced, and no read above is of it.
        self._put(tail.withColumn("_of", F.col("_day")).withColumn("_day", F.lit(day)), self.tails)
        return self._tail_of(day)

    def _tail_of(self, day: str) -> DataFrame:
        return self._read(self.tails).filter(F.col("_day") == day).withColumn("_day", F.col("_of")).drop("_of")

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        # The manifest batch holds one control record per day (never data rows).
        steps = sorted((r.asDict() for r in batch.collect()), key=lambda r: r["seq"])
        for step in steps:
            reveals = [*(step.get("reveals") or []), *([step["reveal"]] if step["reveal"] else [])]
            day = step["day"]
            if day is not None:
                done = self._days(self.output)
                if done and day < done[-1] and day not in done:
                    raise ValueError(f"day {day} comes before {done[-1]}, which is committed")
            if reveals:  # the days' actuals, also if they were corrected since
                self._reveal(reveals)
            if day is not None:
                self._one_day(day, step.get("since") or step["reveal"])

    def _one_day(self, day: str, good: str | None) -> None:
        if self.side_tables is not None:
            number = (dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days
            write_snapshot(self.side_tables(day), self.sides, number)
        todo = self.fact.filter(F.col("_day") == day).withColumns({c: F.lit(None).cast("double") for c in self.hidden})
        if self.features is not None:
            history = self._read(self.history).filter(F.col("_day") < day)
            if self.history_days is not None:
                first = dt.date.fromisoformat(day) - dt.timedelta(days=self.history_days)
                history = history.filter(F.col("_day") >= first.isoformat())
            history = history.drop("_day")
            more = [lambda name: read_snapshot(self.spark, self.sides, name)] if self.side_tables is not None else []
            feats = self.features(history, todo.drop("_day"), *more)
        else:
            both = self._tail(day, good).withColumn("_new", F.lit(False)).unionByName(todo.withColumn("_new", F.lit(True)))
            feats = add_positional_lags(both, [self.value_col], self.lags, self.keys, [self.ts_col, "row_id"]).filter("_new")
        preds = feats.select("row_id", self.ts_col, F.coalesce(self.model(feats), F.lit(0.0)).alias("prediction"), F.lit(day).alias("_day"))
        if self.log is None:
            self._put(preds, self.output)
            return
        watched, metrics = observed(preds, f"forecasts of {day}", ["prediction"])
        self._put(watched, self.output)
        self.log.note(day, {"forecasts": metrics()})

    def run(self, days: Sequence[str]) -> DataFrame:
        """Replay ``days`` and return all forecasts, the newest for each day."""
        write_manifest(self.spark, self.manifest, list(days))
        return self._stream()

    def _stream(self) -> DataFrame:
        stream = self.spark.readStream.schema(MANIFEST_SCHEMA).option("maxFilesPerTrigger", 1).json(self.manifest)
        query = (
            stream.writeStream.foreachBatch(self._process)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self._read(self.output).drop("_day")

    def corrections(self, since: str = "") -> list[str]:
        """The days, from ``since`` up to the last revealed one, whose rows are not
        those that were revealed: changed, added or withdrawn. One scan of the
        fact's days, reduced to a row per day before anything is shuffled."""
        known = self._revealed().filter(F.col("_day") >= since)
        last = known.agg(F.max("_day")).scalar()
        now = day_digests(self.fact.filter((F.col("_day") >= since) & (F.col("_day") <= last)))
        names = {c: f"_now_{c}" for c in now.columns}
        both = known.filter("n > 0").join(now.withColumnsRenamed(names), F.col("_day") == F.col("_now__day"), "full")
        same = F.lit(True)
        for c in ("n", "sum_a", "sum_b"):
            same = same & F.col(c).eqNullSafe(F.col(f"_now_{c}"))
        return sorted(r[0] for r in both.filter(~same).select(F.coalesce("_day", "_now__day")).collect())

    def readers(self, day: str) -> list[str]:
        """The forecast days whose work read rows of ``day``, or would have read
        those that it has now; and ``day`` itself, whose rows were forecast."""
        done = [d for d in self._days(self.output) if d >= day]
        later = [d for d in done if d > day]
        if self.features is not None or not later:
            return done
        series = self._read(self.history).filter(F.col("_day") == day).select(*self.keys).unionByName(
            self.fact.filter(F.col("_day") == day).select(*self.keys)).distinct()
        after = self._read(self.tails).filter((F.col("_day") > day) & (F.col("_of") > day))
        full = after.groupBy("_day", *self.keys).count().filter(F.col("count") >= max(self.lags))
        shut = join_same(series, full, self.keys, "inner").groupBy("_day").count()
        n = series.agg(F.count(F.lit(1))).scalar()
        free = {r["_day"] for r in shut.filter(F.col("count") == n).select("_day").collect()}
        return [d for d in done if d not in free]

    def correct(self, since: str = "") -> DataFrame:
        """Take over all corrections since a day: reveal the days that changed and
        redo the forecasts that read them, the earliest first, each on the tail of
        the one before. The first one's tail is built from the latest tail before
        the changes, or from the whole history if they lie before the first
        forecast. Returns all forecasts."""
        changed = self.corrections(since)
        if not changed:
            return self._read(self.output).drop("_day")
        redo = sorted({d for day in changed for d in self.readers(day)})
        rows = [(None, -1, None, changed, None)]
        # A tail is good up to the first change; from then on, the one redone before.
        rows += [(day, i, None, None, redo[i - 1] if i else changed[0]) for i, day in enumerate(redo)]
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(self.manifest)
        return self._stream()


def group_frames(frames: dict[str, DataFrame], group_col: str, group_id, keep_group: bool = False) -> dict[str, DataFrame]:
    """The rows of every frame that belong to one group id (one replay step);
    the group column is dropped unless ``keep_group``."""
    out = {}
    for name, df in frames.items():
        part = df.filter(F.col(group_col) == F.lit(group_id))
        out[name] = part if keep_group else part.drop(group_col)
    return out


def group_order(df: DataFrame, group_col: str, seq_col: str) -> DataFrame:
    """Group ids in order of first appearance: (group, first_seq, position)."""
    from ..operators.series import distributed_row_number

    first = df.groupBy(group_col).agg(F.min(seq_col).alias("first_seq"))
    return distributed_row_number(first, ["first_seq", group_col], [], name="position")
