"""The log of a run: what each stage wrote, in one table.

A stage's row count, its nulls in chosen columns and its span of time are taken
by an ``Observation`` while the stage is written, so no stage is read again to be
counted. Rows go to a runs table partitioned by run and stage: logging a stage
again replaces its partition. A streaming query's progress comes in through a
``StreamingQueryListener``.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import materialize

SCHEMA = "step string, metric string, value double, recorded_at timestamp_ntz, run_id string, stage string"


def observed(df: DataFrame, name: str, nulls_of: Sequence[str] = ()) -> tuple[DataFrame, Callable[[], dict[str, float]]]:
    """(``df`` observed, its metrics after the next action): rows, and the nulls
    of each column in ``nulls_of``."""
    seen = Observation(name)
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls.{c}") for c in nulls_of]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), lambda: {k: float(v) for k, v in seen.get.items()}


class RunLog:
    """Rows about one run in the runs table at ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path.rstrip("/"), run_id

    def note(self, stage: str, metrics: dict[str, dict[str, float]]) -> None:
        """Replace what is known of ``stage``: {step: {metric: value}} (a few numbers)."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(step, metric, float(value), now, self.run_id, stage) for step, found in metrics.items() for metric, value in found.items()]
        (self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "stage").parquet(self.path))

    def stage(self, name: str, df: DataFrame, nulls_of: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` as the stage's output, log its rows, nulls and seconds, and
        go on from the written table."""
        watched, metrics = observed(df, name, nulls_of)
        start = time.time()
        out = materialize(watched)
        self.note(name, {name: {**metrics(), "seconds": time.time() - start}})
        return out

    def read(self) -> DataFrame:
        """All that is known of all runs in the table."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)


class StreamLog(StreamingQueryListener):
    """Progress of streaming queries, noted in a :class:`RunLog`: one stage per
    query with the input rows and milliseconds of each micro-batch.

    Progress is kept as it arrives and noted by :meth:`flush`; a listener must not
    hold up Spark's event bus with jobs of its own."""

    def __init__(self, log: RunLog, stage: str = "stream"):
        self.log, self.stage, self.batches = log, stage, {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.batches[p.batchId] = {"input_rows": p.numInputRows, "milliseconds": p.durationMs.get("triggerExecution", 0)}

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def flush(self) -> None:
        """Note the progress of all batches whose events have arrived."""
        self.log.spark._jsc.sc().listenerBus().waitUntilEmpty()
        if self.batches:
            self.log.note(self.stage, {f"batch {k}": v for k, v in sorted(self.batches.items())})
