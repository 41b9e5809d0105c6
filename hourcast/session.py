"""Session defaults and the shared checkpoint folder.

Every table holds local wall-clock time as ``TIMESTAMP_NTZ``; the session zone
is pinned to UTC so that the few places that must cross into ``TIMESTAMP``
(watermarks in streaming) do not shift hours. ANSI mode stays on so a bad cast
raises instead of silently producing null, and AQE re-plans joins at runtime:
a dimension that turns out small is broadcast from its measured size, a large
one stays a sort-merge join.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files once nothing references them (long sessions).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "hourcast",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster, leave ``master`` to the launcher and size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM: give it a real heap.
        conf["spark.driver.memory"] = os.environ.get("HOURCAST_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets this to a path that the driver and every
    executor share. Only a local session (a test on one machine) gets a fresh
    scratch folder when none is set; on any other master a missing setting is
    an error, because a machine-local folder would lose files with an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="hourcast-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "hourcast", *parts])


def materialize(df, partition_by=()):
    """Write ``df`` once as Parquet in the shared checkpoint folder and continue
    from the written table. The lineage is cut, the files survive the loss of
    an executor, and later steps still prune columns and push filters into the
    scan. Use it for a stage output that later steps read several times."""
    spark = df.sparkSession
    path = scratch_path(spark, uuid.uuid4().hex)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(written) -> bool:
    """Whether a written table is below the session's broadcast threshold, by the
    size of its files (the rule Spark itself applies to a scan)."""
    limit = written.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit
