"""History snapshots of the side tables (S10, ST2): a log of batches in tiers.

Each ingest batch of a table is one delta; writing a batch id again replaces it.
The read side is a keep-last view: per table key, the row of the greatest batch
id wins. Deltas alone would make every read scan all batches, so ``fan`` of them
are compacted into a tier that holds one row per key (with its batch id), ``fan``
tiers of a level into one of the next, and a read takes the tiers and the few
deltas since: at most ``fan`` folders a level, with ``buckets`` files each by key
hash, whatever the number of batches. A row is rewritten once per level.

What a read takes stands in a manifest file. A new version is written beside and
renamed into place, so a write or a compaction becomes visible at once, and one
that is killed changes nothing. Deltas stay: replacing a batch that tiers already
hold puts those tiers out of use, and their batches count as deltas again until
the next compaction. One writer per table.

::

    <root>/<table>/batch/<id>-<unique>   a delta
    <root>/<table>/tier/<unique>         a compacted tier
    <root>/<table>/manifest/<version>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import keep_last
from ..schemas import TABLE_KEYS

BATCH_COL = "batch_id"
FAN = 8
KEPT_VERSIONS = 3  # manifest files that stay


class SnapshotLog:
    """The batches and tiers of one table."""

    def __init__(self, spark: SparkSession, root: str, name: str, keys: Sequence[str] | None = None, fan: int = FAN, buckets: int = 1):
        if fan < 2:
            raise ValueError("fan must be at least 2")
        self.spark, self.keys, self.fan, self.buckets = spark, list(keys or TABLE_KEYS[name]), fan, buckets
        self.at = "/".join([root.rstrip("/"), name])

    # ------------------------------------------------------------ manifest

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.at, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        files, folder = self._files(), self._path("manifest")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self) -> dict:
        """{"version", "batches": {id: folder}, "tiers": [{"level", "ids", "folder"}]}
        of the newest version: names only, never rows."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "batches": {}, "tiers": []}
        stream = self._files().open(self._path("manifest", f"{versions[-1]}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, manifest: dict) -> None:
        """Make ``manifest`` the newest version by one rename."""
        files, version = self._files(), manifest["version"] + 1
        new = self._path("manifest", f"new-{uuid.uuid4().hex}")
        out = files.create(new, False)
        out.write(bytearray(json.dumps({**manifest, "version": version}).encode()))
        out.close()
        if not files.rename(new, self._path("manifest", f"{version}.json")):
            raise RuntimeError(f"version {version} of {self.at} exists: there is another writer")
        for old in self._versions()[:-KEPT_VERSIONS]:
            files.delete(self._path("manifest", f"{old}.json"), False)

    # ------------------------------------------------------------ rows

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.repartition(self.buckets, *self.keys).write.parquet(f"{self.at}/{folder}")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        paths = [f"{self.at}/{f}" for f in folders]
        return self.spark.read.schema(self.spark.read.parquet(paths[-1]).schema).parquet(*paths)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key: the greatest batch id; within a batch the greatest row."""
        versions = [BATCH_COL, *[c for c in rows.columns if c not in (*self.keys, BATCH_COL)]]
        return keep_last(rows, self.keys, versions)

    @staticmethod
    def _deltas(manifest: dict) -> list[int]:
        held = {i for t in manifest["tiers"] for i in t["ids"]}
        return sorted(int(i) for i in manifest["batches"] if int(i) not in held)

    def folders(self) -> list[str]:
        """What a read takes, oldest batches first."""
        manifest = self.manifest()
        return [t["folder"] for t in manifest["tiers"]] + [manifest["batches"][str(i)] for i in self._deltas(manifest)]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Append batch ``batch_id``, or replace it."""
        folder = f"batch/{int(batch_id)}-{uuid.uuid4().hex}"
        self._write(rows.withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long")), folder)
        manifest = self.manifest()
        manifest["batches"][str(int(batch_id))] = folder
        manifest["tiers"] = [t for t in manifest["tiers"] if int(batch_id) not in t["ids"]]
        self._switch(manifest)

    def compact(self) -> int:
        """Merge ``fan`` deltas into a tier, and ``fan`` tiers of a level into one
        of the next, as long as there are so many. Returns the tiers written."""
        done = 0
        while True:
            manifest = self.manifest()
            deltas, tiers = self._deltas(manifest), manifest["tiers"]
            level = next((k for k in sorted({t["level"] for t in tiers}) if sum(t["level"] == k for t in tiers) >= self.fan), None)
            if len(deltas) >= self.fan:
                level, ids, used, folders = 0, deltas, [], [manifest["batches"][str(i)] for i in deltas]
            elif level is not None:
                used = [t for t in tiers if t["level"] == level]
                ids, folders = sorted(i for t in used for i in t["ids"]), [t["folder"] for t in used]
            else:
                return done
            folder = f"tier/{uuid.uuid4().hex}"
            self._write(self._newest(self._rows(folders)), folder)
            manifest["tiers"] = [t for t in tiers if t not in used] + [{"level": level + 1, "ids": ids, "folder": folder}]
            self._switch(manifest)
            done += 1

    def read(self) -> DataFrame:
        """Newest version of every key over all batches."""
        folders = self.folders()
        if not folders:
            raise FileNotFoundError(f"no batch at {self.at}")
        rows = self._rows(folders)
        return self._newest(rows).select(*[c for c in rows.columns if c != BATCH_COL])


def write_snapshot(tables: Mapping[str, DataFrame], root: str, batch_id: int, fan: int = FAN, buckets: int = 1) -> None:
    """Append (or replace) batch ``batch_id`` of every table under ``root/<table>``
    and compact what has become too many."""
    for name, df in tables.items():
        log = SnapshotLog(df.sparkSession, root, name, fan=fan, buckets=buckets)
        log.write(df, batch_id)
        log.compact()


def read_snapshot(spark: SparkSession, root: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Newest version of every key of table ``name`` over all batches."""
    return SnapshotLog(spark, root, name, keys).read()
