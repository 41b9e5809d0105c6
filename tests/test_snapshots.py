"""Tiered snapshots against a dictionary, and what a killed step leaves."""

import random

import pytest

from hourcast.sources.snapshots import SnapshotLog, read_snapshot, write_snapshot

SCHEMA = "k long, v double"


def log_of(spark, root, **how):
    return SnapshotLog(spark, root, "t", ["k"], **how)


def expected(batches):
    out = {}
    for b in sorted(batches):
        out.update(batches[b])
    return out


def got(log):
    rows = log.read().collect()
    assert len({r["k"] for r in rows}) == len(rows)
    return {r["k"]: r["v"] for r in rows}


def test_tiers_keep_the_newest(spark, tmp_out):
    log, rng, batches = log_of(spark, tmp_out, fan=3, buckets=2), random.Random(3), {}
    for step in range(40):
        b = step if step % 9 else rng.randrange(step + 1)  # now and then an old batch again
        batches[b] = {rng.randrange(25) if rng.random() < 0.95 else None: rng.choice([None, float(step)]) for _ in range(6)}
        log.write(spark.createDataFrame(list(batches[b].items()), SCHEMA), b)
        if step % 2:
            log.compact()
        if step % 8 == 7:
            assert got(log) == expected(batches)
    log.compact()
    levels = [t["level"] for t in log.manifest()["tiers"]]
    assert max(levels) >= 2 and all(levels.count(k) < 3 for k in levels) and len(log._deltas(log.manifest())) < 3
    assert got(log) == expected(batches)
    # At most two tiers a level and two deltas, two files each; the manifest folder stays short.
    assert len(log.read().inputFiles()) <= 2 * (2 * max(levels) + 2)
    assert len(log._versions()) == 3


def test_the_number_of_folders_is_bounded():
    """The manifest of 1,000 batches, by the same rule without the rows."""

    class Names(SnapshotLog):
        def __init__(self):
            self.fan, self.state, self.moved = 8, {"version": 0, "batches": {}, "tiers": []}, 0

        def manifest(self):
            return {"version": 0, "batches": dict(self.state["batches"]), "tiers": list(self.state["tiers"])}

        def _switch(self, manifest):
            self.state = manifest

        def _write(self, rows, folder):
            pass

        def _rows(self, folders):
            self.moved += len(folders)

        def _newest(self, rows):
            pass

    log = Names()
    for b in range(1000):
        log.state["batches"][str(b)] = f"batch/{b}"
        log.compact()
        assert len(log.folders()) <= 7 * 4
    assert sorted(i for t in log.state["tiers"] for i in t["ids"]) == list(range(1000 - 1000 % 8))
    assert log.moved <= 1000 + 125 * 2


def test_a_killed_step_changes_nothing(spark, tmp_out, monkeypatch):
    log, batches = log_of(spark, tmp_out, fan=2), {b: {1: float(b), b: 0.5} for b in range(2)}
    for b, rows in batches.items():
        log.write(spark.createDataFrame(list(rows.items()), SCHEMA), b)
    before = log.manifest()

    def killed(manifest):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(log, "_switch", killed)
        with pytest.raises(OSError):
            log.compact()
        with pytest.raises(OSError):
            log.write(spark.createDataFrame([(1, 9.0)], SCHEMA), 7)
    assert log.manifest() == before and got(log) == expected(batches)
    assert log.compact() == 1 and got(log) == expected(batches)


def test_snapshots_without_rows(spark, tmp_out):
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, tmp_out, "none", ["k"])
    empty = spark.createDataFrame([], "date date, county tinyint, is_business boolean, product_type tinyint, installed_capacity double")
    write_snapshot({"client": empty}, tmp_out, 0)
    assert read_snapshot(spark, tmp_out, "client").count() == 0
