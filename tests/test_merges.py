"""Merges of a workspace: a row is written once a commit, by many tasks, and tables are merged side by side."""

from __future__ import annotations

import os
from threading import Event

import pytest
from pyspark.sql import functions as F

from tidescore.session import scratch_path, scratch_scope, side_by_side
from tidescore.streaming import workspace
from tidescore.streaming.workspace import Workspace


def test_full_tiers_are_merged_in_one_write(spark, tmp_path, monkeypatch):
    space, written = Workspace(spark, str(tmp_path), fan=2), []
    one = Workspace._merged
    monkeypatch.setattr(Workspace, "_merged", lambda self, name, folders, *a: written.append(sum(map(len, folders))) or one(self, name, folders, *a))
    for batch in range(8):
        folder, _ = space.write(spark.range(1).select(F.lit(batch).alias("batch")), "rows", batch)
        tiers = [t for _, t in space.commit(batch, {"rows": folder}).tables["rows"]]
        assert sorted(tiers) == [i for i in range(4) if batch + 1 >> i & 1]  # the batches counted in binary
    assert written == [2, 3, 2, 4]  # one write a commit, whatever the number of full tiers
    assert sorted(r.batch for r in space.read("rows").collect()) == list(range(8))


def test_a_merge_has_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "BYTES_PER_TASK", 20_000)
    space = Workspace(spark, str(tmp_path), fan=2)
    rows = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(8)
    for batch in range(2):
        folder, _ = space.write(rows, "rows", batch)
        manifest = space.commit(batch, {"rows": folder})
    ((merged, tier),) = manifest.tables["rows"]
    assert tier == 1 and sum(n.endswith(".parquet") for n in os.listdir(tmp_path / merged)) > 1
    assert space.read("rows").count() == 80_000


def test_steps_run_at_the_same_time(spark):
    """Each waits for the other; both have the caller's scope and job group; an error is raised when all have ended."""
    here, there = Event(), Event()
    spark.sparkContext.setLocalProperty("tidescore.test", "mine")

    def step(mine, other):
        mine.set()
        assert other.wait(60)
        return scratch_path(spark, "step"), spark.sparkContext.getLocalProperty("tidescore.test")

    with scratch_scope(spark):
        paths, found = zip(*side_by_side(spark, lambda: step(here, there), lambda: step(there, here)))
        for path in paths:
            spark.range(1).write.parquet(path)
    assert found == ("mine", "mine") and not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    ended = []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1 / 0, lambda: ended.append(spark.range(3).count()))
    assert ended == [3]
