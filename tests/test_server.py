"""The server's batches: a missing snapshot stops it, scratch tables go, strange models stop nothing."""

import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidescore.session import _scratch_root, scratch_path, scratch_scope, scratch_table
from tidescore.streaming import keyed, micro_batch
from tests.test_models import START, versions_of, constant, stump


def test_scope_removes_its_tables(spark):
    with scratch_scope(spark):
        inner = scratch_table(spark.range(3), "inner")
        assert inner.count() == 3
        path = scratch_path(spark, "never-written")
    left = os.listdir(_scratch_root(spark)) if os.path.isdir(_scratch_root(spark)) else []
    assert not any(n.startswith(("inner-", "never-written-")) for n in left) and path
    kept = scratch_table(spark.range(3), "kept")
    assert kept.count() == 3


def test_missing_snapshot_stops_the_batch(spark, tmp_path):
    schema = versions_of(spark, []).schema
    assert micro_batch.snapshot_before(spark, str(tmp_path), 0, schema) is None
    start = versions_of(spark, [("a", 1, 0, constant(1.0)), ("a", 2, 5, constant(2.0))])
    assert [r.version for r in micro_batch.snapshot_before(spark, str(tmp_path), 0, schema, start).collect()] == [2]
    with pytest.raises(FileNotFoundError, match="before batch 3"):
        micro_batch.snapshot_before(spark, str(tmp_path), 3, schema)


class State:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def processor():
    p = keyed.VersionedScorer()
    p.current, p.pending, p.stats = State(), State(), State()
    return p


def chunk(*rows):
    names = ["is_model", "ts", "id", "weights", "features", "duration"]
    return pd.DataFrame([dict(zip(names, (m, START + timedelta(minutes=at), i, w, x, d))) for m, at, i, w, x, d in rows])


def test_models_of_other_widths_and_kinds_in_the_state():
    p = processor()
    first = chunk((True, 0, 1, [1.0, 2.0], None, None), (False, 1, 10, None, [3.0], 5.0),
                  (True, 2, 2, [1.0, 2.0, 3.0], None, None), (False, 3, 11, None, [3.0], None),
                  (True, 4, 3, None, None, None), (False, 5, 12, None, [3.0], 7.0))
    out = pd.concat(p.handleInputRows(("a", 0), iter([first]), None))
    assert out["id"].tolist() == [10, 11, 12] and out["version"].tolist() == [1, 2, 3]
    assert out["result"].tolist()[0] == 7.0 and out["result"].isna().tolist() == [False, True, True]
    assert [None if f is None else list(f) for f in out["features"]] == [None, [3.0], [3.0]]
    later = chunk((False, 9, 13, None, [4.0], 1.0), (True, 10, 4, [0.5, 1.0], None, None), (False, 11, 14, None, [4.0], 1.0))
    out = pd.concat(p.handleInputRows(("a", 0), iter([later]), None))
    assert out["version"].tolist() == [3, 4] and out["result"].tolist()[1] == 4.5 and p.current.get()[0] == 4


def test_complete_scores_open_rows(spark):
    versions = versions_of(spark, [("a", 1, 0, stump(3.0)), ("b", 1, 0, stump(4.0))])
    when = datetime(2024, 1, 2)
    rows = [("a", 0, False, 1, when, 1, when, None, 1, [1.0] * 11), ("b", 0, False, 2, when, 1, when, None, 1, [1.0] * 11),
            ("c", 0, False, 3, when, 1, when, 9.0, 1, None)]
    scored = spark.createDataFrame(rows, keyed.OUTPUT_SCHEMA)
    done = keyed.complete(scored, versions)
    assert {r.id: r.result for r in done.collect()} == {1: 3.0, 2: 4.0, 3: 9.0} and "features" not in done.columns
    assert done.where(F.col("result").isNull()).count() == 0
