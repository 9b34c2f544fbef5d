"""A server's batch: independent steps at the same time, layers that plainly fit without a trial."""

from __future__ import annotations

import itertools
import json
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tests.test_workspace import started
from tidescore.operators import batch_scoring, dispatch
from tidescore.schemas import FEATURES
from tidescore.sources.tensor import dense_params, fitting_layers
from tidescore.streaming import serve
from tidescore.streaming.workspace import Workspace


def test_a_batch_writes_and_resolves_at_the_same_time(spark, monkeypatch):
    """Accepted models, dead letters and models in force are written while records are scored; resolution and lookup too."""
    writes, prepared = Barrier(4, timeout=120), Barrier(2, timeout=120)
    write, resolve, others = Workspace.write, dispatch.resolve_after, dispatch._other_kinds
    monkeypatch.setattr(Workspace, "write", lambda self, df, name, *a: (name == "stats" or writes.wait()) and False or write(self, df, name, *a))
    monkeypatch.setattr(dispatch, "resolve_after", lambda *a, **k: prepared.wait() and False or resolve(*a, **k))
    monkeypatch.setattr(dispatch, "_other_kinds", lambda *a: prepared.wait() and False or others(*a))
    target, running = started(spark, "steps", ["a", "b"], 3, 300, at_least=1)
    running.awaitTermination()
    held = Workspace(spark, target).manifest()
    assert held.batch == 0 and set(held.tables) == {"models", "current", "scored", "stats", "dead"}
    assert serve.read(spark, target, "scored").count() == 300 and serve.read(spark, target, "current").count() == 2
    assert {r.usage for r in serve.serve_stats(spark, target).collect()} and held.metrics["usage"] == 300


def test_an_error_in_a_step_stops_the_batch(spark, monkeypatch):
    write = Workspace.write

    def fail(self, df, name, *a):
        if name == "dead":
            raise OSError("no room")
        return write(self, df, name, *a)

    monkeypatch.setattr(Workspace, "write", fail)
    target, running = started(spark, "stops", ["a"], 2, 30, at_least=1)
    with pytest.raises(Exception, match="no room"):
        running.awaitTermination()
    assert Workspace(spark, target).batches() == []


def test_layers_that_fit_need_no_trial(spark, monkeypatch):
    """Where layers plainly fit, the trial agrees; and such models are not tried."""
    def rows(n, width):
        return [[1.0] * width for _ in range(n)]

    width = len(FEATURES)
    shapes = [rows(2, width), rows(1, width), rows(2, 3), rows(2, 2), [[1.0] * width, [1.0]], [[1.0] * width, None], [], [[None] * width]]
    documents = [
        {"layers": [{"activation": a, "normalization": n, "bias": b, "weights": w}]}
        for a, n, b, w in itertools.product(("relu", None, "selu"), ("none", "softmax", None), ([0.0, 0.0], [0.0], [None, 0.0], []), shapes)]
    documents += [
        {"layers": [{"activation": "tanh", "bias": [0.0] * 3, "weights": rows(3, width)},
                    {"activation": last, "bias": [0.0] * 2, "weights": second}]}
        for last in ("softmax", "selu") for second in (rows(2, 3), rows(2, 4), rows(2, width), [[1.0] * 3, None])]
    documents += [{"layers": []}, {"layers": None}, {}, {"layers": [None]}]
    data = spark.createDataFrame([(i, bytearray(json.dumps(d).encode())) for i, d in enumerate(documents)], "id long, data binary")
    found = data.withColumn("params", dense_params(F.col("data"))).where(F.col("params").isNotNull()).select(
        "id", "params", fitting_layers(F.col("params.layers")).alias("fits")).collect()
    fitting = [r.id for r in found if r.fits]
    # relu or no activation, three normalisations, two units and one; and the second layer of three inputs.
    assert len(fitting) == 2 * 3 * 2 + 1
    tried = {r.id: batch_scoring.trial(r.params.asDict(True)) for r in found}
    assert all(tried[i] is None for i in fitting)
    assert any(error for i, error in tried.items()) and len(found) > len(fitting)
