"""Event time: rows in any order of arrival give the answer of the time order; late rows go and are counted."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_streaming import Cell, Handle
from tidescore.session import scratch_path
from tidescore.sources.staged import play, read_staged
from tidescore.streaming import event_time, keyed, sinks

START = datetime(2024, 1, 1)


class Lists(Handle):
    def __init__(self):
        super().__init__()
        self.rows, self.timers = Rows(), set()

    def getListState(self, name, schema):
        return self.rows

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Rows:
    def __init__(self):
        self.held = []

    def appendList(self, rows):
        self.held += rows

    def put(self, rows):
        self.held = list(rows)

    def get(self):
        return iter(list(self.held))

    def clear(self):
        self.held = []


class Mark:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentWatermarkInMs(self):
        return self.millis


def frame(rows):
    names = ["is_model", "ts", "id", "weights", "features", "duration"]
    return pd.DataFrame([dict(zip(names, (m, START + timedelta(seconds=s), i, w, x, None if m else 1))) for m, s, i, w, x in rows])


@pytest.mark.parametrize("seed", range(5))
def test_any_order_of_arrival(seed):
    """The processor alone: rows shuffled over batches, watermarks in between, against the order of time."""
    rng = random.Random(seed)
    rows = [(rng.random() < 0.3, rng.randrange(300), i) for i in range(200)]
    rows = [(m, s, i, [0.0, float(i)] if m else None, None if m else [1.0]) for m, s, i in rows]
    want, handle = {}, Lists()
    for m, s, i, _, _ in rows:
        if not m:
            models = [(t, k) for q, t, k, _, _ in rows if q and t <= s]
            want[i] = max(models)[1] if models else None
    scorer = event_time.EventTimeScorer()
    scorer.init(handle)
    assert all(isinstance(c, Cell) for c in handle.cells.values())
    arrival = sorted(rows, key=lambda r: r[1] + rng.randrange(60))
    got, base = {}, int(pd.Timestamp(START).value // 1_000_000)
    for low in range(0, 200, 25):
        assert list(scorer.handleInputRows(("a", 0), iter([frame(arrival[low : low + 25])]), None)) == []
        mark = base + 1000 * (max(r[1] for r in arrival[: low + 25]) - 60) if low + 25 < 200 else base + 10**6
        for at in [t for t in handle.listTimers() if t <= mark]:
            handle.deleteTimer(at)
            for out in scorer.handleExpiredTimer(("a", 0), Mark(mark), None):
                got |= {i: None if pd.isna(v) else int(v) for i, v in zip(out["id"], out["version"])}
    assert got == want and handle.rows.held == [] and not handle.timers


def test_late_rows_are_counted(spark):
    rows = [("a", True, 0, 1), ("a", False, 5, 10), ("a", False, 100, 11), ("a", True, 200, 2), ("a", False, 300, 12),
            ("a", False, 400, 13), ("a", False, 3, 14), ("a", False, 150, 15), ("a", False, 900, 16)]
    batch = [0, 0, 1, 1, 2, 3, 4, 4, 5]
    data = [(t, m, START + timedelta(seconds=s), i, [0.0, 1.0] if m else None, None if m else [2.0], None, b)
            for (t, m, s, i), b in zip(rows, batch)]
    schema = T.StructType([*keyed.INPUT_SCHEMA.fields, T.StructField("batch", T.IntegerType())])
    table = spark.createDataFrame(data, schema)
    source, path, checkpoint = (scratch_path(spark, n) for n in ("late-stage", "late-out", "late-checkpoint"))
    play(table.drop("batch"), source, arrival=_batch_of(table))
    stream = read_staged(spark, source, keyed.INPUT_SCHEMA)
    scored = event_time.event_time_scoring(stream, "100 seconds", shards=2)
    running = sinks.table(scored, path, checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    got = {r.id: r.version for r in spark.read.schema(keyed.OUTPUT_SCHEMA).parquet(path).collect()}
    # 14 and 15 come in batch 4, whose predecessor worked with the watermark 300 - 100; 16 still waits.
    assert got == {10: 1, 11: 1, 12: 2, 13: 2} and event_time.late_rows(running.recentProgress) == 2


def _batch_of(table):
    cases = F.lit(None)
    for r in table.select("id", "is_model", "batch").collect():
        cases = F.when((F.col("id") == r.id) & (F.col("is_model") == r.is_model), r.batch).otherwise(cases)
    return cases
