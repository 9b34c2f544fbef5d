"""Keyed scoring in event time: rows wait until the watermark has passed them and are applied in time order.

`keyed` applies the rows of a key in the order of the micro-batches, and inside one by time. Here arrival
does not count: a row goes to the waiting list of its key, and a timer at the earliest waiting time fires once
the watermark (the latest time seen less `delay`) is there. It releases every waiting row up to the
watermark, sorted, so a record meets the model whose time is the latest at or before its own, in whatever
order the two arrived.

Late rows: a row whose time is not after the watermark that the batch before its own worked with is dropped by
Spark before it gets here, records and models alike, and counted in the progress
(`numRowsDroppedByWatermark`). All others are released exactly once. Rows without a time are dropped too.
The rows of the last `delay` stay in the state until later ones arrive.

Keys are hashed into buckets as in `keyed`, and a bucket has one waiting list, in blocks of Arrow data, and one
timer. It holds its keys' rows of the last `delay` and of one batch. Spark sees the single rows, not blocks, and so
drops and counts the late ones itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from tidescore.session import use_rocksdb
from tidescore.streaming.keyed import (
    BLOCK, DEFAULT_SHARDS, PagedScorer, VersionedScorer, bucket_of, from_blocks, sharded, to_block, unpacked)

WAITING = T.StructType(
    [
        T.StructField("is_model", T.BooleanType()),
        T.StructField("ts", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("duration", T.LongType()),
    ]
)


def listed(values) -> list[float] | None:
    return None if values is None else [float(v) for v in values]


class EventTimeScorer(VersionedScorer):
    """Holds rows back until the watermark has passed them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for chunk in rows:
            chunk = chunk[chunk["ts"].notna()]
            if chunk.empty:
                continue
            times = chunk["ts"].to_numpy("datetime64[us]").astype(np.int64).tolist()
            self.waiting.appendList([
                (bool(m), t, int(i), listed(w), listed(x), None if pd.isna(d) else int(d))
                for m, t, i, w, x, d in zip(chunk["is_model"], times, chunk["id"], chunk["weights"], chunk["features"], chunk["duration"])])
            earliest = min(times) if earliest is None else min(earliest, min(times))
        if earliest is not None:
            self._wake(earliest)
        return iter(())

    def _wake(self, micros: int) -> None:
        """One timer a key, at its earliest waiting row."""
        at, known = -(-micros // 1000), list(self.handle.listTimers())
        if not known or at < min(known):
            for old in known:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        ready, later = [], []
        for row in self.waiting.get():
            (ready if row[1] <= until else later).append(tuple(row))
        if later:
            self.waiting.put(later)
        else:
            self.waiting.clear()
        if ready:
            frame = pd.DataFrame(ready, columns=WAITING.names)
            frame["ts"] = pd.to_datetime(frame["ts"], unit="us")
            frame["duration"] = frame["duration"].astype("float64")
            yield from super().handleInputRows(key, iter([frame]), timerValues)
        if later:
            self.handle.registerTimer(-(-min(r[1] for r in later) // 1000))


def row_block(frame: pd.DataFrame) -> pa.Table:
    """Rows as Spark gives them -> BLOCK, without those that have no time."""
    frame = frame[frame["ts"].notna()]
    times = frame["ts"].to_numpy("datetime64[us]").astype(np.int64)
    return pa.Table.from_arrays(
        [pa.array(times) if f.name == "ts" else pa.array(frame[f.name], f.type, from_pandas=True) for f in BLOCK], schema=BLOCK)


class BucketEventTimeScorer(PagedScorer):
    """`EventTimeScorer` for the keys of a bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")

    _wake = EventTimeScorer._wake

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        table = pa.concat_tables([BLOCK.empty_table(), *[row_block(chunk) for chunk in rows]]).combine_chunks()
        if len(table):
            self.waiting.appendList([(to_block(table),)])
            self._wake(int(table["ts"].to_numpy().min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        held = [bytes(row[0]) for row in self.waiting.get()]
        if not held:
            return
        table = from_blocks(held).combine_chunks()
        ready = table["ts"].to_numpy() <= until
        later = table.filter(pa.array(~ready)).combine_chunks()
        if len(later):
            self.waiting.put([(to_block(later),)])
        else:
            self.waiting.clear()
        yield from self.score(table.filter(pa.array(ready)))
        if len(later):
            self.handle.registerTimer(-(-int(later["ts"].to_numpy().min()) // 1000))


def event_time_scoring(stream: DataFrame, delay: str, shards: int = DEFAULT_SHARDS, swap: str = "immediate",
                       emit_models: bool = False) -> DataFrame:
    """Stream in `keyed.INPUT_SCHEMA` -> one row per record, once no earlier row can come any more.

    `delay` is how much later than the latest row a row may come, as an interval such as `10 minutes`.
    """
    use_rocksdb(stream.sparkSession)
    timed = stream.withWatermark("ts", delay)
    rows = sharded(timed, shards).withColumn("bucket", bucket_of("data_type", "shard"))
    return unpacked(rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=BucketEventTimeScorer(swap, emit_models),
        outputStructType="rows binary",
        outputMode="Append",
        timeMode="EventTime",
    ))


def late_rows(progress: list) -> int:
    """Rows that a run has dropped as late, from its progress reports."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p["stateOperators"])
