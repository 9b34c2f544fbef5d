"""Keyed stateful scoring: each key holds its current model and that model's statistics.

A key is (data type, shard). Model messages go to every shard of their data type, records to
one shard by hash, so a data type with most of the records still uses many tasks. State holds
version numbers, the weights of sum models, and counters; documents stay in the registry. Records
of other kinds of models leave the stream with their version and inputs, and `complete` scores
them with the registry's parameters.

Keys are hashed into buckets, and a bucket is what Spark groups by: a call of the processor costs far more
than a key, and a stream may have many keys with a row or two each in a batch. A call to the state costs far
more than an entry too, so a bucket's entries lie in a few pages, each a block of Arrow data: a batch reads and
writes the pages of the keys it touches, and marks in them which keys those were. Rows travel packed, a block
per bucket and task. The rows of all keys of a bucket are worked on together as columns.

Rows of one bucket in one micro-batch are ordered by (key, ts, models first, id) before they are
applied. That buffer is bounded by the source's per-trigger limit divided over the buckets, or over the
shards of one data type; `play` and the topic source both set one. For streams without state per key use
`micro_batch`, which buffers nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidescore.functions.features import bind_fields
from tidescore.operators.dispatch import score_resolved
from tidescore.schemas import FEATURES, LONG_MAX, LONG_MIN
from tidescore.session import use_rocksdb

DEFAULT_SHARDS = 16
BUCKETS = 256  # groups of keys; fixed, as a checkpoint's state lies in them
PAGES = 8  # pages of a bucket; fixed as well
ROWS_PER_BLOCK = 100_000
NO_TIME = np.iinfo(np.int64).min  # a row without a time, as NumPy has it

# One layout for both streams.
INPUT_SCHEMA = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("is_model", T.BooleanType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("id", T.LongType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("duration", T.LongType()),
    ]
)
OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("is_model", T.BooleanType()),
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("version", T.LongType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("result", T.DoubleType()),
        T.StructField("duration", T.LongType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)
SLOT = [("version", T.LongType()), ("valid_from", T.LongType()), ("weights", T.ArrayType(T.DoubleType()))]
MODEL_STATE = T.StructType([T.StructField(n, t) for n, t in SLOT])
STATS_STATE = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("since_arrival", T.LongType()),
        T.StructField("since_first_use", T.LongType()),
        T.StructField("usage", T.LongType()),
        T.StructField("duration", T.LongType()),
        T.StructField("min_duration", T.LongType()),
        T.StructField("max_duration", T.LongType()),
    ]
)
KEY = T.StructType([T.StructField("data_type", T.StringType()), T.StructField("shard", T.IntegerType())])
ENTRY = T.StructType(
    [
        T.StructField("current", MODEL_STATE),
        T.StructField("pending", MODEL_STATE),
        T.StructField("stats", STATS_STATE),
    ]
)
INITIAL_SCHEMA = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("version", T.LongType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
    ]
)


def model_rows(models: DataFrame, weights: Sequence[str] | None = None) -> DataFrame:
    """Models -> stream layout; `weights` names intercept and coefficient columns, None: another kind."""
    return models.select(
        "data_type", F.lit(True).alias("is_model"), F.col("valid_from").cast("timestamp").alias("ts"),
        F.col("version").alias("id"),
        (F.array(*[F.col(c).cast("double") for c in weights]) if weights else F.lit(None).cast("array<double>")).alias("weights"),
        F.lit(None).cast("array<double>").alias("features"), F.lit(None).cast("long").alias("duration"),
    )


def record_rows(records: DataFrame, key: str, features: Sequence[str], duration: str = "duration") -> DataFrame:
    return records.select(
        "data_type", F.lit(False).alias("is_model"), F.col("ts").cast("timestamp").alias("ts"), F.col(key).cast("long").alias("id"),
        F.lit(None).cast("array<double>").alias("weights"),
        F.array(*bind_fields(features, records.columns)).alias("features"),
        F.col(duration).cast("long").alias("duration"),
    )


def sharded(stream: DataFrame, shards: int) -> DataFrame:
    """Models to every shard of their data type, each record to one."""
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    one = F.array(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return stream.withColumn("shard", F.explode(F.when(F.col("is_model"), every).otherwise(one)))


def _empty_stats(version, since) -> tuple:
    return (version, since, None, 0, 0, LONG_MAX, LONG_MIN)


def _add_stats(stats: tuple, ts: np.ndarray, duration: np.ndarray) -> tuple:
    version, since, first, usage, total, low, high = stats
    if not len(ts):
        return stats
    start = int(ts.min())
    return (
        version, since, start if first is None else min(first, start), usage + len(ts), total + int(duration.sum()),
        min(low, int(duration.min())), max(high, int(duration.max())),
    )


def _micros(ts: pd.Series) -> np.ndarray:
    return ts.to_numpy("datetime64[us]").astype(np.int64)


def _ordered(parts: list[tuple]) -> tuple:
    """Concatenate (ts, id, ...) column groups and sort them by (ts, id)."""
    if not parts:
        return ()
    columns = [np.concatenate(group) for group in zip(*parts)]
    order = np.lexsort((columns[1], columns[0]))
    return tuple(c[order] for c in columns)


class Slots:
    """Models of one key in order of effect: the current one, the one waiting, those that arrived."""

    def __init__(self, current, pending) -> None:
        self.had_current, self.had_pending = current.exists(), pending.exists()
        known = [s.get() for s, have in ((current, self.had_current), (pending, self.had_pending)) if have]
        self.first_new = len(known)
        self.versions = np.array([k[0] for k in known], dtype=np.int64)
        self.starts = np.array([k[1] for k in known], dtype=np.int64)
        self.weights: list = [None if k[2] is None else np.array(k[2], dtype=float) for k in known]
        self.new_times = np.empty(0, dtype=np.int64)
        self.new_versions = np.empty(0, dtype=np.int64)

    def add(self, times=None, versions=None, weights=None) -> None:
        if times is None:
            return
        self.new_times, self.new_versions = times, versions
        self.versions = np.concatenate([self.versions, versions])
        self.starts = np.concatenate([self.starts, times])
        self.weights += list(weights)

    def in_force(self, ts: np.ndarray) -> np.ndarray:
        """Position of the slot in force at each time; -1 where no model is known yet."""
        return self.first_new - 1 + np.searchsorted(self.new_times, ts, side="right")

    def row(self, at: int) -> tuple:
        weights = self.weights[at]
        return int(self.versions[at]), int(self.starts[at]), None if weights is None else [float(w) for w in weights]

    def matrix(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights of each slot in `at`, and whether they fit records of `width` - 1 inputs."""
        used, place = np.unique(at, return_inverse=True)
        rows, fits = np.zeros((len(used), width)), np.zeros(len(used), dtype=bool)
        for i, slot in enumerate(used):
            weights = self.weights[slot]
            if weights is not None and len(weights) == width and not np.isnan(weights).any():
                rows[i], fits[i] = weights, True
        return rows[place], fits[place]


class VersionedScorer(StatefulProcessor):
    """Scores each record with the model current for its key.

    swap="immediate": a model replaces the current one on arrival.
    swap="next_record": it waits in a second slot until the next record of its key, so a model
    replaced before any record leaves the statistics of the one in use untouched.
    """

    def __init__(self, swap: str = "immediate", emit_models: bool = False) -> None:
        if swap not in ("immediate", "next_record"):
            raise ValueError("swap must be 'immediate' or 'next_record'")
        self.swap = swap
        self.emit_models = emit_models

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", MODEL_STATE)
        self.pending = handle.getValueState("pending", MODEL_STATE)
        self.stats = handle.getValueState("stats", STATS_STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            start = int(row.valid_from.value // 1000)
            weights = None if row.weights is None else [float(w) for w in row.weights]
            self.current.update((int(row.version), start, weights))
            self.stats.update(_empty_stats(int(row.version), start))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        models, records = [], []
        for chunk in rows:
            flags = chunk["is_model"].to_numpy(dtype=bool)
            if flags.any():
                part = chunk.loc[flags]
                weights = np.empty(len(part), dtype=object)
                weights[:] = [None if w is None else np.asarray(w, dtype=float) for w in part["weights"]]
                models.append((_micros(part["ts"]), part["id"].to_numpy(np.int64), weights))
            if not flags.all():
                part = chunk.loc[~flags]
                records.append(
                    (_micros(part["ts"]), part["id"].to_numpy(np.int64), np.stack(part["features"].to_numpy()),
                     part["duration"].fillna(0).to_numpy(np.int64))
                )
        slots = Slots(self.current, self.pending)
        slots.add(*_ordered(models))
        if records:
            ts, ids, x, duration = _ordered(records)
            slot = slots.in_force(ts)
            yield self._scored(key, slots, slot, ts, ids, x, duration)
        else:
            ts, slot, duration = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        if self.emit_models and models:
            none = [None] * len(slots.new_times)
            yield self._frame(key, True, slots.new_versions, slots.new_times, none, none, none, none)
        self._keep(slots, slot, ts, duration)

    def _scored(self, key, slots, slot, ts, ids, x, duration) -> pd.DataFrame:
        known = slot >= 0
        at = slot[known]
        result, sums = np.full(len(ts), np.nan), np.zeros(len(ts), dtype=bool)
        if len(at):
            weights, fits = slots.matrix(at, x.shape[1] + 1)
            total = weights[:, 0].copy()
            for i in range(x.shape[1]):
                total += weights[:, i + 1] * x[known, i]
            result[known], sums[known] = total, fits
        versions, starts = pd.array([None] * len(ts), dtype="Int64"), pd.array([None] * len(ts), dtype="Int64")
        versions[known], starts[known] = slots.versions[at], slots.starts[at]
        # A record of a model that is no sum keeps its inputs for `complete`.
        kept = [None if done or not has else row for done, has, row in zip(sums, known, x)]
        return self._frame(key, False, ids, ts, versions, starts, pd.Series(result).where(sums), duration, kept)

    def _frame(self, key, is_model, ids, ts, versions, starts, results, duration, features=None) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "data_type": key[0],
                "shard": key[1],
                "is_model": is_model,
                "id": ids,
                "ts": pd.to_datetime(np.asarray(ts), unit="us"),
                "version": pd.Series(versions, dtype="Int64"),
                "valid_from": pd.to_datetime(pd.Series(starts, dtype="Int64"), unit="us"),
                "result": pd.Series(results, dtype="Float64"),
                "duration": pd.Series(duration, dtype="Int64"),
                "features": pd.Series([None] * len(ids) if features is None else features, dtype=object),
            }
        )

    def _keep(self, slots, slot, ts, duration) -> None:
        """New state: which slot is current, which one waits, and the current one's statistics."""
        last = len(slots.versions) - 1
        if last < 0:
            return
        used = int(slot.max()) if len(slot) else -1
        if self.swap == "immediate":
            current = last
        elif used >= 0:
            current = used
        else:  # no record came: whatever was current stays, also when there was none
            current = 0 if slots.had_current else -1
        if current >= 0:
            carried = current == 0 and slots.had_current
            base = tuple(self.stats.get()) if carried else _empty_stats(*slots.row(current)[:2])
            mine = slot == current
            self.stats.update(_add_stats(base, ts[mine], duration[mine]))
            if not carried:
                self.current.update(slots.row(current))
        if self.swap == "next_record" and last != current:
            self.pending.update(slots.row(last))
        elif slots.had_pending:
            self.pending.clear()

    def close(self) -> None:
        pass


class Cell:
    """One value of a key's entry."""

    def __init__(self, value=None) -> None:
        self.value = value

    def exists(self) -> bool:
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value) -> None:
        self.value = value

    def clear(self) -> None:
        self.value = None


# What a block holds, and what is packed into blocks again on the way out; times are microseconds.
BLOCK = pa.schema([
    ("data_type", pa.string()), ("shard", pa.int32()), ("is_model", pa.bool_()), ("ts", pa.int64()), ("id", pa.int64()),
    ("weights", pa.list_(pa.float64())), ("features", pa.list_(pa.float64())), ("duration", pa.int64())])
SCORED = pa.schema([
    ("data_type", pa.string()), ("shard", pa.int32()), ("is_model", pa.bool_()), ("id", pa.int64()), ("ts", pa.int64()),
    ("version", pa.int64()), ("valid_from", pa.int64()), ("result", pa.float64()), ("duration", pa.int64()),
    ("features", pa.list_(pa.float64()))])
SCORED_SQL = ("data_type string, shard int, is_model boolean, id long, ts long, version long, valid_from long, "
              "result double, duration long, features array<double>")


def to_block(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_blocks(blocks: Sequence[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blocks])


def _numbers(column: pa.ChunkedArray, missing=0) -> np.ndarray:
    return column.fill_null(missing).to_numpy()


def _codes(table: pa.Table, *more: str) -> np.ndarray:
    """Equal numbers for rows of one key."""
    words = table["data_type"].combine_chunks().dictionary_encode(null_encoding="encode")
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for c in more:
        codes = codes * (1 << 20) + _numbers(table[c])
    return codes


def _lists(column: pa.ChunkedArray) -> list:
    """An array of numbers per row, None for a null."""
    whole = column.combine_chunks()
    low, high = whole.offsets.to_numpy()[:-1], whole.offsets.to_numpy()[1:]
    flat = whole.values.to_numpy(zero_copy_only=False).astype(float, copy=False)
    known = whole.is_valid().to_numpy(zero_copy_only=False)
    return [flat[a:b] if k else None for a, b, k in zip(low.tolist(), high.tolist(), known.tolist())]


def packer(keep_models: bool):
    """Rows with their buckets -> a block per bucket. Of models of one key and instant only the newest can apply."""

    def pack(table: pa.Table) -> Iterator[tuple[int, bytes]]:
        if not keep_models:
            ts, ids, models = _numbers(table["ts"], NO_TIME), _numbers(table["id"]), _numbers(table["is_model"], False)
            at = np.flatnonzero(models)
            codes = _codes(table)[at]
            order = np.lexsort((ids[at], ts[at], codes))
            last = np.ones(len(at), dtype=bool)
            last[:-1] = (np.diff(codes[order]) != 0) | (np.diff(ts[at][order]) != 0)
            table = table.take(np.sort(np.concatenate([np.flatnonzero(~models), at[order[last]]])))
        places = table["buckets"].combine_chunks()
        widths = np.diff(places.offsets.to_numpy())
        rows = np.repeat(np.arange(len(table)), widths)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(widths) - widths, widths)
        buckets = places.flatten().to_numpy(zero_copy_only=False)
        shards = (_numbers(table["shard"])[rows] + nth).astype(np.int32)
        order = np.argsort(buckets, kind="stable")
        spread = table.drop_columns(["buckets"]).take(rows[order])
        spread = spread.set_column(spread.schema.get_field_index("shard"), "shard", pa.array(shards[order]))
        found, starts = np.unique(buckets[order], return_index=True)
        for bucket, low, high in zip(found.tolist(), starts, [*starts[1:], len(order)]):
            yield bucket, to_block(spread.slice(low, high - low).select(BLOCK.names).cast(BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            made = list(pack(pa.Table.from_batches(held).combine_chunks()))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in made], pa.int32()), pa.array([x for _, x in made], pa.binary())], ["bucket", "rows"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= ROWS_PER_BLOCK:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.column(0):
            yield from pa.ipc.open_stream(block.as_py()).read_all().to_batches()


def bucket_of(data_type, shard):
    return F.pmod(F.xxhash64(data_type, shard), F.lit(BUCKETS)).cast("int")


class BucketScorer(VersionedScorer):
    """`VersionedScorer` for the keys of a bucket: rows come and go in blocks, the state is an entry per key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getMapState("entries", KEY, ENTRY)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            self._load((row.data_type, int(row.shard)))
            super().handleInitialState(None, pd.DataFrame([row]), timerValues)
            self._store((row.data_type, int(row.shard)))

    def _load(self, key: tuple) -> None:
        held = self.entries.getValue(key)
        self.current, self.pending, self.stats = (Cell(v) for v in (held or (None, None, None)))

    def _store(self, key: tuple) -> None:
        entry = (self.current.value, self.pending.value, self.stats.value)
        if any(v is not None for v in entry):
            self.entries.updateValue(key, tuple(None if v is None else tuple(v) for v in entry))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self.score(from_blocks([b for chunk in rows for b in chunk["rows"]]))

    def score(self, table: pa.Table) -> Iterator[pd.DataFrame]:
        """Apply rows (BLOCK) key by key; one frame of blocks (SCORED)."""
        ts, ids, models = _numbers(table["ts"], NO_TIME), _numbers(table["id"]), _numbers(table["is_model"], False)
        codes = _codes(table, "shard")
        order = np.lexsort((ids, ts, ~models, codes))
        table, ts, ids, models, codes = table.take(order), ts[order], ids[order], models[order], codes[order]
        duration, weights, x = _numbers(table["duration"]), _lists(table["weights"]), _lists(table["features"])
        starts = np.flatnonzero(np.concatenate([[True], np.diff(codes) != 0]))
        names, shards = table["data_type"].take(starts).to_pylist(), table["shard"].take(starts).to_pylist()
        out = []
        for name, shard, low, high in zip(names, shards, starts.tolist(), [*starts[1:].tolist(), len(codes)]):
            mid = low + int(models[low:high].sum())  # models first
            self._load((name, shard))
            slots = Slots(self.current, self.pending)
            if mid > low:
                slots.add(ts[low:mid], ids[low:mid], weights[low:mid])
            slot = slots.in_force(ts[mid:high])
            if high > mid:
                out.append((name, shard, False, ids[mid:high], ts[mid:high], *self._columns(slots, slot, x[mid:high]), duration[mid:high]))
            if self.emit_models and mid > low:
                n = mid - low
                nothing = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n), np.ones(n, bool), [None] * n
                out.append((name, shard, True, ids[low:mid], ts[low:mid], *nothing, np.zeros(n, np.int64)))
            self._keep(slots, slot, ts[mid:high], duration[mid:high])
            self._store((name, shard))
        if out:
            yield pd.DataFrame({"rows": self._blocks(out)})

    def _columns(self, slots: Slots, slot: np.ndarray, x: list) -> tuple:
        """Version and its time with a mask of rows that have none, score with such a mask, and inputs kept for `complete`."""
        known = slot >= 0
        at = slot[known]
        versions, starts, result = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64), np.zeros(len(slot))
        sums = np.zeros(len(slot), dtype=bool)
        if len(at):
            versions[known], starts[known] = slots.versions[at], slots.starts[at]
            inputs = np.stack(x)
            weights, fits = slots.matrix(at, inputs.shape[1] + 1)
            total = weights[:, 0].copy()
            for i in range(inputs.shape[1]):
                total += weights[:, i + 1] * inputs[known, i]
            result[known], sums[known] = total, fits
        kept = [None] * len(slot)
        for i in np.flatnonzero(known & ~sums).tolist():
            kept[i] = x[i]
        # As a null: a sum that is not a number.
        return versions, starts, ~known, result, ~sums | np.isnan(result), kept

    def _blocks(self, parts: list[tuple]) -> list[bytes]:
        sizes = [len(p[3]) for p in parts]
        ids, ts, versions, starts, bare, result, open_, kept, duration = (
            (lambda group: np.concatenate(group) if isinstance(group[0], np.ndarray) else [v for g in group for v in g])(list(g))
            for g in list(zip(*parts))[3:])
        place = np.repeat(np.arange(len(parts)), sizes)
        is_model = np.array([p[2] for p in parts])[place]
        table = pa.Table.from_arrays([
            pa.array([p[0] for p in parts], pa.string()).take(pa.array(place)),
            pa.array(np.array([p[1] for p in parts], np.int32)[place]), pa.array(is_model), pa.array(ids),
            pa.array(ts, mask=ts == NO_TIME), pa.array(versions, mask=bare), pa.array(starts, mask=bare | (starts == NO_TIME)),
            pa.array(result, mask=open_), pa.array(duration, mask=is_model), pa.array(kept, pa.list_(pa.float64()))], schema=SCORED)
        return [to_block(table.slice(low, ROWS_PER_BLOCK)) for low in range(0, len(table), ROWS_PER_BLOCK)]


# A page of the state: entries as ENTRY has them, flat. A slot without a version column is empty; `touched` marks
# the keys that the batch which wrote the page worked on.
SLOTS = ("current", "pending")
LISTS = pa.list_(pa.float64())
ENTRIES = pa.schema([
    ("data_type", pa.string()), ("shard", pa.int32()),
    *[(f"{slot}_{n}", LISTS if n == "weights" else pa.int64()) for slot in SLOTS for n in MODEL_STATE.names],
    *[(f"{slot}_held", pa.bool_()) for slot in SLOTS],
    *[(f"stats_{n}", pa.int64()) for n in STATS_STATE.names], ("touched", pa.bool_())])


def page_of(data_type: str | None, shard: int) -> int:
    return zlib.crc32(b"-" if data_type is None else b"+" + data_type.encode(), shard) % PAGES


def _spans(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each list in the values, -1 for a null, and the values, NaN for a null."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), -1)
    return offsets[:-1], sizes, lists.values.to_numpy(zero_copy_only=False).astype(float, copy=False)


def _sums(weights: pa.Array, slot: np.ndarray, features: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sum of each row's features under the weights of its slot, and whether they fit."""
    at, sizes, values = _spans(weights)
    whole = np.ones(len(sizes), dtype=bool)
    whole[np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))[np.isnan(_flat(at, sizes, values))]] = False
    x_at, x_sizes, x_values = _spans(features)
    total = np.zeros(len(slot))
    fits = (x_sizes >= 0) & (sizes[slot] == x_sizes + 1) & whole[slot]
    for width in np.unique(x_sizes[fits]).tolist():
        rows = np.flatnonzero(fits & (x_sizes == width))
        w, x = at[slot[rows]], x_at[rows]
        sums = values[w].copy()
        for i in range(width):
            sums += values[w + i + 1] * x_values[x + i]
        total[rows] = sums
    return total, fits


def _flat(at: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of the lists that are not null, one list after the other."""
    n = np.maximum(sizes, 0)
    return values[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _taken(column: pa.Array, at: np.ndarray) -> pa.Array:
    """Values at positions, null where the position is negative."""
    return column.take(pa.array(np.maximum(at, 0), mask=at < 0))


class PagedScorer(BucketScorer):
    """`BucketScorer` for many keys a batch: entries come and go by the page, and all keys of a call are worked on as columns."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("pages", "page int", "entries binary")

    def _read(self, page: int) -> pa.Table:
        held = self.pages.getValue((page,))
        return ENTRIES.empty_table() if held is None else from_blocks([bytes(held[0])])

    def _write(self, page: int, entries: pa.Table) -> None:
        self.pages.updateValue((page,), (to_block(entries.combine_chunks()),))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = initialState
        names = [None if pd.isna(n) else n for n in rows["data_type"]]
        shards, versions, starts = rows["shard"].to_numpy(np.int32), rows["version"].to_numpy(np.int64), _micros(rows["valid_from"])
        n = len(rows)
        fresh = dict(zip(STATS_STATE.names, _empty_stats(versions, starts)))
        columns = {
            "data_type": names, "shard": shards, "current_version": versions, "current_valid_from": starts,
            "current_weights": [None if w is None else list(w) for w in rows["weights"]],
            "current_held": np.ones(n, bool), "pending_held": np.zeros(n, bool), "touched": np.ones(n, bool),
            **{f"stats_{k}": v if isinstance(v, np.ndarray) else [v] * n for k, v in fresh.items()}}
        made = pa.Table.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in ENTRIES], schema=ENTRIES)
        pages = np.array([page_of(a, b) for a, b in zip(names, shards.tolist())])
        for page in np.unique(pages).tolist():
            held = self._read(page)
            new = made.filter(pa.array(pages == page))
            again = set(zip(new["data_type"].to_pylist(), new["shard"].to_pylist()))
            kept = [k not in again for k in zip(held["data_type"].to_pylist(), held["shard"].to_pylist())]
            self._write(page, pa.concat_tables([held.filter(pa.array(kept, pa.bool_())), new]))

    def score(self, table: pa.Table) -> Iterator[pd.DataFrame]:
        """Apply rows (BLOCK) of all keys; one frame of blocks (SCORED)."""
        if not len(table):
            return
        ts, ids, models = _numbers(table["ts"], NO_TIME), _numbers(table["id"]), _numbers(table["is_model"], False)
        codes = _codes(table, "shard")
        order = np.lexsort((ids, ~models, ts, codes))
        ts, ids, models, codes = ts[order], ids[order], models[order], codes[order]
        first = np.concatenate([[True], np.diff(codes) != 0])
        key, starts = np.cumsum(first) - 1, np.flatnonzero(first)
        keys = table.select(["data_type", "shard"]).take(order[starts])
        names, shards = keys["data_type"].to_pylist(), keys["shard"].to_pylist()
        pages = np.array([page_of(a, b) for a, b in zip(names, shards)])
        held = {page: self._read(page) for page in np.unique(pages).tolist()}
        known = pa.concat_tables(held.values())
        place = dict(zip(zip(known["data_type"].to_pylist(), known["shard"].to_pylist()), range(len(known))))
        mine = np.array([place.get(k, -1) for k in zip(names, shards)])

        def has(slot: str) -> np.ndarray:
            return (mine >= 0) & np.append(_numbers(known[f"{slot}_held"], False), False)[mine]

        # The models of a key in order of effect: the current one, the one waiting, those that arrived.
        had = {slot: has(slot) for slot in SLOTS}
        before = had["current"].astype(np.int64) + had["pending"]
        arrived = np.cumsum(models)
        base = (arrived - models)[starts]
        counts = before + np.diff(np.append(base, arrived[-1]))
        offset = np.cumsum(counts) - counts
        total = int(counts.sum())
        # Where a slot's model is found: in the current slots of the state, in its waiting slots, or in the rows.
        source, n_known = np.zeros(total, np.int64), len(known)
        source[offset[had["current"]]] = mine[had["current"]]
        both = offset + had["current"]
        source[both[had["pending"]]] = n_known + mine[had["pending"]]
        new = np.flatnonzero(models)
        source[(offset + before)[key[new]] + (arrived[new] - 1 - base[key[new]])] = 2 * n_known + order[new]
        versions = np.concatenate([*[_numbers(known[f"{s}_version"]) for s in SLOTS], _numbers(table["id"])])[source]
        since = np.concatenate([*[_numbers(known[f"{s}_valid_from"], NO_TIME) for s in SLOTS], _numbers(table["ts"], NO_TIME)])[source]
        weights = pa.concat_arrays(
            [*[_whole(known[f"{s}_weights"]) for s in SLOTS], _whole(table["weights"])]).take(pa.array(source))

        records = np.flatnonzero(~models)
        of, r_ts = key[records], ts[records]
        slot = before[of] - 1 + arrived[records] - base[of]
        duration, features = _numbers(table["duration"])[order[records]], _whole(table["features"]).take(pa.array(order[records]))
        in_force = slot >= 0
        at = np.where(in_force, offset[of] + slot, 0)
        out = []
        if len(records):
            if total:
                result, sums = _sums(weights, at, features)
                sums &= in_force
                scored_by, valid_from = versions[at], since[at]
            else:
                result, sums = np.zeros(len(slot)), np.zeros(len(slot), bool)
                scored_by, valid_from = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
            kept = np.where(in_force & ~sums, np.arange(len(slot)), -1)
            out.append(pa.Table.from_arrays([
                *[c.take(pa.array(of)) for c in (_whole(keys["data_type"]), _whole(keys["shard"]))], pa.array(np.zeros(len(slot), bool)),
                pa.array(ids[records]), pa.array(r_ts, mask=r_ts == NO_TIME), pa.array(scored_by, mask=~in_force),
                pa.array(valid_from, mask=~in_force | (valid_from == NO_TIME)),
                pa.array(result, mask=~sums | np.isnan(result)),  # as a null: a sum that is not a number
                pa.array(duration), _taken(features, kept)], schema=SCORED))
        if self.emit_models and len(new):
            m_ts, m_key = pa.array(ts[new], mask=ts[new] == NO_TIME), pa.array(key[new])
            told = {"data_type": _whole(keys["data_type"]).take(m_key), "shard": _whole(keys["shard"]).take(m_key),
                    "is_model": pa.array(np.ones(len(new), bool)), "id": pa.array(ids[new]), "ts": m_ts}
            out.append(pa.Table.from_arrays([told.get(f.name, pa.nulls(len(new), f.type)) for f in SCORED], schema=SCORED))

        self._keep_all(known, mine, had, keys, pages, held, counts, offset, (versions, since, weights), of, slot, r_ts, duration)
        if out:
            done = pa.concat_tables(out).combine_chunks()
            yield pd.DataFrame({"rows": [to_block(done.slice(low, ROWS_PER_BLOCK)) for low in range(0, len(done), ROWS_PER_BLOCK)]})

    def _keep_all(self, known, mine, had, keys, pages, held, counts, offset, slots, of, slot, ts, duration) -> None:
        """New entries of the keys worked on: which slot is current, which one waits, and the current one's statistics."""
        n, last = len(counts), counts - 1
        used = np.full(n, -1)
        np.maximum.at(used, of, slot)
        if self.swap == "immediate":
            current = last.copy()
        else:  # no record came: whatever was current stays, also when there was none
            current = np.where(used >= 0, used, np.where(had["current"], 0, -1))
        pending = np.where((last != current) & (self.swap == "next_record"), last, -1)
        carried = (current == 0) & had["current"]
        versions, since, weights = slots
        columns = {"data_type": _whole(keys["data_type"]), "shard": _whole(keys["shard"]), "touched": pa.array(np.ones(n, bool))}
        for name, at in (("current", current), ("pending", pending)):
            where, none = np.where(at >= 0, offset + at, -1), at < 0
            columns[f"{name}_held"] = pa.array(~none)
            columns[f"{name}_version"] = _taken(pa.array(versions), where)
            columns[f"{name}_valid_from"] = _taken(pa.array(since), where)
            columns[f"{name}_weights"] = _taken(weights, where)

        def stat(name: str, otherwise, missing: int = 0) -> np.ndarray:
            old = np.append(_numbers(known[f"stats_{name}"], missing), 0)[mine]
            return np.where(carried, old, otherwise)

        place = np.where(current >= 0, offset + current, 0)
        start = {"version": versions[place], "since_arrival": since[place]} if len(versions) else {"version": 0, "since_arrival": 0}
        stats = {k: stat(k, v) for k, v in start.items()}
        first, usage, spent = stat("since_first_use", LONG_MAX, LONG_MAX), stat("usage", 0), stat("duration", 0)
        low, high = stat("min_duration", LONG_MAX), stat("max_duration", LONG_MIN)
        own = (slot == current[of]) & (slot >= 0)
        of, ts, duration = of[own], ts[own], duration[own]
        np.minimum.at(first, of, ts)
        np.add.at(usage, of, 1)
        np.add.at(spent, of, duration)
        np.minimum.at(low, of, duration)
        np.maximum.at(high, of, duration)
        stats |= {"since_first_use": first, "usage": usage, "duration": spent, "min_duration": low, "max_duration": high}
        empty = current < 0
        for name, values in stats.items():
            columns[f"stats_{name}"] = pa.array(values, mask=empty | (usage == 0) if name == "since_first_use" else empty)
        made = pa.Table.from_arrays([columns[f.name] for f in ENTRIES], schema=ENTRIES)
        stored = (current >= 0) | (pending >= 0)
        replaced = np.zeros(len(known), dtype=bool)
        replaced[mine[mine >= 0]] = True
        low_row = 0
        for page, old in held.items():
            gone = replaced[low_row : low_row + len(old)]
            low_row += len(old)
            fresh = made.filter(pa.array((pages == page) & stored))
            if len(fresh):
                rest = old.filter(pa.array(~gone))
                rest = rest.set_column(ENTRIES.get_field_index("touched"), "touched", pa.array(np.zeros(len(rest), bool)))
                self._write(page, pa.concat_tables([rest, fresh]))


def entries_of(pages: DataFrame, *more: str) -> DataFrame:
    """Pages of the state (`entries`) -> key, current, pending, stats and touched per entry, with the columns `more`."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.select(*more).schema.fields} if more else {}
    flat = {f.name: {"string": "string", "int32": "int", "int64": "long", "bool": "boolean"}.get(str(f.type), "array<double>") for f in ENTRIES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, page in enumerate(batch.column(0)):
                entries = from_blocks([page.as_py()]).combine_chunks()
                again = pa.array(np.full(len(entries), row))
                for part in entries.to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(i + 1).take(again) for i in range(len(more))], *part.columns], [*more, *ENTRIES.names])

    schema = ", ".join(f"{n} {t}" for n, t in {**kinds, **flat}.items())
    rows = pages.select("entries", *more).mapInArrow(run, schema)
    struct = lambda part, names: F.struct(*[F.col(f"{part}_{n}").alias(n) for n in names])
    return rows.select(
        *more, F.struct("data_type", "shard").alias("key"),
        *[F.when(F.col(f"{s}_held"), struct(s, MODEL_STATE.names)).alias(s) for s in SLOTS],
        F.when(F.col("stats_version").isNotNull(), struct("stats", STATS_STATE.names)).alias("stats"), "touched")


def unpacked(blocks: DataFrame) -> DataFrame:
    """Blocks that a processor gave -> OUTPUT_SCHEMA."""
    flat = blocks.mapInArrow(_unpack, SCORED_SQL)
    times = {c: F.timestamp_micros(c) for c in ("ts", "valid_from")}
    return flat.select(*[times.get(c, F.col(c)).alias(c) for c in OUTPUT_SCHEMA.names])


def seeds(initial: DataFrame, shards: int) -> DataFrame:
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    rows = initial.select("data_type", every, "version", "valid_from", "weights")
    return rows.select(bucket_of("data_type", "shard").alias("bucket"), "*")


def keyed_scoring(stream: DataFrame, shards: int = DEFAULT_SHARDS, swap: str = "immediate",
                  emit_models: bool = False, initial: DataFrame | None = None) -> DataFrame:
    """Stream in INPUT_SCHEMA -> one row per record (and, with `emit_models`, per model and shard).

    `initial` is (data_type, version, valid_from, weights): models in force before the stream.
    """
    spark = stream.sparkSession
    use_rocksdb(spark)
    shard = F.when(F.col("is_model"), F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(shards))).cast("int")
    each = F.sequence(F.lit(0), F.lit(shards - 1))
    buckets = F.when(F.col("is_model"), F.transform(each, lambda s: bucket_of(F.col("data_type"), s.cast("int")))).otherwise(
        F.array(bucket_of(F.col("data_type"), F.col("shard"))))
    # A slice is one file: without the shuffle one task would read and pack it alone.
    rows = stream.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("id")).withColumn("shard", shard).select(
        "data_type", "shard", "is_model", F.unix_micros("ts").alias("ts"), "id", "weights", "features", "duration",
        buckets.alias("buckets"))
    packed = rows.mapInArrow(packer(emit_models), "bucket int, rows binary")
    return unpacked(packed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=PagedScorer(swap, emit_models),
        outputStructType="rows binary",
        outputMode="Append",
        timeMode="None",
        initialState=None if initial is None else seeds(initial, shards).groupBy("bucket"),
    ))


def complete(scored: DataFrame, versions: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Score what the stream left open, by data type and version; works on a table or inside foreachBatch."""
    inputs = [F.get("features", F.lit(i)).alias(c) for i, c in enumerate(columns)]
    open_rows = scored.where(F.col("features").isNotNull()).drop("result")
    done = score_resolved(open_rows.select("*", *inputs), versions, columns)
    return scored.where(F.col("features").isNull()).drop("features").unionByName(done.drop("features", *columns))


def unscored(scored: DataFrame, mode: str = "drop") -> DataFrame:
    """`drop` records that had no model, or keep them with null."""
    return scored if mode == "null" else scored.where(F.col("version").isNotNull() | F.col("is_model"))
