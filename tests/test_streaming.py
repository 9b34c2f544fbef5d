"""The stateful processor against a plain loop, and the adapters around streams."""

import random
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidescore.plans import stream_queries
from tidescore.session import CHANGELOGS, kept_batches, scratch_path, shared_dir
from tidescore.sources import artifacts, delimited, kafka, registry, replay
from tidescore.sources.staged import play, read_staged
from tidescore.streaming import introspect, keyed, sinks


class Cell:
    """Stand-in for one value of state."""

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


class Handle:
    def __init__(self):
        self.cells = {}

    def getValueState(self, name, schema):
        return self.cells.setdefault(name, Cell())


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        model = rng.random() < 0.3
        out.append({
            "is_model": model, "ts": rng.randrange(n), "id": i,
            "weights": [0.5, rng.random()] if model else None,
            "features": None if model else [rng.random()], "duration": None if model else rng.randrange(9),
        })
    return out


def loop(batches, swap):
    """One message at a time, as the description reads."""
    current = pending = stats = None
    out = {}
    for batch in batches:
        for m in sorted(batch, key=lambda m: (m["ts"], not m["is_model"], m["id"])):
            if m["is_model"]:
                if swap == "immediate":
                    current, stats = m, (0, 0, None, None)
                else:
                    pending = m
                continue
            if pending is not None:
                current, pending, stats = pending, None, (0, 0, None, None)
            if current is None:
                out[m["id"]] = (None, None)
                continue
            d = m["duration"]
            n, total, lo, hi = stats
            stats = (n + 1, total + d, d if lo is None else min(lo, d), d if hi is None else max(hi, d))
            out[m["id"]] = (current["id"], current["weights"][0] + current["weights"][1] * m["features"][0])
    return out, current, pending, stats


def frame(batch):
    df = pd.DataFrame(batch)
    df["ts"] = pd.to_datetime(df["ts"], unit="s")
    for c in ("weights", "features"):
        df[c] = [None if v is None else np.array(v) for v in df[c]]
    return df


@pytest.mark.parametrize("swap", ["immediate", "next_record"])
@pytest.mark.parametrize("seed", range(12))
def test_processor_equals_a_loop(swap, seed):
    rng = random.Random(seed)
    messages = rows(seed, 60)
    cuts = sorted(rng.sample(range(1, 60), 4))
    batches = [messages[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    want, current, pending, stats = loop(batches, swap)
    processor, handle = keyed.VersionedScorer(swap), Handle()
    processor.init(handle)
    got = {}
    for batch in batches:
        df = frame(batch).sample(frac=1.0, random_state=seed)
        halves = iter([df.iloc[: len(df) // 2], df.iloc[len(df) // 2:]])
        for out in processor.handleInputRows(("k", 0), (h for h in halves if len(h)), None):
            for r in out.itertuples():
                got[r.id] = (None if pd.isna(r.version) else r.version, None if pd.isna(r.result) else r.result)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1])
    cells = handle.cells
    assert (cells["current"].value or (None,))[0] == (current["id"] if current else None)
    assert (cells["pending"].value or (None,))[0] == (pending["id"] if pending else None)
    if stats:
        _, _, _, usage, total, lo, hi = cells["stats"].value
        assert (usage, total) == stats[:2]
        if usage:
            assert (lo, hi) == stats[2:]


def test_unknown_swap():
    with pytest.raises(ValueError):
        keyed.VersionedScorer("later")


def test_sharding_repeats_models_only(spark):
    df = spark.createDataFrame([("a", True, 1), ("a", False, 2), ("a", False, 3)], "data_type string, is_model boolean, id long")
    out = keyed.sharded(df, 4).collect()
    assert sorted(r.shard for r in out if r.is_model) == [0, 1, 2, 3]
    assert len([r for r in out if not r.is_model]) == 2


def test_play_delivers_in_order(spark):
    df = spark.range(1000).select(F.timestamp_seconds("id").alias("ts"), "id")
    target, seen = scratch_path(spark, "play"), []
    play(df, target, lambda: seen.append(spark.read.parquet(target).agg(F.max("id"), F.count("id")).first()), at_least=4)
    assert len(seen) == 4 and seen[-1][1] == 1000
    assert all(high == count - 1 for high, count in seen)
    stream = read_staged(spark, target, df.schema)
    assert stream.isStreaming and stream.columns == ["ts", "id"]


def test_topic_options():
    options = kafka.source_options("b:9092", kafka.DATA_TOPIC, group="g", min_partitions=8)
    assert options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "g"
    assert options["maxOffsetsPerTrigger"] == "1000000" and options["minPartitions"] == "8"
    assert kafka.sink_options("b:9092", "t")["kafka.acks"] == "all"
    with pytest.raises(ValueError):
        kafka.source_options("b:9092", "t", start="middle")


def test_text_sources(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("1; 2;3;4;5;6;7;8;9;10;11; 5\n" * 3)
    assert delimited.read_lines(spark, str(good)).count() == 3
    assert delimited.read_lines(spark, str(good)).first().features == [float(i) for i in range(1, 12)]
    record = delimited.read_records(spark, str(good)).first()
    assert record.dataType == "wine" and record.alcohol == 11.0
    for bad in ("1;2;3", "1;x;3;4;5;6;7;8;9;10;11;5"):
        path = tmp_path / f"bad{len(bad)}.csv"
        path.write_text(bad + "\n")
        with pytest.raises(Exception):
            delimited.read_lines(spark, str(path)).collect()
    with_header = tmp_path / "header.csv"
    with_header.write_text(";".join(delimited.CSV_HEADER) + "\n1;2;3;4;5;6;7;8;9;10;11;5\n1;2\nx;2;3;4;5;6;7;8;9;10;11;5\n")
    rows = delimited.read_training_csv(spark, str(with_header))
    assert rows.count() == 2 and rows.select("quality").count() == 2
    with pytest.raises(Exception):
        delimited.read_lines_with_header(spark, str(with_header)).collect()


def test_artifacts(spark, tmp_path):
    assert artifacts.scan_artifacts(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "a.pmml").write_bytes(b"one")
    (tmp_path / "b.txt").write_bytes(b"two")
    found = artifacts.scan_artifacts(spark, str(tmp_path)).collect()
    assert [bytes(r.content) for r in found] == [b"one"]
    one = artifacts.read_artifact(spark, str(tmp_path / "a.pmml"))
    out = one.select(artifacts.pmml_descriptor(F.col("path"), F.col("content")).alias("d")).first().d
    assert (out.name, out.dataType, out.modeltype) == ("a", "wine", "PMML")


def test_registry_round_trip_prunes_by_type(spark):
    from tidescore.plans import models
    from tidescore.schemas import MODEL_VERSION_SCHEMA

    rows = [(t, i, "n", "d", "PMML", datetime(2024, 1, 1), bytearray(b"x"), models.linear())
            for i, t in enumerate(["a", "b"])]
    path = scratch_path(spark, "registry")
    registry.append_versions(spark.createDataFrame(rows, MODEL_VERSION_SCHEMA), path)
    back = registry.read_versions(spark, path).where("data_type = 'a'")
    assert [r.version for r in back.collect()] == [0]
    assert "PartitionFilters: [isnotnull(data_type" in back._jdf.queryExecution().toString()


def test_stream_of_versions_reaches_the_registry(spark):
    from tidescore.plans import models
    from tidescore.schemas import MODEL_VERSION_SCHEMA
    from tidescore.streaming import micro_batch

    rows = [(t, i, "n", "d", "PMML", datetime(2024, 1, 1), bytearray(b"x"), models.linear())
            for i, t in enumerate(["a", "b", "a"])]
    source, target, checkpoint = (scratch_path(spark, n) for n in ("s", "r", "c"))
    spark.createDataFrame(rows, MODEL_VERSION_SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(MODEL_VERSION_SCHEMA).parquet(source)
    writer = micro_batch.publish_versions(stream, target).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    back = registry.read_versions(spark, target)
    assert sorted((r.data_type, r.version) for r in back.collect()) == [("a", 0), ("a", 2), ("b", 1)]


def test_replay_goes_round(spark):
    table = replay.replay_table(spark.range(3).withColumnRenamed("id", "n"), ["n"])
    ticks = spark.range(7).select(F.current_timestamp().alias("timestamp"), F.col("id").alias("value"))
    out = {r.sequence: r.n for r in replay.endless_replay(ticks, table, 3).collect()}
    assert [out[i] for i in range(7)] == [2, 1, 0, 2, 1, 0, 2]
    assert replay.paced_ticks(spark).isStreaming and replay.batch_ticks(spark, 1, 60_000).isStreaming


def test_progress_lines():
    class Event:
        class progress:
            numInputRows = 7

    lines = sinks.ProgressLog(every=10)
    for _ in range(3):
        lines.onQueryProgress(Event)
    assert lines.rows == 21 and lines.lines == 2


def test_writers(spark):
    ticks = replay.paced_ticks(spark)
    assert sinks.paced(sinks.discard(ticks)) is not None and sinks.console(ticks) is not None


def test_unknown_key_is_empty(spark):
    df = spark.createDataFrame(
        [("a", True, datetime(2024, 1, 1), 1, [0.0, 2.0], None, None),
         ("a", False, datetime(2024, 1, 2), 2, None, [3.0], 4)], keyed.INPUT_SCHEMA)
    source, out, checkpoint = (scratch_path(spark, n) for n in ("s", "o", "c"))
    play(df, source, at_least=1)
    scored = keyed.keyed_scoring(read_staged(spark, source, keyed.INPUT_SCHEMA), shards=2)
    sinks.table(scored, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert introspect.serving_info(spark, checkpoint, "a").first().usage == 1
    assert introspect.serving_info(spark, checkpoint, "zzz").count() == 0
    assert introspect.stores(spark, checkpoint, "default").count() == 1
    assert spark.read.parquet(out).first().result == 6.0


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_long_batches_of_the_replay(spark):
    """Batches of more milliseconds than an int holds."""
    table = spark.createDataFrame([(0, "a")], "position long, value string")
    sent = replay.two_speed_replay(spark, table, 1, table, 1, 5, models_per_batch=100_000)
    assert sent.isStreaming and sent.columns == ["topic", "sequence", "sent_at", "position", "value"]


def test_change_feed_in_a_session_without_change_logs(spark):
    key, retained = CHANGELOGS, "spark.sql.streaming.minBatchesToRetain"
    spark.conf.set(key, "false")
    spark.conf.set(retained, "2")
    try:
        days = [datetime(2024, 1, d) for d in range(1, 9)]
        df = spark.createDataFrame(
            [("a", True, days[0], 1, [0.0, 2.0], None, None), *[("a", False, d, i, None, [3.0], 4) for i, d in enumerate(days)]],
            keyed.INPUT_SCHEMA)
        source, out, checkpoint = (scratch_path(spark, n) for n in ("s", "o", "c"))
        slices = play(df, source, arrival=F.dayofmonth("ts") - 1)
        with kept_batches(spark, slices + 1):
            scored = keyed.keyed_scoring(read_staged(spark, source, keyed.INPUT_SCHEMA), shards=1)
            sinks.table(scored, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
        assert spark.conf.get(retained) == "2"
        changes = introspect.stats_changes(spark, checkpoint, 0).collect()
        assert sorted((r.batch_id, r.usage) for r in changes) == [(i, i + 1) for i in range(8)]
    finally:
        spark.conf.set(key, "true")
        spark.conf.unset(retained)


def test_state_partitions_do_not_follow_the_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    at = F.timestamp_seconds("id")
    models = spark.range(0, 40, 2).select(
        (F.col("id") % 3).cast("string").alias("data_type"), "id", at.alias("valid_from"), F.lit(0.0).alias("b"), F.lit(2.0).alias("w"))
    records = spark.range(1, 41, 2).select(
        (F.col("id") % 3).cast("string").alias("data_type"), "id", at.alias("ts"), F.lit(1.5).alias("value"), F.lit(1).alias("duration"))
    rows = keyed.model_rows(models.withColumnRenamed("id", "version"), ["b", "w"]).unionByName(
        keyed.record_rows(records, "id", ["value"]))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        scored, checkpoint = stream_queries.run_keyed(rows, shards=1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = {r.numPartitions for r in introspect.stores(spark, checkpoint).collect()}
    assert stores == {2 * spark.sparkContext.defaultParallelism}
    # Models have even numbers and records odd ones, so the newest model of a record's type is three seconds older.
    got = {r.id: (r.version, r.result) for r in scored.collect()}
    assert got == {i: (i - 3, 3.0) if i >= 3 else (None, None) for i in range(1, 41, 2)}
