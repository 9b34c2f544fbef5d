"""The server's commit log: whole batches or nothing, few folders, two servers side by side, times by record."""

import os

import pytest
from pyspark.sql import functions as F

from tests.test_models import START, constant, stump, versions_of
from tidescore.functions import codec
from tidescore.operators import dispatch
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES, RECORD_SCHEMA
from tidescore.session import scratch_path, scratch_scope, scratch_table
from tidescore.sources.staged import play, read_staged
from tidescore.streaming import serve
from tidescore.streaming.workspace import Workspace

PMML = (
    '<PMML version="4.2" xmlns="http://www.dmg.org/PMML-4_2"><DataDictionary><DataField name="alcohol" optype="continuous" '
    'dataType="double"/></DataDictionary><RegressionModel functionName="regression"><MiningSchema><MiningField name="alcohol"/>'
    '</MiningSchema><RegressionTable intercept="{}"><NumericPredictor name="alcohol" coefficient="1"/></RegressionTable>'
    "</RegressionModel></PMML>"
)


def folders(path):
    return sum(len(names) for at, names, _ in os.walk(path) if os.path.dirname(at) == str(path) or at == str(path))


def test_many_batches_leave_few_folders(spark, tmp_path):
    space = Workspace(spark, str(tmp_path), latest=("state",), fan=4, retain=2)
    one = spark.range(1).coalesce(1)
    for batch in range(40):
        before = space.begin(batch)
        assert before.batch == batch - 1
        written = {}
        for name in ("rows", "state", "sums"):
            written[name], back = space.write(one.select(F.lit(batch).alias("batch"), F.lit(1).alias("n")), name, batch)
        assert back.count() == 1
        space.commit(batch, written, {"usage": 1}, merge={"sums": lambda d: d.agg(F.max("batch").alias("batch"), F.sum("n").alias("n"))})
    assert sorted(r.batch for r in space.read("rows").collect()) == list(range(40))
    assert [r.batch for r in space.read("state").collect()] == [39]
    assert space.read("sums").agg(F.sum("n")).first()[0] == 40 and space.read("sums").count() < 12
    assert space.batches() == [38, 39] and space.manifest().metrics == {"usage": 1}
    # Three folders a tier at most, three tiers, and what the manifest before still lists.
    assert max(len(f) for f in space.manifest().tables.values()) <= 9
    assert all(len(os.listdir(tmp_path / name)) <= 20 for name in ("rows", "state", "sums"))


def test_half_a_batch_is_invisible(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        space.read("rows")
    done, _ = space.write(spark.range(3), "rows", 0)
    space.commit(0, {"rows": done})
    space.write(spark.range(100), "rows", 1)  # the batch stops here
    assert space.read("rows").count() == 3 and space.begin(1).batch == 0
    again, _ = space.write(spark.range(5), "rows", 1)
    space.commit(1, {"rows": again})
    assert space.read("rows").count() == 8 and len(os.listdir(tmp_path / "rows")) == 2
    assert space.begin(1) is None  # published: a retry does nothing
    with pytest.raises(FileNotFoundError, match="before batch 5"):
        space.begin(5)


def messages(spark, types, models, records):
    """Messages of a server: `models` linear models per type, then records of all types."""
    rows = [(f"m{n}", "", t, "PMML", bytearray(PMML.format(n).encode()), None) for t in types for n in range(models)]
    sent = spark.createDataFrame(rows, DESCRIPTOR_SCHEMA).withColumn("n", F.substring("name", F.lit(2), F.lit(9)).cast("int"))
    first = sent.select(
        F.lit("models").alias("topic"), codec.encode_descriptor(F.struct(*DESCRIPTOR_SCHEMA.names)).alias("value"),
        (F.lit(START) + F.make_interval(mins=F.col("n") * 10)).alias("timestamp"), F.lit(0).alias("partition"),
        (F.col("n") * 16 + F.pmod(F.xxhash64("dataType"), F.lit(16))).alias("offset"))
    kinds = F.array(*[F.lit(t) for t in types])
    lines = spark.range(records).select(
        *[F.lit(1.0).alias(c) for c in FEATURES], F.element_at(kinds, (F.col("id") % len(types) + 1).cast("int")).alias("dataType"), "id")
    second = lines.select(
        F.lit("mdata").alias("topic"), codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("value"),
        (F.lit(START) + F.make_interval(mins=(F.col("id") % 60 + 1).cast("int"))).alias("timestamp"), F.lit(0).alias("partition"),
        (F.col("id") + 1000).alias("offset"))
    return first.unionByName(second).select(*serve.MESSAGE_SCHEMA.names)


def started(spark, tag, types, models, records, at_least=3):
    source, target, checkpoint = (scratch_path(spark, f"{tag}-{n}") for n in ("stage", "workspace", "checkpoint"))
    play(messages(spark, types, models, records), source, ts="timestamp", at_least=at_least)
    writer = serve.serve(read_staged(spark, source, serve.MESSAGE_SCHEMA), target, fan=2)
    return target, writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def test_two_servers_in_one_session(spark):
    runs = [started(spark, tag, types, 6, 600) for tag, types in (("one", ["a", "b"]), ("two", ["c"]))]
    for _, running in runs:
        running.awaitTermination()
    for (target, _), types in zip(runs, (["a", "b"], ["c"])):
        scored = serve.read(spark, target, "scored")
        assert scored.count() == 600 and {r.data_type for r in scored.select("data_type").distinct().collect()} == set(types)
        # The model of a record's ten minutes gives its number and one.
        minute = (F.unix_timestamp("ts") - F.unix_timestamp(F.lit(START))) / 60
        assert scored.where(F.col("result") != F.least(F.floor(minute / 10), F.lit(5)) + 1).count() == 0


def test_a_batch_has_shortest_and_longest_times(spark):
    target, running = started(spark, "times", ["a"], 1, 6000, at_least=1)
    running.awaitTermination()
    stats = serve.serve_stats(spark, target).collect()
    assert len(stats) == 1 and stats[0].usage == 6000 and 0 < stats[0].min_duration < stats[0].avg_duration < stats[0].max_duration
    seen = Workspace(spark, target).manifest().metrics
    assert seen["usage"] == 6000 and seen["min_duration"] == stats[0].min_duration and seen["max_duration"] == stats[0].max_duration
    assert serve.read(spark, target, "scored").where(F.col("duration").isNull()).count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_times_of_sums_and_other_kinds(spark, monkeypatch, shuffled):
    """Results are those without times; a record without a model has neither."""
    if shuffled:
        monkeypatch.setattr(dispatch, "fits_broadcast", lambda df: False)
    versions = versions_of(spark, [("a", 1, 0, constant(10.0)), ("a", 2, 5, stump(3.0)), ("b", 1, 0, {**constant(0.5, "glm"), "link": "log"})])
    records = spark.range(900).select(
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("data_type"),
        (F.lit(START) + F.make_interval(mins=(F.col("id") % 10).cast("int"))).alias("ts"), "id", *[F.lit(1.0).alias(c) for c in FEATURES])
    plain, timed = (
        {r.id: r for r in dispatch.score_with_versions(records, versions, "null", duration=name).collect()} for name in (None, "duration"))
    assert {i: r.result for i, r in plain.items()} == pytest.approx({i: r.result for i, r in timed.items()})
    assert all((r.duration is None) == (r.result is None) and (r.duration or 1) > 0 for r in timed.values())


def test_scopes_of_two_threads(spark):
    """A scope that opens while another is open deletes its own tables only."""
    from threading import Event, Thread

    opened, closed, found = Event(), Event(), []

    def other():
        with scratch_scope(spark):
            opened.wait(60)
            found.append(scratch_table(spark.range(7), "other").count())
        closed.set()

    thread = Thread(target=other)
    thread.start()
    with scratch_scope(spark):
        mine = scratch_table(spark.range(5), "mine")
        opened.set()
        assert closed.wait(60) and mine.count() == 5
    thread.join()
    assert found == [7]
