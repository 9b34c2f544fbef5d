"""The streaming scorers, run to the end of staged files; each is checked by the batch question."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.functions import codec
from tidescore.operators import clean
from tidescore.plans import inputs, sqltext
from tidescore.plans.catalogue import query
from tidescore.plans.registry_queries import MIXED, _mixed_sql, published
from tidescore.plans.resolve_queries import CURRENT, EVENT_SCORE
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES, MODEL_VERSION_SCHEMA, PARAMS_TYPE, RECORD_SCHEMA
from tidescore.session import batches_by_rows, kept_batches, scratch_path, state_partitions
from tidescore.sources import registry, replay
from tidescore.sources.staged import play, read_staged
from tidescore.streaming import event_time, introspect, keyed, micro_batch, serve, sinks, workspace

REPLAY_SECONDS = 1800


def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    models = inputs.event_models(spark, folder).withColumn("zero", F.lit(0.0))
    records = inputs.event_records(spark, folder)
    return keyed.model_rows(models, ["zero", "weight"]).unionByName(keyed.record_rows(records, "event_id", ["value"]))


def line_rows(spark: SparkSession, folder: str) -> DataFrame:
    models = inputs.order_models(spark, folder)
    records = inputs.wine(spark, folder).withColumn("id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    weights = ["intercept", *[f"c{i}" for i in range(len(FEATURES))]]
    return keyed.model_rows(models, weights).unionByName(keyed.record_rows(records, "id", FEATURES))


def drain(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over everything that is there, then stop."""
    with state_partitions(df.sparkSession), batches_by_rows(df.sparkSession):
        running = sinks.table(df, path, checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()


def run_keyed(rows: DataFrame, shards: int, **options) -> tuple[DataFrame, str]:
    """Deliver `rows` as slices in time order and run a stream over them, one slice per batch."""
    spark = rows.sparkSession
    source, path, checkpoint = (scratch_path(spark, n) for n in ("stage", "out", "checkpoint"))
    play(rows, source)
    stream = read_staged(spark, source, keyed.INPUT_SCHEMA)
    drain(keyed.keyed_scoring(stream, shards=shards, **options), path, checkpoint)
    return spark.read.schema(keyed.OUTPUT_SCHEMA).parquet(path), checkpoint


def event_result(scored: DataFrame) -> DataFrame:
    return scored.select("data_type", F.col("id").alias("event_id"), "version", F.round("result", 6).alias("result"))


@query("stream_keyed_score", EVENT_SCORE)
def stream_keyed_score(spark, folder):
    """One key per user, one shard per key."""
    scored, _ = run_keyed(event_rows(spark, folder), shards=1)
    return event_result(keyed.unscored(scored))


@query(
    "stream_sharded",
    f"WITH {sqltext.ORDER_ASOF} SELECT l_orderkey * 8 + l_linenumber AS id, version, "
    f"round({sqltext.ORDER_SCORE}, 6) AS result FROM resolved WHERE version IS NOT NULL",
)
def stream_sharded(spark, folder):
    """Two data types hold all records; shards spread each over the tasks."""
    scored, _ = run_keyed(line_rows(spark, folder), shards=8)
    return keyed.unscored(scored).select("id", "version", F.round("result", 6).alias("result"))


@query("stream_keyed_mixed", f"SELECT l_orderkey * 8 + l_linenumber AS id, version, result FROM ({MIXED}) AS s")
def stream_keyed_mixed(spark, folder):
    """Keyed state for models of every kind: state picks the version, the registry has its parameters."""
    versions = published(spark, folder)
    records = inputs.wine(spark, folder).withColumn("id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    rows = keyed.model_rows(versions).unionByName(keyed.record_rows(records, "id", FEATURES))
    scored, _ = run_keyed(rows, shards=8)
    done = keyed.complete(keyed.unscored(scored), versions)
    return done.select("id", "version", F.round("result", 5).alias("result"))


_DAYS_PER_SLICE, _LATE_DAYS = 5, 6


def _slice_sql(ts: str, key: str) -> str:
    """Number of the batch a row comes in: by its time, some rows one batch late, some three."""
    return (f"(date_diff('day', (SELECT min(ts)::DATE FROM events), {ts}::DATE) // {_DAYS_PER_SLICE} "
            f"+ CASE WHEN {key} % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN {key} % 31 = 0 THEN 3 ELSE 0 END)")


_IN_TIME = (
    f"WITH {sqltext.EVENTS}, arrived AS (SELECT valid_from AS ts, version AS id, {_slice_sql('valid_from', 'version')} AS batch "
    f"FROM models UNION ALL SELECT ts, event_id, {_slice_sql('ts', 'event_id')} FROM records), "
    "marks AS (SELECT batch, coalesce(max(max(epoch_ms(ts))) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) "
    f"- {_LATE_DAYS * 86_400_000}, -1) AS mark FROM arrived GROUP BY batch), "
    f"last AS (SELECT max(epoch_ms(ts)) - {_LATE_DAYS * 86_400_000} AS mark FROM arrived), "
    f"m AS (SELECT models.* FROM models JOIN marks ON batch = {_slice_sql('valid_from', 'version')} WHERE epoch_us(valid_from) > mark * 1000), "
    f"r AS (SELECT records.* FROM records JOIN marks ON batch = {_slice_sql('ts', 'event_id')}, last "
    "WHERE epoch_us(ts) > marks.mark * 1000 AND epoch_us(ts) <= last.mark * 1000) "
    "SELECT r.data_type, event_id, version, round(weight * value, 6) AS result FROM r ASOF JOIN m "
    "ON r.data_type = m.data_type AND r.ts >= m.valid_from"
)


@query("stream_event_time", _IN_TIME)
def stream_event_time(spark, folder):
    """Records and models that come out of time order: each record meets the model of its own time, late rows go."""
    rows = event_rows(spark, folder)
    first = inputs.table(spark, folder, "events").agg(F.to_date(F.min("ts")).alias("d")).first().d
    day = F.date_diff(F.to_date("ts"), F.lit(first))
    arrival = F.floor(day / _DAYS_PER_SLICE) + F.when(F.col("id") % 7 == 0, 1).otherwise(0) + F.when(
        F.col("id") % 31 == 0, 3).otherwise(0)
    source, path, checkpoint = (scratch_path(spark, n) for n in ("stage", "out", "checkpoint"))
    play(rows, source, arrival=arrival)
    stream = read_staged(spark, source, keyed.INPUT_SCHEMA)
    drain(event_time.event_time_scoring(stream, f"{_LATE_DAYS} days", shards=2), path, checkpoint)
    return event_result(keyed.unscored(spark.read.schema(keyed.OUTPUT_SCHEMA).parquet(path)))


@query(
    "stream_one_output_per_input",
    f"WITH {sqltext.EVENT_ASOF} SELECT false AS is_model, version IS NULL AS empty, count(*) AS n FROM resolved "
    "GROUP BY 1, 2 UNION ALL SELECT true, true, count(*) FROM models",
)
def stream_one_output_per_input(spark, folder):
    """Model messages and records without a model appear as empty results."""
    scored, _ = run_keyed(event_rows(spark, folder), shards=1, emit_models=True)
    return scored.groupBy("is_model", F.col("version").isNull().alias("empty")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_restart", EVENT_SCORE)
def stream_restart(spark, folder):
    """Two slices per run: the second batch of a run and the first of the next both find their models."""
    rows = event_rows(spark, folder)
    source, path, checkpoint = (scratch_path(spark, n) for n in ("stage", "out", "checkpoint"))
    delivered = []

    def run() -> None:
        delivered.append(1)
        if len(delivered) % 2 == 0:
            stream = read_staged(spark, source, keyed.INPUT_SCHEMA)
            drain(keyed.unscored(keyed.keyed_scoring(stream, shards=1)), path, checkpoint)

    play(rows, source, run, at_least=4)
    if len(delivered) % 2:
        run()
    return event_result(spark.read.schema(keyed.OUTPUT_SCHEMA).parquet(path))


@query(
    "stream_initial_state",
    f"WITH {sqltext.EVENT_ASOF} SELECT data_type, event_id, coalesce(version, -1 - CAST(data_type AS BIGINT)) AS version, "
    "round(coalesce(weight, 1e0) * value, 6) AS result FROM resolved",
)
def stream_initial_state(spark, folder):
    """Every user starts with a model of weight one, so no record goes unscored."""
    users = inputs.table(spark, folder, "events").select("user_id").distinct()
    initial = users.select(
        F.col("user_id").cast("string").alias("data_type"),
        (-1 - F.col("user_id")).alias("version"),
        F.lit("2000-01-01 00:00:00").cast("timestamp").alias("valid_from"),
        F.array(F.lit(0.0), F.lit(1.0)).alias("weights"),
    )
    scored, _ = run_keyed(event_rows(spark, folder), shards=1, initial=initial)
    return event_result(keyed.unscored(scored))


def micro_batch_workspace(spark, folder) -> str:
    source, workspace, checkpoint = (scratch_path(spark, n) for n in ("stage", "workspace", "checkpoint"))

    def split(batch):
        records = batch.where(~F.col("is_model")).select("data_type", "ts", "id", "features", "duration")
        models = batch.where("is_model").select(
            "data_type", F.col("id").alias("version"), F.col("ts").alias("valid_from"), "weights"
        )
        return records, models

    def score(resolved):
        value = F.col("weights")[0] + F.col("weights")[1] * F.col("features")[0]
        return resolved.withColumn("result", value).drop("weights", "features")

    play(event_rows(spark, folder), source)
    stream = read_staged(spark, source, keyed.INPUT_SCHEMA)
    writer = micro_batch.registry_scoring(stream, workspace, split, score)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return workspace


@query("stream_broadcast", EVENT_SCORE)
def stream_broadcast(spark, folder):
    """No state per key: each micro-batch joins the models in force."""
    return event_result(micro_batch.read_scored(spark, micro_batch_workspace(spark, folder)))


@query(
    "stream_broadcast_stats",
    f"WITH {sqltext.EVENT_ASOF} SELECT data_type, version, count(*) AS usage, "
    "CAST(sum(duration) AS BIGINT) AS duration, min(duration) AS min_duration, max(duration) AS max_duration "
    "FROM resolved WHERE version IS NOT NULL GROUP BY 1, 2",
)
def stream_broadcast_stats(spark, folder):
    """Statistics as a table: per-batch partials, merged when read."""
    stats = micro_batch.read_stats(spark, micro_batch_workspace(spark, folder))
    return stats.select("data_type", "version", "usage", "duration", "min_duration", "max_duration")


_STATS = "data_type, version, usage, duration, lo AS min_duration, hi AS max_duration"


def _stats(df: DataFrame) -> DataFrame:
    return df.select("data_type", "version", "usage", "duration", "min_duration", "max_duration")


@query("stream_two_slot_stats", f"WITH {CURRENT} SELECT {_STATS} FROM newest")
def stream_two_slot_stats(spark, folder):
    """A model waits until the next record, so the statistics are those of the newest model in use."""
    _, checkpoint = run_keyed(event_rows(spark, folder), shards=1, swap="next_record")
    return _stats(introspect.serving_info(spark, checkpoint))


@query(
    "state_read",
    f"WITH {CURRENT}, last_model AS (SELECT data_type, arg_max(version, valid_from) AS newest FROM models GROUP BY 1) "
    f"SELECT {_STATS.replace('data_type', 'u.data_type', 1)} FROM used u JOIN last_model l "
    "ON u.data_type = l.data_type AND u.version = l.newest",
)
def state_read(spark, folder):
    """Current statistics read from the state store of a stream that replaces models at once."""
    _, checkpoint = run_keyed(event_rows(spark, folder), shards=1)
    return _stats(introspect.serving_info(spark, checkpoint))


@query(
    "state_keys",
    "SELECT CASE WHEN o_orderstatus IS NULL THEN NULL ELSE o_orderstatus END AS data_type, 8 AS shards "
    "FROM orders GROUP BY 1",
)
def state_keys(spark, folder):
    _, checkpoint = run_keyed(line_rows(spark, folder), shards=8)
    return introspect.state_keys(spark, checkpoint).select("data_type", F.col("shards").cast("int").alias("shards"))


# What Spark calls the operator and its store.
@query(
    "state_metadata",
    "SELECT 0 AS \"operatorId\", 'transformWithStateInPandasExec' AS \"operatorName\", 'default' AS \"stateStoreName\", "
    "count(DISTINCT o_orderstatus) > 0 AS partitioned FROM orders",
)
def state_metadata(spark, folder):
    _, checkpoint = run_keyed(line_rows(spark, folder), shards=8)
    return introspect.stores(spark, checkpoint).select(
        F.col("operatorId").cast("int").alias("operatorId"), "operatorName", "stateStoreName",
        (F.col("numPartitions") > 0).alias("partitioned"))


@query(
    "stream_dead_letters",
    "SELECT l_returnflag = 'N' AS bad, count(*) AS n FROM lineitem GROUP BY 1",
)
def stream_dead_letters(spark, folder):
    """Encoded records arrive as bytes, some cut short; good rows and dead letters go apart."""
    df = inputs.wine(spark, folder).withColumnRenamed("data_type", "dataType")
    raw = df.select(
        "ts", "l_returnflag", codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("value")
    )
    cut = F.when(
        F.col("l_returnflag") == "N", F.substring("value", F.lit(1), F.length("value") - 1)
    ).otherwise(F.col("value"))
    rows = raw.select("ts", cut.alias("value"))
    source, good, bad, checkpoint = (scratch_path(spark, n) for n in ("stage", "good", "bad", "checkpoint"))

    play(rows, source)
    writer = sinks.good_and_bad(clean.parse_records(read_staged(spark, source, rows.schema)), good, bad)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    counts = [
        spark.read.parquet(path).select(F.lit(flag).alias("bad")) for path, flag in ((good, False), (bad, True))
    ]
    return counts[0].unionByName(counts[1]).groupBy("bad").agg(F.count(F.lit(1)).alias("n"))


def message_rows(spark: SparkSession, folder: str, unscorable: bool = False) -> DataFrame:
    """Orders and lines as encoded messages of one stream, records cut short where lines are new.

    With `unscorable`, models that read well and cannot score stand in for those of low priority.
    """
    descriptors = inputs.order_descriptors(spark, folder)
    if unscorable:
        bad = inputs.unscorable_descriptors(spark, folder).where("description = '5-LOW'")
        descriptors = descriptors.where("description <> '5-LOW'").unionByName(bad)
    models = descriptors.select(
        F.lit("models").alias("topic"), codec.encode_descriptor(F.struct(*DESCRIPTOR_SCHEMA.names)).alias("value"),
        F.col("valid_from").cast("timestamp").alias("timestamp"), F.col("version").alias("offset"),
    )
    lines = inputs.wine(spark, folder).withColumnRenamed("data_type", "dataType")
    encoded = lines.select(
        F.lit("mdata").alias("topic"), codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("whole"),
        F.col("ts").cast("timestamp").alias("timestamp"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("offset"),
        "l_returnflag",
    )
    short = F.substring("whole", F.lit(1), F.length("whole") - 1)
    records = encoded.withColumn(
        "value", F.when(F.col("l_returnflag") == "N", short).otherwise(F.col("whole"))
    ).drop("whole", "l_returnflag")
    both = models.unionByName(records).withColumn("partition", F.lit(0))
    return both.select(*serve.MESSAGE_SCHEMA.names)


def served(spark: SparkSession, folder: str, unscorable: bool = False, initial: DataFrame | None = None, fan: int = 8) -> str:
    source, target, checkpoint = (scratch_path(spark, n) for n in ("stage", "workspace", "checkpoint"))
    play(message_rows(spark, folder, unscorable), source, ts="timestamp")
    writer = serve.serve(read_staged(spark, source, serve.MESSAGE_SCHEMA), target, initial=initial, fan=fan)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return target


_SERVED = MIXED.replace("FROM wine w ASOF", "FROM (SELECT * FROM wine WHERE l_returnflag <> 'N') w ASOF")


@query(
    "stream_serve",
    f"SELECT l_orderkey * 8 + l_linenumber AS record, version, result FROM ({_SERVED}) AS s",
)
def stream_serve(spark, folder):
    """Bytes in, scores out: decode, refuse, register, resolve and score, models of three kinds."""
    return serve_result(serve.read(spark, served(spark, folder), "scored"))


def serve_result(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("offset").alias("record"), F.shiftright("version", serve.PARTITION_BITS).alias("version"),
        F.round("result", 5).alias("result"),
    )


@query("stream_serve_bad_models", f"SELECT l_orderkey * 8 + l_linenumber AS record, version, result FROM ({_SERVED}) AS s")
def stream_serve_bad_models(spark, folder):
    """Models that cannot score stop nothing and replace nothing."""
    return serve_result(serve.read(spark, served(spark, folder, unscorable=True), "scored"))


_STARTED = _mixed_sql(join="ASOF LEFT JOIN", otherwise=("-1", "7.5e0")).replace(
    "FROM wine w ASOF", "FROM (SELECT * FROM wine WHERE l_returnflag <> 'N') w ASOF")


@query("stream_serve_initial", f"SELECT l_orderkey * 8 + l_linenumber AS record, version, result FROM ({_STARTED}) AS s")
def stream_serve_initial(spark, folder):
    """The server starts with the models of a registry: every record has one."""
    params = F.struct(*[
        {"kind": F.lit("linear"), "intercept": F.lit(7.5), "link": F.lit("identity"),
         "coefs": F.array(*[F.lit(0.0)] * len(FEATURES))}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in PARAMS_TYPE.fields])
    types = inputs.table(spark, folder, "lineitem").select(F.col("l_linestatus").alias("data_type")).distinct()
    values = {
        "version": F.lit(-1) * (1 << serve.PARTITION_BITS), "name": F.lit("start"), "modeltype": F.lit("PMML"),
        "valid_from": F.lit("1990-01-01 00:00:00"), "params": params, "data_type": F.col("data_type"),
    }
    initial = types.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MODEL_VERSION_SCHEMA.fields])
    path = scratch_path(spark, "registry")
    registry.append_versions(initial, path)
    return serve_result(serve.read(spark, served(spark, folder, initial=registry.read_versions(spark, path)), "scored"))


@query(
    "serve_stats",
    f"SELECT m.o_orderstatus AS data_type, s.version, count(*) AS usage, true AS ordered FROM ({_SERVED}) AS s "
    "JOIN orders m ON s.version = m.o_orderkey GROUP BY 1, 2",
)
def serve_stats(spark, folder):
    """Statistics of a server's run per model version, over all its batches."""
    stats = serve.serve_stats(spark, served(spark, folder))
    mean, low, high = F.col("avg_duration"), F.col("min_duration"), F.col("max_duration")
    return stats.select(
        "data_type", F.shiftright("version", serve.PARTITION_BITS).alias("version"), "usage",
        ((low > 0) & (low <= mean * 1.000001) & (mean <= high * 1.000001)).alias("ordered"))


@query(
    "serve_compacted",
    f"SELECT l_orderkey * 8 + l_linenumber AS record, version, result, true AS few_folders FROM ({_SERVED}) AS s",
)
def serve_compacted(spark, folder):
    """A server whose folders are merged two by two: the same rows, and no tier left with two folders."""
    space = workspace.Workspace(spark, served(spark, folder, fan=2))
    held = space.manifest()
    tiers = [[tier for _, tier in folders] for folders in held.tables.values()]
    few = held.batch > 0 and all(len(t) == len(set(t)) for t in tiers)
    return serve_result(space.read("scored", held)).withColumn("few_folders", F.lit(few))


@query(
    "serve_durations",
    f"SELECT m.o_orderstatus AS data_type, s.version, count(*) AS usage, true AS timed, true AS summed FROM ({_SERVED}) AS s "
    "JOIN orders m ON s.version = m.o_orderkey GROUP BY 1, 2",
)
def serve_durations(spark, folder):
    """Scoring times record by record: every record has one, and the statistics are their sum, least and largest."""
    path = served(spark, folder)
    of_records = serve.read(spark, path, "scored").groupBy("data_type", "version").agg(
        F.count("duration").alias("n"), F.min("duration").alias("low"), F.max("duration").alias("high"), F.sum("duration").alias("total"))
    both = serve.serve_stats(spark, path).join(of_records, ["data_type", "version"])
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1e-6 * F.abs(F.col(b))
    return both.select(
        "data_type", F.shiftright("version", serve.PARTITION_BITS).alias("version"), "usage",
        ((F.col("n") == F.col("usage")) & (F.col("low") > 0)).alias("timed"),
        (near("duration", "total") & near("min_duration", "low") & near("max_duration", "high")).alias("summed"))


@query(
    "serve_current_stats",
    f"WITH used AS (SELECT m.o_orderstatus AS data_type, s.version, m.o_orderdate AS since, count(*) AS usage FROM ({_SERVED}) "
    "AS s JOIN orders m ON s.version = m.o_orderkey GROUP BY 1, 2, 3), newest AS (SELECT * FROM used QUALIFY row_number() "
    "OVER (PARTITION BY data_type ORDER BY since DESC, version DESC) = 1), types AS (SELECT DISTINCT o_orderstatus AS "
    "data_type FROM orders) SELECT data_type, coalesce('order-' || version, 'None') AS name, coalesce(usage, 0) AS usage "
    "FROM types LEFT JOIN newest USING (data_type)",
)
def serve_current_stats(spark, folder):
    """What a lookup shows: a row per data type, defaults where no model has been used."""
    types = inputs.table(spark, folder, "orders").select(F.col("o_orderstatus").alias("data_type"))
    return serve.serve_current(spark, served(spark, folder), types).select("data_type", "name", "usage")


@query(
    "stream_serve_dead_letters",
    "SELECT 'models' AS source, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Bad model: broken document' "
    "WHEN o_totalprice > 250000 THEN 'Location based is not yet supported' ELSE 'Bad model type' END AS error, "
    "count(*) AS n FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY 1, 2 UNION ALL "
    "SELECT 'mdata', 'undecodable message: DecodeError', count(*) FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2",
)
def stream_serve_dead_letters(spark, folder):
    dead = serve.read(spark, served(spark, folder), "dead")
    return dead.groupBy("source", "error").agg(F.count(F.lit(1)).alias("n"))


def run_batches(sent: DataFrame, count: int) -> str:
    """Run an endless stream for its first batches; the folder of its rows."""
    out, checkpoint = (scratch_path(sent.sparkSession, n) for n in ("out", "checkpoint"))
    running = sinks.table(sent, out, checkpoint).start()
    deadline = time.monotonic() + REPLAY_SECONDS
    while not running.recentProgress or running.lastProgress["batchId"] < count - 1:
        running.awaitTermination(1)
        if time.monotonic() > deadline:
            running.stop()
            raise TimeoutError(f"{count} batches of the replay took more than {REPLAY_SECONDS} s")
    running.stop()
    return out


_MODEL_BATCHES, _RECORDS_PER_MODEL = 3, 5


@query(
    "stream_replay_models",
    "WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS pair FROM part), "
    "e AS (SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS position, count(*) OVER () AS n FROM events), "
    f"s AS (SELECT unnest(range(2 * {_RECORDS_PER_MODEL} * (SELECT count(*) FROM part))) AS sequence) "
    "SELECT 'models' AS topic, 2 * pair AS sequence, 60 * (2 * pair) AS second, 'pmml-' || p_name AS value FROM p UNION ALL "
    "SELECT 'models', 2 * pair + 1, 60 * (2 * pair + 1), 'tensor-' || p_name FROM p UNION ALL "
    f"SELECT 'mdata', sequence, {60 // _RECORDS_PER_MODEL} * sequence, event_id::VARCHAR FROM s JOIN e ON position = sequence % n",
)
def stream_replay_models(spark, folder):
    """Records every twelve seconds and models every minute in one stream, the models' kinds alternating: one round of models."""
    events = inputs.table(spark, folder, "events").select("ts", "event_id", F.col("event_id").cast("string").alias("value"))
    parts = inputs.table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("pmml-"), "p_name").alias("pmml"), F.concat(F.lit("tensor-"), "p_name").alias("tensor"))
    paths = [scratch_path(spark, n) for n in ("replay-records", "replay-models")]
    replay.replay_table(events, ["ts", "event_id"]).write.parquet(paths[0])
    replay.alternating_models(parts, ["p_partkey"]).withColumnRenamed("model", "value").write.parquet(paths[1])
    records, models = (spark.read.parquet(p) for p in paths)
    size = models.count()
    sent = replay.two_speed_replay(
        spark, records, records.count(), models, size, _RECORDS_PER_MODEL, models_per_batch=-(-size // _MODEL_BATCHES))
    rows = spark.read.parquet(run_batches(sent, _MODEL_BATCHES))
    last = F.when(F.col("topic") == "models", size).otherwise(size * _RECORDS_PER_MODEL)
    return rows.where(F.col("sequence") < last).select(
        "topic", "sequence", F.unix_seconds("sent_at").alias("second"), "value")


_BATCHED = (
    f"WITH {sqltext.EVENT_ASOF}, numbered AS (SELECT *, date_diff('day', (SELECT min(ts)::DATE FROM events), ts::DATE) // 5 AS batch "
    "FROM resolved), arrived AS (SELECT data_type, version, valid_from, "
    "date_diff('day', (SELECT min(ts)::DATE FROM events), valid_from::DATE) // 5 AS batch FROM models), "
    "touched AS (SELECT DISTINCT data_type, batch FROM numbered UNION SELECT DISTINCT data_type, batch FROM arrived), "
    "newest AS (SELECT t.data_type, t.batch, max_by(a.version, (a.valid_from, a.version)) AS version FROM touched t JOIN arrived a "
    "ON a.data_type = t.data_type AND a.batch <= t.batch GROUP BY 1, 2) "
    "SELECT n.batch AS batch_id, n.data_type, n.version, count(r.event_id) AS usage FROM newest n LEFT JOIN numbered r "
    "ON r.data_type = n.data_type AND r.version = n.version AND r.batch <= n.batch GROUP BY 1, 2, 3"
)


@query("state_changes", _BATCHED)
def state_changes(spark, folder):
    """What a poller sees after every batch: the statistics of each key that the batch touched."""
    rows = event_rows(spark, folder)
    first = inputs.table(spark, folder, "events").agg(F.to_date(F.min("ts")).alias("d")).first().d
    source, path, checkpoint = (scratch_path(spark, n) for n in ("stage", "out", "checkpoint"))
    slices = play(rows, source, arrival=F.floor(F.date_diff(F.to_date("ts"), F.lit(first)) / 5))
    with kept_batches(spark, slices + 1):
        drain(keyed.keyed_scoring(read_staged(spark, source, keyed.INPUT_SCHEMA), shards=1), path, checkpoint)
    return introspect.stats_changes(spark, checkpoint, 0).select(
        F.col("batch_id").cast("long").alias("batch_id"), "data_type", "version", "usage")


@query(
    "stream_replay",
    "SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS position FROM events",
)
def stream_replay(spark, folder):
    """A paced stream sends the numbered table; one round of it is one row per record."""
    events = inputs.table(spark, folder, "events").select("ts", "event_id")
    path = scratch_path(spark, "replay")
    replay.replay_table(events, ["ts", "event_id"]).write.parquet(path)
    table = spark.read.parquet(path)
    size = table.count()
    sent = replay.endless_replay(replay.batch_ticks(spark, size), table, size)
    out = run_batches(sent, 2)
    first = spark.read.parquet(out).where(F.col("sequence") < size)
    return first.select("event_id", "position")
