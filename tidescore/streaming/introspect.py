"""Questions about a stream from outside it: current statistics, stores, instances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.operators.stats import merge_stats
from tidescore.streaming.keyed import entries_of


def state_values(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """Raw (key, value) rows of one part of the keys' entries: `current`, `pending` or `stats`."""
    rows = spark.read.format("statestore").option("stateVarName", "pages").load(checkpoint)
    return _part(_entries(rows), variable)


def _entries(pages: DataFrame, *more: str) -> DataFrame:
    entries = F.col("user_map_value.entries").alias("entries")
    return entries_of(pages.select(entries, *more).where(F.col("entries").isNotNull()), *more)


def _part(rows: DataFrame, variable: str, *more: str) -> DataFrame:
    return rows.where(F.col(variable).isNotNull()).select(*more, "key", F.col(variable).alias("value"))


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the newest batch whose state is complete; -1 before the first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


def state_changes(
    spark: SparkSession, checkpoint: str, variable: str, first: int, last: int | None = None, data_type: str | None = None
) -> DataFrame:
    """What batches `first` to `last` (the newest by default) changed in a part of the keys' entries: batch_id, change_type, key, value.

    A change log has whole pages; of those the keys that the batch worked on are given.

    A poller asks for one key from the batch after the `last_batch` it has seen, so a poll reads the change logs
    of the batches since and not the state. No batches give no rows.
    """
    newest = last_batch(spark, checkpoint)
    last = newest if last is None else min(last, newest)
    reader = spark.read.format("statestore").option("stateVarName", "pages").option("readChangeFeed", True)
    span = (first, last) if first <= last else (max(newest, 0), max(newest, 0))
    rows = reader.option("changeStartBatchId", span[0]).option("changeEndBatchId", span[1]).load(checkpoint)
    rows = _part(_entries(rows, "batch_id", "change_type").where("touched"), variable, "batch_id", "change_type")
    if first > last:
        rows = rows.limit(0)
    if data_type is not None:
        rows = rows.where(F.col("key.data_type") == data_type)
    return rows


def stats_changes(
    spark: SparkSession, checkpoint: str, first: int, last: int | None = None, data_type: str | None = None
) -> DataFrame:
    """Statistics as each batch left them, per key it touched: batch_id, data_type, shard, version, usage, durations."""
    rows = state_changes(spark, checkpoint, "stats", first, last, data_type).where("change_type = 'update'")
    return rows.select(
        "batch_id", "key.data_type", "key.shard", "value.version", "value.usage", "value.duration", "value.min_duration",
        "value.max_duration")


def serving_info(spark: SparkSession, checkpoint: str, data_type: str | None = None) -> DataFrame:
    """Current statistics per data type, shards merged; empty where the key is unknown.

    Shards of a data type may differ in their current version for a moment; the newest one with
    any record is reported.
    """
    raw = state_values(spark, checkpoint, "stats")
    rows = raw.select(
        F.col("key.data_type").alias("data_type"),
        F.col("value.version").alias("version"),
        F.timestamp_micros("value.since_arrival").alias("since_arrival"),
        F.timestamp_micros("value.since_first_use").alias("since_first_use"),
        *[F.col(f"value.{c}").alias(c) for c in ("usage", "duration", "min_duration", "max_duration")],
    )
    if data_type is not None:
        rows = rows.where(F.col("data_type") == data_type)
    merged = merge_stats(rows.where(F.col("usage") > 0))
    names = [c for c in merged.columns if c != "data_type"]
    return (
        merged.groupBy("data_type")
        .agg(F.max_by(F.struct(*names), F.struct("since_arrival", "version")).alias("s"))
        .select("data_type", *[F.col(f"s.{c}").alias(c) for c in names])
    )


def stores(spark: SparkSession, checkpoint: str, store: str | None = None) -> DataFrame:
    """Operators and their state stores with partition counts; optionally one store's rows."""
    df = spark.read.format("state-metadata").load(checkpoint)
    if store is not None:
        df = df.where(F.col("stateStoreName") == store)
    return df.select("operatorId", "operatorName", "stateStoreName", "numPartitions")


def state_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Data types the stream knows, with their shard count."""
    raw = state_values(spark, checkpoint, "current")
    return raw.groupBy(F.col("key.data_type").alias("data_type")).agg(F.count(F.lit(1)).alias("shards"))

