"""Paced, endless replay of a record table and of alternating model files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.operators.ordering import with_global_index
from tidescore.sources.kafka import DATA_TOPIC, MODELS_TOPIC


def replay_table(records: DataFrame, order_by: list[str]) -> DataFrame:
    """Number the records for replay: the list was built by prepending, so the last one goes first."""
    return with_global_index(records, [F.col(c).desc() for c in order_by], "position")


def alternating_models(pairs: DataFrame, order_by: list[str]) -> DataFrame:
    """(pmml, tensor) descriptor pairs -> one replay sequence PMML, tensor, PMML, tensor, ..."""
    indexed = with_global_index(pairs, [F.col(c).asc() for c in order_by], "pair")
    keep = [c for c in pairs.columns if c not in ("pmml", "tensor")]
    return indexed.select("pair", *keep, F.posexplode(F.array("pmml", "tensor")).alias("slot", "model")).select(
        (F.col("pair") * 2 + F.col("slot")).alias("position"), *keep, "model"
    )


def paced_ticks(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """One tick per record to send."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def batch_ticks(spark: SparkSession, rows_per_batch: int, advance_millis: int = 1000) -> DataFrame:
    """Ticks with repeatable values and timestamps: `advance_millis=60000` paces models once a minute."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("advanceMillisPerBatch", advance_millis)
        .option("numPartitions", spark.sparkContext.defaultParallelism)
        .load()
    )


def endless_replay(ticks: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """Join ticks to the numbered table round and round.

    `size` is the row count of `table`. The table joins by its number, so Spark picks broadcast
    or shuffle by the table's own size.
    """
    numbered = ticks.select(
        F.col("timestamp").alias("sent_at"), F.col("value").alias("sequence"),
        F.pmod(F.col("value"), F.lit(size)).alias("position"),
    )
    return numbered.join(table, "position")


def two_speed_replay(
    spark: SparkSession, records: DataFrame, record_count: int, models: DataFrame, model_count: int,
    records_per_model: int = 60, models_per_batch: int = 1, model_millis: int = 60_000,
) -> DataFrame:
    """Both producers as one endless stream: a model every `model_millis`, `records_per_model` records in that time.

    The tables are numbered (`replay_table`, `alternating_models`), hold what is sent in `value`, and are sent
    round and round. Rows: topic, sequence (from 0 per topic), sent_at, position, value. A batch is the time of
    `models_per_batch` models.
    """
    def paced(topic: str, table: DataFrame, size: int, each: int) -> DataFrame:
        rows = each * models_per_batch
        # The source takes a batch's time as an int of milliseconds, too small for that of many models: ticks keep
        # their number alone, and a row's time is that of its batch and as many paces more as it has predecessors there.
        ticks = batch_ticks(spark, rows)
        begun = ((F.col("sequence") - F.pmod("sequence", F.lit(rows))) / F.lit(rows)).cast("long") * (model_millis * models_per_batch * 1000)
        later = F.pmod("sequence", F.lit(rows)) * (model_millis * 1000 // each)
        own = F.timestamp_micros(begun + later)
        return endless_replay(ticks, table.select("position", "value"), size).select(
            F.lit(topic).alias("topic"), "sequence", own.alias("sent_at"), "position", "value")

    if record_count < 1 or model_count < 1:
        raise ValueError("nothing to send round and round")
    return paced(MODELS_TOPIC, models, model_count, 1).unionByName(paced(DATA_TOPIC, records, record_count, records_per_model))
