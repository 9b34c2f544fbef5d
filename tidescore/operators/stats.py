"""Serving statistics per model version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidescore.functions.text import epoch_millis, format_millis
from tidescore.operators.ordering import carried_before, ordered_chunks
from tidescore.schemas import EMPTY_STATS
from tidescore.session import checked_broadcast

KEYS = ["data_type", "version"]


def serving_stats(scored: DataFrame, duration: str = "duration") -> DataFrame:
    """Count, sum, mean, min and max of scoring time, and both meanings of `since`.

    A version that served no record has no row. All aggregates combine on the map side.
    """
    d = F.col(duration)
    return scored.groupBy(*KEYS).agg(
        F.min("valid_from").alias("since_arrival"),
        F.min("ts").alias("since_first_use"),
        F.count(F.lit(1)).alias("usage"),
        F.sum(d).alias("duration"),
        F.min(d).alias("min_duration"),
        F.max(d).alias("max_duration"),
        F.try_divide(F.sum(d).cast("double"), F.count(F.lit(1))).alias("avg_duration"),
    )


def merge_stats(partials: DataFrame) -> DataFrame:
    """Combine statistics rows of several shards or micro-batches into one row per version."""
    return partials.groupBy(*KEYS).agg(
        F.min("since_arrival").alias("since_arrival"),
        F.min("since_first_use").alias("since_first_use"),
        F.sum("usage").alias("usage"),
        F.sum("duration").alias("duration"),
        F.min("min_duration").alias("min_duration"),
        F.max("max_duration").alias("max_duration"),
        F.try_divide(F.sum("duration").cast("double"), F.sum("usage")).alias("avg_duration"),
    )


def running_stats(scored: DataFrame, id_columns: list[str], duration: str = "duration") -> DataFrame:
    """Statistics as they stand after each record, in (ts, id) order per version.

    Prefix sums in two levels: inside range chunks, plus what earlier chunks of the version hold.
    """
    names = [*KEYS, "ts", *id_columns]
    rows = scored.select(*names, F.col(duration).alias("_d"))
    chunks = ordered_chunks(rows, [F.col(c) for c in names], "running")
    per_chunk = chunks.groupBy(*KEYS, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_d").alias("_s"), F.min("_d").alias("_lo"), F.max("_d").alias("_hi")
    )
    earlier = carried_before(
        per_chunk, KEYS, {"_n0": F.sum("_n"), "_s0": F.sum("_s"), "_lo0": F.min("_lo"), "_hi0": F.max("_hi")}
    ).where(F.col("_n0").isNotNull())
    inside = (
        Window.partitionBy(*KEYS, "_chunk").orderBy("ts", *id_columns)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = chunks.select(
        *names, "_chunk",
        F.count(F.lit(1)).over(inside).alias("_n"),
        F.sum("_d").over(inside).alias("_s"),
        F.min("_d").over(inside).alias("_lo"),
        F.max("_d").over(inside).alias("_hi"),
    )
    zero = F.lit(0)
    return own.join(earlier, [*KEYS, "_chunk"], "left").select(
        *names,
        (F.col("_n") + F.coalesce("_n0", zero)).alias("usage"),
        (F.col("_s") + F.coalesce("_s0", zero)).alias("duration"),
        F.least("_lo", "_lo0").alias("min_duration"),
        F.greatest("_hi", "_hi0").alias("max_duration"),
    )


def current_stats(data_types: DataFrame, stats: DataFrame, models: DataFrame) -> DataFrame:
    """One row per data type: the statistics of its newest used version, defaults where none is."""
    names = ["version", "name", "description", "modeltype", "since", "usage", "duration", "min_duration",
             "max_duration"]
    described = stats.join(
        models.select(*KEYS, "name", "description", "modeltype"), KEYS, "left"
    ).withColumn("since", epoch_millis(F.col("since_arrival")))
    newest = described.groupBy("data_type").agg(
        F.max_by(F.struct(*names), F.struct("since_arrival", "version")).alias("s")
    )
    types = data_types.select("data_type").distinct()
    return types.join(newest, "data_type", "left").select(
        "data_type",
        *[
            F.coalesce(F.col(f"s.{c}"), F.lit(EMPTY_STATS[c])).alias(c) if c in EMPTY_STATS
            else F.col(f"s.{c}").alias(c)
            for c in names
        ],
    )


def version_names(models: DataFrame) -> DataFrame:
    """Name, description and type of each version, measured for a join."""
    return checked_broadcast(models.select(*KEYS, "name", "description", "modeltype"))


def describe_stats(stats: DataFrame, models: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Attach name, description and type of each version; `names` are `version_names(models)` where they are made already."""
    return stats.join(version_names(models) if names is None else names, KEYS, "left")


def stats_report(described: DataFrame) -> DataFrame:
    """The printed report: seven columns, `since` as text."""
    return described.select(
        "name",
        "description",
        format_millis(epoch_millis(F.col("since_arrival"))).alias("since"),
        "usage",
        F.try_divide(F.col("duration").cast("double"), F.col("usage")).alias("average"),
        F.col("min_duration").alias("min"),
        F.col("max_duration").alias("max"),
    )
