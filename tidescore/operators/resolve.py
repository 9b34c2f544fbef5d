"""Which model version applies to which record.

Records are (data_type, ts, ...), models are (data_type, version, valid_from, ...). A record
gets the newest version of its data type with valid_from <= ts; on equal valid_from the higher
version wins. A model with the timestamp of a record applies to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidescore.functions.text import epoch_micros
from tidescore.operators.ordering import carried_before, ordered_chunks
from tidescore.session import broadcast_limit, checked_broadcast, row_bytes, scratch_table

# Beyond these the lookup table is no longer small or no longer short to scan; see `resolve`.
MAX_BROADCAST_MODELS = 2_000_000
MAX_BUCKET_MODELS = 64
OWN = "_rs_"  # names with this prefix are the joins' own


def usable(records: DataFrame, models: DataFrame) -> DataFrame:
    """Models that can apply at all: a data type and a time are set. Refuses columns that would collide."""
    taken = {c.lower() for c in records.columns}
    payload = [c for c in models.columns if c != "data_type"]
    wrong = [c for c in payload if c.lower() in taken]
    wrong += [c for c in [*records.columns, *payload] if c.lower().startswith(OWN)]
    if wrong:
        raise ValueError(f"columns {wrong} are taken: rename them before records meet models")
    return models.where(F.col("data_type").isNotNull() & F.col("valid_from").isNotNull())


def newest_per_instant(models: DataFrame) -> DataFrame:
    """One version per (data_type, valid_from): the others could never apply to a record."""
    payload = [c for c in models.columns if c not in ("data_type", "valid_from")]
    return (
        models.groupBy("data_type", "valid_from")
        .agg(F.max_by(F.struct(*payload), F.col("version")).alias("_rs_m"))
        .select("data_type", "valid_from", *[F.col(f"_rs_m.{c}").alias(c) for c in payload])
    )


def model_intervals(models: DataFrame) -> DataFrame:
    """Validity [valid_from, _rs_to) per version; _rs_to is null for the current one."""
    w = Window.partitionBy("data_type").orderBy("valid_from")
    return newest_per_instant(models).withColumn("_rs_to", F.lead("valid_from").over(w))


def _grid(models: DataFrame) -> DataFrame:
    """Per data type: origin, bucket width in microseconds and bucket count, about one model per bucket."""
    us = epoch_micros(F.col("valid_from"))
    return models.groupBy("data_type").agg(
        F.min(us).alias("_rs_origin"),
        F.count(F.lit(1)).alias("_rs_buckets"),
        F.ceil((F.max(us) - F.min(us) + 1) / F.count(F.lit(1))).alias("_rs_width"),
    )


def _bucket(micros):
    """Bucket number; the last bucket is open-ended, a time before the first model has none."""
    raw = F.floor((micros - F.col("_rs_origin")) / F.col("_rs_width"))
    return F.when(raw >= 0, F.least(raw, F.col("_rs_buckets") - 1)).cast("long")


def _lookup_is_small(intervals: DataFrame, grid: DataFrame) -> bool:
    """Check size and evenness of the written model side before it is sent to every executor."""
    crowd = (
        intervals.join(grid, "data_type")
        .groupBy("data_type", _bucket(epoch_micros(F.col("valid_from"))).alias("_rs_bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(intervals)).alias("bytes"))
        .agg(F.sum("n").alias("models"), F.max("n").alias("crowd"), F.sum("bytes").alias("bytes"))
        .first()
    )
    # Each model lies in its own bucket and at most one more per bucket boundary it crosses.
    return (
        (crowd.models or 0) <= MAX_BROADCAST_MODELS
        and (crowd.crowd or 0) <= MAX_BUCKET_MODELS
        and 3 * (crowd.bytes or 0) <= broadcast_limit(intervals.sparkSession)
    )


def resolve(records: DataFrame, models: DataFrame, unscored: str = "drop") -> DataFrame:
    """Latest-model join. `unscored="null"` keeps records that have no model yet.

    The model side is reduced to intervals and written once. The usual case, many records and few
    models, is two broadcast hash joins in the record scan's own stage: data type -> time grid,
    then (data type, time bucket) -> versions, with the exact interval as residual condition.
    Neither moves a record, so a hot data type costs nothing. When the model side fails its size
    check, the sorted form answers, from the same intervals and with the same result.
    """
    intervals = scratch_table(model_intervals(usable(records, models)), "intervals")
    grid = _grid(intervals)
    if not _lookup_is_small(intervals, grid):
        return _sorted(records, intervals.select(*models.columns), unscored)
    payload = [c for c in models.columns if c != "data_type"]
    last = F.when(F.col("_rs_to").isNull(), F.col("_rs_buckets") - 1).otherwise(
        _bucket(epoch_micros(F.col("_rs_to")) - 1)
    )
    placed = intervals.join(F.broadcast(grid), "data_type").select(
        F.col("data_type").alias("_rs_type"), *payload, "_rs_to",
        F.explode(F.sequence(_bucket(epoch_micros(F.col("valid_from"))), last)).alias("_rs_place"),
    )
    located = records.join(
        F.broadcast(grid.withColumnRenamed("data_type", "_rs_grid")), F.col("data_type") == F.col("_rs_grid"), "left"
    ).withColumn("_rs_bucket", _bucket(epoch_micros(F.col("ts"))))
    applies = (
        (F.col("data_type") == F.col("_rs_type"))
        & (F.col("_rs_bucket") == F.col("_rs_place"))
        & (F.col("ts") >= F.col("valid_from"))
        & (F.col("_rs_to").isNull() | (F.col("ts") < F.col("_rs_to")))
    )
    how = "left" if unscored == "null" else "inner"
    return located.join(F.broadcast(placed), applies, how).select(*records.columns, *payload)


def resolve_sorted(records: DataFrame, models: DataFrame, unscored: str = "drop") -> DataFrame:
    """The same answer from one sort: union both streams, take the last model seen so far."""
    return _sorted(records, newest_per_instant(usable(records, models)).select(*models.columns), unscored)


def _sorted(records: DataFrame, newest: DataFrame, unscored: str) -> DataFrame:
    """Range chunks split a hot data type over many tasks; what a chunk inherits from earlier
    chunks of its data type is one row per (data type, chunk).
    """
    payload = [c for c in newest.columns if c != "data_type"]
    fields = [c for c in records.columns if c not in ("data_type", "ts")]
    left = newest.select(
        "data_type", F.col("valid_from").alias("ts"), F.lit(0).alias("_rs_side"), F.col("version").alias("_rs_tie"),
        F.struct(*payload).alias("_rs_model"),
    )
    right = records.select(
        "data_type", "ts", F.lit(1).alias("_rs_side"), F.xxhash64(*records.columns).alias("_rs_tie"),
        F.struct(*(fields or [F.lit(0).alias("_rs_none")])).alias("_rs_rec"),
    )
    order = ["data_type", "ts", "_rs_side", "_rs_tie"]
    union = left.unionByName(right, allowMissingColumns=True)
    # The tie is a hash, which no shuffle or file can compress: it goes once the order is made.
    chunks = ordered_chunks(union, [F.col(c) for c in order], "asof", drop=["_rs_tie"])
    latest = chunks.groupBy("data_type", "_chunk").agg(
        F.max_by("_rs_model", F.when(F.col("_rs_side") == 0, F.col("ts"))).alias("_rs_model")
    )
    inherited = carried_before(latest, ["data_type"], {"_rs_inherited": F.last("_rs_model", ignorenulls=True)})
    seen = (
        Window.partitionBy("data_type", "_chunk").orderBy("_offset")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = chunks.withColumn("_rs_own", F.last("_rs_model", ignorenulls=True).over(seen)).where("_rs_side = 1")
    joined = filled.join(inherited, ["data_type", "_chunk"], "left").withColumn(
        "_rs_model", F.coalesce("_rs_own", "_rs_inherited")
    )
    if unscored != "null":
        joined = joined.where(F.col("_rs_model").isNotNull())
    values = {"data_type": F.col("data_type"), "ts": F.col("ts")}
    values.update({c: F.col(f"_rs_rec.{c}") for c in fields})
    # Field order of the payload as in the models, time included.
    return joined.select(
        *[values[c].alias(c) for c in records.columns], *[F.col(f"_rs_model.{c}").alias(c) for c in payload]
    )


def resolve_after(records: DataFrame, snapshot: DataFrame | None, arrived: DataFrame, unscored: str = "drop") -> DataFrame:
    """As `resolve` with `arrived`; where none of them applies yet, the data type's row in `snapshot` does.

    `snapshot` has one row per data type. It applies whatever a record's time is: a late record is
    scored with the model current when it arrives.
    """
    if snapshot is None:
        return resolve(records, arrived, unscored)
    payload = [c for c in arrived.columns if c != "data_type"]
    newer = resolve(records, arrived, "null")
    before = snapshot.select(
        F.col("data_type").alias("_rs_type"), F.struct(*payload).alias("_rs_before"))
    joined = newer.join(before, F.col("data_type") == F.col("_rs_type"), "left")
    chosen = [F.when(F.col("version").isNotNull(), F.col(c)).otherwise(F.col(f"_rs_before.{c}")).alias(c) for c in payload]
    out = joined.select(*records.columns, *chosen)
    return out if unscored == "null" else out.where(F.col("version").isNotNull())


def resolve_latest(records: DataFrame, models: DataFrame, unscored: str = "drop") -> DataFrame:
    """Score everything with the newest model of each data type, whatever the record's time."""
    payload = [c for c in models.columns if c != "data_type"]
    current = current_models(models)
    how = "left" if unscored == "null" else "inner"
    return records.join(checked_broadcast(current), "data_type", how).select(*records.columns, *payload)


def resolve_single(records: DataFrame, models: DataFrame) -> DataFrame:
    """One model for all records, without a key: the newest version overall."""
    payload = [c for c in models.columns if c != "data_type"]
    newest = models.agg(F.max_by(F.struct(*payload), F.struct("valid_from", "version")).alias("m"))
    # One row by construction, so a scalar subquery: no join at all.
    tagged = records.withColumn("_m", newest.scalar()).where(F.col("_m").isNotNull())
    return tagged.select(*records.columns, *[F.col(f"_m.{c}").alias(c) for c in payload])


def current_models(models: DataFrame) -> DataFrame:
    """Newest version per data type."""
    payload = [c for c in models.columns if c != "data_type"]
    return (
        models.groupBy("data_type")
        .agg(F.max_by(F.struct(*payload), F.struct("valid_from", "version")).alias("m"))
        .select("data_type", *[F.col(f"m.{c}").alias(c) for c in payload])
    )


def tagged_union(data: DataFrame, models: DataFrame) -> DataFrame:
    """Both streams as one: nullable structs `data` and `model`, keyed by data type."""
    d = data.select(F.struct(*data.columns).alias("data"))
    m = models.select(F.struct(*models.columns).alias("model"))
    both = d.unionByName(m, allowMissingColumns=True)
    return both.select(
        F.coalesce(F.col("model.data_type"), F.col("data.data_type")).alias("data_type"),
        F.col("model").isNotNull().alias("is_model"),
        "data",
        "model",
    )
