"""Total order without a single task: range-split chunks, carried prefixes, global row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidescore.session import checked_broadcast, scratch_table

OFFSET_BITS = 33  # layout of monotonically_increasing_id: partition number above, row offset below


def ordered_chunks(df: DataFrame, order: Sequence[Column], label: str, drop: Sequence[str] = ()) -> DataFrame:
    """Split rows into range partitions of the total order `order` and keep the split as a column.

    Adds `_chunk` (increases with the order) and `_offset` (row position inside the chunk). Spark
    samples the range bounds, so a hot key is cut into as many chunks as its rows need. The
    table is written once because the bounds must not change between its readers. Columns to `drop`
    serve the order only and are not written; `_offset` has it from there.
    """
    split = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    placed = split.select(
        *[c for c in df.columns if c not in drop],
        F.shiftright("_pos", OFFSET_BITS).cast("int").alias("_chunk"),
        F.col("_pos").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1)).alias("_offset"),
    )
    return scratch_table(placed, label)


def with_global_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Zero-based row number over the whole table."""
    chunks = ordered_chunks(df, order, "index")
    sizes = chunks.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: as many rows as shuffle partitions, at any data size.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return chunks.join(F.broadcast(starts), "_chunk").select(
        *df.columns, (F.col("_start") + F.col("_offset")).alias(name)
    )


def with_key_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Zero-based row number within each key, by `order`; a key with most of the rows is cut into chunks like any other."""
    chunks = ordered_chunks(df, [*[F.col(k) for k in keys], *order], "index")
    spans = chunks.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"), F.min("_offset").alias("_low"))
    # A chunk holds a key's rows in one run. Rows here: one per chunk, and one more per key.
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_of"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_low")).alias("_start"))
    same = F.col("_chunk") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return chunks.join(checked_broadcast(starts), same).select(*df.columns, (F.col("_start") + F.col("_offset")).alias(name))


def carried_before(per_chunk: DataFrame, keys: Sequence[str], carry: dict[str, Column]) -> DataFrame:
    """For each (keys, _chunk): aggregates of that key's earlier chunks.

    `carry` maps output names to window aggregates over (keys ordered by chunk); one key has at
    most one row per chunk.
    """
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(*keys, "_chunk", *[c.over(before).alias(n) for n, c in carry.items()])
