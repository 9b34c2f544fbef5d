"""Folds and bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.session import scratch_table

SAMPLE_PARTS = 8


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, fold: Column, rows: int, id_col: str, text_col: str
) -> DataFrame:
    """At most `rows` labelled rows for which `fold` (an expression over `doc`) holds: doc, label, rank, text.

    The rows are those first in the order of a hash of the id. Conflicting labels of one id count as
    the larger; of several texts of one id that with the smallest hash is taken, so an id is one row
    however often it repeats; null ids and labels are left out. The list of ids is bounded by `rows`, so it is sent
    to the scan and only the texts of the sample move.
    """
    chosen = (
        labels.select(F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label"))
        .dropna().groupBy("doc").agg(F.max("label").alias("label")).where(fold)
        .orderBy(F.xxhash64("doc"), "doc").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    single = texts.join(F.broadcast(chosen), "doc").groupBy("doc", "label").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")).select("doc", "text", "label")
    joined = single.repartition(SAMPLE_PARTS, F.xxhash64("doc", "text"))
    return scratch_table(joined.withColumn("hash", F.xxhash64("doc")), "labelled")


def texts_of(batches: Iterator[pa.RecordBatch], text_at: int, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts as strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(text_at).to_pylist()


def scored_rows(
    docs: DataFrame, carried: Sequence[str], text_col: str, make: Callable[[], Callable[[list[str]], np.ndarray]]
) -> DataFrame:
    """`row` (struct of the carried columns) and `score` per row; `make` builds the scorer once per task."""
    source = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make()
        for part, texts in texts_of(batches, 0, 256):
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(scorer(texts), pa.float64())], ["row", "score"])

    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, score double")


def predictions(scored: DataFrame, id_col: str, folds: int, held_fold: int) -> DataFrame:
    held = F.coalesce(fold_of(F.col(f"row.`{id_col}`"), folds) == held_fold, F.lit(False))
    return scored.select(
        F.col(f"row.`{id_col}`").alias(id_col), held.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
