"""Rows of vectors: which take part, classes of equal vectors, and their values as bytes for numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_sound(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def sound_rows(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (id, vector) of sound vectors that have an id and the most frequent length."""
    vector = F.col(vector_col).cast("array<double>") if "double" in rows.schema[vector_col].dataType.simpleString() else F.col(vector_col)
    sound = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & is_sound(F.col("vector")))
    lengths = sound.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "length").first()
    return sound.where(F.size("vector") == (usual["length"] if usual else -1))


def item_type(rows: DataFrame) -> str:
    return "<f8" if "double" in rows.schema["vector"].dataType.simpleString() else "<f4"


def with_bytes(rows: DataFrame, *keep: str) -> DataFrame:
    """`vector` as the little-endian bytes of its components, beside the long columns `keep`."""
    kind = np.dtype(item_type(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(kind)
                packed = [r.tobytes() for r in flat.reshape(batch.num_rows, -1)]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *batch.columns[1:]], ["vector", *keep])

    schema = "vector binary" + "".join(f", {k} {rows.schema[k].dataType.simpleString()}" for k in keep)
    return rows.select("vector", *keep).mapInArrow(run, schema)


def matrix(packed: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)


def rotation(seed: int, size: int, columns: int) -> np.ndarray:
    """Orthonormal columns, the same on every executor."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0][:, :columns]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, as one table per run of equal values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0].column(0)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
