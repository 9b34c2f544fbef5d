"""Embedding near-duplicates: randomly rotated binary codes with stored correction factors.

A unit vector x is rotated; its code is the signs of the result, and its correction factor f the inner
product of x with its code's unit vector. For any unit q, <code, q> / f estimates <x, q> without bias,
and with D dimensions the error stays below eps * sqrt((1 - f * f) / (f * f * (D - 1))) but for a
probability that falls exponentially with eps squared. Pairs whose bound reaches the threshold are
recomputed exactly; no pair links on its estimate.

Candidate pairs share a band of sign bits under random directions of their own. The bands are as wide as
leaves some tens of vectors per bucket at the table's size, and there are so many that a pair at the
threshold meets with probability 1 - `miss`: the directions are independent normal vectors, each of which
gives a pair's vectors one sign with probability 1 - angle / pi, so bits and bands of a pair are independent
and the rate is exact at any size and number of dimensions. Pairs that never meet are not found. A bucket above a block is dealt out as pairs of blocks. A block
counts each pair only in the first band its two vectors share, and gives link counts and a spanning
set of links, never all pairs.

Defined cases: vectors that are null, zero, of an unusual length, or hold null or non-finite
components link with nothing; equal vectors are one class and link with each other; a row without an
id links with nothing and is not kept; repeated ids count as rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.llm.links import components
from tidescore.llm.vector_rows import item_type, matrix, rotation, runs, sound_rows, with_bytes
from tidescore.session import scratch_table

PER_BUCKET = 32
BLOCK = 1024
PAIRS = 16_384  # pairs whose values are held at a time
EPS = 4.0


def band_layout(n: int, dims: int, cosine: float, miss: float) -> tuple[int, int]:
    """(bits of a band, number of bands) for n vectors."""
    agree = 1 - np.arccos(cosine) / np.pi
    bits = int(np.clip(np.ceil(np.log2(max(n, 1) / PER_BUCKET)), 4, min(dims, 30)))
    meet = agree**bits
    return bits, 1 if meet >= 1 - miss else int(np.ceil(np.log(miss) / np.log(1 - meet)))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(maxsize=1)
def directions(dims: int, bits: int, count: int) -> np.ndarray:
    """Independent normal directions of each band (band, dims, bits), the same on every executor."""
    return np.random.default_rng(1).standard_normal((count, dims, bits))


def bands(x: np.ndarray, bits: int, count: int) -> np.ndarray:
    """Band values of unit vectors: one column per band."""
    weights = 1 << np.arange(bits, dtype=np.int64)
    return np.stack([(x @ d > 0) @ weights for d in directions(x.shape[1], bits, count)], axis=1)


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction factor of unit vectors under the first rotation."""
    turned = x @ rotation(0, x.shape[1], x.shape[1])
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def linked_pairs(x: np.ndarray, code: np.ndarray, factor: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j, of unit vectors with inner product >= cosine: bounds choose, exact products decide."""
    dims = x.shape[1]
    signs = (np.unpackbits(code, axis=1, count=dims).astype(np.float32) * 2 - 1) / np.sqrt(dims)
    turned = (x @ rotation(0, dims, dims)).astype(np.float32)
    estimate = turned @ signs.T / factor[None, :].astype(np.float32)
    bound = EPS * np.sqrt(np.maximum(1 - factor**2, 0) / (factor**2 * max(1, dims - 1)))
    i, j = np.nonzero(np.triu(estimate + bound[None, :].astype(np.float32) >= cosine, 1))
    near = np.concatenate([np.zeros(0, bool), *((x[i[a : a + PAIRS]] * x[j[a : a + PAIRS]]).sum(axis=1) >= cosine
                                                for a in range(0, len(i), PAIRS))])
    return i[near], j[near]


def labels_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def block_links(kind: str, cosine: float, bits: int, count: int):
    """Runs of (group, band, side, rep, weight, vector, code, factor) -> (rep, links) and links (rep, other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches):
            if table.num_rows < 2:
                continue
            band = table.column("band")[0].as_py()
            side, rep, weight, factor = (table.column(c).to_numpy() for c in ("side", "rep", "weight", "factor"))
            x = unit(matrix(table.column("vector").to_pylist(), kind))
            packed = table.column("code").to_pylist()
            i, j = linked_pairs(x, np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), factor, cosine)
            two = side.min() != side.max()
            if two:
                cross = side[i] != side[j]
                i, j = i[cross], j[cross]
            if not len(i):
                continue
            used = np.unique(np.concatenate([i, j]))
            own = bands(x[used], bits, count)
            a, b = np.searchsorted(used, i), np.searchsorted(used, j)
            fresh = np.concatenate([np.argmax(own[a[s : s + PAIRS]] == own[b[s : s + PAIRS]], axis=1) == band
                                    for s in range(0, len(a), PAIRS)])
            n = np.bincount(i[fresh], weight[j[fresh]], len(rep)) + np.bincount(j[fresh], weight[i[fresh]], len(rep))
            some = np.flatnonzero(n)
            label = labels_of(len(rep), i, j)
            ties = np.flatnonzero(label != np.arange(len(rep)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rep[some], rep[ties]])),
                 pa.array(np.concatenate([n[some], np.zeros(len(ties))]).astype(np.int64)),
                 pa.array([None] * len(some) + rep[label[ties]].tolist(), pa.int64())], ["rep", "links", "other"])

    return run


def near_duplicates(
    rows: DataFrame, cosine: float = 0.95, miss: float = 1e-6, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row: id, n_links, component_id (smallest id reachable, itself included), kept (id = component_id)."""
    sound = sound_rows(rows, id_col, vector_col)
    kind = item_type(sound)
    grouped = sound.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    plain = with_bytes(grouped, "rep", "weight")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, factor = codes(unit(matrix(batch.column(0).to_pylist(), kind))) if batch.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(np.asarray(factor, np.float64))],
                ["vector", "rep", "weight", "code", "factor"])

    classes = scratch_table(plain.mapInArrow(coded, "vector binary, rep long, weight long, code binary, factor double"), "classes")
    sized = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("vector")).alias("bytes")).first()
    dims = (sized["bytes"] or 0) // np.dtype(kind).itemsize
    bits, count = band_layout(sized["n"], max(1, dims), cosine, miss)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, reps = bands(unit(matrix(batch.column(0).to_pylist(), kind)), bits, count), batch.column(1).to_numpy()
                for band in range(count):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(reps), band, np.int32)), pa.array(own[:, band]), pa.array(reps)], ["band", "value", "rep"])

    seats = scratch_table(classes.select("vector", "rep").mapInArrow(spread, "band int, value long, rep long"), "seats")
    sizes = scratch_table(
        seats.groupBy(F.col("band").alias("b"), F.col("value").alias("v")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    parts = F.ceil(F.col("n") / BLOCK)
    placed = seats.join(sizes, (F.col("band") == F.col("b")) & (F.col("value") == F.col("v"))).withColumn(
        "side", F.pmod(F.xxhash64("rep"), parts)).select(
        "band", "value", "rep", "side", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other_side"))
    seated = placed.select(
        F.xxhash64("band", "value", F.least("side", "other_side"), F.greatest("side", "other_side")).alias("group"),
        "band", "side", F.col("rep").alias("member"))
    meeting = seated.join(classes, F.col("member") == F.col("rep")).select(
        "group", "band", "side", "rep", "weight", "vector", "code", "factor")
    found = scratch_table(
        meeting.repartition("group").sortWithinPartitions("group").mapInArrow(
            block_links(kind, cosine, bits, count), "rep long, links long, other long"),
        "vector-links")
    counts = scratch_table(found.groupBy(F.col("rep").alias("of")).agg(F.sum("links").alias("links")), "counts")
    roots = components(found.where(F.col("other").isNotNull()).select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = scratch_table(
        grouped.join(counts, F.col("rep") == F.col("of"), "left").join(roots, F.col("rep") == F.col("node"), "left").select(
            F.col("vector").alias("known"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id")),
        "named")
    return with_components(rows, sound, named, id_col, vector_col)


def with_components(rows: DataFrame, sound: DataFrame, named: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part get their class's answer, the others stand alone."""
    wanted = sound.schema["vector"].dataType
    every = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast(wanted).alias("vector"))
    return every.join(named, F.col("id").isNotNull() & (F.col("vector") == F.col("known")), "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
