"""Nearest neighbours by inner product from several shifted Hilbert orderings.

Vectors are projected onto a few random directions per curve, shifted and numbered along a Hilbert
curve. Spark range-partitions all curves into one global order; a query looks at the windows around
its places on the curves, the windows' candidates are scored exactly and the lists merge. Inner
product becomes distance by the usual extra coordinate: sqrt(M**2 - |x|**2) for data, 0 for queries,
M being the greatest norm.

Every vector is on every curve. The half-width of the windows is fitted: for a bounded sample of
queries the true neighbours are found by brute force, and the width is taken at which `recall` of
them lie in some window. Equal vectors share one place, so a vector that fills a third of the table
does not fill the windows.

Defined cases: vectors that are null, zero, of an unusual length, or hold null or non-finite
components take no part, as do rows without an id; equal rows count once; ties go to the smaller id;
with fewer than k candidates all that are found are given; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidescore.llm.vector_rows import item_type, matrix, rotation, sound_rows, with_bytes
from tidescore.operators.ordering import with_global_index
from tidescore.session import scratch_table

FIT_ROWS = 4096  # vectors that set the bounds of the projections
FIT_QUERIES = 96  # queries that set the width of the windows
SHARE_QUERIES = 4096  # queries of a block that go to one task, about as many as a block has rows
SLICE_QUERIES = 256  # queries scored at a time


def hilbert_number(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of points with `bits`-bit coordinates (rows), bits * columns <= 62.

    Coordinates are turned level by level into the curve's frame (undoing reflections and swaps from
    the top bit down), then Gray-decoded and interleaved.
    """
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for i, axis in enumerate(axes):
            high = axis & top != 0
            swap = np.where(high, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(axes[-1] & 1 << level != 0, turn ^ (1 << level) - 1, turn)
    number = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            number = number << 1 | (axis ^ turn) >> level & 1
    return number


class Curves:
    """Projections, shifts and bounds of all curves; a fixed number of small matrices."""

    def __init__(self, sample: np.ndarray, norm: float, curves: int, dims: int):
        self.norm, self.dims, self.bits = norm, dims, min(16, 60 // dims)
        self.maps = [rotation(1000 + c, sample.shape[1] + 1, dims) for c in range(curves)]
        shifts = np.random.default_rng(999).random((curves, dims)) / 2
        points = self.data_points(sample)
        self.low, self.scale = [], []
        for m in self.maps:
            z = points @ m
            low, high = z.min(axis=0), z.max(axis=0)
            self.low.append(low)
            self.scale.append(0.5 / np.maximum(high - low, 1e-9))
        self.shifts = shifts

    def data_points(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return np.hstack([x, extra[:, None]])

    def query_points(self, x: np.ndarray) -> np.ndarray:
        length = np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.hstack([x / length * self.norm, np.zeros((len(x), 1))])

    def numbers(self, points: np.ndarray, curve: int) -> np.ndarray:
        z = (points @ self.maps[curve] - self.low[curve]) * self.scale[curve] + self.shifts[curve]
        return hilbert_number((np.clip(z, 0, 1) * ((1 << self.bits) - 1)).astype(np.int64), self.bits)


def vector_classes(sound: DataFrame, is_query: Column, kept: int) -> DataFrame:
    """One row per distinct vector: rep (smallest id), asked (whether a query has it), its `kept` smallest ids."""
    first = Window.partitionBy("vector").orderBy("id")
    ids = sound.distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= kept)
    members = ids.groupBy("vector").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("members"))
    asked = sound.where(is_query).select(F.col("vector").alias("wanted")).distinct()
    return members.join(asked, F.col("vector") == F.col("wanted"), "left").select(
        "vector", "rep", "members", F.col("wanted").isNotNull().alias("asked"))


def best_of(scores: np.ndarray, reps: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k greatest scores, ties to the smaller rep."""
    k = min(k, scores.shape[1])
    least = np.partition(scores, -k, axis=1)[:, -k]
    row, column = np.nonzero(scores >= least[:, None])
    order = np.lexsort((reps[column], -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    return row[rank < k], column[rank < k]


def brute_force(classes: DataFrame, queries: list, kind: str, k: int) -> DataFrame:
    """True k best classes (query, rep, score) of a bounded list of queries; every executor reads its share."""
    sent = classes.sparkSession.sparkContext.broadcast(
        (np.array([q["rep"] for q in queries]), matrix([bytes(q["vector"]) for q in queries], kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = sent.value
        for batch in batches:
            if batch.num_rows:
                reps = batch.column(1).to_numpy()
                scores = wanted @ matrix(batch.column(0).to_pylist(), kind).T
                row, column = best_of(scores, reps, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(reps[column]), pa.array(scores[row, column])], ["query", "rep", "score"])

    found = classes.select("vector", "rep").mapInArrow(run, "query long, rep long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def window_radius(placed: DataFrame, truth: DataFrame, recall: float, least: int) -> int:
    """Half-width at which the windows of a sample of queries hold `recall` of their true neighbours."""
    pairs = F.broadcast(truth.select(F.col("query").alias("q"), F.col("rep").alias("r")))
    seats = placed.select("curve", "rep", "asking", "place")
    near = seats.where("asking = 0").join(pairs, F.col("rep") == F.col("r")).select("curve", "q", "r", F.col("place").alias("there"))
    here = seats.where("asking = 1").select(F.col("curve").alias("c"), F.col("rep").alias("asker"), "place")
    steps = near.join(here, (F.col("curve") == F.col("c")) & (F.col("q") == F.col("asker")))
    width = steps.groupBy("q", "r").agg(F.min(F.abs(F.col("place") - F.col("there"))).alias("w")).agg(
        F.percentile("w", F.lit(recall))).first()[0]
    return max(least, int(np.ceil(width or 0)))


def shares(there: DataFrame, asking: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the blocks (`block`, `rep`) with `share`: a block's queries dealt out `most` a share or
    so, and its data rows repeated for each share. Every query meets every data row of its block once.
    """
    counted = asking.groupBy(F.col("block").alias("of")).agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    parts = scratch_table(counted, "shares")
    same = F.col("block") == F.col("of")
    data = there.join(parts, same).select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("share"), "rep")
    return data, asking.join(parts, same).select("block", F.pmod(F.xxhash64("rep"), "parts").alias("share"), "rep")


def search(
    rows: DataFrame, is_query: Column, k: int = 20, curves: int = 16, dims: int = 6, recall: float = 0.95,
    least_window: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """`is_query` is an expression over `id`. Per query and rank: query_id, rank, the neighbour's id, score."""
    sound = sound_rows(rows, id_col, vector_col)
    kind, spare = item_type(sound), k + 1  # one more than asked for, as a query is its own neighbour
    grouped = vector_classes(sound, is_query, spare)
    classes = scratch_table(with_bytes(grouped, "rep", "members", "asked"), "classes")
    result = f"query_id long, rank int, {id_col} long, score double"
    sample = classes.orderBy(F.xxhash64("rep")).limit(FIT_ROWS).select("vector").collect()
    if not sample:
        return rows.sparkSession.createDataFrame([], result)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0).to_pylist(), kind)
                yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum(axis=1).max())])], ["square"])

    norm = classes.select("vector").mapInArrow(squares, "square double").agg(F.max("square")).first()[0] ** 0.5
    fitted = Curves(matrix([bytes(r["vector"]) for r in sample], kind), norm, curves, dims)
    sent = rows.sparkSession.sparkContext.broadcast(fitted)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, reps = matrix(batch.column(0).to_pylist(), kind), batch.column(1).to_numpy()
            asked = batch.column(2).to_numpy(zero_copy_only=False)
            data, queries = own.data_points(x), own.query_points(x[asked])
            for curve in range(len(own.maps)):
                for asking, points, ids in ((0, data, reps), (1, queries, reps[asked])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), curve, np.int32)), pa.array(own.numbers(points, curve)),
                         pa.array(np.full(len(ids), asking, np.int32)), pa.array(ids)], ["curve", "number", "asking", "rep"])

    numbered = classes.select("vector", "rep", "asked").mapInArrow(number, "curve int, number long, asking int, rep long")
    order = [F.col(c) for c in ("curve", "number", "asking", "rep")]
    placed = scratch_table(with_global_index(numbered, order, "place"), "places")
    picked = classes.where("asked").orderBy(F.xxhash64("rep")).limit(FIT_QUERIES).select("rep", "vector").collect()
    if not picked:
        return rows.sparkSession.createDataFrame([], result)
    radius = window_radius(placed, brute_force(classes, picked, kind, spare), recall, least_window)
    block = min(max(radius, 256), 4096)

    vectors = classes.select(F.col("rep").alias("of"), "vector")
    there = placed.where("asking = 0").select(F.floor(F.col("place") / block).alias("block"), "rep")
    reach = F.sequence(F.floor(F.greatest(F.col("place") - radius, F.lit(0)) / block), F.floor((F.col("place") + radius) / block))
    # Two curves can reach one block, so a query may be in it twice; its lists merge below.
    asking = placed.where("asking = 1").select(F.explode(reach).alias("block"), "rep")
    there, asking = shares(there, asking, SHARE_QUERIES)

    def with_vector(seats: DataFrame):
        joined = seats.join(vectors, F.col("rep") == F.col("of"))
        return joined.select(*[F.col(c).alias(c) for c in ("block", "share", "rep", "vector")]).groupBy("block", "share")

    def rerank(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query": [], "rep": [], "score": []})
        x, q = matrix(data["vector"].tolist(), kind), matrix(queries["vector"].tolist(), kind)
        reps, askers, best = data["rep"].to_numpy(), queries["rep"].to_numpy(), []
        for at in range(0, len(q), SLICE_QUERIES):
            part = q[at : at + SLICE_QUERIES]
            row, column = best_of(part @ x.T, reps, spare)
            # Summed the same way wherever a pair meets, so that its scores agree.
            exact = (part[row] * x[column]).sum(axis=1)
            best.append(pd.DataFrame({"query": askers[at + row], "rep": reps[column], "score": exact}))
        return pd.concat(best)

    found = with_vector(there).cogroup(with_vector(asking)).applyInPandas(rerank, "query long, rep long, score double")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    best = (
        found.groupBy("query", "rep").agg(F.max("score").alias("score"))
        .withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= spare).select("query", "rep", "score")
    )
    # Classes back to ids: the best ids of a class of queries, then each query without itself.
    expanded = best.join(classes.select(F.col("rep").alias("of"), "members"), F.col("rep") == F.col("of")).select(
        "query", "score", F.explode("members").alias("id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = scratch_table(
        expanded.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= spare).groupBy("query").agg(
            F.array_sort(F.collect_list(F.struct("_n", "id", "score"))).alias("best")),
        "lists")
    askers = sound.where(is_query).distinct().select(F.col("id").alias("asker"), F.col("vector").alias("wanted"))
    reps = grouped.where("asked").select("vector", F.col("rep").alias("asker_rep"))
    return (
        askers.join(reps, F.col("wanted") == F.col("vector")).join(lists, F.col("asker_rep") == F.col("query"))
        .select("asker", F.posexplode(F.slice(F.filter("best", lambda b: b["id"] != F.col("asker")), 1, k)))
        .select(F.col("asker").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"),
                F.col("col.id").alias(id_col), F.col("col.score").alias("score"))
    )
