"""Forests scored by bit vectors: what a false test rules out is a mask, and the masks left together name the leaf.

The leaves of a tree are numbered from left to right, a bit each. A test `x <= t` that is false rules out the
leaves of its left branch, so the mask of a test has zeros there. The leaf a row reaches is the lowest bit that
no false test has cleared, whatever the order of the tests.

The tests of one feature are false for all thresholds below the row's value, so the masks of a feature are
combined once for each interval between two thresholds (`interval_table`): a row meets one interval per feature,
not one leaf after the other. Values are binned by a grid of equal steps between a feature's first and last
threshold; the bin is the key of an equi-join and the interval's ends decide. An interval lies in the bins it
crosses, so there are as many rows as intervals and bins, and a bin's intervals are few where thresholds are
spread evenly.

Models are measured before they are broadcast; larger ones meet their records by a shuffle on model and bin,
where adaptive execution splits hot models. A model's masks stand side by side, `words` longs to a tree.

A missing value (NaN) fails every test, as in `leaf_join.descend`; null inputs read as 0.0. Rows whose version
is no tree or forest do not come out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.functions.features import bind_fields
from tidescore.functions.vectors import argmax_index
from tidescore.operators.leaf_join import same_model
from tidescore.schemas import FEATURES
from tidescore.session import checked_broadcast

WORD = 64
MOST_COLUMNS = 64  # trees whose masks stand in columns of their own
BINS_PER_THRESHOLD, MOST_BINS = 2, 65_536
JOINS_PER_STAGE = 2  # as many as Spark compiles to one method that the JVM compiles too
INTERVALS = (
    "data_type string, version long, feature int, low double, high double, first boolean, last boolean, masks array<long>, "
    "start double, step double, bins long"
)
LEAVES = "data_type string, version long, words int, scores array<array<double>>, probs array<array<array<double>>>"


class TreeMasks:
    """One tree: its leaves from left to right, and per internal node (feature, threshold, leaves of the left branch)."""

    def __init__(self, rows: dict[int, dict]):
        self.scores: list[float | None] = []
        self.probs: list[list[float] | None] = []
        self.tests: list[tuple[int, float, int, int]] = []
        # Left first; a node's left branch is complete when its right branch is begun.
        todo: list[tuple[int, tuple[int, float, int] | None]] = [(0, None)]
        while todo:
            number, left_of = todo.pop()
            if left_of is not None:
                self.tests.append((*left_of, len(self.scores)))
            row = rows[number]
            if row["feature"] < 0:
                self.scores.append(row["score"])
                self.probs.append(None if row["probs"] is None else list(row["probs"]))
            else:
                todo.append((row["right"], (row["feature"], row["threshold"], len(self.scores))))
                todo.append((row["left"], None))


def trees_from(nodes: Sequence[dict]) -> list[TreeMasks]:
    by_tree: dict[int, dict[int, dict]] = {}
    for row in nodes:
        by_tree.setdefault(row["tree"], {})[row["node"]] = row
    return [TreeMasks(by_tree[t]) for t in sorted(by_tree)]


def words_of(trees: Sequence[TreeMasks]) -> int:
    return max(-(-len(t.scores) // WORD) for t in trees)


def cleared(low: int, high: int, words: int) -> np.ndarray:
    """Ones but for the bits low to high."""
    bits = ((1 << WORD * words) - 1) ^ ((1 << high) - (1 << low))
    return np.array([bits >> WORD * w & (1 << WORD) - 1 for w in range(words)], np.uint64)


def intervals_of(nodes: Sequence[dict]) -> Iterator[tuple]:
    """(feature, low, high, first, last, masks, start, step, bins) of every interval of a model."""
    trees = trees_from(nodes)
    words = words_of(trees)
    by_feature: dict[int, dict[float, list[tuple[int, int, int]]]] = {}
    for number, tree in enumerate(trees):
        for feature, threshold, low, high in tree.tests:
            by_feature.setdefault(feature, {}).setdefault(float(threshold), []).append((number, low, high))
    for feature, tests in sorted(by_feature.items()):
        ends = sorted(tests)
        bins = min(MOST_BINS, BINS_PER_THRESHOLD * len(ends))
        step = (ends[-1] - ends[0]) / bins if math.isfinite(ends[-1] - ends[0]) and ends[-1] > ends[0] else 1.0
        masks = np.full((len(trees), words), (1 << WORD) - 1, np.uint64)
        for i in range(len(ends) + 1):
            if i:
                for number, low, high in tests[ends[i - 1]]:
                    masks[number] &= cleared(low, high, words)
            yield (
                feature, ends[max(i - 1, 0)], ends[min(i, len(ends) - 1)], i == 0, i == len(ends),
                masks.view(np.int64).ravel().tolist(), ends[0], step, bins)


def _of_trees(versions: DataFrame) -> DataFrame:
    kind = F.col("data_type") if "data_type" in versions.columns else F.lit(None).cast("string")
    trees = versions.where(F.col("params.kind").isin("tree", "forest"))
    return trees.select(kind.alias("data_type"), "version", F.col("params.nodes").alias("nodes"))


def _without_type(table: DataFrame, versions: DataFrame) -> DataFrame:
    return table if "data_type" in versions.columns else table.drop("data_type")


def interval_table(versions: DataFrame) -> DataFrame:
    """`version, params` -> one row per model, feature and interval between thresholds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_(), pa.list_(pa.int64()),
                 pa.float64(), pa.float64(), pa.int64()]
        for batch in batches:
            for kind, version, nodes in zip(*[c.to_pylist() for c in batch.columns]):
                rows = [(kind, version, *r) for r in intervals_of(nodes)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = [part.split()[0] for part in INTERVALS.split(", ")]
    return _without_type(_of_trees(versions).mapInArrow(run, INTERVALS), versions)


def leaf_values(versions: DataFrame) -> DataFrame:
    """`version, params` -> one row per model: per tree its leaves' scores and distributions, from left to right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, version, nodes in zip(*[c.to_pylist() for c in batch.columns]):
                trees = trees_from(nodes)
                rows.append((kind, version, words_of(trees), [t.scores for t in trees], [t.probs for t in trees]))
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.list_(pa.float64())),
                         pa.list_(pa.list_(pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["data_type", "version", "words", "scores", "probs"])

    return _without_type(_of_trees(versions).mapInArrow(run, LEAVES), versions)


def bin_of(value: Column, start: Column, step: Column, bins: Column) -> Column:
    """Bin of a value: 0 up to the first threshold, the last for what is beyond and for NaN; never falls as values grow."""
    inside = F.least(F.floor((value - start) / step), bins.cast("long"))
    return F.when(value <= start, F.lit(0).cast("long")).when(value > start + bins * step, bins.cast("long")).otherwise(inside)


def lowest_bit(word: Column) -> Column:
    """Number of the lowest one of a word that has any."""
    # The least long stands for the highest bit alone, and has no negative of its own.
    least = F.lit(-(1 << 63))
    return F.when(word == least, F.lit(63)).otherwise(F.bit_count(word.bitwiseAND(-word) - 1))


def compiled_apart(df: DataFrame) -> DataFrame:
    """What comes after is compiled by itself: too many operators in one method are too long for the JVM, and run one by one.

    No row moves: partitions are put together only where there are more of them than the largest number.
    """
    return df.coalesce((1 << 31) - 1)


def leaf_numbers(records: DataFrame, versions: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with a `version` (and `data_type`) of a tree or forest, with `leaves`: per tree the number of the
    leaf it falls in, `scores` and `probs`: those leaves' values.
    """
    named = {c: f"n_{c}" for c in ("data_type", "version") if c in versions.columns}
    table = interval_table(versions).withColumnsRenamed(named)
    ends = leaf_values(versions).withColumnsRenamed({**named, "scores": "_scores", "probs": "_probs", "words": "_words"})
    keys = list(named.values())
    # Per model the grids of its features by their numbers: one row, whose size follows the number of features.
    of_features = F.map_from_entries(F.collect_list(F.struct("feature", F.struct("start", "step", "bins"))))
    grids = table.where("first").groupBy(*keys).agg(of_features.alias("_grids")).withColumn(
        "_grids", F.array(*[F.try_element_at("_grids", F.lit(i)) for i in range(len(columns))]))
    frame = records.withColumn("_x", F.array(*bind_fields(columns, records.columns)))
    frame = frame.join(checked_broadcast(grids), same_model(frame, grids), "left").drop(*keys)
    spots = {}
    for i in range(len(columns)):
        grid = F.get("_grids", F.lit(i))
        spots[f"_at{i}"] = bin_of(F.get("_x", F.lit(i)), grid["start"], grid["step"], grid["bins"])
    frame = frame.withColumns(spots).drop("_grids")
    low, high = (bin_of(F.col(e), F.col("start"), F.col("step"), F.col("bins")) for e in ("low", "high"))
    zero, all_ones = F.lit(0).cast("long"), F.lit(-1).cast("long")
    placed = table.select(
        *keys, "feature", F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("first").alias("_first"),
        F.col("last").alias("_last"), F.col("masks").alias("_masks"),
        F.explode(F.sequence(F.when(F.col("first"), zero).otherwise(low), F.when(F.col("last"), F.col("bins")).otherwise(high))).alias("_bin"))
    size = ends.agg(F.max(F.size("_scores")).alias("trees"), F.max("_words").alias("words")).first()
    # Masks of one word and few trees are a column each, which compiled code combines; others stay arrays.
    slots = [f"_left{t}" for t in range(size.trees or 0)] if size.words == 1 and size.trees <= MOST_COLUMNS else []
    carried = list(frame.columns)
    frame = frame.withColumns({c: all_ones for c in slots} or {"_left": F.lit(None).cast("array<long>")})
    for i in range(len(columns)):
        if i % JOINS_PER_STAGE == 0:
            frame = compiled_apart(frame)
        side = checked_broadcast(placed.where(F.col("feature") == i))
        x = F.get("_x", F.lit(i))
        here = same_model(frame, side) & (F.col(f"_at{i}") == F.col("_bin")) & (
            (F.col("_first") | (x > F.col("_low"))) & (F.col("_last") | (x <= F.col("_high"))))
        carried.remove(f"_at{i}")
        if slots:
            left = [F.col(c).bitwiseAND(F.coalesce(F.get("_masks", F.lit(t)), all_ones)).alias(c) for t, c in enumerate(slots)]
        else:
            left = [F.when(F.col("_left").isNull(), F.col("_masks")).when(F.col("_masks").isNull(), F.col("_left"))
                    .otherwise(F.zip_with("_left", "_masks", lambda a, b: a.bitwiseAND(b))).alias("_left")]
        frame = frame.join(side, here, "left").select(*carried, *left)
    # The leaves' values are far longer than a row: they meet it last.
    frame = compiled_apart(frame)
    kept = [F.col(c) for c in records.columns]
    frame = frame.join(checked_broadcast(ends), same_model(frame, ends)).drop(*keys)
    if slots:
        numbers = [lowest_bit(F.col(c)).cast("int").alias(f"_leaf{t}") for t, c in enumerate(slots)]
        found = frame.select(*kept, *numbers, "_scores", "_probs")

        def of_trees(cell) -> Column:
            """A cell per tree that the row's model has."""
            return F.slice(F.array(*[cell(t) for t in range(len(slots))]), F.lit(1), F.size("_scores"))

        value = lambda table: of_trees(lambda t: F.get(F.get(F.col(table), F.lit(t)), F.col(f"_leaf{t}")))
        return found.select(
            *kept, of_trees(lambda t: F.col(f"_leaf{t}")).alias("leaves"), value("_scores").alias("scores"), value("_probs").alias("probs"))
    # A model without any test has one leaf a tree.
    trees = F.sequence(F.lit(0), F.size("_scores") - 1)
    frame = frame.withColumn("_left", F.coalesce("_left", F.array_repeat(all_ones, (F.size("_scores") * F.col("_words")).cast("int"))))

    def leaf(tree: Column) -> Column:
        mine = F.slice(F.col("_left"), tree * F.col("_words") + 1, F.col("_words"))
        word = F.array_position(F.transform(mine, lambda w: w != 0), True).cast("int") - 1
        return word * WORD + lowest_bit(F.get(mine, word))

    found = frame.select(*kept, F.transform(trees, leaf).alias("leaves"), "_scores", "_probs")
    value = lambda table: F.zip_with(F.col(table), F.col("leaves"), lambda t, at: F.get(t, at))
    return found.select(*kept, "leaves", value("_scores").alias("scores"), value("_probs").alias("probs"))


def score_forest_by_bits(records: DataFrame, versions: DataFrame, labels: Sequence[str], result: str = "result") -> DataFrame:
    """The mean of the reached leaves' class distributions, then the best label, the first among equals."""
    found = leaf_numbers(records, versions)

    def mean(k: int) -> Column:
        return F.aggregate("probs", F.lit(0.0), lambda total, p: total + F.get(p, F.lit(k))) / F.size("probs")

    values = F.array(*[F.lit(float(v)) for v in labels])
    return found.withColumn("_mean", F.array(*[mean(k) for k in range(len(labels))])).select(
        *records.columns, F.element_at(values, (argmax_index(F.col("_mean")) + 1).cast("int")).alias(result))


def score_tree_by_bits(records: DataFrame, versions: DataFrame, result: str = "result") -> DataFrame:
    """The score of the one tree of each row's version."""
    return leaf_numbers(records, versions).select(*records.columns, F.get("scores", F.lit(0)).alias(result))
