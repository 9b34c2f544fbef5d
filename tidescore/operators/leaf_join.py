"""Trees as tables, scoring as joins, for rows that already carry a model version.

`descend` follows each row through the node table, one equi-join per level: a hash lookup per
row and level whatever the number of versions and leaves. `match_leaves` answers the same
question from the leaves alone: each leaf is a box of per-feature bounds, the version is the
hash key and the bounds are a residual condition, so only the matching leaf of each tree leaves
the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.functions.features import bind_fields
from tidescore.functions.vectors import argmax_index
from tidescore.schemas import FEATURES
from tidescore.session import checked_broadcast, fits_broadcast

LO = [f"lo{i}" for i in range(len(FEATURES))]
HI = [f"hi{i}" for i in range(len(FEATURES))]
LEAF_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("tree", T.IntegerType()),
        T.StructField("leaf", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in [*LO, *HI]],
        T.StructField("score", T.DoubleType()),
        T.StructField("probs", T.ArrayType(T.DoubleType())),
    ]
)

ARROW_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), *[pa.float64()] * (2 * len(FEATURES)), pa.float64(), pa.list_(pa.float64()),
]


def leaf_rows(version: int, nodes: Sequence) -> Iterator[tuple]:
    """Leaves of one model as boxes lo <= x <= hi.

    A split x > t becomes lo = the next double above t. An open upper end is NaN, which Spark
    orders above every other double.
    """
    by_tree: dict[int, dict] = {}
    for row in nodes:
        by_tree.setdefault(row["tree"], {})[row["node"]] = row
    for tree, rows in by_tree.items():
        open_nodes = [(0, [-math.inf] * len(FEATURES), [math.nan] * len(FEATURES))]
        while open_nodes:
            number, lo, hi = open_nodes.pop()
            row = rows[number]
            if row["feature"] < 0:
                probs = None if row["probs"] is None else list(row["probs"])
                yield version, tree, number, *lo, *hi, row["score"], probs
                continue
            i, t = row["feature"], row["threshold"]
            left_hi, right_lo = list(hi), list(lo)
            left_hi[i] = t if math.isnan(hi[i]) else min(hi[i], t)
            right_lo[i] = max(lo[i], math.nextafter(t, math.inf))
            open_nodes += [(row["left"], lo, left_hi), (row["right"], right_lo, hi)]


def leaf_table(versions: DataFrame) -> DataFrame:
    """`version, params` -> leaves. Runs where the model rows are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            models = zip(*(batch.column(c).to_pylist() for c in ("data_type", "version", "nodes")))
            rows = [(kind, *r) for kind, v, nodes in models for r in leaf_rows(v, nodes)]
            # Built by Arrow itself: a DataFrame would turn the open ends (NaN) into nulls.
            columns = list(zip(*rows)) or [[] for _ in schema.names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, [pa.string(), *ARROW_TYPES])], names=schema.names
            )

    schema = T.StructType([T.StructField("data_type", T.StringType()), *LEAF_SCHEMA.fields])
    trees = versions.where(F.col("params.kind").isin("tree", "forest"))
    typed = "data_type" in versions.columns
    kind = (F.col("data_type") if typed else F.lit(None).cast("string")).alias("data_type")
    leaves = trees.select(kind, "version", F.col("params.nodes").alias("nodes")).mapInArrow(run, schema)
    return leaves if typed else leaves.drop("data_type")


def node_table(versions: DataFrame) -> DataFrame:
    """`version, params` -> nodes; a leaf leads to itself."""
    trees = versions.where(F.col("params.kind").isin("tree", "forest"))
    names = [c for c in ("data_type", "version") if c in versions.columns]
    n = trees.select(*names, F.explode("params.nodes").alias("n")).select(*names, "n.*")
    leaf = F.col("feature") < 0
    return n.select(
        *names, "tree", "node", F.greatest("feature", F.lit(0)).alias("feature"),
        F.coalesce("threshold", F.lit(0.0)).alias("threshold"), F.when(leaf, F.col("node")).otherwise(F.col("left")).alias("left"),
        F.when(leaf, F.col("node")).otherwise(F.col("right")).alias("right"), "score", "probs",
    )


def same_model(records: DataFrame, table: DataFrame) -> Column:
    """Version, and data type where both sides have it (the table's columns are prefixed)."""
    same = F.col("version") == F.col("n_version")
    both = "data_type" in records.columns and "n_data_type" in table.columns
    return same & (F.col("data_type") == F.col("n_data_type")) if both else same


def deepest(nodes: Sequence) -> int:
    """Levels below the root of the deepest tree of one model."""
    rows = {(r["tree"], r["node"]): r for r in nodes}
    open_nodes, most = [((r["tree"], 0), 0) for r in nodes if r["node"] == 0], 0
    while open_nodes:
        (tree, number), level = open_nodes.pop()
        row, most = rows[tree, number], max(most, level)
        if row["feature"] >= 0:
            open_nodes += [((tree, row["left"]), level + 1), ((tree, row["right"]), level + 1)]
    return most


def levels(versions: DataFrame) -> int:
    """Levels below the root of the deepest tree among the versions; one number comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [deepest(nodes) for nodes in batch.column("nodes").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.int32())], names=["level"])

    trees = versions.where(F.col("params.kind").isin("tree", "forest"))
    per_model = trees.select(F.col("params.nodes").alias("nodes")).mapInArrow(run, "level int")
    return per_model.agg(F.max("level").alias("n")).first().n or 0


def descend(records: DataFrame, versions: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with `version` and `tree` -> the `leaf_score` and `probs` of the leaf they reach."""
    nodes = node_table(versions)
    place = [F.col(c).alias(f"n_{c}") for c in ("data_type", "version", "tree", "node") if c in nodes.columns]
    steps = nodes.select(*place, "feature", "threshold", "left", "right")
    ends = nodes.select(*place, F.col("score").alias("leaf_score"), "probs")
    small = fits_broadcast(nodes)
    steps, ends = (F.broadcast(t) if small else t for t in (steps, ends))
    here = same_model(records, steps) & (F.col("tree") == F.col("n_tree")) & (F.col("_node") == F.col("n_node"))
    frame = records.select("*", F.array(*bind_fields(columns, records.columns)).alias("_x"), F.lit(0).alias("_node"))
    keep = [c for c in frame.columns if c != "_node"]
    go_left = F.get("_x", F.col("feature")) <= F.col("threshold")
    for _ in range(levels(versions)):
        frame = frame.join(steps, here).select(*keep, F.when(go_left, F.col("left")).otherwise(F.col("right")).alias("_node"))
    return frame.join(ends, here).select(*records.columns, "leaf_score", "probs")


def match_leaves(records: DataFrame, leaves: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with a `version` -> one row per tree of that version with the leaf it falls in.

    Every leaf of the version is tested against the row, so `descend` is the faster form from
    a few leaves on; this one serves as its check.
    """
    x = bind_fields(columns, records.columns)
    inside = reduce(
        lambda a, b: a & b, [(v >= F.col(lo)) & (v <= F.col(hi)) for v, lo, hi in zip(x, LO, HI)]
    )
    names = {c: f"n_{c}" for c in ("data_type", "version") if c in leaves.columns}
    boxes = leaves.withColumnsRenamed({**names, "score": "leaf_score"})
    return records.join(checked_broadcast(boxes), same_model(records, boxes) & inside).drop(*names.values(), *LO, *HI)


def score_tree_by_leaves(records: DataFrame, leaves: DataFrame, result: str = "result") -> DataFrame:
    hit = match_leaves(records, leaves)
    return hit.select(*records.columns, F.col("leaf_score").alias(result))


def score_forest_by_leaves(records: DataFrame, leaves: DataFrame, labels: Sequence[str], keys: Sequence[str],
                           result: str = "result") -> DataFrame:
    """Average the class distributions of the matched leaves per record, then take the best label.

    The leaves of one record leave the join next to each other, so the partial aggregate folds
    them into one row before the shuffle.
    """
    hit = match_leaves(records, leaves)
    means = [F.avg(F.col("probs")[k]) for k in range(len(labels))]
    values = F.array(*[F.lit(float(v)) for v in labels])
    return (
        hit.groupBy(*keys)
        .agg(F.array(*means).alias("_probs"))
        .select(*keys, F.element_at(values, (argmax_index(F.col("_probs")) + 1).cast("int")).alias(result))
    )
