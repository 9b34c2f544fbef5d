"""One model, known when the query is built, over a whole table.

Linear and tree models become columns, so Spark prunes the scan to the inputs the model reads
and compiles the rest into the scan's stage. Small forests become a few projections. Larger ones
and networks go through Arrow batches (`batch_scoring`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.functions.features import bind_fields
from tidescore.functions.maths import inverse_link, linear_predictor
from tidescore.functions.vectors import argmax_index
from tidescore.operators.batch_scoring import leaf_probs, score_batches
from tidescore.operators.kinds import load, registered
from tidescore.schemas import FEATURES

# Nested CASE up to this many leaves compiles well. Measured on 600k rows: a forest of 320 leaves
# takes 9 s as CASE columns and 2 s in Arrow batches, where all rows descend level by level.
MAX_CASE_LEAVES = 64


def _inputs(df: DataFrame, columns: Sequence[str], missing: str) -> list[Column]:
    return bind_fields(columns, df.columns, missing=missing)


def _used(params: dict) -> list[int]:
    if params["kind"] in ("tree", "forest"):
        return sorted({n["feature"] for n in params["nodes"] if n["feature"] >= 0})
    used = {i for i, c in enumerate(params["coefs"] or []) if c != 0.0}
    for term in params["terms"] or []:
        used |= {i for i, e in enumerate(term["exponents"]) if e != 0.0}
    return sorted(used)


def _unless_missing(value: Column, params: dict, x: Sequence[Column], missing: str) -> Column:
    if missing == "zero" or not _used(params):
        return value
    gaps = reduce(lambda a, b: a | b, [x[i].isNull() for i in _used(params)])
    return F.when(~gaps, value)


def linear_column(params: dict, x: Sequence[Column]) -> Column:
    eta = linear_predictor(params["intercept"], params["coefs"], x)
    for term in params["terms"] or []:
        product = F.lit(float(term["beta"]))
        for i, power in enumerate(term["exponents"]):
            if power:
                product = product * (x[i] if power == 1.0 else F.pow(x[i], F.lit(float(power))))
        eta = eta + product
    return inverse_link(eta, params["link"])


def descend(nodes: dict, x: Sequence[Column], leaf, number: int = 0) -> Column:
    """Nested CASE over one tree; `leaf(row)` gives the value at a leaf."""
    row = nodes[number]
    if row["feature"] < 0:
        return leaf(row)
    return F.when(
        x[row["feature"]] <= F.lit(float(row["threshold"])), descend(nodes, x, leaf, row["left"])
    ).otherwise(descend(nodes, x, leaf, row["right"]))


def trees_of(params: dict) -> list[dict]:
    by_tree: dict[int, dict] = {}
    for row in params["nodes"]:
        by_tree.setdefault(row["tree"], {})[row["node"]] = row
    return [by_tree[t] for t in sorted(by_tree)]


def tree_column(params: dict, x: Sequence[Column]) -> Column:
    return descend(trees_of(params)[0], x, lambda row: F.lit(float(row["score"])))


def tree_probability_columns(params: dict, x: Sequence[Column]) -> dict[str, Column]:
    """`probability(label)` of a classification tree, from the counts in its leaf."""
    tree = trees_of(params)[0]
    dist = descend(tree, x, lambda row: F.array(*[F.lit(p) for p in leaf_probs(row, params["labels"])]))
    return {label: F.element_at(dist, i + 1) for i, label in enumerate(params["labels"])}


def _literal(values, dtype: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{dtype}>")


def forest_frame(df: DataFrame, params: dict, x: Sequence[Column]) -> DataFrame:
    """Add `_probs` (mean class distribution) or `_mean` (mean score) of an ensemble.

    Each tree yields the number of the leaf a row lands in, as one CASE over the inputs; leaf
    numbers then index literal arrays of class probabilities. The leaf columns sit in a
    projection of their own so that they are computed once per row.
    """
    trees = trees_of(params)
    leaves = [[row for row in tree.values() if row["feature"] < 0] for tree in trees]
    frame = df
    for t, tree in enumerate(trees):
        number = {row["node"]: i for i, row in enumerate(leaves[t])}
        frame = frame.withColumn(f"_leaf{t}", descend(tree, x, lambda row, n=number: F.lit(n[row["node"]])))
    count = float(len(trees))
    if params["labels"]:
        sums = []
        for k in range(len(params["labels"])):
            parts = [
                _literal([leaf_probs(row, params["labels"])[k] for row in leaves[t]], "double")[F.col(f"_leaf{t}")]
                for t in range(len(trees))
            ]
            sums.append(reduce(lambda a, b: a + b, parts) / count)
        out = frame.withColumn("_probs", F.array(*sums))
    else:
        parts = [
            _literal([float(row["score"]) for row in leaves[t]], "double")[F.col(f"_leaf{t}")]
            for t in range(len(trees))
        ]
        out = frame.withColumn("_mean", reduce(lambda a, b: a + b, parts) / count)
    return out.drop(*[f"_leaf{t}" for t in range(len(trees))])


def score(df: DataFrame, params: dict, result: str = "result", columns: Sequence[str] = FEATURES,
          missing: str = "zero") -> DataFrame:
    """Add column `result`: the model's value, class label as a number, or class index (dense)."""
    kind = params["kind"]
    x = _inputs(df, columns, missing)
    added = registered().get(kind)
    if added is not None and added.column is not None:
        return df.withColumn(result, load(added.column)(params, x))
    if kind in ("linear", "glm"):
        return df.withColumn(result, _unless_missing(linear_column(params, x), params, x, missing))
    small = sum(n["feature"] < 0 for n in params["nodes"] or []) <= MAX_CASE_LEAVES
    if kind == "tree" and small:
        return df.withColumn(result, _unless_missing(tree_column(params, x), params, x, missing))
    if kind == "forest" and small:
        frame = forest_frame(df, params, x)
        if params["labels"]:
            labels = _literal([float(v) for v in params["labels"]], "double")
            value = F.element_at(labels, (argmax_index(F.col("_probs")) + 1).cast("int"))
        else:
            value = F.col("_mean")
        value = _unless_missing(value, params, x, missing)
        return frame.withColumn(result, value).drop("_probs", "_mean")
    return score_batches(df, params, result, columns, missing)
