"""Leaves by bit vectors against a walk down every tree."""

import math
import random

import pytest

from tidescore.operators import bit_vectors
from tidescore.schemas import FEATURES, MODEL_VERSION_SCHEMA
from tidescore.sources.pmml import empty_params

VALUES = [0.0, -0.0, 1.0, 2.5, 3.0, -7.5, 1e300, -1e300, math.inf, -math.inf, math.nan, None]


def random_tree(rng, tree, leaves):
    """Nodes of a tree of so many leaves; thresholds repeat and lie close together."""
    rows, ends = [], [(0, leaves)]
    number = 0
    while ends:
        node, n = ends.pop()
        row = {"tree": tree, "node": node, "feature": -1, "threshold": None, "left": -1, "right": -1, "score": None, "probs": None}
        if n == 1:
            row |= {"score": float(rng.randrange(1000)), "probs": [rng.random(), rng.random()]}
        else:
            cut = rng.randint(1, n - 1)
            row |= {"feature": rng.randrange(4), "left": number + 1, "right": number + 2,
                    "threshold": rng.choice([0.0, 1.0, 2.5, 3.0, math.nextafter(3.0, 4), rng.uniform(-9, 9), rng.uniform(2.9, 3.1), 1e6])}
            ends += [(number + 1, cut), (number + 2, n - cut)]
            number += 2
        rows.append(row)
    return rows


def walk(nodes, tree, x):
    rows = {r["node"]: r for r in nodes if r["tree"] == tree}
    row = rows[0]
    while row["feature"] >= 0:
        row = rows[row["left"] if x[row["feature"]] <= row["threshold"] else row["right"]]
    return row


@pytest.mark.parametrize("broadcast", [True, False])
def test_every_leaf_is_the_walks(spark, broadcast):
    rng = random.Random(3)
    models = {("a", 1): [5, 64, 1], ("a", 2): [200, 65, 3], ("b", 1): [1], ("c", 9): [2, 2]}
    nodes = {key: [r for t, n in enumerate(sizes) for r in random_tree(rng, t, n)] for key, sizes in models.items()}
    versions = spark.createDataFrame(
        [(k, v, "n", "d", "PMML", None, None, {**empty_params("forest"), "nodes": n}) for (k, v), n in nodes.items()]
        + [("z", 1, "n", "d", "PMML", None, None, empty_params("linear"))], MODEL_VERSION_SCHEMA)
    keys = [*models, ("z", 1), ("a", 7), (None, 1)]
    rows = []
    for i in range(400):
        kind, version = rng.choice(keys)
        x = [rng.choice(VALUES) if rng.random() < 0.5 else rng.choice([rng.uniform(-9, 9), rng.uniform(2.9, 3.1)]) for _ in range(4)]
        rows.append((i, kind, version, [9], *x, *[0.0] * (len(FEATURES) - 4)))
    schema = "id long, data_type string, version long, _scores array<int>, " + ", ".join(f"{c} double" for c in FEATURES)
    # A NaN in a Python row stays one; only None is null.
    records = spark.createDataFrame(rows, schema).withColumnRenamed("_scores", "kept")
    old = spark.conf.get("spark.tidescore.broadcastBytes", None)
    spark.conf.set("spark.tidescore.broadcastBytes", "100000000" if broadcast else "0")
    try:
        got = {r.id: r for r in bit_vectors.leaf_numbers(records, versions).collect()}
    finally:
        spark.conf.unset("spark.tidescore.broadcastBytes") if old is None else spark.conf.set("spark.tidescore.broadcastBytes", old)
    assert set(got) == {r[0] for r in rows if (r[1], r[2]) in models}
    for i, kind, version, _, *x in rows:
        if i in got:
            clean = [0.0 if v is None else v for v in x]
            reached = [walk(nodes[kind, version], t, clean) for t in range(len(models[kind, version]))]
            assert got[i].scores == [r["score"] for r in reached] and got[i].probs == [r["probs"] for r in reached]
            assert got[i].kept == [9]


def test_masks_of_a_small_tree():
    leaf = {"feature": -1, "threshold": None, "left": -1, "right": -1, "probs": None}
    nodes = [{"tree": 0, "node": 0, "feature": 2, "threshold": 5.0, "left": 1, "right": 2, "score": None, "probs": None},
             {"tree": 0, "node": 1, **leaf, "score": 1.0},
             {"tree": 0, "node": 2, "feature": 2, "threshold": 7.0, "left": 3, "right": 4, "score": None, "probs": None},
             {"tree": 0, "node": 3, **leaf, "score": 2.0}, {"tree": 0, "node": 4, **leaf, "score": 3.0}]
    found = [(r[1], r[2], r[3], r[4], r[5]) for r in bit_vectors.intervals_of(nodes)]
    assert found == [(5.0, 5.0, True, False, [-1]), (5.0, 7.0, False, False, [-2]), (7.0, 7.0, False, True, [-4])]
    assert bit_vectors.cleared(60, 70, 2).tolist() == [(1 << 60) - 1, ((1 << 64) - 1) ^ 63]
