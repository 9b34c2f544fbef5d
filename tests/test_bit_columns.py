"""Masks in columns of their own against masks in arrays and a walk down every tree."""

import random

from tests.test_bit_vectors import random_tree, walk
from tidescore.operators import bit_vectors
from tidescore.schemas import FEATURES, MODEL_VERSION_SCHEMA
from tidescore.sources.pmml import empty_params

SIZES = {("a", 1): [5, 64, 1], ("a", 2): [20, 2, 33, 7], ("b", 1): [1]}


def test_small_trees_need_no_arrays_of_masks(spark, monkeypatch):
    rng = random.Random(5)
    nodes = {key: [r for t, n in enumerate(sizes) for r in random_tree(rng, t, n)] for key, sizes in SIZES.items()}
    versions = spark.createDataFrame(
        [(k, v, "n", "d", "PMML", None, None, {**empty_params("forest"), "nodes": n}) for (k, v), n in nodes.items()], MODEL_VERSION_SCHEMA)
    rows = [(i, *rng.choice([*SIZES, ("c", 1)]), *[rng.choice([0.0, 3.0, float("nan"), rng.uniform(-9, 9)]) for _ in range(4)],
             *[0.0] * (len(FEATURES) - 4)) for i in range(200)]
    records = spark.createDataFrame(rows, "id long, data_type string, version long, " + ", ".join(f"{c} double" for c in FEATURES))
    found = bit_vectors.leaf_numbers(records, versions)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "zip_with" not in plan
    # The leaves' values, far longer than a row, meet it after the eleven joins with intervals.
    assert all("_probs" not in line for line in plan.splitlines() if "_left0" in line and "_masks" in line)
    got = {r.id: r for r in found.collect()}
    assert set(got) == {r[0] for r in rows if (r[1], r[2]) in SIZES}
    for i, kind, version, *x in rows:
        if i in got:
            reached = [walk(nodes[kind, version], t, x) for t in range(len(SIZES[kind, version]))]
            assert got[i].scores == [r["score"] for r in reached] and got[i].probs == [r["probs"] for r in reached]
    monkeypatch.setattr(bit_vectors, "MOST_COLUMNS", 0)
    assert {r.id: (r.leaves, r.scores) for r in bit_vectors.leaf_numbers(records, versions).collect()} == {
        i: (r.leaves, r.scores) for i, r in got.items()}
