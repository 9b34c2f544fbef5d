"""The training programs' whole summaries against their own coefficients and nodes, on the small table."""

import numpy as np
import pytest

import __spark_entry__ as spark_entry
from tidescore.plans.training_queries import training_data
from tidescore.schemas import FEATURES

QUERIES = spark_entry.queries()


@pytest.fixture(scope="module")
def table(spark, folder):
    rows = training_data(spark, folder).collect()
    return np.array([[float(r[c]) for c in FEATURES] for r in rows]), np.array([float(r.quality) for r in rows])


def test_linear(spark, folder, table):
    x, y = table
    of = {r.term: r.coefficient for r in QUERIES["train_linear_coefficients_full"](spark, folder).collect()}
    assert set(of) == {"intercept", *FEATURES}
    measures = {r.measure: r.value for r in QUERIES["train_linear_summary_full"](spark, folder).collect()}
    error = y - x @ np.array([of[c] for c in FEATURES]) - of["intercept"]
    assert measures["rmse"] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-6)
    assert measures["r2"] == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)
    objectives = [v for k, v in measures.items() if k.startswith("objective_")]
    assert "iterations" in measures and objectives and min(objectives) == objectives[-1]


def test_glm(spark, folder, table):
    x, y = table
    rows = {r.term: r for r in QUERIES["train_glm_summary_full"](spark, folder).collect()}
    assert set(rows) == {"intercept", *FEATURES}
    assert all(r.t == pytest.approx(r.coefficient / r.std_error) and 0 <= r.p <= 1 for r in rows.values())
    mean = x @ np.array([rows[c].coefficient for c in FEATURES]) + rows["intercept"].coefficient
    want = np.sign(y - mean) * np.sqrt(np.maximum(2 * ((y - mean) / mean - np.log(y / mean)), 0))
    got = [r[0] for r in QUERIES["train_glm_residuals_full"](spark, folder).collect()]
    assert sorted(got) == pytest.approx(sorted(want.tolist()), abs=1e-6)
    measures = {r.measure: r.value for r in QUERIES["train_glm_measures_full"](spark, folder).collect()}
    assert measures["residual_degrees_of_freedom"] == len(y) - len(FEATURES) - 1
    assert measures["null_deviance"] == pytest.approx(((y - y.mean()) ** 2).sum(), rel=1e-9)


def test_tree_nodes(spark, folder, table):
    x, y = table
    nodes = {r.node: r for r in QUERIES["train_tree_nodes_full"](spark, folder).collect()}
    inner = [r for r in nodes.values() if r.left >= 0]
    assert sorted([0, *(n for r in inner for n in (r.left, r.right))]) == sorted(nodes)
    reached = {}
    for row, label in zip(x, y):
        at = nodes[0]
        while at.left >= 0:
            at = nodes[at.left if row[at.feature] <= at.threshold else at.right]
        reached.setdefault(at.node, []).append(label)
    # A leaf predicts one class, its most frequent, so as many classes as predictions are met.
    most = {}
    for node, labels in reached.items():
        counts = {v: labels.count(v) for v in labels}
        most.setdefault(nodes[node].prediction, []).append({v for v, n in counts.items() if n == max(counts.values())})
    assert set(reached) == {r.node for r in nodes.values() if r.left < 0}
    assert all(set.intersection(*sets) for sets in most.values())
