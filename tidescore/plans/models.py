"""Models used by the registered queries, built by rule over the feature ranges."""

from __future__ import annotations

from tidescore.plans.inputs import FEATURE_RANGES
from tidescore.schemas import FEATURES
from tidescore.sources.pmml import empty_params

LABELS = ["5", "6", "7", "4", "8", "3"]


def linear(kind: str = "linear", link: str = "identity", scale: float = 1.0) -> dict:
    """A weighted sum whose terms are each of the order of `scale`."""
    params = empty_params(kind)
    params["intercept"], params["link"], params["terms"] = 0.5 * scale, link, []
    params["coefs"] = [
        round(scale * ((i * 7) % 5 - 2 + 0.25) / FEATURE_RANGES[name][1], 6) for i, name in enumerate(FEATURES)
    ]
    return params


def tree_nodes(seed: int, depth: int, tree: int = 0, classes: int = 6) -> list[dict]:
    """Full binary tree: features and thresholds rotate with the seed and the node number."""
    rows: list[dict] = []

    def grow(level: int) -> int:
        number = len(rows)
        row = {"tree": tree, "node": number, "feature": -1, "threshold": None, "left": -1, "right": -1,
               "score": None, "probs": None}
        rows.append(row)
        counts = [float((seed * 5 + number * 3 + k * (number + seed + 2)) % 17 + 1) for k in range(classes)]
        total = sum(counts)
        row["probs"] = [c / total for c in counts]
        row["score"] = float(LABELS[row["probs"].index(max(row["probs"]))])
        if level < depth:
            row["feature"] = (seed * 3 + level * 4 + number) % len(FEATURES)
            lo, hi = FEATURE_RANGES[FEATURES[row["feature"]]]
            fraction = 0.25 + 0.5 * ((seed + number * 5) % 8) / 8
            row["threshold"] = round(lo + (hi - lo) * fraction, 4)
            row["left"], row["right"] = grow(level + 1), grow(level + 1)
        return number

    grow(0)
    return rows


def tree_classifier(seed: int = 1, depth: int = 4) -> dict:
    params = empty_params("tree")
    params["nodes"], params["labels"] = tree_nodes(seed, depth), LABELS
    return params


def tree_regressor(seed: int = 2, depth: int = 4) -> dict:
    params = empty_params("tree")
    params["nodes"] = tree_nodes(seed, depth)
    for row in params["nodes"]:
        row["score"] = 3.0 + 5.0 * row["probs"][0] + 2.0 * row["probs"][1]
        row["probs"] = None
    return params


def forest(trees: int = 10, depth: int = 5) -> dict:
    params = empty_params("forest")
    params["labels"] = LABELS
    params["nodes"] = [row for t in range(trees) for row in tree_nodes(t + 3, depth, tree=t)]
    return params


def _layer(sizes: tuple[int, int], number: int, activation: str, normalization: str = "none") -> dict:
    fan_in, fan_out = sizes
    return {
        "activation": activation,
        "normalization": normalization,
        "bias": [((j * 3 + number) % 7 - 3) / 10.0 for j in range(fan_out)],
        "weights": [
            [((i * 7 + j * 13 + i * j * number + number * 5) % 11 - 5) / 5.0 for i in range(fan_in)]
            for j in range(fan_out)
        ],
    }


def perceptron() -> dict:
    """11-10-20-6, logistic twice, softmax last; the first layer centres each input in its range."""
    params = empty_params("network")
    params["inputs"], params["labels"] = list(range(len(FEATURES))), LABELS
    first = _layer((11, 10), 1, "logistic")
    for j, row in enumerate(first["weights"]):
        for i, name in enumerate(FEATURES):
            lo, hi = FEATURE_RANGES[name]
            slope = round(4.0 * row[i] / (hi - lo), 6)
            first["bias"][j] = round(first["bias"][j] - slope * (lo + hi) / 2, 6)
            row[i] = slope
    params["layers"] = [
        first,
        _layer((10, 20), 2, "logistic"),
        _layer((20, 6), 3, "identity", "softmax"),
    ]
    return params


def dense(inputs: int = 64, classes: int = 10) -> dict:
    params = empty_params("dense")
    params["layers"] = [
        _layer((inputs, 16), 1, "relu"),
        _layer((16, 12), 2, "relu"),
        _layer((12, classes), 3, "sigmoid"),
    ]
    return params
