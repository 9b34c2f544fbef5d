"""Plain SQL for the checks: streams as CTEs and models spelled out as expressions."""

from __future__ import annotations

from tidescore.plans import inputs
from tidescore.plans.inputs import number
from tidescore.schemas import FEATURES

WINE = f"wine AS ({inputs.WINE_SQL})"
EVENTS = f"models AS ({inputs.EVENT_MODELS_SQL}), records AS ({inputs.EVENT_RECORDS_SQL})"
EVENT_ASOF = (
    f"{EVENTS}, resolved AS (SELECT r.*, m.version, m.valid_from, m.weight "
    "FROM records r ASOF LEFT JOIN models m ON r.data_type = m.data_type AND r.ts >= m.valid_from)"
)
ORDERS_DEDUP = (
    f"all_models AS ({inputs.ORDER_MODELS_SQL}), models AS (SELECT * FROM all_models "
    "QUALIFY row_number() OVER (PARTITION BY data_type, valid_from ORDER BY version DESC) = 1)"
)
ORDER_ASOF = (
    f"{WINE}, {ORDERS_DEDUP}, resolved AS (SELECT w.*, m.version, m.valid_from, m.intercept, "
    + ", ".join(f"m.c{i}" for i in range(len(FEATURES)))
    + " FROM wine w ASOF LEFT JOIN models m ON w.data_type = m.data_type AND w.ts >= m.valid_from)"
)
ORDER_SCORE = "intercept" + "".join(f" + c{i} * {name}" for i, name in enumerate(FEATURES))


def eta(params: dict) -> str:
    text = number(params["intercept"])
    for name, coef in zip(FEATURES, params["coefs"]):
        if coef:
            text += f" + {number(coef)} * {name}"
    return f"({text})"


def linked(params: dict) -> str:
    value = eta(params)
    return {
        "identity": value,
        "log": f"exp({value})",
        "inverse": f"(1e0 / {value})",
        "logit": f"(1e0 / (1e0 + exp(-{value})))",
        "sqrt": f"({value} * {value})",
        "cloglog": f"(1e0 - exp(-exp({value})))",
    }[params["link"]]


def tree_case(nodes: dict, leaf, at: int = 0) -> str:
    row = nodes[at]
    if row["feature"] < 0:
        return leaf(row)
    left, right = tree_case(nodes, leaf, row["left"]), tree_case(nodes, leaf, row["right"])
    return f"CASE WHEN {FEATURES[row['feature']]} <= {number(row['threshold'])} THEN {left} ELSE {right} END"


def numbers(values) -> str:
    return "[" + ", ".join(number(v) for v in values) + "]"


def forest_select(params: dict, trees: list[dict]) -> tuple[str, str]:
    """(select list of leaf numbers, expression for the list of mean class probabilities)."""
    numbered, sums = [], []
    leaves = [[r for r in tree.values() if r["feature"] < 0] for tree in trees]
    for t, tree in enumerate(trees):
        position = {r["node"]: i + 1 for i, r in enumerate(leaves[t])}
        numbered.append(f"{tree_case(tree, lambda r, p=position: str(p[r['node']]))} AS leaf{t}")
    for k in range(len(params["labels"])):
        parts = " + ".join(f"({numbers([r['probs'][k] for r in leaves[t]])})[leaf{t}]" for t in range(len(trees)))
        sums.append(f"({parts}) / {number(len(trees))}")
    return ", ".join(numbered), "[" + ", ".join(sums) + "]"


def layer_outputs(layer: dict, source: str) -> str:
    """List expression of one dense layer over the list expression `source`."""
    rows = "[" + ", ".join(numbers(r) for r in layer["weights"]) + "]"
    affine = (
        f"list_transform(list_zip({rows}, {numbers(layer['bias'])}), "
        f"lambda z: list_dot_product(z[1], {source}) + z[2])"
    )
    if layer["activation"] in ("logistic", "sigmoid"):
        return f"list_transform({affine}, lambda y: 1e0 / (1e0 + exp(-y)))"
    if layer["activation"] == "relu":
        return f"list_transform({affine}, lambda y: greatest(y, 0e0))"
    return affine


def network_ctes(params: dict, source: str, vector: str, keep: str) -> str:
    """CTEs layer0..n, each carrying `keep` and the activations as `x`."""
    ctes = [f"layer0 AS (SELECT {keep}, {vector} AS x FROM {source})"]
    for i, layer in enumerate(params["layers"]):
        ctes.append(f"layer{i + 1} AS (SELECT {keep}, {layer_outputs(layer, 'x')} AS x FROM layer{i})")
    return ", ".join(ctes)
