"""Model documents -> model parameters, and parameters -> documents.

The reader runs in Arrow batches over the model stream, which is small beside the record
stream; scoring never touches XML.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidescore.operators.batch_scoring import trial
from tidescore.functions.maths import LINKS
from tidescore.schemas import FEATURE_INDEX, FEATURES, MODEL_FIELD_NAMES, PARAMS_TYPE

NAMESPACE = "http://www.dmg.org/PMML-4_3"
PARSED = T.StructType([T.StructField("params", PARAMS_TYPE), T.StructField("error", T.StringType())])

# Document spelling of normalisations and links -> link names here.
REGRESSION_LINKS = {"none": "identity", "exp": "log", "softmax": "logit", "logit": "logit"}


class ModelError(ValueError):
    """The document is not a model this package can score."""


def empty_params(kind: str) -> dict:
    params = dict.fromkeys(PARAMS_TYPE.names)
    params["kind"] = kind
    return params


def _index(field: str) -> int:
    """Record position of a model input, -1 when the record has no such field (it reads as 0.0)."""
    return FEATURE_INDEX.get(MODEL_FIELD_NAMES.get(field, field), -1)


@lru_cache(maxsize=1024)
def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _children(element, name):
    return [c for c in element if _local(c.tag) == name]


def _child(element, name):
    found = _children(element, name)
    if not found:
        raise ModelError(f"{_local(element.tag)} without {name}")
    return found[0]


def _only(element, *names: str) -> None:
    """Refuse children that this reader would pass over."""
    for child in element:
        if _local(child.tag) not in names:
            raise ModelError(f"{_local(child.tag)} is not supported")


def _regression(model) -> dict:
    table = _child(model, "RegressionTable")
    link = REGRESSION_LINKS.get(model.get("normalizationMethod", "none"))
    if link is None or model.get("functionName") != "regression":
        raise ModelError("unsupported regression form")
    _only(table, "NumericPredictor", "Extension")
    if len(_children(model, "RegressionTable")) != 1:
        raise ModelError("unsupported regression form")
    params = empty_params("linear")
    params["intercept"] = float(table.get("intercept", "0"))
    params["link"] = link
    params["coefs"], params["terms"] = _sum_of_terms(
        [
            (float(p.get("coefficient")), [(p.get("name"), float(p.get("exponent", "1")))])
            for p in _children(table, "NumericPredictor")
        ]
    )
    return params


def _sum_of_terms(terms):
    """Terms that are coef * x become a dense vector; the others stay product terms."""
    coefs, products = [0.0] * len(FEATURES), []
    for beta, factors in terms:
        if len(factors) == 1 and factors[0][1] == 1.0:
            i = _index(factors[0][0])
            if i >= 0:
                coefs[i] += beta
            continue
        factors = [(_index(name), power) for name, power in factors if power != 0.0]
        if any(i < 0 for i, _ in factors):
            continue  # a factor that reads as 0.0
        if len(factors) == 1 and factors[0][1] == 1.0:
            coefs[factors[0][0]] += beta
        else:
            exponents = [0.0] * len(FEATURES)
            for i, power in factors:
                exponents[i] += power
            products.append({"beta": beta, "exponents": exponents})
    return coefs, products


def _general_regression(model) -> dict:
    link = model.get("linkFunction", "identity")
    if model.get("modelType") != "generalizedLinear" or link not in LINKS:
        raise ModelError("unsupported general regression form")
    _only(model, "MiningSchema", "ParameterList", "FactorList", "CovariateList", "PPMatrix", "ParamMatrix", "PCovMatrix",
          "Output", "ModelStats", "ModelExplanation", "Extension")
    if any(len(element) for element in _children(model, "FactorList")):
        raise ModelError("categorical predictors are not supported")
    cells: dict[str, list] = {}
    for cell in _children(_child(model, "PPMatrix"), "PPCell"):
        cells.setdefault(cell.get("parameterName"), []).append((cell.get("predictorName"), float(cell.get("value"))))
    intercept, terms = 0.0, []
    for cell in _children(_child(model, "ParamMatrix"), "PCell"):
        beta, factors = float(cell.get("beta")), cells.get(cell.get("parameterName"))
        if factors is None:
            intercept += beta
        else:
            terms.append((beta, factors))
    params = empty_params("glm")
    params["intercept"], params["link"] = intercept, link
    params["coefs"], params["terms"] = _sum_of_terms(terms)
    return params


def _split(left, right):
    """Field and threshold of a complementary lessOrEqual / greaterThan pair."""
    a, b = _child(left, "SimplePredicate"), _child(right, "SimplePredicate")
    same = a.get("field") == b.get("field") and float(a.get("value")) == float(b.get("value"))
    if not same or (a.get("operator"), b.get("operator")) != ("lessOrEqual", "greaterThan"):
        raise ModelError("only binary lessOrEqual / greaterThan splits are supported")
    return a.get("field"), float(a.get("value"))


def _tree_nodes(root, tree: int, labels: list[str] | None) -> list[dict]:
    """Flat node table of one tree, parents before children."""
    if not _children(root, "True"):
        raise ModelError("root predicate must be True")
    nodes: list[dict] = []

    def visit(element) -> int:
        branches = _children(element, "Node")
        if branches and len(branches) != 2:
            raise ModelError("only binary splits are supported")
        if branches:
            field, threshold = _split(*branches)
            if _index(field) < 0:  # the field reads as 0.0, so the branch is known
                return visit(branches[0] if 0.0 <= threshold else branches[1])
        row = {"tree": tree, "node": len(nodes), "feature": -1, "threshold": None, "left": -1, "right": -1,
               "score": None, "probs": None}
        nodes.append(row)
        if element.get("score") is not None:
            row["score"] = float(element.get("score"))
        if branches:
            row["feature"], row["threshold"] = _index(field), threshold
            row["left"], row["right"] = visit(branches[0]), visit(branches[1])
        elif labels is not None:
            counts = {d.get("value"): float(d.get("recordCount")) for d in _children(element, "ScoreDistribution")}
            total = sum(counts.values())
            if total > 0:
                row["probs"] = [counts.get(label, 0.0) / total for label in labels]
        return row["node"]

    visit(root)
    return nodes


def _labels(document, model) -> list[str] | None:
    if model.get("functionName") != "classification":
        return None
    target = [f.get("name") for f in _children(_child(model, "MiningSchema"), "MiningField")
              if f.get("usageType") in ("target", "predicted")]
    for field in _children(_child(document, "DataDictionary"), "DataField"):
        if target and field.get("name") == target[0]:
            return [v.get("value") for v in _children(field, "Value")]
    raise ModelError("classification without target values")


def _tree(document, model) -> dict:
    params = empty_params("tree")
    params["labels"] = _labels(document, model)
    params["nodes"] = _tree_nodes(_child(model, "Node"), 0, params["labels"])
    return params


def _forest(document, model) -> dict:
    segmentation = _child(model, "Segmentation")
    if segmentation.get("multipleModelMethod") != "average":
        raise ModelError("only averaged ensembles are supported")
    params = empty_params("forest")
    params["labels"] = _labels(document, model)
    params["nodes"] = []
    for i, segment in enumerate(_children(segmentation, "Segment")):
        tree = _child(segment, "TreeModel")
        params["nodes"].extend(_tree_nodes(_child(tree, "Node"), i, params["labels"]))
    return params


def _network(document, model) -> dict:
    params = empty_params("network")
    default = model.get("activationFunction")
    ids, inputs = [], []
    for item in _children(_child(model, "NeuralInputs"), "NeuralInput"):
        ids.append(item.get("id"))
        inputs.append(_index(_child(_child(item, "DerivedField"), "FieldRef").get("field")))
    layers = []
    for element in _children(model, "NeuralLayer"):
        position = {name: i for i, name in enumerate(ids)}
        neurons = _children(element, "Neuron")
        weights = []
        for neuron in neurons:
            row = [0.0] * len(ids)
            for con in _children(neuron, "Con"):
                row[position[con.get("from")]] += float(con.get("weight"))
            weights.append(row)
        activation = element.get("activationFunction", default)
        if activation not in ("logistic", "identity", "tanh", "rectifier"):
            raise ModelError(f"activation {activation!r} is not supported")
        layers.append({"activation": activation, "normalization": element.get("normalizationMethod", "none"),
                       "bias": [float(n.get("bias", "0")) for n in neurons], "weights": weights})
        ids = [n.get("id") for n in neurons]
    by_neuron = {}
    for item in _children(_child(model, "NeuralOutputs"), "NeuralOutput"):
        by_neuron[item.get("outputNeuron")] = _child(_child(item, "DerivedField"), "NormDiscrete").get("value")
    params["inputs"], params["layers"] = inputs, layers
    params["labels"] = [by_neuron[i] for i in ids]
    return params


def parse_pmml(content: bytes) -> dict:
    """One document -> params of PARAMS_TYPE; raises ModelError when it cannot be scored."""
    if b"<!DOCTYPE" in content or b"<!ENTITY" in content:
        raise ModelError("document type declarations are not accepted")
    try:
        document = ET.fromstring(content)
    except ET.ParseError as exc:
        raise ModelError("broken document") from exc
    readers = {
        "RegressionModel": lambda m: _regression(m),
        "GeneralRegressionModel": lambda m: _general_regression(m),
        "TreeModel": lambda m: _tree(document, m),
        "MiningModel": lambda m: _forest(document, m),
        "NeuralNetwork": lambda m: _network(document, m),
    }
    for element in document:
        reader = readers.get(_local(element.tag))
        if reader:
            try:
                return reader(element)
            except (KeyError, TypeError, ValueError, AttributeError) as exc:
                raise exc if isinstance(exc, ModelError) else ModelError("incomplete model") from exc
    raise ModelError("no supported model in document")


def parse_documents(content: Column) -> Column:
    """PMML bytes -> struct(params, error); null in, nulls out. Failures become errors, not exceptions."""

    kind = to_arrow_type(PARAMS_TYPE)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            params, errors = [], []
            for payload in batch.to_pylist():
                value = error = None
                if payload is not None:
                    try:
                        value = parse_pmml(payload)
                        # Every model scores one row before it may replace another.
                        error = trial(value)
                        value = value if error is None else None
                    except ModelError as exc:
                        error = f"Bad model: {exc}"
                params.append(value)
                errors.append(error)
            yield pa.StructArray.from_arrays([pa.array(params, kind), pa.array(errors, pa.string())], ["params", "error"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Marked nondeterministic so that a filter on the outcome does not parse a second time.
    return F.arrow_udf(run, PARSED).asNondeterministic()(content)


# --- writing -------------------------------------------------------------------------------

SPACED = [name.replace("_", " ") for name in FEATURES]


def _document(function: str, model_tag: str, labels: list[str] | None, **attributes):
    root = ET.Element("PMML", {"xmlns": NAMESPACE, "version": "4.3"})
    ET.SubElement(root, "Header")
    fields = ET.SubElement(root, "DataDictionary")
    target = ET.SubElement(fields, "DataField", name="quality",
                           optype="categorical" if labels else "continuous",
                           dataType="string" if labels else "double")
    for label in labels or []:
        ET.SubElement(target, "Value", value=label)
    for name in SPACED:
        ET.SubElement(fields, "DataField", name=name, optype="continuous", dataType="double")
    model = ET.SubElement(root, model_tag, functionName=function, **attributes)
    schema = ET.SubElement(model, "MiningSchema")
    ET.SubElement(schema, "MiningField", name="quality", usageType="target")
    for name in SPACED:
        ET.SubElement(schema, "MiningField", name=name)
    return root, model


def _write_node(parent, nodes: dict, number: int, labels, test=None) -> None:
    row = nodes[number]
    element = ET.SubElement(parent, "Node")
    if row["score"] is not None:
        element.set("score", f"{int(row['score'])}" if labels else repr(float(row["score"])))
    if test is None:
        ET.SubElement(element, "True")
    else:
        ET.SubElement(element, "SimplePredicate", field=SPACED[test[0]], operator=test[1], value=repr(test[2]))
    if row["probs"] is not None:
        for label, p in zip(labels, row["probs"]):
            ET.SubElement(element, "ScoreDistribution", value=label, recordCount=repr(float(p)))
    if row["feature"] >= 0:
        _write_node(element, nodes, row["left"], labels, (row["feature"], "lessOrEqual", float(row["threshold"])))
        _write_node(element, nodes, row["right"], labels, (row["feature"], "greaterThan", float(row["threshold"])))


def render_pmml(params: dict) -> bytes:
    """Parameters of one model -> document that `parse_pmml` and other readers accept."""
    kind, labels = params["kind"], params["labels"]
    function = "classification" if labels else "regression"
    if kind == "linear":
        if params["terms"]:
            raise ModelError("product terms need the glm form")
        names = {link: name for name, link in REGRESSION_LINKS.items()}
        root, model = _document(function, "RegressionModel", None, normalizationMethod=names[params["link"]])
        table = ET.SubElement(model, "RegressionTable", intercept=repr(float(params["intercept"])))
        for name, coef in zip(SPACED, params["coefs"]):
            if coef:
                ET.SubElement(table, "NumericPredictor", name=name, coefficient=repr(float(coef)))
    elif kind == "glm":
        root, model = _document(function, "GeneralRegressionModel", None, modelType="generalizedLinear",
                                linkFunction=params["link"])
        cells, betas = ET.Element("PPMatrix"), ET.Element("ParamMatrix")
        ET.SubElement(betas, "PCell", parameterName="p0", beta=repr(float(params["intercept"])))
        unit = [[1.0 if i == j else 0.0 for j in range(len(FEATURES))] for i in range(len(FEATURES))]
        terms = [(c, unit[i]) for i, c in enumerate(params["coefs"])]
        terms += [(t["beta"], t["exponents"]) for t in params["terms"] or []]
        for number, (beta, exponents) in enumerate(terms, start=1):
            for name, power in zip(SPACED, exponents):
                if power:
                    ET.SubElement(cells, "PPCell", value=repr(float(power)), predictorName=name,
                                  parameterName=f"p{number}")
            ET.SubElement(betas, "PCell", parameterName=f"p{number}", beta=repr(float(beta)))
        model.extend([cells, betas])
    elif kind in ("tree", "forest"):
        by_tree: dict[int, dict] = {}
        for row in params["nodes"]:
            by_tree.setdefault(row["tree"], {})[row["node"]] = row
        if kind == "tree":
            root, model = _document(function, "TreeModel", labels, splitCharacteristic="binarySplit")
            _write_node(model, by_tree[0], 0, labels)
        else:
            root, model = _document(function, "MiningModel", labels)
            segmentation = ET.SubElement(model, "Segmentation", multipleModelMethod="average")
            for tree in sorted(by_tree):
                segment = ET.SubElement(segmentation, "Segment", id=str(tree + 1))
                ET.SubElement(segment, "True")
                inner = ET.SubElement(segment, "TreeModel", functionName=function, splitCharacteristic="binarySplit")
                _write_node(inner, by_tree[tree], 0, labels)
    elif kind == "network":
        root, model = _document(function, "NeuralNetwork", labels, activationFunction="logistic")
        inputs = ET.SubElement(model, "NeuralInputs")
        for i, position in enumerate(params["inputs"], start=1):
            item = ET.SubElement(inputs, "NeuralInput", id=f"0/{i}")
            field = ET.SubElement(item, "DerivedField", optype="continuous", dataType="double")
            ET.SubElement(field, "FieldRef", field=SPACED[position])
        for depth, layer in enumerate(params["layers"], start=1):
            element = ET.SubElement(model, "NeuralLayer", activationFunction=layer["activation"],
                                    normalizationMethod=layer["normalization"])
            for i, (bias, row) in enumerate(zip(layer["bias"], layer["weights"]), start=1):
                neuron = ET.SubElement(element, "Neuron", id=f"{depth}/{i}", bias=repr(float(bias)))
                for j, weight in enumerate(row, start=1):
                    ET.SubElement(neuron, "Con", {"from": f"{depth - 1}/{j}", "weight": repr(float(weight))})
        outputs = ET.SubElement(model, "NeuralOutputs")
        for i, label in enumerate(labels, start=1):
            item = ET.SubElement(outputs, "NeuralOutput", outputNeuron=f"{len(params['layers'])}/{i}")
            field = ET.SubElement(item, "DerivedField", optype="categorical", dataType="string")
            ET.SubElement(field, "NormDiscrete", field="quality", value=label)
    else:
        raise ModelError(f"kind {kind!r} has no document form")
    return ET.tostring(root, encoding="utf-8", xml_declaration=True)
