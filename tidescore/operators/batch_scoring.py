"""Arrow-batch scoring with NumPy: networks, large forests, and tables of many model versions."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.functions.features import bind_fields
from tidescore.operators.kinds import Kind, batch_of, registered
from tidescore.schemas import FEATURES


ACTIVATIONS = ("logistic", "sigmoid", "tanh", "rectifier", "relu", "identity", "linear", "softmax")


def _activate(x: np.ndarray, name: str) -> np.ndarray:
    if name in ("logistic", "sigmoid"):
        return 1.0 / (1.0 + np.exp(-x))
    if name == "tanh":
        return np.tanh(x)
    if name in ("rectifier", "relu"):
        return np.maximum(x, 0)
    if name in (None, "identity", "linear"):
        return x
    if name == "softmax":
        return _softmax(x)
    raise ValueError(f"activation {name!r} is not supported")


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _network(params: dict):
    dense = params["kind"] == "dense"
    dtype = np.float32 if dense else np.float64
    layers = [
        (np.array(l["weights"], dtype=dtype).T, np.array(l["bias"], dtype=dtype), l["activation"], l["normalization"])
        for l in params["layers"]
    ]
    inputs = params["inputs"]
    labels = None if dense else np.array([float(v) for v in params["labels"]])

    def outputs(x: np.ndarray) -> np.ndarray:
        if inputs is not None:
            padded = np.concatenate([x, np.zeros((len(x), 1))], axis=1)  # input -1 reads as 0.0
            x = padded[:, list(inputs)]
        x = x.astype(dtype)
        for weights, bias, activation, normalization in layers:
            x = _activate(x @ weights + bias, activation)
            if normalization == "softmax":
                x = _softmax(x)
        return x

    def run(x: np.ndarray) -> np.ndarray:
        out = outputs(x)
        # A NaN in first place stays the winner, a later NaN never wins.
        out[:, 1:] = np.where(np.isnan(out[:, 1:]), -np.inf, out[:, 1:])
        best = np.argmax(out, axis=1)
        return best.astype(float) if dense else labels[best]

    run.outputs = outputs
    return run


def leaf_probs(row: dict, labels: Sequence[str]) -> list[float]:
    """Class distribution of a node: its own, else all for the class it scores, else unknown."""
    if row["probs"]:
        return list(row["probs"])
    if row["score"] is None:
        return [float("nan")] * len(labels)
    return [float(float(v) == float(row["score"])) for v in labels]


def _trees(params: dict):
    """Level-by-level descent of all rows at once, one tree after the other."""
    labels = None if not params["labels"] else np.array([float(v) for v in params["labels"]])
    by_tree: dict[int, list] = {}
    for row in params["nodes"]:
        by_tree.setdefault(row["tree"], []).append(row)
    trees = []
    for rows in by_tree.values():
        rows = sorted(rows, key=lambda r: r["node"])
        leaf = np.array([r["feature"] < 0 for r in rows])
        own = np.arange(len(rows))
        if labels is None or params["kind"] == "tree":
            value = np.array([[np.nan if r["score"] is None else r["score"]] for r in rows], dtype=float)
        else:
            value = np.array([leaf_probs(r, params["labels"]) for r in rows], dtype=float)
        trees.append(
            (
                np.where(leaf, 0, [r["feature"] for r in rows]),
                np.array([0.0 if r["threshold"] is None else r["threshold"] for r in rows]),
                np.where(leaf, own, [r["left"] for r in rows]),
                np.where(leaf, own, [r["right"] for r in rows]),
                leaf,
                value,
            )
        )

    def run(x: np.ndarray) -> np.ndarray:
        total, every = 0.0, np.arange(len(x))
        for feature, threshold, left, right, leaf, value in trees:
            node = np.zeros(len(x), dtype=np.int64)
            while not leaf[node].all():
                goes_left = x[every, feature[node]] <= threshold[node]
                node = np.where(goes_left, left[node], right[node])
            total = total + value[node]
        mean = total / len(trees)
        if labels is None or params["kind"] == "tree":
            return mean[:, 0]
        return labels[np.argmax(mean, axis=1)]

    return run


INVERSE_LINKS = {
    "identity": lambda e: e,
    "log": np.exp,
    "inverse": lambda e: np.where(e == 0, np.inf, 1.0 / e),
    "logit": lambda e: 1.0 / (1.0 + np.exp(-e)),
    "sqrt": np.square,
    "cloglog": lambda e: 1.0 - np.exp(-np.exp(e)),
}


def _sum(params: dict):
    coefs = np.array(params["coefs"], dtype=float)
    terms = [(t["beta"], np.array(t["exponents"])) for t in params["terms"] or []]
    inverse = INVERSE_LINKS[params["link"] or "identity"]

    def run(x: np.ndarray) -> np.ndarray:
        eta = np.full(len(x), float(params["intercept"]))
        for i, c in enumerate(coefs):
            if c:
                eta = eta + c * x[:, i]
        for beta, exponents in terms:
            eta = eta + beta * np.prod(np.power(x, exponents), axis=1)
        return inverse(eta)

    return run


def batch_scorer(params: dict, known: dict[str, Kind] | None = None):
    """params -> function from an (n, inputs) array to n values; `known` are the added kinds a query has carried along."""
    own = {"linear": _sum, "glm": _sum, "tree": _trees, "forest": _trees, "network": _network, "dense": _network}
    return own[params["kind"]](params) if params["kind"] in own else batch_of(params, registered() if known is None else known)


def trial(params: dict) -> str | None:
    """Why a model cannot score a record, or None if it can."""
    if params["kind"] in ("linear", "glm") and not any(params[c] for c in ("terms", "nodes", "layers")):
        # A sum over the record's inputs scores whatever its numbers are.
        numbers = [params["intercept"], *(params["coefs"] or [])]
        if len(numbers) == len(FEATURES) + 1 and None not in numbers and (params["link"] or "identity") in INVERSE_LINKS:
            return None
    try:
        width = None
        for layer in params["layers"] or []:
            rows = {len(w) for w in layer["weights"]}
            if len(rows) != 1 or len(layer["bias"]) != len(layer["weights"]) or width not in (None, *rows):
                return "Bad model: layer shapes do not fit"
            width = len(layer["weights"])
        for row in params["nodes"] or []:
            if row["feature"] < 0 and (row["score"] is None if params["kind"] == "tree" or not params["labels"]
                                       else np.isnan(leaf_probs(row, params["labels"])).any()):
                return "Bad model: a leaf has no value"
        with np.errstate(all="ignore"):
            value = batch_scorer(params)(np.zeros((1, len(FEATURES))))
        return None if np.shape(value) == (1,) else "Bad model: no single score"
    except Exception as exc:  # whatever a strange document leads to
        return f"Bad model: cannot be scored ({type(exc).__name__})"


def scoring_error(params: Column) -> Column:
    """The reason for refusing a model, null where it scores (or where there is no model)."""

    @F.udf(T.StringType())
    def run(row):
        return None if row is None else trial(row.asDict(True))

    return run.asNondeterministic()(params)


def _matrix(columns: Sequence[pd.Series]) -> np.ndarray:
    if len(columns) == 1 and len(columns[0]) and isinstance(columns[0].iloc[0], (np.ndarray, list)):
        return np.stack(columns[0].to_numpy())
    return np.column_stack([c.to_numpy(dtype=float) for c in columns])


def _result_udf(scorer, dtype=T.DoubleType()):
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            columns = [columns] if isinstance(columns, pd.Series) else columns
            with np.errstate(all="ignore"):
                yield pd.Series(scorer(_matrix(columns)))

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, dtype)


def score_batches(df: DataFrame, params: dict, result: str = "result", columns: Sequence[str] = FEATURES,
                  missing: str = "zero") -> DataFrame:
    """Score with one model; only the input columns travel to the Python workers."""
    x = bind_fields(columns, df.columns, missing=missing)
    value = _result_udf(batch_scorer(params))(*x)
    if missing == "null":
        gap = F.lit(False)
        for c in x:
            gap = gap | c.isNull()
        value = F.when(~gap, value)
    return df.withColumn(result, value)


def score_timed(df: DataFrame, params: dict, result: str = "result", duration: str = "duration_ms",
                columns: Sequence[str] = FEATURES) -> DataFrame:
    """Score and measure: each row carries its share of the batch's scoring time, in milliseconds."""
    scorer = batch_scorer(params)
    layout = T.StructType([T.StructField(result, T.DoubleType()), T.StructField(duration, T.DoubleType())])

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for values in batches:
            start = time.perf_counter()
            with np.errstate(all="ignore"):
                scores = scorer(_matrix(values))
            share = (time.perf_counter() - start) * 1000.0 / max(len(scores), 1)
            yield pd.DataFrame({result: scores, duration: share})

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    # Nondeterministic: the measured time must be taken once, not again for every use of it.
    timed = F.pandas_udf(run, layout).asNondeterministic()
    return df.select("*", timed(*bind_fields(columns, df.columns)).alias("_t")).select(*df.columns, "_t.*")


def score_bundle(df: DataFrame, params: dict, signatures: DataFrame) -> DataFrame:
    """Score a tensor column named by the bundle's first signature, into a column named by its output.

    `signatures` is what `artifacts.model_signatures` lists for one bundle: a handful of rows.
    """
    first = signatures.agg(F.min("signature").alias("s"))
    sides = (
        signatures.join(F.broadcast(first), F.col("signature") == F.col("s"))
        .groupBy("side").agg(F.min("tensor").alias("tensor")).collect()
    )
    names = {row.side: row.tensor for row in sides}
    return df.withColumn(names["output"], score_vector(F.col(names["input"]), params))


def score_vector(vector: Column, params: dict) -> Column:
    """Score an array column, for tensors that are not the eleven record fields; null for a null."""
    scorer = batch_scorer(params)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out, known = np.full(len(batch), np.nan), np.flatnonzero(batch.notna().to_numpy())
            if len(known):
                with np.errstate(all="ignore"):
                    out[known] = scorer(_matrix([batch.iloc[known]]))
            yield pd.Series(out)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    value = F.pandas_udf(run, T.DoubleType())(vector)
    return F.when(vector.isNotNull(), F.coalesce(value, F.lit(float("nan"))))


def network_outputs(vector: Column, params: dict) -> Column:
    """Output activations of a network as array<double>."""
    scorer = _network(params).outputs

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out, known = [None] * len(batch), np.flatnonzero(batch.notna().to_numpy())
            if len(known):
                for i, row in zip(known, scorer(_matrix([batch.iloc[known]])).astype(float)):
                    out[i] = row
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.ArrayType(T.DoubleType()))(vector)
