"""Fitted models -> model parameters -> registry rows, plus their printed descriptions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.schemas import FEATURE_INDEX, FEATURES, MODEL_VERSION_SCHEMA
from tidescore.session import scratch_path
from tidescore.sources.pmml import empty_params, render_pmml
from tidescore.training.fit import Fitted


def _positions(fitted: Fitted) -> list[int]:
    return [FEATURE_INDEX[c] for c in fitted.columns]


def _sum_params(fitted: Fitted, link: str) -> dict:
    params = empty_params(fitted.kind)
    params["intercept"], params["link"], params["terms"] = float(fitted.model.intercept), link, []
    params["coefs"] = [0.0] * len(FEATURES)
    for position, value in zip(_positions(fitted), fitted.model.coefficients.toArray()):
        params["coefs"][position] = float(value)
    return params


def saved_nodes(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Node table of a fitted tree or forest, read from the model's saved form."""
    path = scratch_path(spark, "model")
    fitted.model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree"), "*")
    return data.select(
        "tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), "prediction", "impurityStats",
    )


def _tree_params(spark: SparkSession, fitted: Fitted) -> dict:
    params = empty_params(fitted.kind)
    params["labels"] = fitted.labels
    positions = _positions(fitted)
    nodes = []
    # A model's nodes: bounded by trees * 2^depth, independent of the data.
    for row in saved_nodes(spark, fitted).orderBy("tree", "node").collect():
        inner = row.left >= 0
        stats = [float(v) for v in row.impurityStats]
        total = sum(stats)
        nodes.append(
            {
                "tree": row.tree,
                "node": row.node,
                "feature": positions[row.feature] if inner else -1,
                "threshold": float(row.threshold) if inner else None,
                "left": row.left,
                "right": row.right,
                "score": float(fitted.labels[int(row.prediction)]) if fitted.labels else float(row.prediction),
                "probs": [v / total for v in stats] if fitted.labels else None,
            }
        )
    params["nodes"] = nodes
    return params


def _network_params(fitted: Fitted) -> dict:
    params = empty_params("network")
    params["inputs"], params["labels"] = _positions(fitted), fitted.labels
    sizes, flat, at, layers = fitted.model.getLayers(), fitted.model.weights.toArray(), 0, []
    for depth, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
        last = depth == len(sizes) - 2
        block = flat[at:at + fan_in * fan_out].reshape(fan_in, fan_out)
        at += fan_in * fan_out
        layers.append(
            {
                "activation": "identity" if last else "logistic",
                "normalization": "softmax" if last else "none",
                "bias": [float(v) for v in flat[at:at + fan_out]],
                "weights": [[float(v) for v in block[:, j]] for j in range(fan_out)],
            }
        )
        at += fan_out
    params["layers"] = layers
    return params


def to_params(spark: SparkSession, fitted: Fitted) -> dict:
    """Model parameters of a fitted pipeline, ready for every scorer here."""
    if fitted.kind == "linear":
        return _sum_params(fitted, "identity")
    if fitted.kind == "glm":
        return _sum_params(fitted, fitted.model.getLink())
    if fitted.kind in ("tree", "forest"):
        return _tree_params(spark, fitted)
    return _network_params(fitted)


def version_row(spark: SparkSession, fitted: Fitted, data_type: str, version: int, name: str,
                valid_from: datetime) -> DataFrame:
    """A registry row for a fitted model: document bytes and parameters."""
    params = to_params(spark, fitted)
    row = (data_type, version, name, "generated from SparkML", "PMML", valid_from, bytearray(render_pmml(params)), params)
    return spark.createDataFrame([row], MODEL_VERSION_SCHEMA)


def describe(fitted: Fitted) -> str:
    """What the training program prints about its model."""
    model = fitted.model
    if fitted.kind in ("tree", "forest"):
        return model.toDebugString
    if fitted.kind == "network":
        return f"layers {model.getLayers()}, {len(model.weights)} weights"
    return f"coefficients {list(model.coefficients)}, intercept {model.intercept}"


def coefficients(spark: SparkSession, fitted: Fitted) -> DataFrame:
    rows = [("intercept", float(fitted.model.intercept))]
    rows += [(c, float(v)) for c, v in zip(fitted.columns, fitted.model.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, coefficient double")


def linear_summary(spark: SparkSession, fitted: Fitted) -> DataFrame:
    s = fitted.model.summary
    rows = [("iterations", float(s.totalIterations)), ("rmse", s.rootMeanSquaredError), ("r2", s.r2)]
    rows += [(f"objective_{i}", float(v)) for i, v in enumerate(s.objectiveHistory)]
    return spark.createDataFrame(rows, "measure string, value double")


def glm_summary(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Per term: coefficient, standard error, t and p; the intercept is last in Spark's order."""
    s = fitted.model.summary
    names = [*fitted.columns, "intercept"]
    values = [*fitted.model.coefficients.toArray(), fitted.model.intercept]
    rows = [
        (n, float(v), float(e), float(t), float(p))
        for n, v, e, t, p in zip(names, values, s.coefficientStandardErrors, s.tValues, s.pValues)
    ]
    return spark.createDataFrame(rows, "term string, coefficient double, std_error double, t double, p double")


def glm_measures(spark: SparkSession, fitted: Fitted) -> DataFrame:
    s = fitted.model.summary
    rows = [
        ("dispersion", s.dispersion), ("null_deviance", s.nullDeviance), ("deviance", s.deviance), ("aic", s.aic),
        ("residual_degrees_of_freedom", float(s.residualDegreeOfFreedom)),
        ("residual_degrees_of_freedom_null", float(s.residualDegreeOfFreedomNull)),
    ]
    return spark.createDataFrame([(n, float(v)) for n, v in rows], "measure string, value double")


def deviance_residuals(fitted: Fitted) -> DataFrame:
    return fitted.model.summary.residuals()
