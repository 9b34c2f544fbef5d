"""Scalar maths used by the model kinds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidescore.functions.vectors import bind

LINKS = ("identity", "log", "inverse", "logit", "sqrt", "cloglog")


def linear_predictor(intercept: float, coefs: Sequence[float], values: Sequence[Column]) -> Column:
    """intercept + sum(coef * x), added in predictor order; zero coefficients read no column."""
    total = F.lit(float(intercept))
    for coef, value in zip(coefs, values):
        if coef != 0.0:
            total = total + F.lit(float(coef)) * value
    return total


def inverse_link(eta: Column, link: str) -> Column:
    if link == "identity":
        return eta
    if link == "log":
        return F.exp(eta)
    if link == "inverse":
        # 1/0 is infinite here and in the batch form, whatever the session says about division.
        return F.when(eta == 0.0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1.0), eta))
    if link == "logit":
        return logistic(eta)
    if link == "sqrt":
        return eta * eta
    if link == "cloglog":
        return 1.0 - F.exp(-F.exp(eta))
    raise ValueError(f"link {link!r} is not supported; use one of {', '.join(LINKS)}")


def inverse_link_by_name(eta: Column, link: Column) -> Column:
    """Inverse link when the link is itself a column, for rows scored by different models."""
    out = F.when(link.isNull() | (link == "identity"), eta)
    for name in LINKS[1:]:
        out = out.when(link == name, inverse_link(eta, name))
    return out


def logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def softmax(values: Column) -> Column:
    """Softmax of an array, shifted by its maximum."""
    return bind(
        F.transform(values, lambda x: F.exp(x - F.array_max(values))),
        lambda e: bind(
            F.aggregate(e, F.lit(0.0), lambda s, x: s + x), lambda n: F.transform(e, lambda x: x / n)
        ),
    )
