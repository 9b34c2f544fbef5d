"""Results beside expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expected_pairs(scored: DataFrame, result: str = "result", label: str = "label") -> DataFrame:
    return scored.select(F.col(result).alias("result"), F.col(label).cast("double").alias("expected"))


def accuracy(pairs: DataFrame) -> DataFrame:
    hit = (F.col("result") == F.col("expected")).cast("double")
    return pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("correct"), F.avg(hit).alias("accuracy"))


def regression_error(pairs: DataFrame) -> DataFrame:
    """RMSE and r2 in one pass: the total sum of squares comes from the label's variance."""
    e = F.col("expected") - F.col("result")
    sse, sst = F.sum(e * e), F.var_pop("expected") * F.count("expected")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1.0 - F.try_divide(sse, sst)).alias("r2"),
    )


def residuals(pairs: DataFrame) -> DataFrame:
    return pairs.select("result", "expected", (F.col("expected") - F.col("result")).alias("residual"))
