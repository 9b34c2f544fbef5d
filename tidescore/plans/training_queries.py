"""Training programs over the line-item records, and their models served from the registry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.operators import scoring
from tidescore.plans import inputs, sqltext
from tidescore.plans.catalogue import query
from tidescore.session import scratch_path
from tidescore.sources import registry
from tidescore.sources.pmml import parse_pmml
from tidescore.training import export, fit

FITS = {
    "tree_classifier": fit.fit_tree_classifier,
    "tree_regressor": fit.fit_tree_regressor,
    "forest": fit.fit_forest,
    "perceptron": fit.fit_perceptron,
    "linear": fit.fit_linear,
    "glm": fit.fit_glm,
}


def training_data(spark, folder) -> DataFrame:
    return inputs.wine(spark, folder)


@query(
    "train_label_index",
    f"WITH {sqltext.WINE} SELECT CAST(quality AS VARCHAR) AS label, row_number() OVER "
    "(ORDER BY count(*) DESC, CAST(quality AS VARCHAR)) - 1 AS idx FROM wine GROUP BY quality",
)
def train_label_index(spark, folder):
    text = training_data(spark, folder).select(F.col("quality").cast("string").alias("quality"))
    labels = fit.label_index(text).labels
    return spark.createDataFrame(list(enumerate(labels)), "idx long, label string").select("label", "idx")


@query(
    "train_simple_linear",
    f"WITH {sqltext.WINE} SELECT round(regr_slope(CAST(quality AS DOUBLE), alcohol), 5) AS slope, "
    "round(regr_intercept(CAST(quality AS DOUBLE), alcohol), 4) AS intercept FROM wine",
)
def train_simple_linear(spark, folder):
    fitted = fit.fit_linear(training_data(spark, folder), columns=["alcohol"], reg=0.0, elastic_net=0.0)
    rows = [(round(float(fitted.model.coefficients[0]), 5), round(float(fitted.model.intercept), 4))]
    return spark.createDataFrame(rows, "slope double, intercept double")


def _served(name: str) -> None:
    @query(f"train_{name}", "SELECT count(*) AS n, count(*) AS agree, true AS beats_constant FROM lineitem")
    def run(spark, folder):
        """Fit, publish to the registry, read back, score from the document; compare with the pipeline."""
        data = training_data(spark, folder)
        fitted = FITS[name](data)
        path = scratch_path(spark, "registry")
        registry.append_versions(
            export.version_row(spark, fitted, "wine", 1, name, datetime(2024, 1, 1)), path
        )
        row = registry.read_versions(spark, path).select("content").first()
        both = scoring.score(fitted.predict(data), parse_pmml(bytes(row.content)))
        near = F.abs(F.col("result") - F.col("prediction")) < 1e-9
        y = F.col("quality").cast("double")
        if fitted.labels:
            # More right answers than the most frequent class has rows.
            right = F.sum((F.col("result") == y).cast("long"))
            beats = right > data.groupBy("quality").count().agg(F.max("count")).scalar()
        else:
            beats = F.sum((F.col("result") - y) ** 2) < F.var_pop(y) * F.count(F.lit(1))
        return both.agg(
            F.count(F.lit(1)).alias("n"), F.sum(near.cast("long")).alias("agree"), beats.alias("beats_constant"))


for _name in FITS:
    _served(_name)


# Sums of the regression of quality on alcohol, which has closed forms without regularisation.
_SUMS = (
    f"WITH {sqltext.WINE}, xy AS (SELECT CAST(quality AS DOUBLE) AS y, alcohol AS x FROM wine), "
    "s AS (SELECT count(*) AS n, avg(x) AS mx, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_slope(y, x) AS b, "
    "regr_intercept(y, x) AS a FROM xy), e AS (SELECT *, syy - b * b * sxx AS sse FROM s)"
)


def one_column(spark, folder):
    return fit.fit_linear(training_data(spark, folder), columns=["alcohol"], reg=0.0, elastic_net=0.0)


def one_column_glm(spark, folder):
    return fit.fit_glm(training_data(spark, folder), columns=["alcohol"], family="gaussian", reg=0.0)


@query(
    "train_linear_summary",
    f"{_SUMS} SELECT 'rmse' AS measure, round(sqrt(sse / n), 5) AS value FROM e UNION ALL "
    "SELECT 'r2', round(1 - sse / syy, 5) FROM e",
)
def train_linear_summary(spark, folder):
    summary = export.linear_summary(spark, one_column(spark, folder))
    return summary.where(F.col("measure").isin("rmse", "r2")).withColumn("value", F.round("value", 5))


@query(
    "train_linear_coefficients",
    f"{_SUMS} SELECT 'intercept' AS term, round(a, 4) AS coefficient FROM e UNION ALL SELECT 'alcohol', round(b, 4) FROM e",
)
def train_linear_coefficients(spark, folder):
    return export.coefficients(spark, one_column(spark, folder)).withColumn("coefficient", F.round("coefficient", 4))


@query(
    "train_glm_summary",
    f"{_SUMS}, t AS (SELECT a, b, sqrt(sse / (n - 2) / sxx) AS eb, sqrt(sse / (n - 2) * (1e0 / n + mx * mx / sxx)) AS ea "
    "FROM e) SELECT 'alcohol' AS term, round(b, 4) AS coefficient, round(eb, 6) AS std_error, round(b / eb, 2) AS t FROM t "
    "UNION ALL SELECT 'intercept', round(a, 4), round(ea, 6), round(a / ea, 2) FROM t",
)
def train_glm_summary(spark, folder):
    rows = export.glm_summary(spark, one_column_glm(spark, folder))
    return rows.select(
        "term", F.round("coefficient", 4).alias("coefficient"), F.round("std_error", 6).alias("std_error"),
        F.round("t", 2).alias("t"))


@query(
    "train_glm_measures",
    f"{_SUMS}, m AS (SELECT ['dispersion', 'null_deviance', 'deviance', 'aic', 'residual_degrees_of_freedom', "
    "'residual_degrees_of_freedom_null'] AS names, [sse / (n - 2), syy, sse, n * (ln(2 * pi() * sse / n) + 1) + 2 + 4, "
    "n - 2, n - 1] AS figures FROM e) SELECT unnest(names) AS measure, round(unnest(figures), 3) AS value FROM m",
)
def train_glm_measures(spark, folder):
    return export.glm_measures(spark, one_column_glm(spark, folder)).withColumn("value", F.round("value", 3))


@query(
    "train_glm_residuals",
    f"{_SUMS} SELECT n, round(sse, 3) AS squares, true AS centred FROM e",
)
def train_glm_residuals(spark, folder):
    rows = export.deviance_residuals(one_column_glm(spark, folder)).toDF("r")
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("r") ** 2), 3).alias("squares"),
        (F.abs(F.avg("r")) < 1e-6).alias("centred"))


@query(
    "train_tree_nodes",
    f"WITH {sqltext.WINE} SELECT CAST(quality AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS n FROM wine GROUP BY 1",
)
def train_tree_nodes(spark, folder):
    """Every training row lies in one leaf: the leaves' class counts add up to the table's."""
    fitted = fit.fit_tree_classifier(training_data(spark, folder))
    leaves = export.saved_nodes(spark, fitted).where(F.col("left") < 0)
    counts = leaves.select(F.posexplode("impurityStats").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    labels = F.array(*[F.lit(v) for v in fitted.labels])
    return counts.select(F.element_at(labels, F.col("k") + 1).alias("label"), "n")


# The whole programs: eleven features and the programs' own settings. SQL cannot fit them; tests/test_training.py
# holds them against their own coefficients and nodes.
@query("train_linear_summary_full")
def train_linear_summary_full(spark, folder):
    return export.linear_summary(spark, fit.fit_linear(training_data(spark, folder)))


@query("train_linear_coefficients_full")
def train_linear_coefficients_full(spark, folder):
    return export.coefficients(spark, fit.fit_linear(training_data(spark, folder)))


@query("train_glm_summary_full")
def train_glm_summary_full(spark, folder):
    return export.glm_summary(spark, fit.fit_glm(training_data(spark, folder)))


@query("train_glm_measures_full")
def train_glm_measures_full(spark, folder):
    return export.glm_measures(spark, fit.fit_glm(training_data(spark, folder), family="gaussian"))


@query("train_glm_residuals_full")
def train_glm_residuals_full(spark, folder):
    """One deviance residual per row."""
    return export.deviance_residuals(fit.fit_glm(training_data(spark, folder)))


@query("train_tree_nodes_full")
def train_tree_nodes_full(spark, folder):
    return export.saved_nodes(spark, fit.fit_tree_classifier(training_data(spark, folder))).drop("impurityStats")
