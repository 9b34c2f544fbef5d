"""The six training programs. Settings are parameters; the defaults are fixed values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.schemas import FEATURES


@dataclass
class Fitted:
    """A fitted pipeline, the position of its model stage, and the class labels if it has any."""

    kind: str
    pipeline: PipelineModel
    stage: int
    labels: list[str] | None = None
    columns: list[str] = field(default_factory=lambda: list(FEATURES))

    @property
    def model(self):
        return self.pipeline.stages[self.stage]

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds `prediction`, for classifiers the label's number."""
        out = self.pipeline.transform(df)
        if self.labels is None:
            return out.select(*df.columns, "prediction")
        return out.select(*df.columns, F.col("predictedLabel").cast("double").alias("prediction"))


def assembler(columns: Sequence[str] = tuple(FEATURES)) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def label_index(df: DataFrame, label: str = "quality") -> StringIndexerModel:
    """Labels as text, numbered by falling frequency; fitted on the whole table before the pipeline."""
    return StringIndexer(inputCol=label, outputCol="indexedLabel", stringOrderType="frequencyDesc").fit(df)


def _fit_classifier(kind: str, df: DataFrame, estimator, columns: Sequence[str]) -> Fitted:
    text = df.withColumn("quality", F.col("quality").cast("string"))
    indexer = label_index(text)
    back = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=list(indexer.labels))
    estimator.setFeaturesCol("features").setLabelCol("indexedLabel")
    # The indexed table is read once per tree level or iteration; the estimators cache it themselves.
    fitted = Pipeline(stages=[assembler(columns), estimator, back]).fit(indexer.transform(text))
    return Fitted(kind, fitted, 1, list(indexer.labels), list(columns))


def _fit_regressor(kind: str, df: DataFrame, estimator, columns: Sequence[str], label_type: str) -> Fitted:
    data = df.withColumn("quality", F.col("quality").cast(label_type))
    estimator.setFeaturesCol("features").setLabelCol("quality")
    # Not every estimator keeps its input between iterations; the assembled columns are held here.
    held = data.select(*dict.fromkeys([*columns, "quality"])).persist()
    try:
        return Fitted(kind, Pipeline(stages=[assembler(columns), estimator]).fit(held), 1, None, list(columns))
    finally:
        held.unpersist()


# Fixed values below: trees 10; hidden layers 10 and 20, block size 128, seed 1234, 100 iterations;
# linear 50 iterations, regularisation 0.1, elastic net 0.5; glm gamma with identity link, 100
# iterations, regularisation 0.3.
def fit_tree_classifier(df: DataFrame, columns: Sequence[str] = tuple(FEATURES), **settings) -> Fitted:
    return _fit_classifier("tree", df, DecisionTreeClassifier(**settings), columns)


def fit_tree_regressor(df: DataFrame, columns: Sequence[str] = tuple(FEATURES), **settings) -> Fitted:
    return _fit_regressor("tree", df, DecisionTreeRegressor(**settings), columns, "int")


def fit_forest(df: DataFrame, columns: Sequence[str] = tuple(FEATURES), trees: int = 10, seed: int = 1234,
               **settings) -> Fitted:
    return _fit_classifier("forest", df, RandomForestClassifier(numTrees=trees, seed=seed, **settings), columns)


def fit_perceptron(df: DataFrame, columns: Sequence[str] = tuple(FEATURES), hidden: Sequence[int] = (10, 20),
                   classes: int = 6, block_size: int = 128, seed: int = 1234, iterations: int = 100) -> Fitted:
    layers = [len(columns), *hidden, classes]
    estimator = MultilayerPerceptronClassifier(layers=layers, blockSize=block_size, seed=seed, maxIter=iterations)
    return _fit_classifier("network", df, estimator, columns)


def fit_linear(df: DataFrame, columns: Sequence[str] = tuple(FEATURES), iterations: int = 50, reg: float = 0.1,
               elastic_net: float = 0.5) -> Fitted:
    estimator = LinearRegression(maxIter=iterations, regParam=reg, elasticNetParam=elastic_net)
    return _fit_regressor("linear", df, estimator, columns, "double")


def fit_glm(df: DataFrame, columns: Sequence[str] = tuple(FEATURES), family: str = "gamma", link: str = "identity",
            iterations: int = 100, reg: float = 0.3) -> Fitted:
    estimator = GeneralizedLinearRegression(family=family, link=link, maxIter=iterations, regParam=reg)
    return _fit_regressor("glm", df, estimator, columns, "double")
