"""Delimited text sources of the training and replay programs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.functions.features import features_and_label, split_fields
from tidescore.schemas import FEATURES, MODEL_FIELD_NAMES

CSV_HEADER = [*MODEL_FIELD_NAMES, "quality"]


def read_training_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Header line, `;`, all strings; rows with a wrong number of columns are dropped.

    The schema stays all-string so that a bad number is not dropped but raises at the cast.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or CSV_HEADER])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ";")
        .option("mode", "DROPMALFORMED")
        # With pruning on, a query that reads few columns parses few and never sees a short row.
        .option("columnPruning", False)
        .option("enforceSchema", True)
        .csv(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Headerless `;` lines -> features array<float>, label float. A bad or short row raises."""
    fields = split_fields(F.col("value"))
    features, label = features_and_label(fields)
    width = F.size(fields)
    checked = F.when(width >= 12, fields).otherwise(
        F.raise_error(F.concat(F.lit("expected 12 fields, got "), width.cast("string"))).cast("array<string>")
    )
    return (
        spark.read.text(path)
        .select(checked.alias("fields"))
        .select(
            F.transform(features_and_label(F.col("fields"))[0], lambda x: x.cast("float")).alias("features"),
            features_and_label(F.col("fields"))[1].cast("float").alias("label"),
        )
    )


def read_lines_with_header(spark: SparkSession, path: str) -> DataFrame:
    """As `read_lines` for files whose first line is a header; numbers parse or the read fails."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in [*FEATURES, "label"]])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ";")
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return df.select(
        F.array(*[F.col(c).cast("float") for c in FEATURES]).alias("features"), F.col("label").cast("float")
    )


def read_records(spark: SparkSession, path: str, data_type: str = "wine") -> DataFrame:
    """Headerless lines -> record columns with a constant data type."""
    lines = read_lines(spark, path)
    return lines.select(
        *[F.col("features")[i].cast("double").alias(c) for i, c in enumerate(FEATURES)],
        F.lit(data_type).alias("dataType"),
    )
