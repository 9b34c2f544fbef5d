"""String, date and JSON helpers for names and statistics reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that model names lose at their end.
PMML_SUFFIX_LENGTH = 5
TENSOR_SUFFIX_LENGTH = 3


def drop_right(value: Column, n: int) -> Column:
    return F.substring(value, F.lit(1), F.greatest(F.length(value) - n, F.lit(0)))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def pmml_model_name(path: Column) -> Column:
    """File name without its five-character suffix."""
    return drop_right(file_name(path), PMML_SUFFIX_LENGTH)


def tensor_model_name(path: Column) -> Column:
    """Whole path without its three-character suffix; the directory is kept."""
    return drop_right(path, TENSOR_SUFFIX_LENGTH)


def before_colon(name: Column) -> Column:
    return F.split_part(name, F.lit(":"), F.lit(1))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def format_millis(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy/MM/dd HH:mm:ss")


def as_json(df: DataFrame, alias: str = "json") -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(alias))
