"""Good rows and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.functions.codec import LOCATION_UNSUPPORTED, decode_descriptor, decode_record
from tidescore.operators.kinds import scorable_types

UNSUPPORTED_TYPE = "Bad model type"


def descriptor_error() -> Column:
    """Reason to refuse a descriptor before its content is read; null when it may go on."""
    return (
        F.when(F.col("data").isNull(), F.lit(LOCATION_UNSUPPORTED))
        .when(F.col("modeltype").isNull() | ~F.col("modeltype").isin(*scorable_types()), F.lit(UNSUPPORTED_TYPE))
        .otherwise(F.lit(None).cast("string"))
    )


def split_valid(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one)."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def parse_records(raw: DataFrame, value: str = "value") -> DataFrame:
    """Bytes -> record fields + error, other columns kept. Streaming safe."""
    keep = [c for c in raw.columns if c != value]
    return raw.select(*keep, value, decode_record(F.col(value)).alias("_d")).select(
        *keep, value, "_d.*"
    )


def parse_descriptors(raw: DataFrame, value: str = "value") -> DataFrame:
    keep = [c for c in raw.columns if c != value]
    return raw.select(*keep, value, decode_descriptor(F.col(value)).alias("_d")).select(
        *keep, value, "_d.*"
    )


def dead_letters(bad: DataFrame, payload: str, source: str) -> DataFrame:
    """Bad rows in one layout: where they came from, what they were, why they were refused."""
    return bad.select(F.lit(source).alias("source"), F.col(payload).alias("payload"), "error")


def count_by_reason(bad: DataFrame) -> DataFrame:
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("n"))
