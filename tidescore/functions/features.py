"""Feature projections: casts, splits, name binding, vectors, result normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.schemas import FEATURES, MODEL_FIELD_NAMES


def cast_columns(df: DataFrame, names: Sequence[str], dtype: str = "double", lenient: bool = False) -> DataFrame:
    """Cast columns in place. Bad text raises (ANSI cast); `lenient` turns it into null."""
    cast = (lambda c: c.try_cast(dtype)) if lenient else (lambda c: c.cast(dtype))
    wanted = set(names)
    return df.select(*[cast(F.col(f"`{c}`")).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def cast_label(df: DataFrame, label: str = "quality", dtype: str = "double") -> DataFrame:
    return cast_columns(df, [label], dtype)


def split_fields(line: Column, sep: str = ";") -> Column:
    """One text line -> array of trimmed fields."""
    return F.transform(F.split(line, sep, -1), lambda x: F.trim(x))


def features_and_label(fields: Column, n: int = 11) -> tuple[Column, Column]:
    """First n entries as features, the next one as label."""
    return F.slice(fields, 1, n), F.element_at(fields, n + 1)


def float_vector(columns: Sequence[str] = tuple(FEATURES)) -> Column:
    """Record fields in message order, narrowed to float, as a tensor row."""
    return F.array(*[F.col(c).cast("float") for c in columns])


def double_vector(columns: Sequence[str] = tuple(FEATURES)) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def bind_fields(model_fields: Sequence[str], available: Sequence[str], strict: bool = False,
                missing: str = "zero") -> list[Column]:
    """Record columns for a model's input names, in the model's order.

    An unknown name gives 0.0, or raises when `strict`. A null value gives 0.0, or stays null
    with `missing="null"`.
    """
    have = set(available)
    bound = []
    for name in model_fields:
        field = MODEL_FIELD_NAMES.get(name, name)
        if field not in have:
            if strict:
                raise KeyError(f"model input {name!r} is not a record field")
            bound.append(F.lit(0.0))
        elif missing == "zero":
            bound.append(F.coalesce(F.col(field).cast("double"), F.lit(0.0)))
        else:
            bound.append(F.col(field).cast("double"))
    return bound
