"""Kinds of models that others add: how a document is read, checked and scored, by the names of functions.

A kind serves one model type of the descriptors. Its functions are named `module:function`; drivers and
workers import them by that name, so the modules must be on the workers' path (`--py-files` or installed).
Names come from `register` alone, never from a model's own bytes.

* parser: bytes -> a dict with some of the fields of `schemas.PARAMS_TYPE` (the others are null). Whatever it
  raises refuses the model.
* checker (optional): params -> the reason to refuse a model, or None. Every model also scores one row of zeros
  before it may replace another.
* batch: params -> a function from an (n, inputs) array to n numbers, called per Arrow batch.
* column (optional): (params, input columns) -> a Column, for a whole table scored with one model.

Queries planned after `register` know the kind; register before a stream is started.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from importlib import import_module

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.schemas import FEATURES, MODEL_TYPES, PARAMS_TYPE, SCORABLE_TYPES

BUILT_IN = ("linear", "glm", "tree", "forest", "network", "dense")
RESULT = T.StructType([T.StructField("params", PARAMS_TYPE), T.StructField("error", T.StringType())])


@dataclass(frozen=True)
class Kind:
    name: str
    modeltype: str
    parser: str
    batch: str
    checker: str | None = None
    column: str | None = None


_kinds: dict[str, Kind] = {}


@lru_cache(maxsize=64)
def load(reference: str) -> Callable:
    """The function behind `module:function`."""
    module, _, name = reference.partition(":")
    found = getattr(import_module(module), name, None) if name else None
    if not callable(found):
        raise ValueError(f"{reference!r} names no function")
    return found


def register(kind: Kind) -> None:
    """Add a kind. Its functions are looked up here first, so a wrong name is an error of the caller's."""
    if kind.name in BUILT_IN or kind.modeltype in SCORABLE_TYPES:
        raise ValueError(f"{kind.name!r} for {kind.modeltype!r} would replace a kind of this package")
    if kind.modeltype not in MODEL_TYPES:
        raise ValueError(f"{kind.modeltype!r} is no model type")
    if any(k.modeltype == kind.modeltype and k.name != kind.name for k in _kinds.values()):
        raise ValueError(f"{kind.modeltype!r} has a kind already")
    for reference in (kind.parser, kind.batch, kind.checker, kind.column):
        if reference is not None:
            load(reference)
    _kinds[kind.name] = kind


def forget(name: str) -> None:
    _kinds.pop(name, None)


def registered() -> dict[str, Kind]:
    """The kinds known now; what a query carries to its workers."""
    return dict(_kinds)


def scorable_types() -> list[str]:
    return [*SCORABLE_TYPES, *(k.modeltype for k in _kinds.values())]


def batch_of(params: dict, known: dict[str, Kind]) -> Callable[[np.ndarray], np.ndarray]:
    """The batch form of a model of an added kind."""
    if params["kind"] not in known:
        raise ValueError(f"kind {params['kind']!r} is not registered")
    return load(known[params["kind"]].batch)(params)


def read_model(content: bytes, kind: Kind) -> tuple[dict | None, str | None]:
    """(params, reason to refuse) of a document."""
    try:
        params = dict.fromkeys(PARAMS_TYPE.names) | load(kind.parser)(content) | {"kind": kind.name}
        error = load(kind.checker)(params) if kind.checker else None
        if error is None:
            with np.errstate(all="ignore"):
                value = load(kind.batch)(params)(np.zeros((1, len(FEATURES))))
            error = None if np.shape(value) == (1,) else "no single score"
    except Exception as exc:  # whatever a strange document leads to
        error = f"cannot be read ({type(exc).__name__})"
    return (params, None) if error is None else (None, f"Bad model: {error}")


def read_models(content: Column, modeltype: Column) -> Column:
    """bytes -> struct(params, error) of the models whose type has an added kind, null for the others."""
    by_type = {k.modeltype: k for k in _kinds.values()}

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for documents, types in batches:
            read = [read_model(bytes(d), by_type[t]) if d is not None and t in by_type else (None, None)
                    for d, t in zip(documents, types)]
            yield pd.DataFrame({"params": pd.Series([p for p, _ in read], dtype=object),
                                "error": pd.Series([e for _, e in read], dtype=object)})

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, RESULT).asNondeterministic()(content, modeltype)
