"""Array functions: argmax, class probabilities, ensemble means."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """Evaluate `value` once and use it several times inside `body`."""
    return F.transform(F.array(value), body)[0]


def argmax_index(scores: Column) -> Column:
    """Index of the greatest entry as double; the first one wins ties.

    A NaN in first place stays the winner and a later NaN never wins, as in a scan that only
    replaces the best value on a strict greater-than.
    """
    floor = F.lit(float("-inf"))
    clean = F.transform(
        scores, lambda x, i: F.when(F.isnan(x) & (i > 0), floor.cast("double")).otherwise(x.cast("double"))
    )
    return bind(clean, lambda a: (F.array_position(a, F.array_max(a)) - 1).cast("double"))


def class_probabilities(counts: Column) -> Column:
    """Class counts of a node -> probability per class."""
    return bind(
        counts,
        lambda a: bind(
            F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double")),
            lambda n: F.transform(a, lambda x: x.cast("double") / n),
        ),
    )


def mean_arrays(arrays: Sequence[Column]) -> Column:
    """Elementwise mean of equally long arrays of one row."""
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), arrays)
    return F.transform(total, lambda x: x / float(len(arrays)))


def elementwise_avg(array: Column, size: int) -> Column:
    """Aggregate: mean vector over rows, one partial sum per position and no explode."""
    return F.array(*[F.avg(array[i].cast("double")) for i in range(size)])
