"""Column expressions over numeric columns and arrays of numbers."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def constant_vector(values: Sequence[float]) -> Column:
    """Array literal that the optimizer folds into one constant."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def silu(x: Column) -> Column:
    """``x / (1 + exp(-x))`` of a number."""
    return x / (1 + F.exp(-x))


def silu_vector(x: Column) -> Column:
    return F.transform(x, silu)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once a row, however often ``body`` uses it.

    An expression that stands inside a lambda is worked out anew for every element of the array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def rms_normalise(x: Column, weights: Column, eps: float = 1e-5) -> Column:
    """Scale an array by the root of its mean square, ``eps`` inside the root, then by ``weights``."""
    squares = _total(F.transform(x, lambda v: v.cast("double") * v.cast("double")))
    root = F.sqrt(F.try_divide(squares, F.size(x)) + F.lit(eps))
    return bind(root, lambda r: F.zip_with(x, weights, lambda v, w: v / r * w))


def log_sum_exp(x: Column) -> Column:
    """``log(sum(exp(x)))`` of an array, safe for large values."""
    top = F.array_max(x).cast("double")
    return bind(top, lambda t: t + F.log(_total(F.transform(x, lambda v: F.exp(v.cast("double") - t)))))


def softmax_vector(x: Column) -> Column:
    """Softmax along an array."""
    return bind(log_sum_exp(x), lambda norm: F.transform(x, lambda v: F.exp(v.cast("double") - norm)))
