"""Comparing a table with a saved one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.operators.joins import null_safe_join

# The usual tolerances of saved numbers.
RTOL, ATOL = 1e-4, 1e-2


def _long_form(df: DataFrame, key: str, value: str, exact: bool) -> tuple[DataFrame, list[str]]:
    """``(key, [idx,] v, copies)``, one row per key or per key and array position, and its keys.

    A key whose array is empty or NULL keeps one row, with a NULL position.
    """
    kind = df.schema[value].dataType
    if isinstance(kind, T.ArrayType):
        flat, keys = df.select(F.col(key).alias("key"), F.posexplode_outer(value).alias("idx", "v")), ["key", "idx"]
        kind = kind.elementType
    else:
        flat, keys = df.select(F.col(key).alias("key"), F.col(value).alias("v")), ["key"]
    if not exact:
        if not isinstance(kind, (T.NumericType, T.BooleanType)):
            raise ValueError(f"{value}: only numbers are compared within a tolerance")
        flat = flat.withColumn("v", F.col("v").cast("double"))
    return flat.groupBy(*keys).agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("copies")), keys


def _close(actual: Column, expected: Column, rtol: float, atol: float) -> Column:
    same = actual.eqNullSafe(expected)
    finite = actual.isNotNull() & expected.isNotNull() & ~F.isnan(actual) & ~F.isnan(expected)
    # An infinite value is close to nothing but itself.
    bounded = F.abs(expected) < float("inf")
    return same | (finite & bounded & (F.abs(actual - expected) <= atol + rtol * F.abs(expected)))


def _shown(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    return F.hex(value) if isinstance(df.schema[column].dataType, T.BinaryType) else value.cast("string")


def table_diff(
    actual: DataFrame,
    expected: DataFrame,
    key: str,
    value: str,
    rtol: float = RTOL,
    atol: float = ATOL,
    exact: bool = False,
    ignore_missing: bool = False,
) -> DataFrame:
    """One row ``(key, idx, kind, actual, expected)`` per difference; an empty result is a match.

    Single values have position 0, and a key with an empty or NULL array has a NULL position. ``kind``
    is ``missing`` (only expected), ``extra`` (only actual), ``repeated`` (a key that is not unique on
    one side) or ``different`` (outside ``atol + rtol * |expected|``). NaN equals NaN and a NULL key a
    NULL key. With ``exact`` values of any type that can be ordered are compared as they are and shown
    as text, bytes as hex. Both sides are aggregated by key before the join, so repeated keys never
    multiply.
    """
    (left, keys), (right, right_keys) = _long_form(actual, key, value, exact), _long_form(expected, key, value, exact)
    if keys != right_keys:
        raise ValueError("both sides must hold single values, or both arrays")
    if exact and left.schema["v"].dataType != right.schema["v"].dataType:
        raise ValueError("exact values must have one type")
    left = left.select(*keys, F.col("v").alias("actual"), F.col("copies").alias("a"))
    right = right.select(*keys, F.col("v").alias("expected"), F.col("copies").alias("e"))
    # Keys of rows that only one side has come from that side.
    marked = right.select(*[F.col(k).alias(f"right_{k}") for k in keys], *right.columns)
    joined = null_safe_join(left, marked, keys, "full_outer")
    for k in keys:
        joined = joined.withColumn(k, F.when(F.col("a").isNull(), F.col(f"right_{k}")).otherwise(F.col(k)))
    position = F.col("idx") if "idx" in keys else F.lit(0)
    equal = F.col("actual").eqNullSafe(F.col("expected")) if exact else _close(F.col("actual"), F.col("expected"), rtol, atol)
    kind = (
        F.when((F.coalesce("a", F.lit(0)) > 1) | (F.coalesce("e", F.lit(0)) > 1), "repeated")
        .when(F.col("a").isNull(), F.lit(None) if ignore_missing else F.lit("missing"))
        .when(F.col("e").isNull(), "extra")
        .when(~equal, "different")
    )
    shown = [_shown(joined, c).alias(c) if exact else F.col(c) for c in ("actual", "expected")]
    return (
        joined.withColumn("kind", kind)
        .filter("kind is not null")
        .select(F.col("key").cast("string").alias("key"), position.alias("idx"), "kind", *shown)
    )


def tables_diff(actual: DataFrame, expected: DataFrame, key: str, values: Sequence[str], **options) -> DataFrame:
    """``table_diff`` of several columns, with the name of the column as ``column``."""
    parts = [table_diff(actual, expected, key, v, **options).select(F.lit(v).alias("column"), "*") for v in values]
    return reduce(DataFrame.unionByName, parts)
