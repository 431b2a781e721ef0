"""Joining rows with a table that has one row per key, when some keys are far more common."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.session import write_table

# A per-key table with at most this many rows and bytes is broadcast; a larger one is split at its
# most common keys, of which as many as fit these bounds are broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL being equal to NULL; the keys of ``left`` and then all other columns."""
    own = {k: f"{k}_{uuid.uuid4().hex[:8]}" for k in keys}
    renamed = right.select(
        *[F.col(k).alias(name) for k, name in own.items()], *[c for c in right.columns if c not in own]
    )
    condition = F.lit(True)
    for k, name in own.items():
        condition = condition & F.col(k).eqNullSafe(F.col(name))
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*own.values())


def _hinted(df: DataFrame, hint: str) -> DataFrame:
    return F.broadcast(df) if hint == "broadcast" else df.hint(hint)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    size = F.lit(16 + 8 * len(df.columns))
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            size = size + 8 * F.coalesce(F.when(F.size(c) > 0, F.size(c)), F.lit(0))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return size.cast("bigint")


def attach_by_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    weight: str,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of ``rows`` with ``per_key``, whose ``weight`` is the number of rows of each key.

    NULL is a key like any other. Without keys ``per_key`` has one row, whose values are added as
    constants. ``per_key`` is written once, counted and measured. When small it is broadcast and
    ``rows`` stay where they are. Otherwise its heaviest keys are broadcast, and the rows of all other
    keys are shuffled; none of those keys has more than one ``n``-th of the rows, where ``n`` is the
    number of broadcast keys, so no task is hot.
    """
    keys = list(keys)
    if not keys:
        values = per_key.drop(weight).first()
        return rows if values is None else rows.withColumns(
            {c: F.lit(values[c]).cast(per_key.schema[c].dataType) for c in values.asDict()}
        )
    per_key = write_table(per_key, "per-key")
    count, total, widest = per_key.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(per_key)), F.lit(0)), F.coalesce(F.max(row_bytes(per_key)), F.lit(1))
    ).first()
    if count <= broadcast_rows and total <= broadcast_bytes:
        return null_safe_join(rows, _hinted(per_key.drop(weight), "broadcast"), keys)
    n_heavy = max(1, min(broadcast_rows, broadcast_bytes // widest))
    heavy = write_table(per_key.orderBy(F.desc(weight), *keys).limit(n_heavy), "heavy-keys")
    names = _hinted(heavy.select(keys), "broadcast")
    light = null_safe_join(per_key, names, keys, "left_anti").drop(weight)
    light_rows = null_safe_join(rows, names, keys, "left_anti")
    return null_safe_join(rows, _hinted(heavy.drop(weight), "broadcast"), keys).unionByName(
        null_safe_join(light_rows, _hinted(light, "shuffle_merge"), keys)
    )
