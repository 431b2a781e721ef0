"""Tables of vectors packed into blocks of bounded size, one row each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def unpack(row_ids: bytes, row_vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row_ids, np.int64), np.frombuffer(row_vectors, np.float64).reshape(-1, dim)


def pack(vectors: DataFrame, rows: int) -> DataFrame:
    """``(shard, dim, ids, data)`` of ``(id BIGINT, vector ARRAY<DOUBLE>)``: blocks of at most ``rows``
    vectors of one dimension, from the rows of one task; ``shard`` is a random-looking number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            ids = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                for i in range(0, len(own), rows):
                    part = own[i : i + rows]
                    data = np.ascontiguousarray(matrix(batch.column(1).take(pa.array(part)), int(dim)), np.float64)
                    mine = np.ascontiguousarray(ids[part])
                    columns = [[int(mine[0])], [int(dim)], [mine.tobytes()], [data.tobytes()]]
                    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["shard", "dim", "ids", "data"])

    return vectors.mapInArrow(run, "shard bigint, dim int, ids binary, data binary")
