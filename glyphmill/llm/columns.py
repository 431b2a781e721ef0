"""Columns the operators add, without touching columns of the same name that the input has."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.session import bound_batch_bytes

# Rows of an Arrow batch of whole texts; Spark's own 10,000 are meant for narrow rows.
BATCH_ROWS, BATCH_SETTING = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"
# Bytes of text a task looks at together; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of the session have at most ``BATCH_ROWS`` rows and few bytes; smaller bounds stay.

    A setting for jobs over whole texts, whose batches would else take some hundred MB on both sides of a task.
    """
    bound_batch_bytes(spark)
    rows = int(spark.conf.get(BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def own_name(df: DataFrame, stem: str) -> str:
    """A column name that neither ``df`` nor a result has."""
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def put(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with the result ``columns`` at its end; input columns of those names are replaced."""
    taken = {c.lower() for c in columns}
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def map_text(df: DataFrame, batch_function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """Apply a function from one Arrow batch to any number of batches, task by task."""

    def run(batches):
        for batch in batches:
            yield from batch_function(batch)

    return df.mapInArrow(run, schema)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string or binary array and where each text starts; NULL counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    bounds = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or len(bounds) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks_of(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with about ``size`` bytes each."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
