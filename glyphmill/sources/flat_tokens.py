"""A stream of token ids as one flat binary file, for training jobs that map it into memory.

Every task writes its stretch of the stream at its own place of a file of the full size. The file gets its
name only when the stretches of all tasks are known to cover it without a gap, so a reader sees the whole
stream or none. A task that runs again writes the same bytes to the same place. Places within a file
need a folder that all executors mount; object stores do not have them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from glyphmill.operators.token_stream import TokenStream

DTYPES = {"uint16": np.dtype("<u2"), "uint32": np.dtype("<u4")}
BLOCK = 1 << 16


@dataclass
class _Stretch(WriterCommitMessage):
    """Tokens ``start`` to ``stop`` that a task wrote; the same number twice if it had none."""

    start: int
    stop: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, dtype: str, n_tokens: int, overwrite: bool):
        self.path, self.dtype, self.n_tokens, self.overwrite = path, DTYPES[dtype], n_tokens, overwrite
        self.partial = f"{path}.writing-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Stretch:
        first = last = 0
        # All tasks may be the first to open it; the size makes it as long as the whole stream.
        file = os.open(self.partial, os.O_RDWR | os.O_CREAT, 0o644)
        try:
            for batch in batches:
                starts = batch.column("start_pos").to_pylist()
                for start, tokens in zip(starts, batch.column("tokens")):
                    ids = tokens.values.to_numpy(zero_copy_only=False)
                    if tokens.values.null_count or (len(ids) and not 0 <= ids.min() <= ids.max() <= np.iinfo(self.dtype).max):
                        raise ValueError(f"a token id is missing or does not fit {self.dtype.name}")
                    if last > first and start != last:
                        raise ValueError("the rows of a task do not follow each other")
                    first = first if last > first else start
                    self._put(file, ids.astype(self.dtype).tobytes(), start * self.dtype.itemsize)
                    last = start + len(ids)
            os.fsync(file)
        finally:
            os.close(file)
        return _Stretch(first, last)

    @staticmethod
    def _put(file: int, data: bytes, at: int) -> None:
        while data:
            done = os.pwrite(file, data, at)
            data, at = data[done:], at + done

    def commit(self, messages: list[_Stretch | None]) -> None:
        reached = 0
        for part in sorted((m for m in messages if m and m.stop > m.start), key=lambda m: m.start):
            if part.start != reached:
                raise ValueError(f"tokens from {min(reached, part.start)} on are missing or written twice")
            reached = part.stop
        if reached != self.n_tokens:
            raise ValueError(f"{reached} tokens were written, not {self.n_tokens}")
        if self.overwrite:
            os.replace(self.partial, self.path)
        else:
            os.link(self.partial, self.path)
            os.unlink(self.partial)

    def abort(self, messages: list[_Stretch | None]) -> None:
        if os.path.exists(self.partial):
            os.unlink(self.partial)


@dataclass(frozen=True)
class _Blocks(InputPartition):
    start: int
    stop: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, dtype: str, block: int, per_task: int):
        self.path, self.dtype, self.block, self.per_task = path, DTYPES[dtype], block, per_task

    def partitions(self) -> list[_Blocks]:
        n = os.path.getsize(self.path) // self.dtype.itemsize
        step = self.block * self.per_task
        return [_Blocks(i, min(i + step, n)) for i in range(0, n, step)] or [_Blocks(0, 0)]

    def read(self, part: _Blocks) -> Iterator[pa.RecordBatch]:
        with open(self.path, "rb") as file:
            for start in range(part.start, part.stop, self.block):
                size = min(self.block, part.stop - start)
                data = os.pread(file.fileno(), size * self.dtype.itemsize, start * self.dtype.itemsize)
                ids = pa.array(np.frombuffer(data, self.dtype).astype(np.int64))
                row = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), row], names=["start_pos", "tokens"])


class FlatTokens(DataSource):
    """Format ``flat_tokens``: ``(start_pos, tokens)``. Options ``path``, ``dtype``, ``nTokens`` to write, ``block`` to read."""

    @classmethod
    def name(cls) -> str:
        return "flat_tokens"

    def schema(self) -> str:
        return "start_pos bigint, tokens array<bigint>"

    def reader(self, schema) -> DataSourceReader:
        block = int(self.options.get("block", BLOCK))
        return _Reader(self.options["path"], self.options.get("dtype", "uint16"), block, max(1, (1 << 24) // block))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        dtype, n_tokens = self.options.get("dtype", "uint16"), int(self.options["nTokens"])
        return _Writer(self.options["path"], dtype, n_tokens, overwrite)


def _local(path: str) -> str:
    return os.path.abspath(path.removeprefix("file://").removeprefix("file:"))


def write_flat_tokens(stream: TokenStream, path: str, dtype: str = "uint16", overwrite: bool = False) -> None:
    """Write the stream to one file of little-endian numbers; an existing file stays unless ``overwrite``.

    Blocks are dealt into ranges, so a task writes one stretch. An id that does not fit fails the job, and a
    stream without tokens gives an empty file.
    """
    spark = stream.blocks.sparkSession
    spark.dataSource.register(FlatTokens)
    own = stream.blocks.selectExpr("start_pos", "slice(tokens, 1, n_tokens) AS tokens")
    own = own.repartitionByRange("start_pos").sortWithinPartitions("start_pos")
    options = {"path": _local(path), "dtype": dtype, "nTokens": str(stream.n_tokens)}
    mode = "overwrite" if overwrite else "append"
    own.selectExpr("start_pos", "CAST(tokens AS array<bigint>) AS tokens").write.format("flat_tokens").options(
        **options
    ).mode(mode).save()


def read_flat_tokens(spark: SparkSession, path: str, dtype: str = "uint16", block: int = BLOCK) -> DataFrame:
    """``(start_pos, tokens)``: the stream of a flat file in blocks."""
    spark.dataSource.register(FlatTokens)
    options = {"path": _local(path), "dtype": dtype, "block": str(block)}
    return spark.read.format("flat_tokens").options(**options).load()


def count_flat_tokens(path: str, dtype: str = "uint16") -> int:
    return os.path.getsize(_local(path)) // DTYPES[dtype].itemsize


def flat_windows(starts: DataFrame, path: str, context_length: int, dtype: str = "uint16") -> DataFrame:
    """``(sample_id, start, x, y)``: windows of a flat file, and the same windows one token later.

    Each task reads the places its rows name; nothing is shuffled. A window beyond the file fails the job.
    """
    path, kind = _local(path), DTYPES[dtype]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as file:
            for batch in batches:
                for i in range(0, batch.num_rows, 1024):
                    part = batch.slice(i, 1024)
                    found = np.empty((part.num_rows, context_length + 1), np.int32)
                    for row, start in enumerate(part.column("start").to_pylist()):
                        size = (context_length + 1) * kind.itemsize
                        data = os.pread(file.fileno(), size, start * kind.itemsize) if start >= 0 else b""
                        if len(data) < size:
                            raise ValueError(f"a window from {start} on is not in the file")
                        found[row] = np.frombuffer(data, kind)
                    ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * context_length)
                    lists = [
                        pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(ids).ravel()))
                        for ids in (found[:, :-1], found[:, 1:])
                    ]
                    columns = [part.column("sample_id"), part.column("start"), *lists]
                    yield pa.RecordBatch.from_arrays(columns, names=["sample_id", "start", "x", "y"])

    schema = "sample_id bigint, start bigint, x array<int>, y array<int>"
    return starts.selectExpr("CAST(sample_id AS bigint) AS sample_id", "CAST(start AS bigint) AS start").mapInArrow(read, schema)
