"""Packing documents into one stream of token ids, and drawing training windows from it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.session import write_table


@dataclass(frozen=True)
class TokenStream:
    """``blocks`` is ``(block_id, start_pos, n_tokens, tokens)``.

    A block owns ``n_tokens`` positions from ``start_pos`` on; ``tokens`` also holds up to
    ``overlap`` tokens that follow them.
    """

    blocks: DataFrame
    n_tokens: int
    block_size: int
    overlap: int


def _running(doc_id: str):
    """Adds to rows sorted by ``doc_id`` their task and the tokens before them in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(doc_id)
            if names.null_count:
                raise ValueError("a document has no id")
            if (last is not None and names[0].as_py() == last) or len(names.unique()) < len(names):
                raise ValueError("a document id repeats")
            last = names[-1].as_py()
            n = batch.column("n").to_numpy()
            inside = before + np.cumsum(n) - n
            before += int(n.sum())
            columns = [*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(inside)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "inside"])

    return run


def placed_documents(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", extra: int = 0) -> DataFrame:
    """``(doc_id, ids, n, offset)``: the id arrays and where each document starts in the stream.

    The documents are dealt into ranges of ``doc_id`` once, each task adds up its own range, and the
    ranges are written so that they are the same in every later job. Only their totals, one row per
    task, are added up in one place. A NULL or repeated ``doc_id`` fails the job.
    """
    kept = encoded.filter(F.col(ids).isNotNull()).select(doc_id, ids, (F.size(ids) + extra).cast("bigint").alias("n"))
    # Finding the ranges reads the rows once more than dealing them out, so they are encoded before.
    kept = write_table(kept, "encoded")
    ranged = kept.repartitionByRange(doc_id).sortWithinPartitions(doc_id)
    schema = T.StructType([*kept.schema, T.StructField("part", T.IntegerType()), T.StructField("inside", T.LongType())])
    ranged = write_table(ranged.mapInArrow(_running(doc_id), schema), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return ranged.join(F.broadcast(bases), "part").select(
        doc_id, ids, "n", (F.col("base") + F.col("inside")).alias("offset")
    )


def document_offsets(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", extra: int = 0) -> DataFrame:
    """``(doc_id, n, offset)``: where each document starts in the stream ordered by ``doc_id``."""
    return placed_documents(encoded, doc_id, ids, extra).drop(ids)


def token_stream(
    encoded: DataFrame,
    block_size: int,
    overlap: int = 0,
    separator_id: int | None = None,
    doc_id: str = "doc_id",
    ids: str = "ids",
) -> TokenStream:
    """Concatenate the id arrays of all documents in ``doc_id`` order and cut them into blocks.

    With ``separator_id`` that token ends every document. ``doc_id`` must be unique and not NULL. The
    id arrays are dealt into ranges and then to their blocks, and a block never holds more than
    ``block_size + overlap`` tokens. The blocks are written once.
    """
    extra = 0 if separator_id is None else 1
    placed = placed_documents(encoded, doc_id, ids, extra).filter("n > 0")
    whole = F.col(ids) if separator_id is None else F.concat(F.col(ids), F.array(F.lit(separator_id)))

    def piece(block: Column) -> Column:
        first = F.greatest(block * block_size - F.col("offset"), F.lit(0))
        last = F.least((block + 1) * block_size + overlap - F.col("offset"), F.col("n"))
        return F.struct(
            block.alias("block_id"),
            (F.col("offset") + first).alias("pos"),
            F.slice(F.col("whole"), (first + 1).cast("int"), (last - first).cast("int")).alias("tokens"),
        )

    first_block = F.greatest(F.call_function("div", F.col("offset") - overlap, F.lit(block_size)), F.lit(0))
    last_block = F.call_function("div", F.col("offset") + F.col("n") - 1, F.lit(block_size))
    pieces = placed.select("offset", "n", whole.alias("whole")).select(
        F.inline(F.transform(F.sequence(first_block, last_block), piece))
    )
    in_order = F.sort_array(F.collect_list(F.struct("pos", "tokens")))
    blocks = (
        pieces.groupBy("block_id")
        .agg(F.flatten(F.transform(in_order, lambda p: p["tokens"])).alias("tokens"))
        .select(
            "block_id",
            (F.col("block_id") * block_size).alias("start_pos"),
            F.least(F.size("tokens"), F.lit(block_size)).alias("n_tokens"),
            "tokens",
        )
    )
    blocks = write_table(blocks, "stream-blocks")
    n_tokens = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    return TokenStream(blocks, n_tokens, block_size, overlap)


def window_starts(
    spark: SparkSession, n_tokens: int, context_length: int, n_samples: int, seed: int
) -> DataFrame:
    """``(sample_id, start)``: uniform starts ``0 .. n_tokens - context_length - 1``.

    They come from a digest of seed and sample number, so a task that runs again draws the same ones.
    """
    choices = n_tokens - context_length
    if choices < 1:
        raise ValueError("the stream is not longer than one context")
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col("id").cast("string")).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return spark.range(n_samples).select(F.col("id").alias("sample_id"), (draw % choices).alias("start"))


def context_windows(stream: TokenStream, context_length: int, n_samples: int, seed: int = 0) -> DataFrame:
    """``(sample_id, start, x, y)``: sampled windows and the same windows one token later.

    A block carries enough of its successor for every window that starts in it, so one join on the
    block suffices.
    """
    if stream.overlap < context_length:
        raise ValueError("blocks must overlap by the context length")
    starts = window_starts(
        stream.blocks.sparkSession, stream.n_tokens, context_length, n_samples, seed
    ).withColumn("block_id", F.call_function("div", F.col("start"), F.lit(stream.block_size)))
    inside = (F.col("start") - F.col("start_pos")).cast("int")
    return starts.join(stream.blocks, "block_id").select(
        "sample_id",
        "start",
        F.slice("tokens", inside + 1, F.lit(context_length)).alias("x"),
        F.slice("tokens", inside + 2, F.lit(context_length)).alias("y"),
    )


def start_uniformity(starts: DataFrame, n_starts: int, n_samples: int, n_bins: int | None = None) -> DataFrame:
    """Histogram of sampled starts with the bounds mean -/+ 5 standard deviations of each bin.

    ``(bin, cnt, low, high, inside)``; by default every start is its own bin.
    """
    spark = starts.sparkSession
    width = -(-n_starts // (n_bins or n_starts))
    counts = starts.groupBy(F.call_function("div", F.col("start"), F.lit(width)).alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    share = F.least(F.lit(width), F.lit(n_starts) - F.col("bin") * width) / F.lit(float(n_starts))
    mean, spread = n_samples * share, 5 * F.sqrt(n_samples * share * (1 - share))
    return (
        spark.range(-(-n_starts // width))
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            F.coalesce("cnt", F.lit(0)).alias("cnt"),
            (mean - spread).alias("low"),
            (mean + spread).alias("high"),
        )
        .withColumn("inside", F.col("cnt").between(F.col("low"), F.col("high")))
    )
