"""Encoding and counting documents as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from glyphmill.operators.codec import encode_corpus
from glyphmill.operators.counts import pretoken_counts
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.schemas import DOCUMENTS
from glyphmill.streaming.compaction import RunningSums

# Fixed value: the class name of Spark's disk-backed state store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def document_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = DOCUMENTS,
    files: str | None = "*.parquet",
    files_per_batch: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Stream of whole documents from parquet files; the unit is never a piece of a text.

    ``folder`` may be a pattern that finds folders and files. ``files`` is a pattern the names of the files
    must match; None takes all, as a read of the folder does.
    ``tasks`` spreads the documents of a batch when they arrive in fewer files than there are cores.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    docs = reader.parquet(folder)
    return docs.repartition(tasks) if tasks else docs


def stream_encode(
    docs: DataFrame, tokenizer: Tokenizer, out: str, checkpoint: str, columns: Sequence[str], text: str = "text"
) -> StreamingQuery:
    """Encode what has arrived and append ``columns`` and ``ids`` to parquet files in ``out``.

    Encoding has no state, so the file sink's log gives each document exactly once over restarts.
    """
    encoded = encode_corpus(docs.select(*dict.fromkeys([*columns, text])), tokenizer, text)
    return (
        encoded.select(*columns, "ids")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _counts(out: str) -> RunningSums:
    return RunningSums(out, ("pretoken",), "cnt")


def stream_pretoken_counts(
    docs: DataFrame, out: str, checkpoint: str, text: str = "text", specials: Sequence[str] = ()
) -> StreamingQuery:
    """Keep pre-token counts current in ``out``; each batch adds its own counts as a run.

    Rows are counted per task before the shuffle. Runs are merged as they grow, so reading costs less than
    twice the number of distinct pre-tokens, whatever the number of batches. A batch that runs again after a
    failure replaces its own run.
    """

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        _counts(out).add(pretoken_counts(batch, text, specials), batch_id)

    return (
        docs.writeStream.foreachBatch(add_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """``(pretoken, cnt)`` of all batches committed so far."""
    return _counts(out).current(spark)
