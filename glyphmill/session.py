"""Session construction and the shared scratch folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Bytes of an Arrow batch, of which a task has a few on both sides; Spark's own 64 MB make some hundred of them.
BATCH_BYTES, BYTES_SETTING = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app_name: str = "glyphmill", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitter's settings are used."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a local run without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="glyphmill-", dir="/tmp"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def bound_batch_bytes(spark: SparkSession) -> None:
    """Let Arrow batches of the session have about ``BATCH_BYTES`` at most; a bound that is set stays."""
    if spark.conf.get(BYTES_SETTING, None) is None:
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def write_table(df: DataFrame, name: str, **options: int) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later jobs never recompute it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Table of a few rows the driver holds, as one partition of a local relation."""
    columns = [pa.array([row[i] for row in rows]) for i in range(len(schema))]
    table = pa.Table.from_arrays(columns, names=schema.names)
    return spark.createDataFrame(table, schema).coalesce(1)
