"""Committed steps of iterative jobs: parquet folders that are complete or not there at all.

A step is a folder ``step=N`` with one sub-folder per table. The marker table is written last, and
only a step whose marker was committed counts, so a job that died while writing leaves no half step.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.schemas import COMMITTED
from glyphmill.session import local_table, new_path

_MARKER = "committed"


def new_run(spark: SparkSession, name: str) -> str:
    return new_path(spark, name)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    fs, location = _files(spark, path)
    return [str(entry.getPath()) for entry in fs.listStatus(location)] if fs.exists(location) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, location = _files(spark, path)
    fs.delete(location, True)


def committed_steps(spark: SparkSession, run_dir: str) -> list[int]:
    fs, location = _files(spark, run_dir)
    if not fs.exists(location):
        return []
    steps = []
    for entry in fs.listStatus(location):
        match = re.fullmatch(r"step=(\d+)", entry.getPath().getName())
        if match and fs.exists(_files(spark, f"{run_dir}/{match[0]}/{_MARKER}/_SUCCESS")[1]):
            steps.append(int(match[1]))
    return sorted(steps)


def latest_step(spark: SparkSession, run_dir: str) -> int | None:
    steps = committed_steps(spark, run_dir)
    return steps[-1] if steps else None


def fingerprint(rows: DataFrame, *settings: object) -> str:
    """A text that tells inputs and settings apart: settings, row count and a sum of row digests."""
    digest = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))
    count, total = rows.agg(F.count(F.lit(1)), digest).first()
    return f"{settings} {count} {total}"


def save_step(spark: SparkSession, run_dir: str, step: int, fingerprint: str = "", **tables: DataFrame) -> None:
    """Write the tables of one step, then its marker with the step number, table names and fingerprint.

    Of the steps committed before, the last one stays, so that a reader of it can end; older ones go.
    """
    folder = f"{run_dir}/step={step}"
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
    marker = local_table(spark, [(step, sorted(tables), fingerprint)], COMMITTED)
    marker.write.mode("overwrite").parquet(f"{folder}/{_MARKER}")
    for old in committed_steps(spark, run_dir)[:-2]:
        remove(spark, f"{run_dir}/step={old}")


def load_step(spark: SparkSession, run_dir: str, step: int, fingerprint: str | None = None) -> dict[str, DataFrame]:
    """Tables of a step; a step that was made from another input or other settings is refused."""
    folder = f"{run_dir}/step={step}"
    marker = spark.read.parquet(f"{folder}/{_MARKER}").first()
    if fingerprint is not None and marker["fingerprint"] != fingerprint:
        raise ValueError(f"{run_dir} holds a run over another input or with other settings")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in marker["tables"]}
