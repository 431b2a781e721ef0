"""Reading corpora: delimited text files and parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions.text import END_OF_TEXT, drop_invalid_utf8


def corpus_scan(
    spark: SparkSession, path: str, delimiter: str = END_OF_TEXT, partitions: int | None = None
) -> DataFrame:
    """``(text)``, one row per document of text files divided by ``delimiter``.

    Files are read in splits that end at a delimiter, so one file of any size is read by many tasks.
    A compressed file cannot be split; ``partitions`` spreads its documents after the read.
    Byte sequences that are not UTF-8 are left out.
    """
    docs = spark.read.option("lineSep", delimiter).text(path)
    if partitions:
        docs = docs.repartition(partitions)
    return docs.select(drop_invalid_utf8(F.col("value")).alias("text"))


def write_corpus(docs: DataFrame, path: str, text: str = "text", delimiter: str = END_OF_TEXT) -> None:
    """Write documents as text files, each followed by ``delimiter``; a text that holds it fails the job."""
    holds = F.raise_error(F.lit("a text holds the delimiter")).cast("string")
    checked = F.when(F.contains(F.col(text), F.lit(delimiter)), holds).otherwise(F.col(text))
    docs.select(checked.alias("value")).write.option("lineSep", delimiter).text(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer splits than there are cores.

    A large table has many splits and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
