"""Vocabulary and merges files in the published printable form, and parquet tables of the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions.text import byte_display, byte_parse
from glyphmill.schemas import MAX_VOCAB, NAMED_TOKENS, VOCAB
from glyphmill.session import local_table


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``(token_id, token)`` from a JSON object of printable token to id; anything else fails."""
    whole = spark.read.text(path, wholetext=True)
    found = F.from_json("value", "map<string,int>", {"mode": "FAILFAST"})
    checked = F.coalesce(found, F.raise_error(F.lit("not a JSON object of tokens")).cast("map<string,int>"))
    entries = F.explode(checked).alias("shown", "token_id")
    return whole.select(entries).select("token_id", byte_parse(F.col("shown")).alias("token"))


def load_merges(spark: SparkSession, path: str) -> DataFrame:
    """``(rank, left, right)``; the rank follows the lines, and lines that are not pairs are skipped.

    The file is read whole so that the order never depends on how it was split.
    """
    lines = F.filter(
        F.transform(F.split("value", "\r\n|\n|\r"), lambda line: F.split(F.regexp_replace(line, r"(?U)\s+$", ""), " ")),
        lambda parts: F.size(parts) == 2,
    )
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(lines).alias("rank", "parts"))
        .select(
            "rank",
            byte_parse(F.col("parts")[0]).alias("left"),
            byte_parse(F.col("parts")[1]).alias("right"),
        )
    )


def append_specials(vocab: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Give each special token that the vocabulary lacks the next id after the greatest, in list order.

    Only the special tokens found in the vocabulary, and its greatest id, reach the driver.
    """
    wanted = {t.encode(): t for t in specials if t}
    spark = vocab.sparkSession
    named = local_table(spark, list(enumerate(wanted.values())), NAMED_TOKENS).drop("token_id")
    held = vocab.join(F.broadcast(named), F.col("token") == F.encode("t", "UTF-8"), "left_semi")
    found = {bytes(row["token"]) for row in held.collect()}
    size = vocab.agg(F.coalesce(F.max("token_id") + 1, F.lit(0))).first()[0]
    missing = [(size + i, t) for i, t in enumerate(t for t in wanted if t not in found)]
    return vocab.select("token_id", "token").unionByName(local_table(spark, missing, VOCAB))


def write_tokenizer(vocab: DataFrame, merges: DataFrame, folder: str) -> None:
    """Write ``vocab`` and ``merges`` as parquet and as printable text.

    The text files are written by one task each; a vocabulary is as small as its parameter says and at
    most ``MAX_VOCAB``. Two ids of the same bytes have no printable form and are refused.
    """
    if vocab.count() > MAX_VOCAB:
        raise ValueError(f"a tokenizer holds at most {MAX_VOCAB} tokens")
    if not vocab.groupBy("token").count().filter("count > 1").isEmpty():
        raise ValueError("two ids share the same bytes")
    vocab.write.parquet(f"{folder}/vocab")
    merges.write.parquet(f"{folder}/merges")
    shown = vocab.select(byte_display(F.col("token")).alias("shown"), "token_id")
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("shown", "token_id"))))
    shown.agg(F.to_json(entries).alias("value")).coalesce(1).write.text(f"{folder}/vocab.json")
    lines = merges.select(
        "rank",
        F.concat_ws(" ", byte_display(F.col("left")), byte_display(F.col("right"))).alias("value"),
    )
    lines.coalesce(1).sortWithinPartitions("rank").select("value").write.text(f"{folder}/merges.txt")
