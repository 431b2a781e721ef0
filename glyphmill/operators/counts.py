"""Pre-token and symbol-pair counting, the inputs of merge training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.text import byte_symbols, pretokens, symbol_array


def pretoken_counts(
    docs: DataFrame, text: str = "text", specials: Sequence[str] = ()
) -> DataFrame:
    """``(pretoken, cnt)`` over all documents; special tokens cut the text and are not counted.

    Partial aggregation before the shuffle leaves one row per pre-token and task, so a word that
    fills the corpus is not a hot key.
    """
    return (
        docs.select(F.explode(pretokens(F.col(text), specials, keep_specials=False)).alias("pretoken"))
        .groupBy("pretoken")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def byte_histogram(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(byte, cnt)``: how often each byte value occurs in the UTF-8 form of the texts.

    Every character lies in exactly one pre-token, so bytes are counted in the distinct pre-tokens
    and weighted, which spares expanding whole texts.
    """
    return (
        words_of(pretoken_counts(docs, text))
        .select(F.explode(symbol_array(F.col("sym"))).alias("h"), "cnt")
        .filter("h <> ''")
        .groupBy("h")
        .agg(F.sum("cnt").alias("cnt"))
        .select(F.conv("h", 16, 10).cast("int").alias("byte"), "cnt")
    )


def words_of(counts: DataFrame) -> DataFrame:
    """Training words ``(sym, cnt)`` at byte level."""
    return counts.select(byte_symbols(F.col("pretoken")).alias("sym"), "cnt")


def adjacent(words: DataFrame, *names: str) -> DataFrame:
    """One row per run of neighbouring symbols, in columns ``names``, with the word's ``cnt``.

    Overlapping runs all count. The symbols are split once per word, in a projection of their own.
    """
    runs = f"greatest(size(parts) - {len(names)}, 0)"
    slices = ", ".join(f"slice(parts, {i + 1}, {runs})" for i in range(len(names)))
    return words.sparkSession.sql(
        f"""
        SELECT inline(arrays_zip({slices})) AS ({", ".join(names)}), cnt
        FROM (SELECT split(replace(sym, '<', ''), '>') AS parts, cnt FROM {{words}})
        """,
        words=words,
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """``(l, r, n)``: weighted count of neighbouring symbols inside words."""
    return adjacent(words, "l", "r").groupBy("l", "r").agg(F.sum("cnt").alias("n"))


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent pairs; equal counts are ordered by greater left, then right bytes."""
    return pairs.orderBy(F.desc("n"), F.desc("l"), F.desc("r")).limit(k)


def merge_symbols(sym: Column, left: Column, right: Column) -> Column:
    """Join every non-overlapping occurrence of the pair, left to right."""
    return F.replace(
        sym,
        F.concat(F.lit("<"), left, F.lit("><"), right, F.lit(">")),
        F.concat(F.lit("<"), left, right, F.lit(">")),
    )


def fold_replacements(sym: Column, replacements: Column) -> Column:
    """Apply an array of ``struct(old, new)`` replacements one after the other."""
    return F.aggregate(replacements, sym, lambda acc, m: F.replace(acc, m["old"], m["new"]))
