"""A corpus pipeline: toxicity, near-duplicates, secrets, mixing and tokens, one stage after another.

Rows with a NULL or empty text pass all stages as texts without words: they are not toxic, all of them are one
group of near-duplicates, hold no secret, take no words of the mix and have no tokens. A NULL id, language or
source is a value like any other. Repeated rows are judged alike. Further columns stay, whatever their names,
and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import bpe_codec, mixing, secrets, simhash_golay, toxicity
from glyphmill.llm.columns import bound_batches, own_name
from glyphmill.llm.queries import tokenizer_path
from glyphmill.session import write_table
from glyphmill.sources.corpus import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half, with their columns."""
    bound_batches(spark)
    score = own_name(docs, "score")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, out=score).filter(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    bound_batches(spark)
    return simhash_golay.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a placeholder."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns of the documents with the token ids of the text, and whether they decode to it again."""
    bound_batches(spark)
    decoded, path = own_name(docs, "decoded"), tokenizer_path()
    coded = bpe_codec.decode(bpe_codec.encode(docs, path, out="ids"), path, "ids", decoded)
    same = F.col(decoded) == F.coalesce(F.col("text"), F.lit(""))
    return coded.withColumn("round_trip", same).drop(decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("bpe_codec", encode_texts),
]

# Models, fingerprint groups and tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
