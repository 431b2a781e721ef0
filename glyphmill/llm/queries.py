"""One registered query per training-data operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import (
    bpe_codec,
    collocations,
    epsilon_join,
    language_mixture,
    license_scan,
    max_score,
    mixing,
    piece_codec,
    repeated_spans,
    secrets,
    simhash_golay,
    toxicity,
    whitening,
)
from glyphmill.llm.columns import bound_batches, held_out
from glyphmill.sources.corpus import table


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files lie on the driver; executors get what is read from them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document and license notice in it."""
    found = license_scan.scan_licenses(_documents(spark, sf).select("doc_id", "text"))
    matches = found.select("doc_id", F.explode("licenses").alias("match"))
    return matches.select(
        "doc_id",
        F.col("match.template_id").alias("template_id"),
        F.round("match.containment", 6).alias("containment"),
        F.size("match.spans").cast("bigint").alias("n_spans"),
        F.array_join(
            F.transform("match.spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
        ).alias("spans"),
    )


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.mix_plan(_documents(spark, sf))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op3_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan_secrets(_documents(spark, sf).select("doc_id", "text"), out="spans")
    known = F.filter("spans", lambda s: s["kind"] != "random")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.spans_text(known).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op4_repeated_spans(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = repeated_spans.remove_repeats(_documents(spark, sf).select("doc_id", "text"))
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)


def op5_epsilon_join(spark: SparkSession, sf: str) -> DataFrame:
    return epsilon_join.near_vectors(table(spark, sf, "embeddings").select("vec_id", "embedding"))


def op6_max_score(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return max_score.top_k(vectors, F.col("vec_id") % 50 == 0)


def op7_simhash_golay(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("doc_id", "text")
    found = simhash_golay.near_duplicates(docs, keep_text=False)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def op8_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    bound_batches(spark)
    return bpe_codec.coding_digest(_documents(spark, sf), tokenizer_path())


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    bound_batches(spark)
    docs = _documents(spark, sf).select("doc_id", "text")
    model = toxicity.train_toxicity(docs, table(spark, sf, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = language_mixture.train_languages(docs)
    return language_mixture.language_of(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op11_piece_codec(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document with digests of its ids and of their text; NULL counts as empty."""
    bound_batches(spark)
    return piece_codec.piece_digest(_documents(spark, sf), tokenizer_path("piece_bpe_32k.model"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """One row per usable vector and component."""
    return whitening.whitened_components(spark, table(spark, sf, "embeddings").select("vec_id", "embedding"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations.collocations(_documents(spark, sf).select("text", "lang"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_repeated_spans": op4_repeated_spans,
    "op5_epsilon_join": op5_epsilon_join,
    "op6_max_score": op6_max_score,
    "op7_simhash_golay": op7_simhash_golay,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_toxicity": op9_toxicity,
    "op10_language_mixture": op10_language_mixture,
    "op11_piece_codec": op11_piece_codec,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op2_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3] AS weight FROM sums
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight::DOUBLE, source) AS place FROM weighed
), levels AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM ranked WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT coalesce(min_by(level, place), 0) AS level FROM levels WHERE 3 * source_size >= level * weight
), targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, c.level * weight) AS target
  FROM weighed, chosen c
), rated AS (
  SELECT doc_id, size, t.source_size, target,
    CASE WHEN t.source_size > 0 THEN target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('42-' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) * size AS taken
FROM rated
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM pieces
), counted AS (
  SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase, count(*) AS f
  FROM places, (VALUES (1), (2), (3), (4)) AS sizes(k)
  WHERE s + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
), phrases AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS parts FROM counted WHERE f >= 30
), cuts AS (
  SELECT p.lang, p.k, p.phrase, p.f AS a, c AS cut,
    array_to_string(parts[1 : c], ' ') AS head, array_to_string(parts[c + 1 : p.k], ' ') AS rest
  FROM phrases p, (VALUES (1), (2), (3)) AS places(c) WHERE c < p.k
), scored AS (
  SELECT c.*, h.f AS l, t.f AS r, (2000000::HUGEINT * a // (h.f + t.f))::BIGINT AS score
  FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = c.head
    JOIN phrases t ON t.lang = c.lang AND t.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), covered AS (
  SELECT p.lang, array_to_string(parts[s : s + m - 1], ' ') AS phrase, max(f) AS longer
  FROM phrases p, (VALUES (1), (2)) AS places(s), (VALUES (2), (3)) AS sizes(m)
  WHERE m < p.k AND s + m - 1 <= p.k GROUP BY ALL
), spans AS (
  SELECT lang, phrase, max(longer) AS longer FROM (
    SELECT * FROM covered
    UNION ALL
    SELECT lang, array_to_string(parts[3 : 4], ' '), f FROM phrases WHERE k = 4
  ) GROUP BY lang, phrase
), kept AS (
  SELECT l.* FROM lowest l LEFT JOIN spans s ON s.lang = l.lang AND s.phrase = l.phrase
  WHERE s.longer IS NULL OR 100 * s.longer < 80 * l.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, rank, phrase, a, l, r, n, score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
""",
}
