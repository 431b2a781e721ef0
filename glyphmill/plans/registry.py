"""The registered queries: each reads whole tables of a folder and returns one DataFrame.

Floats are rounded and byte strings shown as hex so that results compare across engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glyphmill.functions import schedule, text, vector
from glyphmill.operators import bpe, codec, counts, diff, digest_tree, fit, metrics, parameter_table, tiled_vote, tiles, token_stream, vectors
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.schemas import DOCUMENTS
from glyphmill.session import new_path, write_table
from glyphmill.sources import corpus, delimited, flat_tokens, tokenizer_files
from glyphmill.streaming import live, pieces

# Parameters shared with the oracle SQL.
N_MERGES = 16
SPECIALS = (text.END_OF_TEXT,)
TURN_SPECIALS = ("<|user|>", "<|assistant|>", "<|system|>", "<|endoftext|>", "<|endoftext|><|endoftext|>")
BLOCK_SIZE = 1024
CONTEXT = 32
TOKENS_PER_SAMPLE = 64
SEED = 7
# Small enough that the files of a small corpus are read in several ranges.
RANGE_BYTES = 1 << 20
FIT = fit.Settings(steps=6, max_rate=0.05, min_rate=0.005, warmup=2, cycle=5, max_norm=0.5)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return corpus.table(spark, sf, name)


def _documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _table(spark, sf, "documents").select(*columns)


def _texts(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents for jobs that work through every text."""
    return corpus.spread(_documents(spark, sf, *columns))


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return counts.words_of(counts.pretoken_counts(_texts(spark, sf, "text")))


def _trained(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    size = 256 + len(SPECIALS) + N_MERGES
    return bpe.train_bpe(_texts(spark, sf, "text"), size, SPECIALS)


def _tokenizer(spark: SparkSession, sf: str) -> Tokenizer:
    return Tokenizer.from_tables(*_trained(spark, sf), SPECIALS)


def _shown_ids(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"),
    )


def _rounded(column: str, places: int = 4):
    # Adding zero turns -0.0 into 0.0.
    return (F.round(column, places) + 0.0).alias(column)


# Sources and sinks


def corpus_split(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "corpus")
    corpus.write_corpus(_documents(spark, sf, "text"), path)
    docs = corpus.corpus_scan(spark, path)
    return docs.groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )


def corpus_ranges(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "blocked-corpus")
    delimited.write_blocked(_documents(spark, sf, "text"), path)
    docs = delimited.read_ranges(spark, path, split=RANGE_BYTES)
    return docs.groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )


def _written(spark: SparkSession, sf: str) -> str:
    folder = new_path(spark, "tokenizer")
    tokenizer_files.write_tokenizer(*_trained(spark, sf), folder)
    return folder


def _shown_vocab(vocab: DataFrame) -> DataFrame:
    return vocab.select("token_id", F.hex("token").alias("token"))


def vocab_load(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_vocab(tokenizer_files.load_vocab(spark, f"{_written(spark, sf)}/vocab.json"))


def merges_load(spark: SparkSession, sf: str) -> DataFrame:
    merges = tokenizer_files.load_merges(spark, f"{_written(spark, sf)}/merges.txt")
    return merges.select("rank", F.hex("left").alias("left"), F.hex("right").alias("right"))


def vocab_specials(spark: SparkSession, sf: str) -> DataFrame:
    vocab = tokenizer_files.load_vocab(spark, f"{_written(spark, sf)}/vocab.json")
    return _shown_vocab(tokenizer_files.append_specials(vocab, [*SPECIALS, "<|pad|>"]))


def _stream(spark: SparkSession, sf: str, overlap: int) -> token_stream.TokenStream:
    encoded = codec.encode_corpus(_texts(spark, sf, "doc_id", "text"), _tokenizer(spark, sf))
    return token_stream.token_stream(encoded, BLOCK_SIZE, overlap, separator_id=0)


def token_stream_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, 0).blocks.select(
        "block_id",
        "start_pos",
        "n_tokens",
        F.array_join(F.col("tokens").cast("array<string>"), " ").alias("tokens"),
    )


# Projections


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as chat text, the role and the end of the turn marked by special tokens."""
    planted = F.concat(
        F.lit("<|"), "role", F.lit("|>"), "text", F.lit("\n\n<|endoftext|><|endoftext|>")
    )
    return _table(spark, sf, "conversations").select("conv_id", "turn", planted.alias("text"))


def special_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = text.special_split(F.col("text"), TURN_SPECIALS)
    return _turns(spark, sf).select("conv_id", "turn", F.posexplode(parts).alias("pos", "segment")).withColumn(
        "is_special", F.col("segment").isin(list(TURN_SPECIALS))
    )


def special_split_many(spark: SparkSession, sf: str) -> DataFrame:
    """Turns between tokens of their number, of which there are a thousand, and of the next one."""
    names = [f"<|turn {i}|>" for i in range(1000)] + [f"<|turn {i}|><|turn {i + 1}|>" for i in range(1000)]
    number = F.concat(F.lit("<|turn "), F.col("turn").cast("string"), F.lit("|>"))
    following = F.concat(F.lit("<|turn "), (F.col("turn") + 1).cast("string"), F.lit("|>"))
    turns = _table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(number, "text", number, following, F.lit("<|turn x|>")).alias("text")
    )
    parts = text.special_split(F.col("text"), names)
    return turns.select("conv_id", "turn", F.posexplode(parts).alias("pos", "segment"))


def pretoken_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.pretoken_counts(_texts(spark, sf, "text"))


def byte_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return counts.byte_histogram(_texts(spark, sf, "text"))


def byte_display(spark: SparkSession, sf: str) -> DataFrame:
    return pretoken_counts(spark, sf).select(
        text.byte_display(F.encode("pretoken", "UTF-8")).alias("shown"), "cnt"
    )


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))


def silu_features(spark: SparkSession, sf: str) -> DataFrame:
    values = vector.silu_vector(F.col("embedding"))
    return _embeddings(spark, sf).select("vec_id", F.posexplode(values).alias("idx", "value")).select(
        "vec_id", "idx", _rounded("value")
    )


def rms_normalise(spark: SparkSession, sf: str) -> DataFrame:
    rows = _embeddings(spark, sf)
    # One gain per feature: the mean size of the feature over the table.
    gains = (
        rows.select(F.posexplode("embedding").alias("idx", "v")).groupBy("idx").agg(F.avg(F.abs("v")).alias("g"))
    )
    gain = vector.constant_vector([r["g"] for r in sorted(gains.collect())])
    values = vector.rms_normalise(F.col("embedding"), gain)
    return rows.select("vec_id", F.posexplode(values).alias("idx", "value")).select(
        "vec_id", "idx", _rounded("value")
    )


# Lookups and products


def encode_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_ids(codec.encode_corpus(_texts(spark, sf, "doc_id", "text"), _tokenizer(spark, sf)))


def encode_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """Turns with special tokens in their text, encoded by a tokenizer that went through its files."""
    folder = _written(spark, sf)
    vocab = tokenizer_files.load_vocab(spark, f"{folder}/vocab.json")
    merges = tokenizer_files.load_merges(spark, f"{folder}/merges.txt")
    model = Tokenizer.from_tables(tokenizer_files.append_specials(vocab, TURN_SPECIALS), merges, TURN_SPECIALS)
    encoded = codec.encode_corpus(_turns(spark, sf), model)
    shown = F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids")
    return encoded.select("conv_id", "turn", F.size("ids").alias("n_tokens"), shown)


def decode_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    model = _tokenizer(spark, sf)
    encoded = codec.encode_corpus(_texts(spark, sf, "doc_id", "text"), model).drop("text")
    return codec.decode_corpus(encoded, model).select("doc_id", F.size("ids").alias("n_tokens"), "decoded")


def embedding_lookup(spark: SparkSession, sf: str) -> DataFrame:
    encoded = codec.encode_corpus(_texts(spark, sf, "doc_id", "text"), _tokenizer(spark, sf))
    means = vectors.mean_vectors(encoded, _embeddings(spark, sf), "doc_id", "ids", "vec_id", "embedding")
    return means.select("doc_id", "idx", _rounded("mean"))


def token_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vector of every token of the documents that has one, as a digest per document and position."""
    encoded = codec.encode_corpus(_texts(spark, sf, "doc_id", "text"), _tokenizer(spark, sf)).select("doc_id", "ids")
    tokens = write_table(encoded, "encoded").select("doc_id", F.posexplode("ids").alias("pos", "token"))
    table = _table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("vec_id"), "embedding")
    found = vectors.embedding_lookup(tokens, table, "token", "vec_id")
    return found.groupBy("doc_id", "token").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("pos").alias("pos_sum"),
        (F.round(F.max(F.get("embedding", 0).cast("double")), 4) + 0.0).alias("first"),
        (F.round(F.min(F.get("embedding", 63).cast("double")), 4) + 0.0).alias("last"),
    )


def _centroids(spark: SparkSession, sf: str) -> DataFrame:
    means = (
        _embeddings(spark, sf)
        .select("label", F.posexplode("embedding").alias("idx", "v"))
        .groupBy("label", "idx")
        .agg(F.avg("v").alias("v"))
    )
    in_order = F.sort_array(F.collect_list(F.struct("idx", "v")))
    return means.groupBy("label").agg(F.transform(in_order, lambda p: p["v"]).alias("centroid"))


def project_vectors(spark: SparkSession, sf: str) -> DataFrame:
    y = vectors.project_vectors(
        _embeddings(spark, sf).select("vec_id", "embedding"),
        _centroids(spark, sf),
        "vec_id",
        "embedding",
        "label",
        "centroid",
    )
    return y.select("vec_id", "label", _rounded("value"))


def linear_map(spark: SparkSession, sf: str) -> DataFrame:
    """All embeddings through the map whose rows are all embeddings: the outputs of each, summed up."""
    rows = _table(spark, sf, "embeddings")
    parts = tiles.matrix_product(rows, rows, "vec_id", "embedding", "vec_id", "embedding").sums
    sums = parts.groupBy(F.col("key").alias("vec_id")).agg(
        F.sum("n").alias("n_outputs"), F.sum("total").alias("total"), F.max("largest").alias("largest")
    )
    return sums.select("vec_id", "n_outputs", _rounded("total", 3), _rounded("largest"))


def context_windows(spark: SparkSession, sf: str) -> DataFrame:
    stream = _stream(spark, sf, CONTEXT)
    windows = token_stream.context_windows(stream, CONTEXT, stream.n_tokens // TOKENS_PER_SAMPLE, SEED)
    return _shown_windows(windows)


def flat_token_windows(spark: SparkSession, sf: str) -> DataFrame:
    stream, path = _stream(spark, sf, 0), new_path(spark, "flat-tokens")
    flat_tokens.write_flat_tokens(stream, path)
    n = flat_tokens.count_flat_tokens(path)
    starts = token_stream.window_starts(spark, n, CONTEXT, n // TOKENS_PER_SAMPLE, SEED)
    return _shown_windows(flat_tokens.flat_windows(starts, path, CONTEXT))


def _shown_windows(windows: DataFrame) -> DataFrame:
    return windows.select(
        "sample_id",
        "start",
        *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("x", "y")],
    )


def soft_neighbour_vote(spark: SparkSession, sf: str) -> DataFrame:
    keys = _embeddings(spark, sf)
    classes = F.sequence(F.lit(0), F.lit(keys.agg(F.max("label")).first()[0]))
    one_hot = F.transform(classes, lambda c: F.when(c == F.col("label"), 1.0).otherwise(0.0))
    votes = vectors.soft_neighbour_vote(
        _centroids(spark, sf),
        keys.withColumn("vote", one_hot),
        "label",
        "centroid",
        "embedding",
        "vote",
        query_group="label",
        key_group="label",
        keep="different",
    )
    return votes.select("label", "idx", _rounded("weight"))


def masked_vote(spark: SparkSession, sf: str) -> DataFrame:
    """Class weights of every centroid by the embeddings that a table of pairs lets it see: those that lie on
    its side of the first component."""
    keys, centroids = _embeddings(spark, sf), _centroids(spark, sf)
    classes = F.sequence(F.lit(0), F.lit(keys.agg(F.max("label")).first()[0]))
    one_hot = F.transform(classes, lambda c: F.when(c == F.col("label"), 1.0).otherwise(0.0))
    signs = centroids.select("label", (F.get("centroid", 0) > 0).alias("side"))
    mask = signs.join(keys.select("vec_id", (F.get("embedding", 0) > 0).alias("side")), "side").select("label", "vec_id")
    votes = tiled_vote.tiled_neighbour_vote(
        centroids, keys.withColumn("vote", one_hot), "label", "centroid", "vec_id", "embedding", "vote", mask
    )
    return votes.select("label", F.posexplode("weights").alias("idx", "weight")).select("label", "idx", _rounded("weight"))


def table_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled quality against a guess from the length of the text."""
    guess = _documents(spark, sf, "doc_id", "n_chars").select(
        "doc_id", F.when(F.col("n_chars") > 200, 1.0).otherwise(0.0).alias("quality")
    )
    labels = _table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return diff.table_diff(guess, labels, "doc_id", "quality")


def _docs_and_copy(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents, and a copy with a longer count, another source and lower-cased texts."""
    docs = _documents(spark, sf, "doc_id", "text", "source", "n_chars").withColumn("text", F.encode("text", "UTF-8"))
    changed = docs.filter("doc_id % 7 <> 0").select(
        "doc_id",
        F.encode(F.lower(F.decode("text", "UTF-8")), "UTF-8").alias("text"),
        F.when(F.col("doc_id") % 5 == 0, "src0").otherwise(F.col("source")).alias("source"),
        (F.col("n_chars") + F.when(F.col("doc_id") % 3 == 0, 9007199254740993).otherwise(0)).alias("n_chars"),
    )
    return docs, changed


def _with_digests(found: DataFrame) -> DataFrame:
    digests = [F.when(F.col("column") == "text", F.md5(c)).otherwise(F.col(c)).alias(c) for c in ("actual", "expected")]
    return found.select("column", "key", "idx", "kind", *digests)


def table_diff_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against a changed copy."""
    docs, changed = _docs_and_copy(spark, sf)
    return _with_digests(diff.tables_diff(changed, docs, "doc_id", ["n_chars", "source", "text"], exact=True))


def table_diff_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against a changed copy, by their trees of digests."""
    docs, changed = _docs_and_copy(spark, sf)
    trees = [digest_tree.digest_tree(side, "doc_id", ["n_chars", "source", "text"]) for side in (changed, docs)]
    return _with_digests(digest_tree.trees_diff(changed, docs, *trees))


# Aggregations


def pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.pair_counts(_words(spark, sf))


def top_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return counts.top_pairs(pair_counts(spark, sf), 50)


def bpe_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_vocab(_trained(spark, sf)[0])


def group_softmax(spark: SparkSession, sf: str) -> DataFrame:
    scored = _documents(spark, sf, "doc_id", "lang", "n_chars").select(
        "doc_id", "lang", (4 * F.log("n_chars")).alias("score")
    )
    return metrics.group_softmax(scored, ["lang"], "score").select("doc_id", "lang", _rounded("p", 6))


def array_softmax(spark: SparkSession, sf: str) -> DataFrame:
    """Softmax along every embedding."""
    p = vector.softmax_vector(F.col("embedding"))
    return _embeddings(spark, sf).select("vec_id", F.posexplode(p).alias("idx", "p")).select("vec_id", "idx", _rounded("p", 6))


def clip_all_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """All components of all embeddings as the gradients of one model."""
    grads = _embeddings(spark, sf).select("vec_id", F.posexplode("embedding").alias("idx", "grad"))
    return metrics.clip_global_norm(grads, 1.0).select("vec_id", "idx", _rounded("clipped", 6))


def cross_entropy(spark: SparkSession, sf: str) -> DataFrame:
    losses = metrics.cross_entropy(_embeddings(spark, sf), "embedding", "label", ["label"])
    return losses.select("label", _rounded("loss"), "n_rows")


def clip_global_norm(spark: SparkSession, sf: str) -> DataFrame:
    """Signed log lengths as gradients; a document without a label is a frozen parameter."""
    docs = _documents(spark, sf, "doc_id", "lang", "n_chars")
    labels = _table(spark, sf, "labels").select("doc_id", "quality")
    grads = docs.join(labels, "doc_id", "left").withColumn(
        "grad", (2 * F.col("quality") - 1) * F.log("n_chars")
    )
    return metrics.clip_global_norm(grads, 1.0, ["lang"]).select("doc_id", "lang", _rounded("clipped", 6))


def roundtrip_audit(spark: SparkSession, sf: str) -> DataFrame:
    return codec.roundtrip_audit(_texts(spark, sf, "lang", "text"), _tokenizer(spark, sf), "lang")


def start_uniformity(spark: SparkSession, sf: str) -> DataFrame:
    """Starts over the documents at byte level, 32 per document."""
    n_docs, n_tokens = (
        _documents(spark, sf, "text").agg(F.count("text"), F.sum(F.octet_length("text"))).first()
    )
    starts = token_stream.window_starts(spark, n_tokens, CONTEXT, 32 * n_docs, SEED)
    bins = token_stream.start_uniformity(starts, n_tokens - CONTEXT, 32 * n_docs, 64)
    return bins.select("bin", "cnt", _rounded("low"), _rounded("high"), "inside")


# Iterative jobs


def bpe_merges(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(spark, sf)[1].select("rank", F.hex("left").alias("left"), F.hex("right").alias("right"), "n")


def apply_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Training words after the best first merge."""
    words = write_table(_words(spark, sf), "words")
    best = counts.top_pairs(counts.pair_counts(words), 1).first()
    return words.select(
        counts.merge_symbols(F.col("sym"), F.lit(best["l"]), F.lit(best["r"])).alias("sym"), "cnt"
    )


def _trace(spark: SparkSession, model: fit.Model) -> DataFrame:
    return fit.trace_table(spark, model).select(
        "step", _rounded("rate", 6), _rounded("loss", 6), _rounded("grad_norm", 6)
    )


def _n_classes(rows: DataFrame) -> int:
    return rows.agg(F.max("label")).first()[0] + 1


def fit_softmax_regression(spark: SparkSession, sf: str) -> DataFrame:
    rows = _embeddings(spark, sf)
    return _trace(spark, fit.fit_softmax_regression(rows, "embedding", "label", _n_classes(rows), FIT))


def fit_parameter_table(spark: SparkSession, sf: str) -> DataFrame:
    """The fit with its parameters in a table of four pieces."""
    rows = _embeddings(spark, sf)
    model = parameter_table.fit_parameter_table(rows, "embedding", "label", _n_classes(rows), FIT, tile_width=16)
    return parameter_table.trace_table(spark, model).select(
        "step", _rounded("rate", 6), _rounded("loss", 6), _rounded("grad_norm", 6)
    )


def checkpoint_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The same fit stopped half-way and resumed from its last committed step."""
    rows = _embeddings(spark, sf)
    run_dir = new_path(spark, "fit")
    for steps in (FIT.steps // 2, FIT.steps):
        settings = fit.Settings(**{**FIT.__dict__, "steps": steps, "save_every": 3})
        model = fit.fit_softmax_regression(rows, "embedding", "label", _n_classes(rows), settings, run_dir)
    return _trace(spark, model)


def lr_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Rate of a run that takes one step per document: a twentieth is warm-up, a tenth the tail."""
    docs = _documents(spark, sf, "doc_id")
    n = docs.agg(F.max("doc_id")).first()[0] + 1
    rate = schedule.cosine_rate(F.col("doc_id"), 1.0, 0.1, n // 20, n * 9 // 10)
    return docs.select(F.col("doc_id").alias("it"), rate.alias("rate")).select("it", _rounded("rate", 6))


# Streams


def _arriving(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The documents as a stream; the table may be one file, so its rows are spread over the cores."""
    schema = StructType([DOCUMENTS[c] for c in columns])
    cores = spark.sparkContext.defaultParallelism
    # A pattern of the one name: a stream takes a single file only when a pattern finds it.
    return live.document_stream(spark, f"{sf}/documents.parque[t]", schema, files=None, tasks=cores)


def stream_encode(spark: SparkSession, sf: str) -> DataFrame:
    out = new_path(spark, "encoded-stream")
    docs = _arriving(spark, sf, "doc_id", "text")
    live.stream_encode(docs, _tokenizer(spark, sf), f"{out}/data", f"{out}/log", ["doc_id"]).awaitTermination()
    return _shown_ids(spark.read.schema("doc_id bigint, ids array<int>").parquet(f"{out}/data"))


def stream_encode_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in pieces of 1,000 characters, the later half of each arriving before the earlier one."""
    out = new_path(spark, "pieces-stream")
    docs = _texts(spark, sf, "doc_id", "text").filter("text IS NOT NULL")
    n = F.greatest(F.ceil(F.length("text") / 1000), F.lit(1))
    cut = docs.select("doc_id", "text", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("seq"))
    rows = cut.select(
        "doc_id",
        "seq",
        F.substr("text", F.col("seq").cast("int") * 1000 + 1, F.lit(1000)).alias("piece"),
        (F.col("seq") == F.col("n") - 1).alias("last"),
        (2 * F.col("seq") < F.col("n")).alias("early"),
    )
    written = write_table(rows, "pieces").persist()
    log, data, model = f"{out}/log", f"{out}/data", _tokenizer(spark, sf)
    schema = "doc_id bigint, seq bigint, piece string, last boolean"
    for early in (False, True):
        written.filter(F.col("early") == early).drop("early").write.mode("append").parquet(f"{out}/in")
        arriving = spark.readStream.schema(schema).parquet(f"{out}/in")
        pieces.stream_encode_pieces(arriving, model, data, log).awaitTermination()
    written.unpersist()
    return _shown_ids(pieces.whole_ids(spark, data))


def stream_pretoken_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = new_path(spark, "count-stream")
    docs = _arriving(spark, sf, "text")
    live.stream_pretoken_counts(docs, f"{out}/data", f"{out}/log").awaitTermination()
    return live.latest_counts(spark, f"{out}/data")


QUERIES = {
    "apply_merge": apply_merge,
    "array_softmax": array_softmax,
    "bpe_merges": bpe_merges,
    "bpe_vocab": bpe_vocab,
    "byte_display": byte_display,
    "byte_histogram": byte_histogram,
    "checkpoint_resume": checkpoint_resume,
    "clip_all_parameters": clip_all_parameters,
    "clip_global_norm": clip_global_norm,
    "context_windows": context_windows,
    "corpus_ranges": corpus_ranges,
    "corpus_split": corpus_split,
    "cross_entropy": cross_entropy,
    "decode_roundtrip": decode_roundtrip,
    "embedding_lookup": embedding_lookup,
    "encode_documents": encode_documents,
    "encode_from_files": encode_from_files,
    "fit_parameter_table": fit_parameter_table,
    "fit_softmax_regression": fit_softmax_regression,
    "flat_token_windows": flat_token_windows,
    "group_softmax": group_softmax,
    "linear_map": linear_map,
    "lr_schedule": lr_schedule,
    "masked_vote": masked_vote,
    "merges_load": merges_load,
    "pair_counts": pair_counts,
    "pretoken_counts": pretoken_counts,
    "project_vectors": project_vectors,
    "rms_normalise": rms_normalise,
    "roundtrip_audit": roundtrip_audit,
    "silu_features": silu_features,
    "soft_neighbour_vote": soft_neighbour_vote,
    "special_split": special_split,
    "special_split_many": special_split_many,
    "start_uniformity": start_uniformity,
    "stream_encode": stream_encode,
    "stream_encode_pieces": stream_encode_pieces,
    "stream_pretoken_counts": stream_pretoken_counts,
    "table_diff": table_diff,
    "table_diff_exact": table_diff_exact,
    "table_diff_tree": table_diff_tree,
    "token_stream": token_stream_blocks,
    "token_vectors": token_vectors,
    "top_pairs": top_pairs,
    "vocab_load": vocab_load,
    "vocab_specials": vocab_specials,
}
