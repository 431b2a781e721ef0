import pyarrow.parquet as pq
import pytest

from glyphmill.operators import codec, counts
from glyphmill.operators.bpe import train_bpe
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.plans import registry
from glyphmill.session import new_path
from glyphmill.streaming import live

SCHEMA = "doc_id bigint, text string"


@pytest.fixture
def folder(spark, tmp_path):
    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    rows = [(i, f"a  story {i}\n\n\nof {'the ' * i}end ") for i in range(30)]
    for part in (rows[:10], rows[10:15]):
        add(part)
    return str(tmp_path / "in"), rows, add


def _stream(spark, path):
    return live.document_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_stream_encode_equals_batch_over_restarts(spark, folder):
    path, rows, add = folder
    docs = spark.createDataFrame(rows, SCHEMA)
    model = Tokenizer.from_tables(*train_bpe(docs, 256 + 20))
    out = new_path(spark, "out")
    for late in ([], rows[15:], []):
        if late:
            add(late)
        live.stream_encode(_stream(spark, path), model, f"{out}/data", f"{out}/log", ["doc_id"]).awaitTermination()
    got = sorted((r["doc_id"], r["ids"]) for r in spark.read.parquet(f"{out}/data").collect())
    want = sorted((r["doc_id"], r["ids"]) for r in codec.encode_corpus(docs, model).collect())
    assert got == want


def test_stream_counts_equal_batch_over_restarts(spark, folder):
    path, rows, add = folder
    out = new_path(spark, "out")
    for late in ([], rows[15:], []):
        if late:
            add(late)
        live.stream_pretoken_counts(_stream(spark, path), f"{out}/data", f"{out}/log").awaitTermination()
    got = sorted(map(tuple, live.latest_counts(spark, f"{out}/data").collect()))
    want = sorted(map(tuple, counts.pretoken_counts(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == want


@pytest.mark.parametrize("parts", [0, 3])
def test_registered_streams_read_a_table_of_one_file_or_many(spark, tmp_path, parts):
    sf, rows = str(tmp_path), [(i, f"a  story {i}\n\n\nof {'the ' * i}end ", "en", "s", 9) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    if parts:
        docs.repartition(parts).write.parquet(f"{sf}/documents.parquet")
    else:
        pq.write_table(docs.toArrow(), f"{sf}/documents.parquet")
    for stream, batch in (("stream_encode", "encode_documents"), ("stream_pretoken_counts", "pretoken_counts")):
        got, want = (sorted(map(tuple, registry.QUERIES[name](spark, sf).collect())) for name in (stream, batch))
        assert got == want and got
