"""The registered queries over whole small tables, against plain versions of their contracts."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from glyphmill.llm import queries, toxicity
from glyphmill.session import write_table
from glyphmill.sources.corpus import table
from tests.compare import normal, oracle_rows
from tests.llm.test_repeated_spans import plain as plain_repeats
from tests.llm.test_secrets import plain_base
from tests.llm.test_simhash_golay import plain_components, plain_fingerprint

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(folder, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{name}.parquet'").fetchall()


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def result(spark, name, folder=SMALL):
    return queries.QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    names, _, expected = oracle_rows(queries.ORACLES[name], SMALL)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(names, expected)


def test_secrets(spark):
    texts = dict(rows_of(SMALL, "documents", "doc_id, text"))
    found = result(spark, "op3_secrets")
    assert len(found) == len(texts)
    for row in found:
        base = plain_base(texts[row["doc_id"]])
        assert row["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert [row[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]


def test_repeated_spans(spark):
    wanted = plain_repeats(rows_of(SMALL, "documents", "doc_id, text"), 100)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in result(spark, "op4_repeated_spans")}
    assert found == {i: (*w[:3], sha(w[3])) for i, w in wanted.items()}


def test_vectors(spark):
    rows = rows_of(SMALL, "embeddings", "vec_id, embedding")
    ids, values = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    links = [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(near)) if i < j]
    roots = plain_components(ids.tolist(), links)
    for row in result(spark, "op5_epsilon_join"):
        place = int(np.flatnonzero(ids == row["vec_id"])[0])
        assert row["n_links"] == near[place].sum() - 1
        assert row["component_id"] == roots[row["vec_id"]] and row["kept"] == (roots[row["vec_id"]] == row["vec_id"])
    whole, wanted = np.floor(values * 256).astype(np.int64), []
    for q in np.flatnonzero(ids % 50 == 0):
        scores = whole @ whole[q]
        best = [i for i in np.lexsort((ids, -scores)) if i != q][:5]
        wanted += [(int(ids[q]), n + 1, int(ids[i]), int(scores[i])) for n, i in enumerate(best)]
    assert sorted(tuple(r) for r in result(spark, "op6_max_score")) == sorted(wanted)


def test_near_duplicates(spark):
    texts = rows_of(SMALL, "documents", "doc_id, text")
    prints = {i: plain_fingerprint(t) for i, t in texts}
    nodes = sorted(set(prints.values()))
    roots = plain_components(nodes, [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4])
    least = {}
    for i in sorted(prints):
        least.setdefault(roots[prints[i]], i)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op7_simhash_golay")}
    assert found == {i: (f"{p:016x}", least[roots[p]]) for i, p in prints.items()}


def test_codec(spark):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(rows_of(SMALL, "documents", "doc_id, text"))
    for row in result(spark, "op8_bpe_codec"):
        ids = own.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(own.decode(ids, skip_special_tokens=False))


def test_language_accuracy_on_held_out_documents(spark):
    truth = dict(rows_of(LARGER, "documents", "doc_id, lang"))
    tested = [r for r in result(spark, "op10_language_mixture", LARGER) if r["held_out"]]
    assert len(tested) > 150
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in tested]) > 0.98


def test_toxicity_finds_what_is_marked(spark):
    truth = dict(rows_of(LARGER, "labels", "doc_id, toxic"))
    found = result(spark, "op9_toxicity", LARGER)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    scores = {k: [r["score"] for r in found if truth.get(r["doc_id"]) == k] for k in (0, 1)}
    # How often a toxic text scores above an ordinary one.
    above = np.mean([[a > b for b in scores[0]] for a in scores[1]])
    assert above > 0.9
    assert np.mean([s >= 0.5 for s in scores[0]]) < 0.03


def test_licenses_are_those_in_the_texts(spark):
    texts = dict(rows_of(SMALL, "documents", "doc_id, text"))
    found = {(r["doc_id"], r["template_id"]) for r in result(spark, "op1_license_scan")}
    shown = {"mit": "Released under the MIT License", "apache-2.0": "Licensed under the Apache License, Version 2.0", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0"}
    for name, notice in shown.items():
        for i, text in texts.items():
            assert (notice not in (text or "")) or (i, name) in found


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    before = [r.asDict() for r in docs.collect()]
    model = toxicity.train_toxicity(docs, table(spark, SMALL, "labels"))
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = write_table(stage(spark, docs, SMALL), name)
        after = [r.asDict() for r in docs.collect()]
        if place < 4:
            assert docs.columns == columns
        if name == "toxicity":
            assert after == [r for r in before if score[r["doc_id"]] < 0.5]
        elif name == "simhash_near_dedup":
            prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in before}
            nodes = sorted(set(prints.values()))
            roots = plain_components(nodes, [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4])
            least = {}
            for i in sorted(prints):
                least.setdefault(roots[prints[i]], i)
            assert sorted(map(str, after)) == sorted(str(r) for r in before if least[roots[prints[r["doc_id"]]]] == r["doc_id"])
        elif name == "secret_scans":
            old = {r["doc_id"]: r for r in before}
            assert {r["doc_id"] for r in after} == set(old)
            for r in after:
                spans = plain_base(old[r["doc_id"]]["text"])
                assert (r["text"] != old[r["doc_id"]]["text"]) >= bool(spans)
                assert not [s for s in plain_base(r["text"]) if s[0] != "assign"] and r["n_chars"] == len(r["text"])
        elif name == "source_mixing":
            kinds = {str(r) for r in before}
            assert all(str(r) in kinds for r in after)
        else:
            own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            assert all(r["ids"] == own.encode(r["text"], add_special_tokens=False).ids and r["round_trip"] for r in after)
        before = after
    assert before


def test_op11_is_the_library(spark):
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {doc_id: text or "" for doc_id, text in rows_of(SMALL, "documents", "doc_id, text")}
    found = {r["doc_id"]: r for r in result(spark, "op11_piece_codec")}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids, row = own.encode(text), found[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(",".join(map(str, ids))) and row["decoded_sha256"] == sha(own.decode(ids))


def test_op12_is_numpy(spark):
    rows = dict(rows_of(SMALL, "embeddings", "vec_id, embedding"))
    order = sorted(rows)
    x = np.floor(64.0 * np.array([rows[i] for i in order], np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    best = np.argsort(-values)[:16]
    wanted = (x - fit.mean(axis=0)) @ axes[:, best] / np.sqrt(values[best])
    found = result(spark, "op12_whitening")
    assert len(found) == len(order) * 16
    place, got = {i: p for p, i in enumerate(order)}, np.zeros_like(wanted)
    for r in found:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(fit) and r["identity_error"] < 1e-9
        assert abs(r["explained"] - values[best[r["component"] - 1]] / values.sum()) < 1e-10
        assert r["deviation"] == sum((len(fit) * int(a) - int(s)) ** 2 for a, s in zip(x[place[r["vec_id"]]], fit.sum(axis=0)))
    assert np.allclose(got * np.sign((got * wanted).sum(axis=0)), wanted, atol=1e-7)
