import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import repeated_spans


def plain(rows, length):
    """Bytes, removed bytes, runs and the rest, by a set of all strings seen so far."""
    seen, found = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            if part in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(part)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        found[doc_id] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), rest)
    return found


def shown(row):
    return row["n_bytes"], row["n_removed"], row["n_spans"], bytes(row["kept"])


@pytest.mark.parametrize("length, prefix", [(12, 5), (9, 9), (8, 1)])
def test_small_alphabets(make_docs, length, prefix):
    random.seed(length)
    rows = [(i, "".join(random.choice("abé") for _ in range(random.randint(0, 50))) * random.randint(1, 3)) for i in range(60)]
    rows += [(100, "a" * 300), (101, None), (102, "ab" * 100), (103, "é" * 80), (-5, "a" * 20), (104, "")]
    found = repeated_spans.remove_repeats(make_docs(rows), length=length, prefix=prefix)
    wanted = plain(rows, length)
    assert {r["doc_id"]: shown(r) for r in found.collect()} == wanted


def test_passages_copies_and_long_texts(make_docs, monkeypatch):
    monkeypatch.setattr(repeated_spans, "PIECE", 1 << 10)
    random.seed(9)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(1, 6))) for _ in range(400)]
    passage = " ".join(random.choice(words) for _ in range(60))
    texts = [" ".join(random.choice(words) for _ in range(random.randint(5, 300))) for _ in range(30)]
    texts += [t[:40] + passage + t[40:] for t in texts[:10]] + texts[5:8] + [passage[:99], passage[:100], " ".join(texts) * 2]
    rows = list(enumerate(texts))
    found = repeated_spans.remove_repeats(make_docs(rows)).collect()
    assert {r["doc_id"]: shown(r) for r in found} == plain(rows, 100)


def test_equal_rows_null_ids_and_names(make_docs):
    text = "some text that is long enough " * 8
    random.seed(8)
    other = "".join(random.choice("abcdefghij") for _ in range(150))
    docs = make_docs([(1, other), (1, other), (None, other), (2, other), (3, "short")]).withColumn("KEPT", F.lit("mine"))
    found = repeated_spans.remove_repeats(docs)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "n_bytes", "n_removed", "n_spans", "kept"]
    rows = sorted((r["doc_id"] or -1, r["n_removed"]) for r in found.collect())
    assert rows == [(-1, 0), (1, 150), (1, 150), (2, 150), (3, 0)]
    assert repeated_spans.remove_repeats(make_docs([])).count() == 0
    again = repeated_spans.remove_repeats(make_docs([(1, text), (1, text)])).collect()
    assert again[0] == again[1] and 0 < again[0]["n_removed"] < len(text)
    with pytest.raises(ValueError):
        repeated_spans.remove_repeats(docs, prefix=101)


def test_many_texts_without_an_id_stay_apart(make_docs):
    random.seed(20)
    passage = "".join(random.choice("abcdefgh") for _ in range(10))
    texts = {passage * (i % 2) + "".join(random.choice("abcdefgh") for _ in range(24)) for i in range(6000)}
    rows = repeated_spans.remove_repeats(make_docs([(None, t) for t in texts]), length=10, prefix=8).collect()
    assert len(rows) == len(texts)
    assert all(r["n_removed"] <= r["n_bytes"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in rows)
    gone = sorted(r["n_removed"] for r in rows)
    assert gone == sorted(_gone_by_digest(texts, 10, make_docs))


def _gone_by_digest(texts, length, make_docs):
    """Removed bytes of texts that share an id, in the order of their digests."""
    digests = make_docs(list(enumerate(texts))).select("text", F.xxhash64("text").alias("d")).collect()
    ordered = [r["text"] for r in sorted(digests, key=lambda r: r["d"])]
    return [found[1] for found in plain(list(enumerate(ordered)), length).values()]


def test_runs_do_not_depend_on_pieces_and_batches(make_docs):
    random.seed(21)
    texts = ["".join(random.choice("ab") for _ in range(random.randint(0, 400))) for _ in range(200)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])

    def runs(i, j, piece):
        own = bounds[i : j + 1] - bounds[i]
        found = repeated_spans._piece_windows(data[bounds[i] : bounds[j]], own, 40, 12, piece)
        return [(i + t, a - own[t], b - own[t], h, s) for part in found for t, a, b, h, s in zip(*part)]

    whole = runs(0, 200, 1 << 19)
    for size in (1, 100, 1023):
        assert runs(0, 200, size) == whole
        assert runs(0, 77, size) + runs(77, 200, size) == whole


def test_a_batch_of_several_megabytes(make_docs):
    random.seed(22)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(1, 6))) for _ in range(3000)]
    texts = [" ".join(random.choices(words, k=1200)) for _ in range(450)]
    cuts = [(t, a) for t in texts for a in random.sample(range(4000), 6)]
    rows = list(enumerate(texts + ["|".join(t[a : a + 160] for t, a in random.sample(cuts, 40)) for _ in range(80)]))
    assert sum(len(t) for _, t in rows) > 2_000_000
    found = repeated_spans.remove_repeats(make_docs(rows).coalesce(1)).collect()
    assert {r["doc_id"]: shown(r) for r in found} == plain(rows, 100)


def test_a_common_phrase_is_spread(make_docs, monkeypatch):
    monkeypatch.setattr(repeated_spans, "SAMPLE", 4)
    random.seed(23)
    phrase = "a phrase that a third of all documents share, "
    tails = ["".join(random.choice("abcdefgh") for _ in range(60)) for _ in range(40)]
    rows = [(i, "".join(random.choice("abcdefgh") for _ in range(60)) + phrase + random.choice(tails)) for i in range(900)]
    docs = make_docs(rows + rows[:5])
    narrow = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), F.col("text").alias("body"))
    hot = repeated_spans._hot_groups(narrow, 100, 24, 1 << 19)
    assert hot is not None
    largest = []
    for groups in (None, hot):
        emit = repeated_spans._emit_positions(100, 24, 1 << 19, groups)
        runs = repeated_spans.map_text(narrow, emit, repeated_spans.RUN).filter("not later")
        largest.append(runs.groupBy("h").count().agg(F.max("count")).first()[0])
    assert largest[0] > 500 and largest[1] < 50
    found = repeated_spans.remove_repeats(docs).collect()
    assert {r["doc_id"]: shown(r) for r in found} == plain(rows, 100) and len(found) == 905
