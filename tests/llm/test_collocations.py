import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from glyphmill.llm import collocations as c


def plain(docs, least=3, most=2000):
    """The contract, phrase by phrase."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lower = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    count[lang or "und"][tuple(words[i : i + k])] += 1
    rows = []
    for lang, f in count.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            spans = lambda q: {q[i : i + len(p)] for i in range(len(q) - len(p) + 1)}
            if any(len(q) > len(p) and p in spans(q) and b >= least and 100 * b >= 80 * a for q, b in f.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(rows)


def found(docs, **options):
    return sorted(tuple(r) for r in c.collocations(docs, **options).collect())


def some_texts(seed, n, words=9):
    rng = random.Random(seed)
    names = ["a", "B", "the", "of", "Éa", "x-y", "q r", "ß", "和", "z"][:words]
    glue = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; ", "\r\n", "\x0b"]
    return ["".join(rng.choice(names) + rng.choice(glue) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("chunk_words", [1, 3, 16])
def test_equals_plain_counting(make_docs, monkeypatch, chunk_words):
    monkeypatch.setattr(c, "STEP_BYTES", 500)
    texts = some_texts(chunk_words, 60)
    texts += [texts[0]] * 20 + ["", None, " ", "...", "one", "same same same same same same same"]
    rows = [(i, t, [None, "en", "de"][i % 3], "s") for i, t in enumerate(texts)]
    docs = make_docs([*rows, (None, texts[1], "en", None), (0, texts[1], "en", None)]).withColumn("chunk", F.lit(1)).withColumn("a", F.lit("x"))
    given = [(r[1], r[2]) for r in rows] + [(texts[1], "en")] * 2
    monkeypatch.setattr(c.chunk_dictionary, "__defaults__", ("text", "lang", chunk_words))
    assert found(docs, least_count=3) == plain(given)
    assert found(docs.repartition(7), least_count=3, most=5) == plain(given, most=5)


def test_parse_frequencies_are_those_of_the_text(make_docs):
    text = " ".join(some_texts(5, 30)) + ". " + " ".join(["word"] * 5000)
    chunks = c.chunk_dictionary(make_docs([text, text])).collect()
    words = sum(len(p.split()) for p in re.split("[.,;:!?\x0a-\x0d]", text.replace(" ", "")))
    assert sum(r["own"] * r["freq"] for r in chunks) == 2 * words
    assert all(r["freq"] % 2 == 0 for r in chunks)


def test_a_saturated_bit_map_changes_nothing(make_docs, monkeypatch):
    docs = make_docs(some_texts(8, 80))
    wanted = found(docs, least_count=4)
    monkeypatch.setattr(c, "MOST_BITS", 8)
    monkeypatch.setattr(c, "BITS_EACH", 0)
    assert wanted and found(docs, least_count=4) == wanted
    monkeypatch.setattr(c, "bit_map", lambda phrases, size: c.np.full(4, 255, c.np.uint8))
    assert found(docs, least_count=4) == wanted


def test_empty_tables_and_rare_words(make_docs):
    assert found(make_docs([])) == []
    assert found(make_docs(["a b c d", None, ""])) == []


def test_one_very_long_piece(make_docs):
    text = " ".join(f"w{i * i % 71} in spite of" for i in range(30_000))
    assert found(make_docs([text])) == plain([(text, "en")], least=30)


def test_scores_beyond_64_bits(spark):
    big = 10**15
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 3)]
    (row,) = c.lowest_cuts(spark.createDataFrame(rows, "lang string, phrase string, words int, a bigint")).collect()
    assert (row["l"], row["r"], row["score"]) == (big, big + 7, 2_000_000 * (big - 3) // (2 * big + 7))


def test_passes_read_a_row_for_a_step_and_lose_no_chunk(make_docs):
    texts = some_texts(3, 200)
    dictionary = c.chunk_dictionary(make_docs([(i, t, [None, "en", "d\ne"][i % 3], "s") for i, t in enumerate(texts)]))
    packed = c.packed_steps(dictionary)
    steps = list(c.ChunkStep.unpacked(packed.toArrow().to_batches()))
    assert len(steps) == packed.count() <= dictionary.rdd.getNumPartitions()
    got = []
    for step in steps:
        words = [w.as_py().decode()[:-1] for w in step.distinct]
        at = 0
        for lang, size, own, freq in zip(step.lang, step.size, step.own, step.freq):
            got.append((step.langs[lang], "".join(words[code] + " " for code in step.codes[at : at + size]), own, freq))
            at += size
    assert sorted(got) == sorted(tuple(r) for r in dictionary.select("lang", "chunk", "own", "freq").collect())
