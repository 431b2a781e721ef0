import random

import numpy as np

from glyphmill.llm import toxicity
from glyphmill.llm.pair_counts import NO_PAIR, pair_keys

LABELS = "doc_id bigint, toxic int"


def texts(n=400, seed=7):
    rng = random.Random(seed)
    return [" ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randint(0, 60))) for _ in range(n)]


def plain_pairs(rows):
    """Number of texts of each class with a word pair, by its number."""
    n = {}
    for text, toxic in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        slots, _, before = toxicity._words(data, np.array([0, len(data)]))
        for key in set(pair_keys(before, slots[-1], toxicity.WORD_BITS).tolist()) - {NO_PAIR}:
            n.setdefault(key, [0, 0])[toxic] += 1
    return n


def test_numbers_of_pairs_differ():
    before = np.repeat(np.arange(-1, 300), 300)
    keys = pair_keys(before, np.tile(np.arange(300), 301), toxicity.WORD_BITS)
    assert (keys[before < 0] == NO_PAIR).all()
    assert len(np.unique(keys[before >= 0])) == 300 * 300 and keys[before >= 0].max() < NO_PAIR


def test_every_pair_is_in_the_model(spark, make_docs):
    """Pairs that a single text has too, and those of more than 255 texts."""
    rows = [*texts(), *["grumble foot"] * 600, *["plain word"] * 700]
    labels = [(i, int(i % 3 == 0)) for i in range(len(rows))]
    learned = [i for i, f in enumerate(spark.range(len(rows)).select(toxicity._fold(toxicity.F.col("id"))).collect()) if f[0] not in (0, 4)]
    truth = plain_pairs([(rows[i], int(i % 3 == 0)) for i in learned])
    assert sum(sum(n) == 1 for n in truth.values()) > 1000 and max(map(max, truth.values())) > 255
    model = toxicity.train_toxicity(make_docs(rows), spark.createDataFrame(labels, LABELS))
    keys = np.array([*truth, 5, NO_PAIR])
    found = np.stack(model.pairs.find(keys), axis=1)
    assert found[:-2].tolist() == list(truth.values()) and not found[-2:].any()
    assert len(model.pairs.low) == len(truth)


def test_asked_pairs_give_the_same_scores(spark, make_docs, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_TEXTS", 50)
    rows = [*texts(), *["snarkish foot"] * 40, None, "", "...", "lone"]
    docs = make_docs([*rows, (None, "lone"), *[(i, rows[i]) for i in (0, 0, 1)]]).withColumn("Score", toxicity.F.lit("mine"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(len(rows))], LABELS)
    models = [toxicity.train_toxicity(docs, labels, broadcast_pairs=most) for most in (1 << 24, 0)]
    assert models[1].pairs is None and models[0].table is None
    assert (models[0].weights == models[1].weights).all()
    found = [toxicity.score_toxicity(docs, model) for model in models]
    assert found[0].columns == found[1].columns
    scores = [sorted(map(str, f.select("doc_id", "text", "score").collect())) for f in found]
    assert scores[0] == scores[1] and len(scores[0]) == docs.count()
    none = make_docs([])
    assert toxicity.score_toxicity(none, models[1]).count() == 0


def test_no_pairs_at_all(spark, make_docs):
    docs, none = make_docs(["a b c", None, "a"]), spark.createDataFrame([], LABELS)
    scores = [r["score"] for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, none, broadcast_pairs=-1)).collect()]
    assert len(scores) == 3 and len(set(scores)) == 1


def test_left_neighbours_are_counted_beyond_the_marks_of_one_level(spark, make_docs):
    """A word after 500 different ones passes less to its beginning than one after 20,000 of them."""
    rng = random.Random(9)
    name = ["".join(rng.choices("bcdfghjkl", k=9)) for _ in range(20_000)]
    texts = [" ".join(f"{w} common" for w in name[i : i + 50]) for i in range(0, len(name), 50)]
    rows = [*texts, *[" ".join(f"{w} seldom" for w in name[i : i + 50]) for i in range(0, 500, 50)]]
    rows += ["common seldom"] * 100
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(rows) - 100, len(rows))], LABELS)
    model = toxicity.train_toxicity(make_docs(rows), labels)
    data = np.frombuffer(b"common seldom", np.uint8)
    slot = toxicity._words(data, np.array([0, len(data)]))[0][-1]
    # Shared counts of 1,000 and 25 against some 60 labelled texts.
    shared = [model.passed[s] for s in slot]
    assert shared[0] > 0.9 and 0.15 < shared[1] < 0.5
