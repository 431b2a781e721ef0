import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from glyphmill.llm import language_mixture, toxicity
from glyphmill.llm.columns import held_out

LANGS = {"en": ["th", "er", "ing", "and", "wh"], "de": ["sch", "ung", "keit", "ei", "ü"], "fr": ["eau", "oi", "é", "que", "ment"]}


def prose(lang, n, rng):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def language_docs(make_docs, extra=()):
    rng = random.Random(1)
    rows = [(i, prose(lang, 60, rng), lang, "s") for i, lang in enumerate(list(LANGS) * 60)]
    return make_docs([*rows, *extra]), {i: lang for i, _, lang, _ in rows}


def test_languages_of_held_out_texts(make_docs):
    rng = random.Random(2)
    mixed = prose("de", 60, rng) + " " + prose("fr", 30, rng)
    odd = [(900, None, "en", "s"), (901, "", "en", "s"), (902, "123 !! 👍", "fr", "s"), (903, mixed, None, "s"), (904, "Я", None, "s"), (None, "wh", None, "s")]
    docs, truth = language_docs(make_docs, odd + odd[:1])
    docs = docs.withColumn("Score", F.lit("mine"))
    model = language_mixture.train_languages(docs)
    assert model.names == ("de", "en", "fr")
    found = language_mixture.language_of(docs, model)
    assert "Score" not in found.columns
    rows = {r["doc_id"]: r for r in found.collect()}
    tested = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(tested) > 20 and all(rows[i]["lang_pred"] == truth[i] for i in tested)
    assert [(rows[i]["lang_pred"], rows[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert rows[904]["lang_pred"] in model.names
    chosen = language_mixture.predict_languages(docs.filter("doc_id = 903"), model).first()["languages"]
    assert [c["lang"] for c in chosen] == ["de", "fr"] and abs(chosen[0]["share"] - 2 / 3) < 0.1


def plain_set(like):
    """Proportions of one text from the likelihoods of its words, grown language by language."""
    n, n_langs = like.shape
    full = np.full(n_langs, 1 / n_langs)
    for _ in range(language_mixture.STEPS):
        joint = like * full
        full = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    order, best, chosen = np.argsort(-full, kind="stable"), -np.inf, None
    for size in range(1, n_langs + 1):
        share = np.zeros(n_langs)
        share[order[:size]] = np.maximum(full[order[:size]], 1e-6)
        share /= share.sum()
        for _ in range(400 if size > 1 else 0):
            joint = like * share
            share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        fit = np.log((like * share).sum(axis=1)).sum() - size * language_mixture.PENALTY * np.log1p(n)
        if fit <= best:
            break
        best, chosen = fit, share
    return chosen


def test_sets_grow_beyond_three_languages():
    rng, names = random.Random(5), [f"l{i}" for i in range(6)]
    words = {name: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(4, 8))) for _ in range(40)] for name in names}
    texts = {name: " ".join(rng.choices(words[name], k=4000)) for name in names}
    n = np.full((language_mixture.GRAMS, 6), language_mixture.SMOOTHING)
    for i, name in enumerate(names):
        data = np.frombuffer(texts[name].encode(), np.uint8)
        n[:, i] += np.bincount(language_mixture._grams(data, np.array([0, len(data)]))[0], minlength=language_mixture.GRAMS)
    model = language_mixture.LanguageModel(tuple(names), np.log(n / n.sum(axis=0)).astype(np.float32))
    mixes = [names[:k] for k in (1, 2, 4, 6, 3)]
    docs = [" ".join(rng.choice(words[name]) for name in mix for _ in range(60)) for mix in mixes]
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    bounds = np.append(0, np.cumsum([len(d) for d in docs]))
    share, _ = language_mixture.infer(model, data, bounds)
    for i, mix in enumerate(mixes):
        assert [names[j] for j in np.flatnonzero(share[i])] == mix
        assert np.abs(share[i][share[i] > 0] - 1 / len(mix)).max() < 0.05
        slot, starts, _ = language_mixture._grams(data[bounds[i] : bounds[i + 1]], np.array([0, len(docs[i])]))
        log_like = np.add.reduceat(model.log_p[slot], starts, axis=0) * language_mixture.TEMPER
        like = np.exp(np.maximum(log_like - log_like.max(axis=1, keepdims=True), -30.0))
        np.testing.assert_allclose(share[i], plain_set(like), atol=0.02)


def test_languages_without_anything_to_learn_from(make_docs):
    docs = make_docs([(1, "text", None, "s")])
    model = language_mixture.train_languages(docs)
    assert model.names == ()
    assert language_mixture.language_of(docs, model).first()["lang_pred"] == "und"
    assert language_mixture.language_of(make_docs([]), model).count() == 0


def test_held_out_rule(spark):
    ids = [None, *range(-20, 200)]
    found = spark.createDataFrame([(i,) for i in ids], "i bigint").select("i", held_out(F.col("i")).alias("h")).collect()
    assert all(r["h"] == (r["i"] is not None and zlib.crc32(str(r["i"]).encode()) % 5 == 0) for r in found)


def toxic_docs(make_docs, n=900):
    rng = random.Random(3)
    bad = ["grumblefoot", "snarkish", "vilebeast", "vilesnout"]
    rows, labels = [], []
    for i in range(n):
        words = prose("en", rng.randint(20, 120), rng).split()
        toxic = i % 6 == 0
        for _ in range(rng.randint(3, 6) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxic_texts_are_told_apart(spark, make_docs):
    rows, labels = toxic_docs(make_docs)
    odd = [(5000, None, "en", "s"), (5001, "", "en", "s"), (None, "vilesnout", "en", "s"), (5002, "vilesnip " * 3000, "en", "s")]
    docs = make_docs([*rows, *odd, rows[0], rows[0]]).withColumn("SCORE", F.lit("mine"))
    table = spark.createDataFrame([*labels, (0, 1), (None, 1), (7777, None)], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, table)
    found = toxicity.score_toxicity(docs, model)
    assert "SCORE" not in found.columns
    score = {r["doc_id"]: r["score"] for r in found.collect()}
    tested = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(score[i] >= 0.5) == bool(y) for i, y in tested]
    assert len(tested) > 100 and np.mean(right) > 0.97
    assert score[5000] == score[5001] < 0.5


def test_labels_of_held_out_rows_teach_nothing(spark, make_docs):
    rows, labels = toxic_docs(make_docs, 300)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    docs = make_docs(rows)
    models = [toxicity.train_toxicity(docs, spark.createDataFrame(t, "doc_id bigint, toxic int")) for t in (labels, turned)]
    assert (models[0].weights == models[1].weights).all() and (models[0].kept == models[1].kept).all()


def test_no_labels_no_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    docs = make_docs(["a b c", None])
    scores = [r["score"] for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, none)).collect()]
    assert scores[0] == scores[1] < 0.5
    assert toxicity.score_toxicity(make_docs([]), toxicity.train_toxicity(make_docs([]), none)).count() == 0


def test_every_label_is_learned_from(spark, make_docs):
    """Beyond 6,000 rows of a class the counts still cover all of them, whichever way labels are joined."""
    rows = [(i, "grumble foot" if i % 10 == 0 else "plain word", "en", "s") for i in range(11_000)]
    docs, labels = make_docs(rows), spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(11_000)], "doc_id bigint, toxic int")
    fold = [zlib.crc32(str(i).encode()) % 5 for i in range(11_000)]
    models = [toxicity.train_toxicity(docs, labels, broadcast_labels=most) for most in (1 << 20, 0)]
    # Each text has two words of four expressions each.
    n = [sum(f not in (0, 4) and (i % 10 == 0) == kind for i, f in enumerate(fold)) for kind in (False, True)]
    assert n[0] > 5_500 and sum(n) + sum(f == 4 for f in fold) > 6_000
    for model in models:
        assert abs(model.prior - (8 * n[1] + 1) / (8 * sum(n) + 2)) < 1e-12
    np.testing.assert_allclose(models[0].weights, models[1].weights, rtol=1e-9)
    assert (models[0].kept == models[1].kept).all() and (models[0].pair_kept == models[1].pair_kept).all()
