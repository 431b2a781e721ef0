"""Language identification by inference of a mixture of languages per document.

Words are drawn from languages in unknown proportions, and letter n-grams give the likelihood of a
word in each language. Expectation-maximisation finds the proportions; the set of languages grows, in the
order of their proportions, while the likelihood less a penalty for each language does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, held_out, own_name, put, text_buffer
from glyphmill.llm.word_hashes import IS_LETTER, LOWER, word_spans

GRAM_BITS = 16
GRAMS = 1 << GRAM_BITS
# Neighbouring n-grams overlap, so their log-likelihoods count by this factor.
TEMPER = 0.4
SMOOTHING = 0.5
# Steps that rank the languages of a text, and how far and how long those of a chosen set go.
STEPS = 12
TOLERANCE, MOST_STEPS = 0.002, 60
MOST_LANGUAGES = 1_000
# What each language of a document costs per log of the words.
PENALTY = 2.0
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]
    log_p: np.ndarray


def _grams(data: np.ndarray, bounds: np.ndarray):
    """Slot of the four bytes around each letter byte, where each word starts among them, its text."""
    lower = LOWER[data]
    inside = IS_LETTER[lower]
    starts, ends, text = word_spans(lower, bounds, inside)
    padded = np.full(len(lower) + 3, 0x20, np.uint32)
    padded[1 : len(lower) + 1] = np.where(inside, lower, 0x20)
    at = np.flatnonzero(inside)
    four = padded[at] | padded[at + 1] << np.uint32(8) | padded[at + 2] << np.uint32(16) | padded[at + 3] << np.uint32(24)
    slot = four * np.uint32(0x9E3779B1) >> np.uint32(32 - GRAM_BITS)
    size = ends - starts
    return slot.astype(np.int64), np.cumsum(size) - size, text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        data, bounds = text_buffer(batch.column(0))
        lang = batch.column(1).dictionary_encode()
        names, code = lang.dictionary.to_pylist(), lang.indices.to_numpy()
        for i, j in chunks_of(bounds):
            slot, starts, text = _grams(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            own = np.repeat(code[i:j][text], np.diff(np.append(starts, len(slot))))
            for number in np.unique(own):
                total = found.setdefault(names[number], np.zeros(GRAMS, np.int64))
                total += np.bincount(slot[own == number], minlength=GRAMS)
    for name, total in found.items():
        keys = np.flatnonzero(total)
        columns = [pa.array([name] * len(keys)), pa.array(keys.astype(np.int32)), pa.array(total[keys])]
        yield pa.RecordBatch.from_arrays(columns, names=["name", "gram", "n"])


def train_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> LanguageModel:
    """Count letter n-grams per language over all documents with a language.

    Documents whose id's crc32 is divisible by five teach nothing; those with a NULL id do. The driver
    gets one row per language and n-gram slot; more than ``MOST_LANGUAGES`` languages are refused.
    """
    known = docs.filter(docs[f"`{lang}`"].isNotNull() & ~held_out(docs[f"`{doc_id}`"]))
    rows = known.select(known[f"`{text}`"].alias("text"), known[f"`{lang}`"].cast("string").alias("lang"))
    counts = rows.mapInArrow(_count, "name string, gram int, n bigint").groupBy("name", "gram").agg(F.sum("n").alias("n"))
    if rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"at most {MOST_LANGUAGES} languages are told apart")
    found = counts.toPandas()
    names = sorted(found["name"].unique())
    number = {name: i for i, name in enumerate(names)}
    n = np.full((GRAMS, len(names)), SMOOTHING, np.float64)
    n[found["gram"].to_numpy(np.int64), found["name"].map(number).to_numpy(np.int64)] += found["n"].to_numpy(np.float64)
    return LanguageModel(tuple(names), np.log(n / n.sum(axis=0)).astype(np.float32))


def _mixture(like: np.ndarray, firsts: np.ndarray, text: np.ndarray, share: np.ndarray, steps: int, tolerance: float = 0.0) -> np.ndarray:
    """Proportions per text that raise the likelihood of its words, from a first guess.

    Ends after ``steps``, or once no proportion moves by ``tolerance`` any more.
    """
    n = np.diff(np.append(firsts, len(like)))[:, None]
    for _ in range(steps):
        joint = like * share[text]
        joint /= joint.sum(axis=1, keepdims=True)
        before, share = share, np.add.reduceat(joint, firsts, axis=0) / n
        if np.abs(share - before).max() < tolerance:
            break
    return share


def _of_texts(chosen: np.ndarray, like: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of some texts: their likelihoods, where each text begins, and the number of each word's text."""
    keep = chosen[text]
    number = (np.cumsum(chosen) - 1)[text[keep]]
    return like[keep], np.flatnonzero(np.append(True, number[1:] != number[:-1])), number


def infer(model: LanguageModel, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the proportions of the languages, zero outside the chosen set, and which texts have words."""
    n_texts, n_langs = len(bounds) - 1, len(model.names)
    result = np.zeros((n_texts, n_langs))
    slot, starts, word_text = _grams(data, bounds)
    if not len(starts) or not n_langs:
        return result, np.zeros(n_texts, bool)
    log_like = np.add.reduceat(model.log_p[slot], starts, axis=0) * TEMPER
    top = log_like.max(axis=1, keepdims=True)
    # A word is at most this much less likely in one language than in another.
    like = np.exp(np.maximum(log_like - top, -30.0))
    firsts = np.flatnonzero(np.append(True, word_text[1:] != word_text[:-1]))
    present = word_text[firsts]
    text = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(word_text))))
    full = _mixture(like, firsts, text, np.full((len(firsts), n_langs), 1.0 / n_langs), STEPS)
    order = np.argsort(-full, axis=1, kind="stable")
    penalty = PENALTY * np.log1p(np.diff(np.append(firsts, len(word_text))))
    best, chosen = np.full(len(firsts), -np.inf), np.zeros_like(full)
    # A set grows by the next language as long as that pays for its penalty.
    growing = np.ones(len(firsts), bool)
    for size in range(1, n_langs + 1):
        own, own_firsts, own_text = _of_texts(growing, like, text)
        share = np.zeros((int(growing.sum()), n_langs))
        rows, first = np.arange(len(share))[:, None], order[growing, :size]
        share[rows, first] = np.maximum(full[growing][rows, first], 1e-6)
        share /= share.sum(axis=1, keepdims=True)
        if size > 1:
            share = _mixture(own, own_firsts, own_text, share, MOST_STEPS, TOLERANCE)
        fit = np.add.reduceat(np.log((own * share[own_text]).sum(axis=1)), own_firsts) - size * penalty[growing]
        better = fit > best[growing]
        grown = np.flatnonzero(growing)[better]
        best[grown], chosen[grown] = fit[better], share[better]
        growing = np.zeros(len(firsts), bool)
        growing[grown] = True
        if not len(grown):
            break
    result[present] = chosen
    has_words = np.zeros(n_texts, bool)
    has_words[present] = True
    return result, has_words


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "languages") -> DataFrame:
    """Add an array of ``(lang, share)``, the chosen languages of each text, greatest share first.

    NULL, and a text without a letter, give an empty array, as does a model without languages. Only
    the text is looked at. Other columns stay, one named ``out`` is replaced. Ties go to the language
    that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in batches:
            data, bounds = text_buffer(texts)
            rows = []
            for i, j in chunks_of(bounds):
                share, found = infer(own, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                for k in range(i, j):
                    row = share[k - i]
                    if not found[k - i] or not _has_letter(texts[k].as_py()):
                        rows.append([])
                        continue
                    order = [n for n in np.argsort(-row, kind="stable").tolist() if row[n] > 0]
                    rows.append([{"lang": own.names[n], "share": float(row[n])} for n in order])
            yield pa.array(rows, kind)

    udf = F.arrow_udf(predict, "array<struct<lang:string,share:double>>").asNondeterministic()
    return put(docs, {out: udf(docs[f"`{text}`"])})


def language_of(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, the language with the greatest share, and ``score``, that share; ``und`` and
    zero where there is none."""
    languages = own_name(docs, "languages")
    found = predict_languages(docs, model, text, languages)
    first = F.get(languages, 0)
    return put(
        found,
        {
            "lang_pred": F.coalesce(first["lang"], F.lit(UNDETERMINED)),
            "score": F.coalesce(first["share"], F.lit(0.0)),
        },
    ).drop(languages)
