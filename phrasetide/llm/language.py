"""Languages of a document as a mixture, inferred by expectation-maximisation.

Every language is a distribution over hashed byte trigrams. A document's
trigrams are taken as drawn from a mixture of languages; the proportions are
found by expectation-maximisation, and the set of languages by backward
elimination under a penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.common import small_batches

# Hash classes of trigrams; the model has this many numbers per language.
GRAMS = 1 << 15
# Documents per language that the model is fitted on, at most (about).
TRAIN_DOCS = 4000
# A classifier of more languages than this isn't broadcast.
MAX_LANGUAGES = 500
SMOOTHING = 0.5
ROUNDS = 12
UNKNOWN = "und"

# Digits and ASCII signs say nothing about the language: all become spaces.
_LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))


@dataclass
class Model:
    """Log-free likelihoods: ``chances[g, k]`` of trigram class g in language k."""
    languages: list[str]
    chances: np.ndarray


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram classes of a text and how often each occurs."""
    raw = (" " + text.lower() + " ").encode().translate(_LETTERS)
    raw = b" ".join(raw.split())
    codes = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)
    classes = (mixed >> np.uint32(32 - 15)).astype(np.int64)
    if len(classes) < 4000:
        return np.unique(classes, return_counts=True)
    counts = np.bincount(classes, minlength=GRAMS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def is_training(key: str = "doc_id") -> Column:
    """Documents the model may learn from: those of no held-out remainder."""
    return ~held_out(key)


def held_out(key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(4)) == 2


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found, counts = grams(text)
            sums.setdefault(lang, np.zeros(GRAMS, np.int64))[found] += counts
    for lang, counts in sums.items():
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()),
             pa.array(counts[found], pa.int64())], names=["lang", "gram", "n"])


def _place() -> Column:
    """A document's place in the order in which training documents are taken."""
    return F.xxhash64("doc_id")


def reach(n: int, least: int, train_docs: int) -> int:
    """The last place from which a language of ``n`` documents is learnt.

    Places are spread evenly over 64 bits, so that about ``train_docs`` lie up to
    it, and at least the first, ``least``: whole numbers don't round to none
    however many documents there are.
    """
    even = -(1 << 63) + (train_docs << 64) // max(n, 1)
    return max(least, min(even, (1 << 63) - 1))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """The model of all labels among the training documents that have letters.

    A language with more than ``train_docs`` documents is learnt from about that
    many whole ones, the first by a hash of their ids; rarer ones from all. What
    comes to the driver is bounded by languages times trigram classes.
    """
    known = small_batches(docs).select("doc_id", "lang", "text").filter(
        is_training() & F.col("lang").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*"), F.min(_place())).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"{len(sizes)} languages; the model holds {MAX_LANGUAGES}")
    if not sizes:
        return Model([], np.zeros((GRAMS, 0), np.float32))
    last = F.lit(None).cast("bigint")
    for lang, n, least in sizes:
        last = F.when(F.col("lang") == lang, F.lit(reach(n, least, train_docs))).otherwise(last)
    chosen = known.filter((_place() <= last) & has_letter())
    counted = (chosen.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(counted.column("lang").to_pylist()))
    at = {lang: k for k, lang in enumerate(languages)}
    sums = np.full((GRAMS, len(languages)), SMOOTHING)
    if languages:
        row = counted.column("gram").to_numpy()
        column = np.array([at[x] for x in counted.column("lang").to_pylist()])
        sums[row, column] += counted.column("n").to_numpy()
    return Model(languages, (sums / sums.sum(0)).astype(np.float32))


def _mixture(chances: np.ndarray, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions that maximise the likelihood of the counts, and its logarithm."""
    shares, total = start, counts.sum()
    for _ in range(ROUNDS):
        mixed = chances @ shares
        new = shares * ((counts / mixed) @ chances) / total
        done = np.abs(new - shares).max() < 1e-3
        shares = new
        if done:
            break
    return shares, float(counts @ np.log(chances @ shares))


def infer(model: Model, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the languages of a text and their proportions, largest first.

    Languages are left out one at a time, the least first, as long as the loss
    in log likelihood stays below half the logarithm of the number of trigrams.
    """
    found, counts = grams(text)
    k = len(model.languages)
    kept = np.arange(k)
    if not len(found) or not k:
        return kept[:0], np.zeros(0)
    chances, counts = model.chances[found], counts.astype(np.float64)
    penalty = 0.5 * np.log(counts.sum() + 1)
    shares, fit_now = _mixture(chances, counts, np.full(k, 1 / k))
    while len(kept) > 1:
        rest = np.arange(len(kept)) != np.argmin(shares)
        start = shares[rest] + 1e-6
        fewer, fit_less = _mixture(chances[:, rest], counts, start / start.sum())
        if fit_now - fit_less > penalty:
            break
        kept, chances, shares, fit_now = kept[rest], chances[:, rest], fewer, fit_less
    order = np.argsort(-shares, kind="stable")
    return kept[order], shares[order]


def _predictor(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, mixes = [], [], []
            for text, lettered in zip(batch.column("text").to_pylist(),
                                      batch.column("lettered").to_pylist()):
                kept, shares = infer(model, text) if lettered else ([], [])
                if len(kept):
                    langs.append(model.languages[kept[0]])
                    scores.append(min(1.0, max(0.0, float(shares[0]))))
                    mixes.append(",".join(f"{model.languages[i]}:{s:.3f}"
                                          for i, s in zip(kept, shares)))
                else:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    mixes.append("")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(mixes, pa.string())],
                names=["row", "lang_pred", "score", "mixture"])
    return predict


def predict(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """Columns ``carry`` as struct ``row``, with ``lang_pred``, ``score``, ``mixture``.

    Only the text decides. A text that is null or has no letter is ``und`` with
    score 0, and so is every text under a model without languages. ``score`` is
    the proportion of the predicted language, ``mixture`` lists all that stay.
    """
    rows = small_batches(docs).select(F.struct(*[docs[c] for c in carry]).alias("row"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"),
                       F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, " \
             "score double, mixture string"
    return rows.mapInArrow(_predictor(model), schema)


def identified(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per document: whether it is held out, predicted language, score and mixture.

    Learns from ``text`` and ``lang`` of training documents only; rows without
    label are predicted all the same, repeated rows alike. An empty table gives
    an empty result.
    """
    made = predict(docs, fit(docs, train_docs), ["doc_id"])
    return made.select("row.doc_id", "lang_pred", "score", "mixture").withColumn(
        "held_out", held_out("doc_id"))


def with_language(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` without the documents in no language; all its columns stay."""
    made = predict(docs, fit(docs, train_docs), docs.columns)
    return made.filter(F.col("lang_pred") != UNKNOWN).select("row.*")
