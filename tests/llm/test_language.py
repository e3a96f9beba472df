from __future__ import annotations

import itertools
import random
import zlib

import numpy as np

from phrasetide.llm import language
from tests.llm.conftest import TEXTS

VOCABULARY = {
    "en": "the of and with there think would about through night light house",
    "de": "der die und nicht schon über durch nacht licht haus zwischen möchte",
    "fr": "le la et avec était après très nuit lumière maison où beaucoup",
}


def text(rng, *langs, n=60):
    return " ".join(rng.choice(VOCABULARY[rng.choice(langs)].split()) for _ in range(n))


def corpus(rng, n=240):
    return [(i, text(rng, lang), lang) for i in range(n) for lang in [rng.choice(["en", "de", "fr"])]]


def test_held_out_accuracy(docs):
    rows = corpus(random.Random(1))
    got = language.identified(docs(*rows)).collect()
    want = {i: lang for i, _, lang in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) > 0.95


def test_held_out_labels_are_not_learnt(docs):
    rows = corpus(random.Random(2))
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert language.fit(docs(*wrong)).languages == ["de", "en", "fr"]


def test_a_bounded_sample_learns_every_language_at_any_size(docs, monkeypatch):
    for n in (4001, 3_000_000_000, 10_000_000_000, 10 ** 15):
        share = (language.reach(n, -(1 << 63), 4000) + (1 << 63)) / (1 << 64)
        assert abs(share * n - 4000) < 1
    assert language.reach(4000, -5, 4000) == (1 << 63) - 1
    rows = [(i, text(random.Random(i), lang), lang) for i, lang in enumerate(
        ["en"] * 900 + ["de"] * 60 + ["fr"] * 3)]
    # As if every language had ten billion documents: its first one is still learnt.
    real = language.reach
    monkeypatch.setattr(language, "reach", lambda n, *rest: real(10_000_000_000, *rest))
    assert language.fit(docs(*rows)).languages == ["de", "en", "fr"]


def test_mixtures(docs):
    rng = random.Random(3)
    model = language.fit(docs(*corpus(rng)))

    def mix(*langs):
        kept, shares = language.infer(model, text(rng, *langs, n=400))
        return {model.languages[k]: s for k, s in zip(kept, shares)}

    assert set(mix("de")) == {"de"}
    both = mix("en", "fr")
    assert set(both) == {"en", "fr"} and abs(sum(both.values()) - 1) < 1e-6
    assert 0.3 < both["en"] < 0.7


def best_subset(model, text):
    """The languages of largest penalised likelihood among all their subsets."""
    found, counts = language.grams(text)
    penalty = 0.5 * np.log(counts.sum() + 1)
    scores = {}
    for size in range(1, len(model.languages) + 1):
        for subset in itertools.combinations(range(len(model.languages)), size):
            chances = model.chances[found][:, subset].astype(np.float64)
            shares = np.full(size, 1 / size)
            for _ in range(300):
                shares = shares * ((counts / (chances @ shares)) @ chances) / counts.sum()
            scores[subset] = counts @ np.log(chances @ shares) - penalty * size
    return set(max(scores, key=scores.get))


def test_languages_are_those_of_the_best_subset(docs):
    rng = random.Random(5)
    model = language.fit(docs(*corpus(rng)))
    agreed = tried = 0
    for langs in (["en"], ["de"], ["fr", "en"], ["de", "fr"], ["en", "de", "fr"]):
        for n in (5, 20, 80, 300):
            sample = text(rng, *langs, n=n)
            tried += 1
            agreed += set(language.infer(model, sample)[0]) == best_subset(model, sample)
    assert agreed >= 0.9 * tried


def test_odd_texts_and_labels(docs):
    rows = [(i, t, None) for i, t in enumerate(TEXTS)] + [
        (100 + i, t, lang) for i, t, lang in corpus(random.Random(4), 60)]
    got = {r.doc_id: r for r in language.identified(docs(*rows)).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(TEXTS):
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))


def test_fit_is_bounded_by_whole_documents(docs):
    rows = corpus(random.Random(5), 400)
    model = language.fit(docs(*rows), train_docs=5)
    assert model.languages == ["de", "en", "fr"]
    assert np.allclose(model.chances.sum(0), 1, atol=1e-3)


def test_odd_tables(empty, clashing, docs):
    assert language.identified(empty).count() == 0
    assert language.with_language(empty).count() == 0
    unlabelled = language.identified(docs((0, "some words", None)))
    assert [r.lang_pred for r in unlabelled.collect()] == ["und"]
    frame = clashing(*[t for _, t, _ in corpus(random.Random(6), 30)], None, "42")
    kept = language.with_language(frame)
    assert kept.columns == frame.columns and kept.count() == 30
