from __future__ import annotations

import math
from collections import Counter
from itertools import product

import numpy as np
import pytest

from tests.llm.cases import ODD, documents, lower, random_texts, split
from trawl.llm.lattice_lm import (
    SubwordLattice,
    _frequent_words,
    fit_language_model,
    score_texts,
)

PIECES = ["▁a", "▁", "a", "b", "ab", "ba", "bab"]


def lattice(seed=0):
    rng = np.random.default_rng(seed)
    p = rng.random(len(PIECES) + 257)
    return SubwordLattice(PIECES, np.log(p / p.sum())), np.log(p / p.sum())


def segmentations(word):
    if not word:
        yield []
    for i, piece in enumerate(PIECES):
        if word.startswith(piece):
            yield from ([i, *rest] for rest in segmentations(word[len(piece) :]))
    if word:
        spelt = [len(PIECES) + b for b in word[0].encode()]
        yield from ([*spelt, *rest] for rest in segmentations(word[1:]))


@pytest.mark.parametrize("word", ["", "a", "ab", "abab", "babab", "bé", "cab"])
def test_marginal_sums_over_all_segmentations(word):
    model, log = lattice()
    ways = list(segmentations("▁" + word))
    wanted = sum(math.exp(sum(log[i] for i in way)) for way in ways)
    assert math.exp(model.marginals([word])[0]) == pytest.approx(wanted)
    totals = np.zeros(len(log))
    model.expected([word], np.array([3.0]), totals)
    own = np.zeros(len(log))
    for way in ways:
        for i in way:
            own[i] += 3 * math.exp(sum(log[k] for k in way)) / wanted
    assert totals == pytest.approx(own)


def test_probabilities_of_short_texts_add_up_to_less_than_one():
    model, _ = lattice(1)
    words = ["".join(w) for n in range(5) for w in product("ab", repeat=n)]
    one = np.exp(model.marginals(words)).sum()
    assert 0 < one < 1


def plain_base(texts, training):
    def tokens(text):
        return [*split(lower(text)), None]

    counts = Counter(t for text in training for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for text in texts:
        own = tokens(text)
        score = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        yield len(own), sum(counts[t] > 0 for t in own), n, score


@pytest.mark.parametrize("training", ["all", "none"])
def test_base_scores_and_odd_documents(spark, training):
    rows = ODD + [(100 + i, t) for i, t in enumerate(random_texts(3, 60))]
    learnt = rows[::2] if training == "all" else []
    model = fit_language_model(documents(spark, learnt), rounds=1)
    scored = score_texts(documents(spark, rows, clashes=True), model)
    got = sorted(
        ((r.doc_id, r.text, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored.collect()),
        key=repr,
    )
    wanted = plain_base([t for _, t in rows], [t for _, t in learnt])
    wanted = sorted([(i, t, *w) for (i, t), w in zip(rows, wanted)], key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in wanted]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in wanted])
    assert {r.kept for r in scored.collect()} == {"mine"}


def test_score_is_the_lattice_probability_and_learns(spark):
    rows = [(i, "abra cadabra abra") for i in range(20)] + [(99, None)]
    model = fit_language_model(documents(spark, rows))
    model_0 = fit_language_model(documents(spark, rows), rounds=0)
    own = SubwordLattice(model.pieces, model.log_probs)
    assert np.exp(model.log_probs).sum() == pytest.approx(1)
    scored = {r.doc_id: r.score for r in score_texts(documents(spark, rows), model).collect()}
    whole = own.marginals(["abra", "abra", "cadabra"]).sum() + own.end_score()
    assert scored[0] == pytest.approx(whole / math.log(10))
    assert scored[99] == pytest.approx(own.end_score() / math.log(10))
    before = score_texts(documents(spark, rows), model_0).where("doc_id = 0").first().score
    assert scored[0] > before
    assert score_texts(documents(spark, []), model).collect() == []


def test_frequent_words_are_few_and_change_no_score(spark):
    rows = [(i, t) for i, t in enumerate(random_texts(8, 80, vocabulary=60))]
    model = fit_language_model(documents(spark, rows[:60]), rounds=1)
    counts = Counter(w for _, t in rows[:60] for w in split(lower(t)))
    results = []
    for most in (0, 7, 10_000):
        least, found = _frequent_words(model, most)
        assert found.num_rows <= most
        assert {r["word"].decode(): r["n"] for r in found.to_pylist()} == {
            w: n for w, n in counts.items() if n >= least
        }
        scored = score_texts(documents(spark, rows), model, frequent_words=most).collect()
        results.append({r.doc_id: (r.n_known, r.base_score, r.score) for r in scored})
    for other in results[1:]:
        for key, numbers in results[0].items():
            assert other[key] == pytest.approx(numbers)


def test_prefixes_are_found_as_by_a_dictionary():
    rng = np.random.default_rng(3)
    pieces = sorted({"".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(3000)})
    model = SubwordLattice(pieces, np.full(len(pieces) + 257, -5.0))
    words = ["".join(rng.choice(list("abcde"), 7)) for _ in range(200)]
    codes = np.array([[ord(c) for c in w] for w in words], np.uint64)
    found = {
        (words[w], start, end, pieces[p])
        for start, end, own, piece in model._edges(codes)
        for w, p in zip(own.tolist(), piece.tolist())
    }
    known = set(pieces)
    assert found == {
        (w, i, k, w[i:k]) for w in words for i in range(7) for k in range(i + 1, 8) if w[i:k] in known
    }
