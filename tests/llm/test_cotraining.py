from __future__ import annotations

import random

import numpy as np

from tests.llm.cases import ODD, documents
from trawl.llm.cotraining import (
    N_CONTENT,
    N_METADATA,
    _Shapes,
    classify,
    content_features,
    cotrain,
    fit_two_views,
    metadata_features,
)


def corpus(n=900):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        own = [rng.choice(words) for _ in range(rng.randrange(20, 90))]
        if bad:
            own = [w.upper() + "!!" for w in own]
        rows.append((i, " ".join(own)))
        if i % 3 == 0:
            labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = fit_two_views(documents(spark, rows), table)
    found = classify(documents(spark, rows), model).collect()
    known = {i for i, _ in labels}
    unseen = [r for r in found if r.doc_id not in known]
    assert sum(r.kept == (r.doc_id % 5 != 0) for r in unseen) >= 0.98 * len(unseen)
    again = fit_two_views(documents(spark, rows).repartition(7), table)
    assert np.allclose(model.content, again.content)
    odd = classify(documents(spark, ODD, clashes=True), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert {r.held_out for r in odd} == {"mine"}


def test_without_labels_all_stay(spark):
    rows, _ = corpus(60)
    one_kind = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    model = fit_two_views(documents(spark, rows), one_kind)
    assert model is None
    found = classify(documents(spark, ODD), model).collect()
    assert {(r.score, r.kept) for r in found} == {(0.5, True)}
    assert classify(documents(spark, []), model).collect() == []
    assert fit_two_views(documents(spark, []), one_kind) is None


def test_a_view_learns_what_the_other_is_sure_of():
    rng = np.random.default_rng(2)

    def draw(n):
        good = rng.integers(0, 2, n).astype(float)
        rows = rng.normal(size=(n, N_CONTENT + N_METADATA))
        rows[:, 0] += 8 * (good - 0.5)
        rows[:, N_CONTENT] += 2 * (good - 0.5)
        return rows, good

    rows, good = draw(60)
    calibration = np.arange(60) % 2 == 0
    pool, _ = draw(3000)
    test, truth = draw(2000)
    alone = cotrain(rows, good, calibration, pool[:0])
    taught = cotrain(rows, good, calibration, pool)
    right = [((m.scores(test)[:, 1] > 0.5) == truth).mean() for m in (alone, taught)]
    assert right[1] > right[0] + 0.02


def test_features_have_one_form():
    shapes = _Shapes()
    for text in [None, "", "x", "A b\n\nC! d"]:
        assert len(content_features(text, shapes)) == N_CONTENT
        assert len(metadata_features(text, None, None, None)) == N_METADATA
    assert shapes[b"Word,"] == shapes[b"Other,"] != shapes[b"WORD!!"]


def test_words_are_read_whole():
    from trawl.llm.cotraining import SHAPES, _Shapes, content_features

    clean, shapes = "字" * 6400, _Shapes()
    junk = clean[:64] + "aB3$" * 1600
    one, other = (np.array(content_features(t, shapes)[:SHAPES]) for t in (clean, junk))
    assert np.abs(one - other).max() > 0.5
    # A word of up to 64 characters counts once, whatever its length.
    some = np.array(content_features("ab cd " + "e" * 64, shapes)[:SHAPES]) ** 2 * (3 + 5.0)
    assert sorted(some.round(6))[-1] == 3.0
