from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from tests.llm.cases import LONG, ODD, SPACES, documents, random_texts, split
from trawl.llm.quality_rules import (
    IsolationForest,
    QualityModel,
    fit_quality,
    judge_quality,
    rule_statistics,
)


def plain(text):
    text = text or ""
    words = split(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if times[run] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_base_counts():
    texts = [t for _, t in ODD] + random_texts(4, 300, vocabulary=3)
    texts += ["a\nb\na\n \n\n#|<> *x*\na", "x y z x y z x y z x y z", "\x1c \x85   a"]
    for text in texts:
        assert rule_statistics(text)[:5] == plain(text), text


def labelled(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(800):
        own = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        bad = i % 7 == 0
        if bad:
            own = [w + rng.choice(["###", "***"]) if i % 2 else w.upper() + "!!" for w in own]
        rows.append((i, " ".join(own)))
        labels.append((i, int(not bad)))
    return rows, labels


def test_anomalous_documents_go_and_others_stay(spark):
    rows, labels = labelled(spark)
    known = spark.createDataFrame(labels[:500], "doc_id bigint, quality int")
    model = fit_quality(documents(spark, rows), known)
    truth = dict(labels)
    unseen = [r for r in judge_quality(documents(spark, rows), model).collect() if r.doc_id >= 500]
    assert sum(r.kept == bool(truth[r.doc_id]) for r in unseen) >= 0.98 * len(unseen)
    odd = judge_quality(documents(spark, ODD, clashes=True), model).collect()
    assert len(odd) == len(ODD)
    for r in odd:
        n, *_, repeats = plain(r.text)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n) and not (r.base_failed and r.kept)
    assert {r.spans for r in odd} == {"mine"}


def test_without_labels_only_the_base_rules_count(spark):
    rows = [(1, "few words"), (2, " ".join(f"w{i}" for i in range(30))), (3, LONG)]
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    model = fit_quality(documents(spark, rows), empty)
    assert model == QualityModel(None, 2.0)
    kept = {r.doc_id: r.kept for r in judge_quality(documents(spark, rows), model).collect()}
    assert kept == {1: False, 2: True, 3: False}
    only_good = spark.createDataFrame([(2, 1), (2, 1), (3, 1)], "doc_id bigint, quality int")
    model = fit_quality(documents(spark, rows), only_good)
    assert judge_quality(documents(spark, rows), model).where("doc_id = 2").first().kept
    assert judge_quality(documents(spark, []), model).collect() == []


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(1)
    rows = np.hstack([rng.normal(size=(500, 3)), np.zeros((500, 1))])
    forest = IsolationForest(rows)
    far = forest.scores(np.array([[9.0, 0, 0, 0], [0, 0, 0, 5.0]]))
    assert far.min() > forest.scores(rows).mean() + 0.1
    assert (forest.scores(rows[:5]) == IsolationForest(rows).scores(rows[:5])).all()


def test_every_count_reaches_the_forest(spark):
    rows, labels = labelled(spark)
    model = fit_quality(
        documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    )
    rng = random.Random(6)
    words = sorted({w for i, t in rows if i % 7 for w in t.split()})
    own = [rng.choice(words) for _ in range(108)]
    shared = "\n".join(" ".join(own[i : i + 9]) + "\nShare this page" for i in range(0, 108, 9))
    joined = " ".join("".join(own[i : i + 3]) for i in range(0, 108, 3))
    planted = [(1, " ".join(own)), (2, shared), (3, joined)]
    judged = {r.doc_id: r for r in judge_quality(documents(spark, planted), model).collect()}
    assert not any(r.base_failed for r in judged.values())
    assert judged[1].kept and not judged[2].kept
    good = [r.score for r in judge_quality(documents(spark, rows), model).collect() if r.doc_id % 7]
    assert min(judged[2].score, judged[3].score) > max(*good, judged[1].score)
