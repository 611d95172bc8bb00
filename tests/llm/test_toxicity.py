from __future__ import annotations

import random
import zlib

import pytest

from tests.llm.cases import ODD, documents
from trawl.llm.common import fold
from trawl.llm.toxicity import (
    LexiconAutomaton,
    ToxicityModel,
    allowed_edits,
    fit_toxicity,
    score_toxicity,
)

BAD = ["scoundrel", "nitwitted", "dunderhead"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_agrees_with_edit_distance():
    rng = random.Random(5)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randrange(2, 12))) for _ in range(25)]
    automaton = LexiconAutomaton(terms)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 13)))
        fits = [distance(word, t) for t in terms if distance(word, t) <= allowed_edits(t)]
        assert automaton.distance(word) == min(fits, default=None), word


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    words = ["".join(rng.choice("lmnopqrstu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    texts, labels = [], []
    for i in range(1200):
        own = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            term = rng.choice(BAD)
            if rng.random() < 0.2:
                term = term[:3] + rng.choice("xyz") + term[4:]
            own.insert(rng.randrange(len(own)), term)
        texts.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    return texts, labels


def test_held_out_accuracy(spark, corpus):
    texts, labels = corpus
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = fit_toxicity(documents(spark, texts), table)
    assert set(BAD) <= set(model.terms)
    truth = dict(labels)
    rows = score_toxicity(documents(spark, texts), model).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    misspelt = documents(spark, [(1, "lm dunderhaed no"), (2, "lm nop qrs"), (3, "lm dundrhead x")])
    scored = {r.doc_id: r.predicted for r in score_toxicity(misspelt, model).collect()}
    assert scored == {1: 1, 2: 0, 3: 1}
    odd = score_toxicity(documents(spark, ODD, clashes=True), model).collect()
    assert len(odd) == len(ODD) and len({r.score for r in odd}) == 1
    assert {r.kept for r in odd} == {"mine"}


def test_labels_of_held_out_rows_and_clean_rows_only_teach_nothing(spark):
    rows = [(i, f"scoundrel number{i} here now") for i in range(30)]
    labels = [(i, 1) for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = fit_toxicity(documents(spark, rows), table)
    assert model.terms == []
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = fit_toxicity(documents(spark, rows), empty)
    assert {r.score for r in score_toxicity(documents(spark, rows), model).collect()} == {0.5}
    assert score_toxicity(documents(spark, []), model).collect() == []


def test_fold(spark):
    rows = spark.createDataFrame([(i,) for i in [0, 7, 123456, None]], "i bigint")
    got = [r[0] for r in rows.select(fold(rows["i"])).collect()]
    assert got == [zlib.crc32(s) % 5 for s in (b"0", b"7", b"123456", b"")]


@pytest.mark.parametrize(
    "text,quoted",
    [
        ("you’re a scoundrel and don’t care", False),
        ("the dogs’ owner is a scoundrel and isn’t nice", False),
        ("“hello” you scoundrel “and bye”", False),
        ('"hello" you scoundrel "and bye"', False),
        ("«un» scoundrel «deux»", False),
        ("they said “you scoundrel” twice", True),
        ("sie sagten „du scoundrel“ und »du« und gingen", True),
        ("he wrote ‘you’re a scoundrel’ there", True),
        ('a 5" screen, "you scoundrel" it said', True),
        ("“" + "long words " * 20 + "scoundrel " + "long words " * 20 + "”", True),
        ("“an open quotation, you scoundrel", False),
        ("“one ‘two’ scoundrel” three", True),
    ],
)
def test_hits_are_quoted_inside_pairs_of_marks_only(text, quoted):
    assert [in_quotes for _, _, in_quotes, _ in ToxicityModel(["scoundrel"]).hits(text)] == [quoted]


@pytest.mark.parametrize("mark", "“ ” „ « » ‹ ‘ ’ … — – ¡ ¿ 、 。 ！   　  ".split(" "))
def test_marks_beyond_ascii_are_no_part_of_a_word(mark):
    model = ToxicityModel(["scum", "scoundrel"])
    for text in (f"you {mark}scum now", f"you scum{mark} now", f"you{mark}scoundrel{mark}now", f"a scum{mark}s"):
        assert [(word, edits) for word, edits, _, _ in model.hits(text)] in ([("scum", 0)], [("scoundrel", 0)])
    assert model.hits("scumé écum") == []


def test_a_quoted_term_that_touches_its_marks():
    quoted = [q for _, _, q, _ in ToxicityModel(["scum"]).hits("“scum” they said, scum… «scum»")]
    assert quoted == [True, False, True]
