from __future__ import annotations

import random
import re

import pytest

from tests.llm.cases import ODD, documents, lower
from trawl.llm.decontamination import ItemAutomaton, decontaminate, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(lower(text))


def plain(text, items, n):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        sequence = words(item)
        size = min(n, len(sequence))
        for k in range(len(sequence) - size + 1) if size else ():
            for i in range(len(own) - size + 1):
                if own[i : i + size] == sequence[k : k + size]:
                    hit |= set(range(i, i + size))
                    found.add(str(name))
    return len(own), len(hit), sorted(found)


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def random_words(rng, most, vocabulary=3):
    return " ".join(rng.choice("abcdefg"[:vocabulary]) for _ in range(rng.randrange(most)))


@pytest.mark.parametrize("parts", [1, 3])
def test_random_documents(spark, parts):
    rng = random.Random(parts)
    items = [(i, random_words(rng, 12)) for i in range(9)] + [(9, None), (3, "a c a")]
    rows = [(i, random_words(rng, 40, 4)) for i in range(150)]
    size = sum(len(t or "") for _, t in items) // parts + 1
    marked = decontaminate(
        documents(spark, rows), items_table(spark, items), window=5, chars_per_automaton=size
    )
    for r in marked.collect():
        got = (r.n_words, r.n_hit, r["items"])
        assert got == plain(dict(rows)[r.doc_id], items, 5), r.text
        assert r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"])


def test_automaton_against_plain_search():
    rng = random.Random(3)
    for _ in range(300):
        items = [(str(i), random_words(rng, 15, 2)) for i in range(rng.randrange(5))]
        text = random_words(rng, 30, 3)
        spans, found = ItemAutomaton(items, 4).find(words_of(text))
        covered = sorted(w for a, b in spans for w in range(a, b))
        own = plain(text, items, 4)
        assert (len(set(covered)), sorted(found)) == own[1:] and len(covered) == len(set(covered))


def test_passages_are_cut_from_the_text(spark):
    item = "The quick, brown fox; jumps over!"
    rows = [(1, f"Before. {item} After."), (2, "quick brown dog"), (3, None)]
    table = items_table(spark, [(1, item)])
    marked = {r.doc_id: r for r in decontaminate(documents(spark, rows), table, window=4).collect()}
    assert marked[1].clean_text == "Before. ! After." and marked[1].n_hit == 6
    assert marked[2].clean_text == rows[1][1] and marked[3].clean_text is None
    kept = decontaminate(
        documents(spark, rows), table, window=4, least_words=7, least_coverage=0.9
    ).where("doc_id = 1").first()
    assert kept.clean_text == rows[0][1] and kept.contaminated


def test_odd_documents_and_empty_tables(spark):
    items = [(1, "one"), (2, "Same text here AND"), (None, "no id"), (4, "é" * 3000), (5, "")]
    marked = decontaminate(documents(spark, ODD, clashes=True), items_table(spark, items), window=3)
    named = [("" if i is None else i, t) for i, t in items]
    for r in marked.collect():
        assert (r.n_words, r.n_hit, r["items"]) == plain(r.text, named, 3)
        assert r.score == "mine"
    nothing = decontaminate(documents(spark, ODD), items_table(spark, []))
    assert {(r.n_hit, r.contaminated) for r in nothing.collect()} == {(0, False)}
    assert decontaminate(documents(spark, []), items_table(spark, items)).collect() == []
