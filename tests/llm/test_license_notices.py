from __future__ import annotations

import random
import re

from tests.llm.cases import LONG, ODD, documents, lower
from tests.conftest import SAMPLE
from trawl.llm.license_notices import (
    BASE,
    NOTICES,
    Notice,
    NoticeFinder,
    op12_license_notices,
    pieces_of,
    scan_notices,
)

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WORDY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of it",
    "Licensed under the Apache License, Version 2.0.",
    "released under the MIT License",
    "CC BY-NC 4.0 and CC-BY-SA",
    "This work is licensed under the GNU General Public License, version 3.",
    "All rights reserved.",
)


def split_notice(notice):
    """Characters of a notice and whether each has to stand as it is."""
    chars, kept, fixed = [], [], False
    for c in notice.words:
        if c in "{}":
            fixed = c == "{"
        else:
            chars.append(c)
            kept.append(fixed)
    return "".join(chars), kept


def distance(phrase, kept, other):
    """Edits between a phrase and another one, where none may touch the kept characters."""
    far = 10**6
    row = list(range(len(other) + 1))
    if kept[0]:
        row = [0] + [far] * len(other)
    for i, c in enumerate(phrase):
        inside = kept[i] and i + 1 < len(phrase) and kept[i + 1]  # no insertion between the two
        new = [row[0] + 1 if not kept[i] else far]
        for j, d in enumerate(other):
            cost = row[j] + (0 if c == d else far if kept[i] else 1)
            if not kept[i]:
                cost = min(cost, row[j + 1] + 1)
            if not inside and not (kept[i] and (i + 1 == len(phrase) or kept[i + 1])):
                cost = min(cost, new[j] + 1)
            new.append(cost)
        row = new
    return row[-1]


def brute_labels(text, notices):
    """Labels of notices within their edits of some run of whole words."""
    words = WORD.findall(lower(text))
    found = set()
    for notice in notices:
        phrase, kept = split_notice(notice)
        most = 0 if all(k or c == " " for c, k in zip(phrase, kept)) else min(4, len(phrase) // 10)
        for i in range(len(words)):
            run = ""
            for word in words[i:]:
                run = f"{run} {word}" if run else word
                if len(run) > len(phrase) + most:
                    break
                if len(run) >= len(phrase) - most and distance(phrase, kept, run) <= most:
                    found.add(notice.label)
    return sorted(found)


def brute_places(text, phrase):
    words, wanted = WORD.findall(lower(text)), phrase.split(" ")
    return [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]


def spoilt(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        chars[at : at + 1] = [] if kind == 0 else [rng.choice("aeix ")] + ([chars[at]] if kind == 1 else [])
    return "".join(chars)


def test_labels_are_those_of_brute_force():
    rng = random.Random(5)
    finder = NoticeFinder(NOTICES)
    seen = set()
    for _ in range(30):
        lines = [spoilt(rng, rng.choice(WORDY), rng.randrange(4)) for _ in range(2)]
        text = "\n".join(["some words mit ohne", *lines, "the end under the"])
        n_words, spans = finder.find(text)
        assert sorted({s.label for s in spans}) == brute_labels(text, NOTICES), text
        assert n_words == len(WORD.findall(lower(text)))
        for span in spans:
            phrase, kept = split_notice(NOTICES[span.notice])
            words = WORD.findall(lower(text))[span.first_word : span.first_word + span.n_words]
            assert distance(phrase, kept, " ".join(words)) == span.edits
            assert WORD.findall(lower(text[span.first : span.after])) == words
        seen |= {s.edits for s in spans}
    assert seen >= {0, 1, 2}


def test_a_piece_survives_any_edits():
    for notice in NOTICES:
        phrase, _ = split_notice(notice)
        for edits in range(5):
            pieces = pieces_of(phrase, edits)
            assert "".join(p for _, p in pieces) == phrase and len(pieces) == edits + 1
            assert all(phrase[at:].startswith(p) and p for at, p in pieces)


def test_words_that_tell_licences_apart_stay():
    finder = NoticeFinder(NOTICES)
    labels = lambda text: {s.label for s in finder.find(text)[1]}
    assert labels("Released under the MPL license") == set()
    assert labels("CC BY-ND 4.0") == {"cc-by-nd"}
    assert labels("undr the MIT licence") == {"mit"}
    assert labels("under the mit licenses and more") == {"mit"}
    assert labels("mit mit under license the") == set()
    assert labels("GNU Generel Public Licence, version 2") == {"gpl", "gpl-2"}


def test_query_on_planted_documents(spark, tmp_path):
    texts = [
        "Under the MIT License. under the mit-license\nunder, the MIT license",
        "x under the mit licence y",
        "Apache License, Version 2.0 and CC BY-NC and cc by nc nc",
        "nothing here",
        None,
        "",
    ]
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op12_license_notices(spark, str(tmp_path)).collect()}
    assert (rows[0].n_base, rows[0].first_word, rows[0].last_word) == (3, 0, 8)
    assert (rows[0].base_labels, rows[0].labels, rows[0].score) == ("mit", "mit", 1.0)
    assert (rows[1].n_base, rows[1].first_word, rows[1].base_labels) == (0, None, "")
    assert rows[1].labels == "mit" and 0.9 < rows[1].score < 1
    assert rows[2].base_labels == "apache-2,cc-by-nc" and rows[2].n_base == 3
    for i in (3, 4, 5):
        assert (rows[i].n_base, rows[i].labels, rows[i].score) == (0, "", 0.0)
    assert rows[4].n_words == rows[5].n_words == 0 and len(rows) == 6


def test_query_on_the_sample(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()}
    for row in op12_license_notices(spark, SAMPLE).collect():
        text = texts.pop(row.doc_id)
        places = {n.label: brute_places(text, split_notice(n)[0]) for n in BASE}
        starts = sorted(p for own in places.values() for p in own)
        assert row.n_words == len(WORD.findall(lower(text))) and row.n_base == len(starts)
        assert (row.first_word, row.last_word) == ((starts[0], starts[-1]) if starts else (None,) * 2)
        assert row.base_labels == ",".join(sorted(k for k, own in places.items() if own))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
    assert not texts


def test_odd_documents_and_own_columns(spark):
    table = documents(spark, ODD, clashes=True)
    out = scan_notices(table)
    own = [c for c in table.columns if c not in ("n_words", "spans", "score", "labels")]
    assert out.columns == own + ["n_words", "spans", "labels", "score"]
    rows = out.collect()
    assert len(rows) == len(ODD) and {r.kept for r in rows} == {"mine"}
    assert all(r.spans == [] and r.labels == [] and r.score == 0 for r in rows)
    assert scan_notices(documents(spark, [])).collect() == []
    named = scan_notices(documents(spark, [(1, "a bc d")]), [Notice("own", "{bc}")]).first()
    assert named.labels == ["own"] and named.spans[0].first_word == 1


def test_very_long_and_repetitive_texts():
    finder = NoticeFinder(NOTICES)
    text = LONG + "under the mit license " + "under the " * 20_000
    n_words, spans = finder.find(text)
    assert [s.first_word for s in spans if s.edits == 0] == [8000] and n_words == 48_004
    many = finder.find("all rights reserved " * 5_000)[1]
    assert len(many) == 5_000 and many[-1].first_word == 3 * 4_999
    assert finder.find("x" * 300_000) == (1, [])
