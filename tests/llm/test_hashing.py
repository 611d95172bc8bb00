from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import ODD, split
from trawl.llm import hashing

TEXTS = [
    *(text for _, text in ODD),
    "".join(random.Random(1).choice("ab é\n\t\x1c\x85　xyz") for _ in range(2000)),
    *("x" * n for n in (7, 8, 9, 15, 16, 17, 63, 64, 65, 1000)),
    None,
]


@pytest.mark.parametrize("size", [1, 50, 2_000_000])
def test_words_of_slices_are_those_of_each_text(monkeypatch, size):
    monkeypatch.setattr(hashing, "TEXT_BYTES", size)
    texts = pa.array(["cut off", *TEXTS], pa.string()).slice(1)
    found, hashes = [], {}
    for begin, end in hashing.text_slices(texts):
        words = hashing.find_words(texts.slice(begin, end - begin))
        edges = words.start.tolist()
        all_words = [words.joined[a : b - 1].tobytes() for a, b in zip(edges, edges[1:])]
        found += [all_words[a:b] for a, b in zip(words.first, words.first[1:])]
        for word, value in zip(all_words, hashing.word_hashes(words).tolist()):
            assert hashes.setdefault(word, value) == value
    assert found == [[w.encode() for w in split(text)] for text in TEXTS]
    assert len(set(hashes.values())) == len(hashes)


def test_no_texts():
    assert list(hashing.text_slices(pa.array([], pa.string()))) == []
    words = hashing.find_words(pa.array([None, ""], pa.string()))
    assert len(hashing.word_hashes(words)) == 0 and words.first.tolist() == [0, 0, 0]


def test_least_of_runs():
    values = np.random.default_rng(1).integers(0, 99, 30)
    for size in range(1, 32):
        plain = [values[i : i + size].min() for i in range(len(values) - size + 1)]
        assert hashing.least_of_runs(values, size).tolist() == plain
