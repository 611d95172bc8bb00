from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import ODD, documents, random_texts, split
from trawl.llm import hashing, substring_dedup
from trawl.llm.substring_dedup import PhraseShard, drop_repeated_passages


def plain(rows, n):
    least = {}
    for i, text in rows:
        words = split(text)
        for k in range(len(words) - n + 1):
            run = tuple(words[k : k + n])
            if i is not None:
                least[run] = min(i, least.get(run, i))
    out = []
    for i, text in rows:
        words = split(text)
        gone = set()
        for k in range(len(words) - n + 1):
            if i is not None and least[tuple(words[k : k + n])] < i:
                gone |= set(range(k, k + n))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def got(table, n, **options):
    rows = drop_repeated_passages(table, window=n, **options).collect()
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in rows], key=repr)


@pytest.mark.parametrize("n", [3, 6])
def test_odd_documents(spark, n):
    assert got(documents(spark, ODD), n) == plain(ODD, n)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_documents(spark, seed):
    rows = list(enumerate(random_texts(seed, 120, vocabulary=8)))
    assert got(documents(spark, rows).repartition(5), 5) == plain(rows, 5)


def test_hot_anchors_and_small_automata(spark):
    shared = " ".join(f"s{i}" for i in range(9))
    rows = [(i, f"{shared} own{i} {shared} a{i} b{i}") for i in range(40)]
    assert got(documents(spark, rows).repartition(4), 4, hot_documents=5, rows_per_automaton=3) == plain(
        rows, 4
    )


def test_a_shard_remembers_a_route_that_goes_on():
    shard = PhraseShard(2)
    assert shard.find([(7, 1, 0, 0, b"a b c")]) == []
    assert shard.find([(7, 2, 0, 4, b"x a b")]) == [(2, 0, 5, 7)]
    assert shard.find([(8, 3, 0, 0, b"a b")]) == []


def test_columns_and_empty_table(spark):
    table = documents(spark, ODD, clashes=True)
    result = drop_repeated_passages(table)
    assert {"lang", "source", "n_words", "n_removed", "kept_text"} <= set(result.columns)
    assert {r.score for r in result.collect()} == {"mine"}
    assert drop_repeated_passages(documents(spark, [])).collect() == []


def test_short_words_are_hashed_many_at_a_time(monkeypatch):
    def one_by_one(word):
        raise AssertionError(word)

    monkeypatch.setattr(hashing.xxhash, "xxh3_64_intdigest", one_by_one)
    texts = [" ".join(f"w{i}" for i in range(k, k + 9)) for k in range(3)]
    batch = pa.record_batch({"id": pa.array([1, 2, 3]), "text": pa.array([*texts])})
    rows = pa.Table.from_batches(substring_dedup._anchor_rows(9)(iter([batch]))).to_pydict()
    assert rows["id"] == [1, 2, 3]


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(
        substring_dedup, "runs", lambda hashes, size, seed=0: np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    )
    texts = ["a b c", "d e f", "a b c"]
    anchor = [[int(hashing.mix(np.zeros(1, np.uint64)).view(np.int64)[0])]] * 3
    columns = {"id": [1, 2, 3], "place": [11, 12, 13], "text": texts, "anchors": anchor, "hot": [[]] * 3}
    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    batch = pa.record_batch([pa.array(c, t) for c, t in zip(columns.values(), types)], names=[*columns])
    found = [r for b in substring_dedup._phrase_rows(3)(iter([batch])) for r in b.to_pylist()]
    assert {(r["id"], r["phrase"]) for r in found} == {(1, b"a b c"), (2, b"d e f"), (3, None)}
    shard = PhraseShard(3)
    rows = [(0, 1, 11, 0, b"a b c"), (0, 2, 12, 0, b"d e f"), (0, 3, 13, 0, b"a b c")]
    assert shard.find(rows) == [(3, 13, 0, 3)]


def test_a_word_repeated_is_one_phrase(spark):
    rows = [(1, "a " * 40), (2, "b " + "a " * 30 + "c " * 3), (3, "c " * 40)]
    assert got(documents(spark, rows), 5) == plain(rows, 5)
