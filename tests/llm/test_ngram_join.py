from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import ODD, documents, lower, random_texts, split
from trawl.llm import hashing, ngram_join
from trawl.llm.components import components
from trawl.llm.ngram_join import (
    RULE,
    Rule,
    keep_one_of_each,
    linked_pairs,
    ngram_groups,
    odd_sketch,
    part_keys,
    possible_pairs,
    shingle_sets,
    subset_keys,
)


def shingles(text, size=3):
    words = split(lower(text))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain(rows, size=3, percent=90):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                up[top(i)] = top(j)
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((own, len(sets[i]), min(ids) if ids and sets[i] else own))
    return sorted(out, key=repr)


def got(table, rule=RULE):
    rows = ngram_groups(table, rule=rule).collect()
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in rows], key=repr)


def near_copies(seed, n, least, most):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.8:
            own = rng.choice(texts).split()
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            own = own[rng.randrange(2) :]
        else:
            own = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(least, most))]
        texts.append(" ".join(own))
    return list(enumerate(texts))


def test_odd_documents(spark):
    assert got(documents(spark, ODD)) == plain(ODD)
    table = documents(spark, ODD, clashes=True)
    assert {r.score for r in ngram_groups(table).collect()} == {"mine"}
    assert ngram_groups(documents(spark, [])).collect() == []


@pytest.mark.parametrize("least,most", [(8, 26), (60, 160)])
def test_near_copies(spark, least, most):
    rows = near_copies(least, 150, least, most)
    assert got(documents(spark, rows).repartition(3)) == plain(rows)


@pytest.mark.parametrize("least,most", [(8, 16), (40, 120)])
def test_other_rules(spark, least, most):
    rows = near_copies(least + 1, 120, least, most) + ODD
    rule = Rule(words=5, percent=80)
    assert got(documents(spark, rows).repartition(3), rule) == plain(rows, 5, 80)


def test_near_copies_of_the_pipeline(spark):
    words = [f"w{i}" for i in range(100)]
    changed = ["x" if i in (30, 60) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed))]
    assert {c for _, _, c in got(documents(spark, rows), Rule(5, 80))} == {1}
    assert {c for _, _, c in got(documents(spark, rows))} == {1, 2}
    with pytest.raises(ValueError):
        Rule(5, 30)


def test_columns_of_any_name_stay(spark):
    docs = documents(spark, ODD)
    own = docs.withColumns({c: docs.doc_id for c in ("_place", "__found", "_found")})
    for result in (ngram_groups(own), keep_one_of_each(own)):
        assert {"_place", "_found", "__found"} <= set(result.columns)
        assert all(r._place == r.doc_id == r._found for r in result.collect())


def test_sets_with_the_same_empty_part_are_not_listed_together():
    rng = np.random.default_rng(5)
    for rule in (RULE, Rule(5, 80)):
        sets = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(1500)]
        keys = np.concatenate([part_keys(s, rule) for s in sets])
        assert len(np.unique(keys)) > 0.999 * len(keys)


def test_one_of_each_group_stays(spark):
    rows = [(i + 100, t) for i, t in near_copies(5, 60, 30, 60)] + ODD
    kept = keep_one_of_each(documents(spark, rows)).collect()
    groups = plain(rows)
    empty = {i for i, t in rows if not split(t)}
    wanted = {c for i, _, c in groups if i not in empty}
    assert {r.doc_id for r in kept if r.doc_id not in empty} == wanted
    assert len([r for r in kept if r.doc_id not in empty]) == len(wanted)


@pytest.mark.parametrize("rule", [RULE, Rule(5, 80), Rule(2, 60)])
def test_keys_are_shared_by_all_similar_sets(rule):
    rng = np.random.default_rng(7)
    for _ in range(1500):
        n = int(rng.integers(1, 90))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        differ = int(rng.integers(0, max(1, n * (100 - rule.percent) // 100) + 1))
        drop, add = int(rng.integers(0, differ + 1)), int(rng.integers(0, differ + 1))
        b = np.unique(np.append(a[drop:], rng.integers(0, 2**63, add).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        if not len(b) or not rule.similar(both, len(a), len(b)):
            continue
        assert set(part_keys(a, rule)) & set(part_keys(b, rule))
        if max(len(a), len(b)) < rule.largest_boundary:
            assert set(subset_keys(a)) & set(subset_keys(b))


def test_links_of_many_sets_agree_with_plain_comparison():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 10**6, 60).astype(np.uint64)
    sets = []
    for _ in range(40):
        own = base.copy()
        own[rng.integers(0, 60, rng.integers(0, 7))] = rng.integers(0, 10**6)
        sets.append(np.unique(own))
    few = list(linked_pairs(sets[:20]))
    many = list(linked_pairs(sets))
    for found, part in ((few, sets[:20]), (many, sets)):
        for i, j in found:
            both = len(np.intersect1d(part[i], part[j]))
            assert 100 * both >= 90 * (len(part[i]) + len(part[j]) - both)
    assert len(few) < 20 and len(many) < 40


def test_large_clusters_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ELEMENTS", 4_000)
    rows = near_copies(11, 120, 60, 61)
    assert got(documents(spark, rows).repartition(3)) == plain(rows)


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(9)
    for n in (1, 2, 31, 32, 33, 300, 1025):
        for share in (0.0, 0.5, 0.8, 0.95, 1.0):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            more = rng.integers(0, 2**63, int(rng.integers(0, n + 1))).astype(np.uint64)
            b = np.unique(np.append(a[: max(1, int(n * share))], more))
            width = min(len(odd_sketch(a)), len(odd_sketch(b)))
            folded = [ngram_join._folded(odd_sketch(x)[None, :], width) for x in (a, b)]
            differ = int(np.bitwise_count(folded[0] ^ folded[1]).sum())
            assert differ <= len(np.setxor1d(a, b)) and len(odd_sketch(a)) * 64 >= 2 * len(a)


@pytest.mark.parametrize("rule", [RULE, Rule(5, 80), Rule(2, 50)])
def test_possible_pairs_connect_all_similar_sets(rule):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 10**9, 700).astype(np.uint64)
    sets = []
    for _ in range(120):
        own = base[: int(rng.integers(20, 700))].copy()
        own[rng.integers(0, len(own), rng.integers(0, 9))] = rng.integers(0, 10**9)
        sets.append(np.unique(own))
    sizes = np.array([len(s) for s in sets])
    sketches = [odd_sketch(s).tobytes() for s in sets]
    links = {
        (i, j)
        for i in range(120)
        for j in range(i)
        if rule.similar(len(np.intersect1d(sets[i], sets[j])), sizes[i], sizes[j])
    }
    for own in (np.ones(120, bool), np.arange(120) % 3 == 0):
        label = list(range(120))
        for i, j in possible_pairs(sizes, sketches, own, rule):
            assert own[i] or own[j]
            label = [label[i] if x == label[j] else x for x in label]
        assert links and all(label[i] == label[j] for i, j in links if own[i] or own[j])


def test_documents_that_share_passages_only_are_parted_before_texts_are_compared(
    spark, monkeypatch
):
    rng = random.Random(8)
    passages = [" ".join(f"p{k}w{i}" for i in range(60)) for k in range(20)]
    rows = []
    for i in range(60):
        own = " ".join(f"own{i}n{k}" for k in range(500))
        rows.append((i, " ".join([own, *rng.sample(passages, 12)])))
    rows += [(100 + i, text + " end") for i, text in rows[:2]]
    compared = []
    plain_sets = ngram_join._member_sets

    def counted(docs, place, text, chosen, rule):
        compared.append(chosen.count())
        return plain_sets(docs, place, text, chosen, rule)

    monkeypatch.setattr(ngram_join, "_member_sets", counted)
    rule = Rule(words=5, percent=80)
    assert got(documents(spark, rows).repartition(3), rule) == plain(rows, 5, 80)
    assert compared[-1] == 4


@pytest.mark.parametrize("least,most", [(8, 26), (60, 160)])
def test_sketches_of_large_clusters_meet_by_size_in_blocks(spark, monkeypatch, least, most):
    monkeypatch.setattr(ngram_join, "BLOCK_SKETCHES", 1_000)
    rows = near_copies(least + 2, 120, least, most) + ODD
    for rule, words, percent in ((RULE, 3, 90), (Rule(5, 80), 5, 80)):
        assert got(documents(spark, rows).repartition(3), rule) == plain(rows, words, percent)


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, i) for i in range(1001, 3000)]
    table = spark.createDataFrame(path + star + star, "a bigint, b bigint")
    found = {r.node: r.component for r in components(table).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 3000), 1000)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(40, 50), (50, 60), (45, 60), (7, 7)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in components(table).collect()}
    assert found == {**dict.fromkeys(range(21), 0), **dict.fromkeys([40, 45, 50, 60], 40)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("size", [1, 60, 2_000_000])
def test_sets_of_slices_are_those_of_each_text(monkeypatch, size):
    monkeypatch.setattr(hashing, "TEXT_BYTES", size)
    texts = [t for _, t in ODD] + ["One two THREE four five", "one two three four", "a", "A b", None]
    for words in (1, 3, 5):
        found = [s.tolist() for s in shingle_sets(pa.array(texts, pa.string()), words)]
        assert [len(s) for s in found] == [len(shingles(t, words)) for t in texts]
        assert all(s == sorted(set(s)) for s in found)
        values = {}
        for own, text in zip(found, texts):
            assert values.setdefault(frozenset(shingles(text, words)), own) == own
        assert len({tuple(v) for v in values.values()}) == len(values)


def test_lists_are_read_in_the_order_of_keys_alone(spark):
    """Lists longer than a batch hold together, and the same ties are told once."""
    rows = [(key, key // 50 * 1000 + i) for key in range(100) for i in range(30)]
    table = spark.createDataFrame(rows + [(1000 + i, i) for i in range(50)], "key bigint, set bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        ties = ngram_join._list_edges(table)
        plan = ties._jdf.queryExecution().executedPlan().toString()
        found = sorted(tuple(r) for r in ties.collect())
        reached = {r.node: r.component for r in components(ties).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "Sort [key#" in plan and "ASC NULLS FIRST, set#" not in plan
    assert all(a < b for a, b in found) and len(found) == len(set(found)) < 60 * 8
    assert reached == {g * 1000 + i: g * 1000 for g in (0, 1) for i in range(30)}


def test_unlike_sets_are_parted_by_folded_sketches(monkeypatch):
    rng = np.random.default_rng(4)
    rule = Rule(5, 80)
    assert (rule.folds, RULE.folds, Rule(2, 50).folds) == (4, 8, 1)
    sets = [np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64)) for _ in range(80)]
    sets += [np.append(sets[0][:-20], sets[1][:20])]
    looked_at = []
    bits = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: looked_at.append(x.size) or bits(x))
    sizes, sketches = np.array([len(s) for s in sets]), [odd_sketch(s).tobytes() for s in sets]
    pairs = list(possible_pairs(sizes, sketches, np.ones(81, bool), rule))
    assert [set(p) for p in pairs] == [{0, 80}]
    assert sum(looked_at) < 0.35 * 81 * 80 / 2 * len(sketches[0]) / 8
