from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import hard_negatives
from trawl.llm.hard_negatives import (
    BlockSearch,
    Windows,
    blocks_to_read,
    build_blocks,
    mine_hard_negatives,
    score_bounds,
)
from trawl.llm.hilbert import curve_keys

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def kept_rows(rows):
    kept = {}
    dims = max([len(v) for _, v, _ in rows if v is not None], default=0)
    limit = min(2**27, math.isqrt(2**56 // max(1, dims)))
    for own_id, vector, label in rows:
        if own_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) or abs(x * 256) >= limit for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        kept[own_id] = min(kept.get(own_id, (math.inf, [])), (label, whole))
    return {i: (label, v + [0] * (dims - len(v))) for i, (label, v) in kept.items()}


def brute(rows, every=10, positives=5, negatives=10, least=30, most=90):
    kept, out = kept_rows(rows), []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, other == label)
            for i, (other, w) in kept.items()
            if i != a
        )
        for minus, p, _ in [s for s in scores if s[2]][:positives]:
            fits = [
                (a, p, n, -minus, -s)
                for s, n, same in scores
                if not same and least * -minus <= 100 * -s <= most * -minus
            ]
            out += [(a, p, k + 1, n, ps, ns) for k, (a, p, n, ps, ns) in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in mine_hard_negatives(table, anchor_every=10, **options).collect())


def random_rows(seed, n, dims=6, labels=3, spread=0.4, clusters=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        vector = np.array([x + rng.gauss(0, spread) for x in centre], np.float32)
        rows.append((i, vector.tolist(), rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 1), (2, 4), (3, 3), (4, 2), (7, 1)])
def test_the_curve_meets_every_cell_and_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
    keys = curve_keys(cells, bits)
    order = sorted(range(len(keys)), key=keys.__getitem__)
    assert len(set(keys)) == len(cells)
    assert set(np.abs(np.diff(cells[order], axis=0)).sum(axis=1)) <= {1}


def test_bounds_hold_for_every_row_of_a_box():
    rng = np.random.default_rng(1)
    for _ in range(50):
        box, anchors = rng.integers(-50, 50, (8, 5)), rng.integers(-50, 50, (4, 5))
        least, most = score_bounds(anchors, box.min(axis=0), box.max(axis=0))
        scores = anchors @ box.T
        assert (scores >= least[:, None]).all() and (scores <= most[:, None]).all()
        assert (score_bounds(anchors, box[0], box[0])[0] == scores[:, 0]).all()


def test_random_vectors_against_brute_force(spark):
    rows = random_rows(1, 300)
    wanted = brute(rows)
    assert wanted and mined(spark, rows, rows_per_block=16) == wanted
    assert mined(spark, rows, rows_per_block=7, anchors_per_round=4) == wanted


def test_other_numbers_of_positives_and_shares(spark):
    rows = random_rows(2, 150, dims=3)
    options = {"positives": 2, "negatives": 3}
    found = mined(spark, rows, least_share=0, most_share=150, rows_per_block=8, **options)
    assert found == brute(rows, least=0, most=150, **options) and found


def test_ties_go_by_id_and_equal_vectors_are_many(spark):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(0, 90)]
    rows += [(i, [0.5, 0.25], i % 3) for i in range(90, 180)]
    wanted = brute(rows)
    assert wanted and mined(spark, rows, rows_per_block=8) == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 0),
        (1, [1.0, 0.5], 0),
        (2, [0.5, 0.5], 1),
        (2, [0.5, 0.5], 1),
        (3, [0.5, 0.25], 2),
        (3, [0.25, 0.25], 1),
        (4, None, 0),
        (5, [1.0, None], 0),
        (6, [nan, 1.0], 0),
        (7, [inf, 1.0], 0),
        (8, [1.0, 1.0], None),
        (None, [1.0, 1.0], 0),
        (9, [0.75], 1),
        (10, [], 1),
        (20, [-1.0, -1.0], 5),
        (30, [0.0, 0.0], 0),
        (11, [1e30, 0.0], 0),
    ]
    wanted = brute(rows)
    assert wanted and mined(spark, rows) == wanted
    assert mined(spark, [(10, [1.0], 1)]) == [] and mined(spark, []) == []
    assert mined(spark, [(10, None, 1), (None, [1.0], None)]) == []


def test_other_columns_are_not_looked_at(spark):
    rows = random_rows(3, 60)
    table = spark.createDataFrame(rows, SCHEMA)
    names = ["block", "key", "vec", "floor", "score", "rank", "window"]
    table = table.withColumns({n: F.lit("mine") for n in names})
    found = mine_hard_negatives(table, anchor_every=10)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_zone_maps_choose_few_blocks_where_vectors_lie_apart(spark, folder):
    rows = random_rows(4, 2_000, dims=4, labels=2, spread=0.02, clusters=12)
    blocks = build_blocks(spark.createDataFrame(rows, SCHEMA), folder, rows_per_block=32)
    n = blocks.zones.count()
    label, vector = kept_rows(rows)[0]
    facts = (np.array([vector]), np.array([label]), np.array([0]), np.array([0]))
    scores = sorted(np.dot(vector, w) for i, (k, w) in kept_rows(rows).items() if k == label and i)
    windows = Windows(*facts, np.array([scores[-5]]), np.array([2**62]), 5, True)
    chosen = [row.block for row in blocks_to_read(blocks, windows).collect()]
    assert 0 < len(chosen) < n / 6
    held = {r.vec_id for r in blocks.rows.where(F.col("block").isin(chosen)).collect()}
    best = [i for i, (k, w) in kept_rows(rows).items() if i and k == label and np.dot(vector, w) >= scores[-5]]
    assert set(best) <= held
    # Blocks keep to the size asked for and to one label.
    sizes = blocks.rows.groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("label").alias("k"))
    assert sizes.where("n > 32 or k > 1").isEmpty()


def test_a_full_window_passes_over_blocks_that_cannot_better_it():
    facts = (np.array([[1, 0]]), np.array([0]), np.array([7]), np.array([0]))
    search = BlockSearch(Windows(*facts, np.array([-(2**62)]), np.array([2**62]), 2, True))
    assert search.read(0, np.array([1, 2, 3]), np.array([[5, 0], [4, 9], [3, 0]])) == 1
    assert search.read(1, np.array([4]), np.array([[9, 9]])) == 0  # another label
    assert search.read(0, np.array([5]), np.array([[3, 50]])) == 0  # scores less
    assert search.read(0, np.array([6]), np.array([[4, 1]])) == 0  # equal, but a greater id
    assert search.read(0, np.array([0]), np.array([[4, 1]])) == 1
    assert search.best().to_pydict() == {"window": [0, 0], "score": [5, 4], "vec_id": [1, 0]}


def test_many_chosen_blocks_are_read_by_their_parts(spark, monkeypatch):
    rows = random_rows(6, 200)
    monkeypatch.setattr(hard_negatives, "BLOCKS_LISTED", 3)
    assert mined(spark, rows, rows_per_block=8) == brute(rows)
    monkeypatch.setattr(hard_negatives, "STRETCHES", 2)
    assert mined(spark, rows, rows_per_block=8) == brute(rows)
