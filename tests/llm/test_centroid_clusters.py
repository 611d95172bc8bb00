from __future__ import annotations

import hashlib
import math
import os
import random

from pyspark.sql import functions as F

from trawl.llm import centroid_clusters
from trawl.llm.centroid_clusters import cluster_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, clusters, rounds, dims):
    """Clusters and squared distances, all distances worked out anew in every round."""
    kept = []
    for own_id, vector, *_ in rows:
        if vector is None or len(vector) != dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if max(map(abs, whole), default=0) < 2**27:
            kept.append((own_id, whole))
    text = lambda own_id: "2:" + ("" if own_id is None else str(own_id))
    order = sorted(kept, key=lambda r: (hashlib.sha256(text(r[0]).encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, own in groups.items():
            centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    found = [(own_id, *reversed(nearest(v))) for own_id, v in kept]
    return sorted(found, key=repr), centroids


def check(spark, rows, clusters=4, rounds=3, dims=3):
    found = cluster_vectors(spark.createDataFrame(rows, SCHEMA), clusters, rounds, dims)
    got = sorted([(r.vec_id, r.cluster, r.distance) for r in found.rows.collect()], key=repr)
    wanted, centroids = brute(rows, clusters, rounds, dims)
    assert got == wanted and found.centroids.tolist() == centroids
    sums = [sum(d for _, k, d in wanted if k == i) for i in range(len(centroids))]
    assert found.inertias == sums
    return found


def test_random_vectors_against_brute_force(spark):
    rng = random.Random(3)
    for spread in (0.01, 1.0):  # the lesser one makes equal vectors and ties
        rows = [(i, [rng.gauss(0, spread) for _ in range(5)], 0) for i in range(120)]
        rows = [(i, [float(F32(x)) for x in v], k) for i, v, k in rows]
        check(spark, rows, clusters=7, rounds=4, dims=5)


def F32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0),
        (2, [], 0),
        (3, [1.0, 2.0], 0),
        (4, [1.0, None, 2.0], 0),
        (5, [1.0, nan, 2.0], 0),
        (6, [1.0, -inf, 2.0], 0),
        (7, [1e30, 0.0, 0.0], 0),
        (8, [524287.0, -524287.0, 0.0], 0),
        (9, [0.5, 0.25, -0.125], None),
        (9, [0.5, 0.25, -0.125], 1),
        (9, [-3.0, 0.0, 0.0], 1),
        (None, [1.0, 1.0, 1.0], 1),
        (10, [0.0, 0.0, 0.0], 1),
    ]
    found = check(spark, rows)
    assert found.rows.columns == ["vec_id", "embedding", "label", "cluster", "distance"]
    check(spark, rows, clusters=40)
    check(spark, rows, clusters=2, rounds=0)


def test_equal_vectors_leave_clusters_empty(spark):
    found = check(spark, [(i, [0.5, 0.5, 0.5], 0) for i in range(30)])
    assert {r.cluster for r in found.rows.collect()} == {0} and found.inertias == [0, 0, 0, 0]


def test_empty_table_and_own_columns(spark):
    none = cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert none.rows.collect() == [] and none.inertias == []
    rows = spark.createDataFrame([(1, [1.0, 0.0, 0.0], 3)], SCHEMA)
    names = ["own", "vec", "norm", "dots", "cluster", "distance"]
    rows = rows.withColumns({n: F.lit("mine") for n in names})
    found = cluster_vectors(rows, dims=3).rows
    assert found.columns == ["vec_id", "embedding", "label", *names]
    row = found.first()
    assert (row.own, row.vec, row.norm, row.dots) == ("mine",) * 4
    assert (row.cluster, row.distance) == (0, 0)


def test_one_state_is_left_in_the_shared_folder(spark, monkeypatch):
    folders = []
    plain = centroid_clusters.shared_folder
    monkeypatch.setattr(
        centroid_clusters, "shared_folder", lambda s: folders.append(plain(s)) or folders[-1]
    )
    rows = [(i, [i / 7, 1.0, -i / 3], 0) for i in range(20)]
    cluster_vectors(spark.createDataFrame(rows, SCHEMA), 3, 2, 3)
    left = [os.path.exists(f.removeprefix("file:")) for f in folders]
    assert left == [False, False, True]


def test_dot_products_take_no_part_of_unchanged_centroids():
    import numpy as np
    import pyarrow as pa

    change = np.array([[0, 0, 0], [0, 2, 0]])
    correct = centroid_clusters._corrector(change, np.array([5, 6]), 3)
    batch = pa.RecordBatch.from_pydict(
        {
            "own": pa.array([{"a": 1}, {"a": 2}]),
            "vec": [[1, 2, 3], [4, 5, 6]],
            "norm": pa.array([14, 77]),
            "dots": [[10, 20], [30, 40]],
        }
    )
    (out,) = correct(iter([batch]))
    assert out.column("dots").to_pylist() == [[10, 24], [30, 50]]
    assert out.column("cluster").to_pylist() == [1, 1]
    assert out.column("distance").to_pylist() == [14 + 6 - 48, 77 + 6 - 100]
