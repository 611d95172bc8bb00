"""Centroid clustering that keeps every vector's dot products and corrects them by what changed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import remove_folder, require, shared_folder, table, whole_vectors

CLUSTERS = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
SEED = "2"
# Whole components are less than this in size, so that squared distances fit 64 bits.
LIMIT = 2**27

_STATE = ["own", "vec", "norm", "dots", "cluster", "distance"]


@dataclass(frozen=True)
class Clustering:
    """``rows``: the clustered rows with ``cluster`` and ``distance`` (squared).

    ``centroids`` are the final ones, whole numbers, one row each. ``inertias`` are the sums of
    squared distances by cluster; a cluster without vectors has 0.
    """

    rows: DataFrame
    centroids: np.ndarray
    inertias: list[int]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def _corrector(
    change: np.ndarray, norms: np.ndarray, dims: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Brings dot products up to date for centroids that moved by ``change``, then assigns.

    The squared norm of a vector is the same for all centroids, so the nearest one has the least
    ``norms - 2 * dots``. ``argmin`` takes the first of several, which is the smaller number.
    """
    moved = [(k, np.flatnonzero(own)) for k, own in enumerate(change) if own.any()]

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vec"), dims)
            dots = _matrix(batch.column("dots"), len(change)).copy()
            for k, parts in moved:
                dots[:, k] += vectors[:, parts] @ change[k, parts]
            costs = norms - 2 * dots
            nearest = np.argmin(costs, axis=1)
            distance = batch.column("norm").to_numpy() + costs[np.arange(len(costs)), nearest]
            columns = [
                batch.column("own"),
                batch.column("vec"),
                batch.column("norm"),
                _lists(dots),
                pa.array(nearest.astype(np.int32)),
                pa.array(distance),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_STATE)

    return correct


def _first_centroids(state: DataFrame, id_col: str, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose ids hash least; ties of repeated ids go by components."""
    own_id = F.coalesce(F.col(f"own.`{id_col}`").cast("string"), F.lit(""))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), own_id).cast("binary"), 256)
    rows = state.select(hashed.alias("hash"), "vec").orderBy("hash", "vec").limit(k).collect()
    return np.array([row["vec"] for row in rows], np.int64)


def _moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as floor(sum / count) of their vectors, empty ones as they were.

    Sums are combined in each task; the driver receives one row per cluster.
    """
    dims = centroids.shape[1]
    sums = [F.sum(F.get("vec", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    moved = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clustering:
    """Cluster vectors of whole numbers ``floor(scale * x)`` exactly, in a fixed number of rounds.

    The first centroids are the vectors whose ids hash least. A round assigns every vector to the
    nearest centroid (squared distance, ties to the smaller number) and moves each centroid to the
    floor of its vectors' mean; after the last round vectors are assigned once more.

    Every vector is stored with its dot products with all centroids. A round adds to them only what
    the centroids' changed components make out, exactly, and then takes the least distance anew.
    The stored state is Parquet in the folder that executors share, so a lost executor costs the
    tasks it ran; the state of a round goes once the next one is written. Rows are never shuffled.

    Defined cases: vectors that are null, of another length, with a null or non-finite component or
    one of 2**27 or more in size once scaled take no part and have no row. Every other row is a
    vector of its own, with a null id or the id of another row too; a null id hashes as an empty
    one. With fewer vectors than clusters there are as many centroids as vectors, equal ones among
    them. An empty table gives no rows. The columns are those of ``vectors``, and ``cluster`` and
    ``distance``, which replace columns of these names.
    """
    require(vectors, [id_col, vector_col])
    spark = vectors.sparkSession
    own = F.struct(*[F.col(f"`{c}`") for c in vectors.columns])
    sized = vectors.where(F.size(F.col(f"`{vector_col}`")) == dims)
    whole = sized.select(
        own.alias("own"), whole_vectors(F.col(f"`{vector_col}`"), scale, LIMIT).alias("vec")
    ).where(F.col("vec").isNotNull())
    norm = F.aggregate("vec", F.lit(0).cast("bigint"), lambda total, x: total + x * x)
    state = whole.withColumn("norm", norm)

    centroids = _first_centroids(state, id_col, clusters, seed)
    if not len(centroids):
        none = whole.where(F.lit(False)).withColumns(
            {"cluster": F.lit(0), "distance": F.lit(0).cast("bigint")}
        )
        return Clustering(_finished(none, vectors.columns), np.zeros((0, dims), np.int64), [])

    zeros = F.array_repeat(F.lit(0).cast("bigint"), len(centroids))
    state = state.withColumn("dots", zeros)
    schema = T.StructType(
        [
            *state.schema.fields,
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    known = np.zeros_like(centroids)  # the centroids that the stored dot products are with
    path = None
    for step in range(rounds + 1):
        norms = (centroids * centroids).sum(axis=1)
        correct = _corrector(centroids - known, norms, dims)
        target = shared_folder(spark)
        state.select(_STATE[:4]).mapInArrow(correct, schema).write.parquet(target)
        state = spark.read.schema(schema).parquet(target)
        if path is not None:
            remove_folder(spark, path)
        path, known = target, centroids
        if step < rounds:
            centroids = _moved_centroids(state, centroids)
    inertias = [0] * len(centroids)
    for row in state.groupBy("cluster").agg(F.sum("distance").alias("total")).collect():
        inertias[row["cluster"]] = row["total"]
    return Clustering(_finished(state, vectors.columns), centroids, inertias)


def _finished(state: DataFrame, columns: list[str]) -> DataFrame:
    found = ["cluster", "distance"]
    own = [F.col(f"own.`{c}`").alias(c) for c in columns if c.lower() not in found]
    return state.select(*own, *found)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector of ``embeddings`` with its cluster, and digests of the clustering."""
    found = cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    digests = [
        hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
        for centroid in found.centroids
    ]
    by_cluster = F.lit(found.inertias).cast("array<bigint>")
    return found.rows.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(found.inertias)).cast("bigint").alias("inertia"),
        F.get(F.lit(digests).cast("array<string>"), F.col("cluster")).alias("centroid_sha256"),
    )


def _oracle() -> str:
    steps = []
    for step in range(ROUNDS + 1):
        steps.append(f"""near_{step} AS MATERIALIZED (
    SELECT vec_id, v, min({{'d': list_inner_product(v, v) + list_inner_product(m, m)
                                - 2 * list_inner_product(v, m), 'c': c}}) AS best
    FROM kept, centroids_{step} GROUP BY vec_id, v
)""")
        if step < ROUNDS:
            steps.append(f"""sums_{step} AS (
    SELECT best.c AS c, i, sum(x::BIGINT)::BIGINT AS s, count(*) AS n
    FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near_{step})
    GROUP BY ALL
), centroids_{step + 1} AS MATERIALIZED (
    SELECT c, coalesce(moved.m, stays.m) AS m
    FROM centroids_{step} AS stays LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS m
        FROM sums_{step} GROUP BY c) AS moved USING (c)
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
    FROM embeddings
    WHERE len(embedding) = {DIMS}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}
), centroids_0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, v AS m
    FROM kept QUALIFY c < {CLUSTERS}
), {", ".join(steps)}
SELECT vec_id, best.c::INT AS cluster, best.d::BIGINT AS distance,
       sum(best.d::BIGINT) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d::BIGINT) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(m, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM near_{ROUNDS} JOIN centroids_{ROUNDS} ON c = best.c
"""


ORACLE_SQL = _oracle()
