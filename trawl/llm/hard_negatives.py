"""Hard negatives by exact search over Hilbert-ordered blocks with zone maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.llm.common import remove_folder, require, shared_folder, table, whole_vectors
from trawl.llm.hilbert import curve_keys
from trawl.operators.numbering import measure_id_ranges

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score is between these hundredths of the positive's.
LEAST_SHARE = 30
MOST_SHARE = 90
ANCHOR_EVERY = 100

# Cells along each dimension of the curve: 2 ** BITS.
BITS = 4
ROWS_PER_BLOCK = 512
ROWS_PER_PART = 250_000
# Anchors searched for together: their vectors and best rows are what a task holds.
ANCHORS_PER_ROUND = 4_096
# Numbers of chosen blocks that the driver receives, and stretches of blocks named in a plan.
BLOCKS_LISTED = 10_000
STRETCHES = 64

_WINDOWS_AT_ONCE = 256
_NO_SCORE = -(2**62)
_NO_ID = 2**63 - 1

_ROWS = "block bigint, label bigint, vec_id bigint, vec array<int>"
_ZONES = "block bigint, label bigint, n int, first_id bigint, lows array<int>, highs array<int>"
_ANCHORS = f"{_ROWS}, floor bigint"
_BEST = "window int, score bigint, vec_id bigint"

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Blocks:
    """Vectors in blocks that follow the curve within a label.

    ``rows``: ``block, label, vec_id, vec``; ``zones``: ``block, label, n, first_id, lows, highs``,
    the extent of a block in every dimension. A large block may have several zones.
    """

    rows: DataFrame
    zones: DataFrame
    dims: int


@dataclass(frozen=True)
class Windows:
    """What is searched for: for each window the best ``keep`` rows with scores in its bounds.

    ``vectors, labels, ids`` are the anchors'; ``anchor`` is each window's. ``same`` wants rows of
    the anchor's label other than itself, else rows of other labels are wanted.
    """

    vectors: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    keep: int
    same: bool


def score_bounds(
    vectors: np.ndarray, lows: np.ndarray, highs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that each vector can have with a point of the box."""
    positive, negative = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return positive @ lows + negative @ highs, positive @ highs + negative @ lows


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of a matrix; a shorter one goes on with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel().astype(np.int32)))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; in floating point where that is exact too."""
    largest = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0))
    if largest * left.shape[1] < 2**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def _pieces(batches: Batches, dims: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``block, label, ids, vectors`` of the blocks in batches of rows in order.

    A block that goes on in the next batch comes as two pieces.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, labels = _numbers(batch, "block"), _numbers(batch, "label")
        ids, vectors = _numbers(batch, "vec_id"), _matrix(batch.column("vec"), dims)
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(blocks[a]), int(labels[a]), ids[a:b], vectors[a:b]


class BlockSearch:
    """The best rows of each window, from blocks one after another.

    A block is scored for the windows only that it may serve: its bounds meet the window, and
    reach the worst of the window's best rows so far, with a lesser id if they but equal it.
    """

    def __init__(self, windows: Windows) -> None:
        self.windows = windows
        n = len(windows.anchor)
        self.low = windows.low.copy()
        self.worst_id = np.full(n, _NO_ID)
        self.scores = np.full((n, windows.keep), _NO_SCORE)
        self.ids = np.full((n, windows.keep), _NO_ID)

    def served(self, label: int, first_id: int, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Numbers of the windows that a block may serve."""
        w = self.windows
        least, most = score_bounds(w.vectors, lows, highs)
        wanted = (w.labels == label) == w.same
        least, most = least[w.anchor], most[w.anchor]
        reached = (most > self.low) | ((most == self.low) & (first_id < self.worst_id))
        return np.flatnonzero(wanted[w.anchor] & reached & (least <= w.high))

    def read(self, label: int, ids: np.ndarray, vectors: np.ndarray) -> int:
        """Take a block in; returns how many windows it was scored for."""
        served = self.served(label, int(ids.min()), vectors.min(axis=0), vectors.max(axis=0))
        for at in range(0, len(served), _WINDOWS_AT_ONCE):
            self._score(served[at : at + _WINDOWS_AT_ONCE], ids, vectors)
        return len(served)

    def _score(self, numbers: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        w = self.windows
        anchors, own = np.unique(w.anchor[numbers], return_inverse=True)
        scores = _products(w.vectors[anchors], vectors)[own]
        fits = (scores >= self.low[numbers, None]) & (scores <= w.high[numbers, None])
        if w.same:
            fits &= ids != w.ids[w.anchor[numbers], None]
        window, place = np.nonzero(fits)
        if not len(window):
            return
        # The best so far compete with what the block has, by score and then by id.
        touched = np.unique(window)
        before, slot = np.nonzero(self.scores[numbers[touched]] != _NO_SCORE)
        window_of = np.concatenate([window, touched[before]])
        score = np.concatenate([scores[window, place], self.scores[numbers[touched[before]], slot]])
        row_id = np.concatenate([ids[place], self.ids[numbers[touched[before]], slot]])
        order = np.lexsort((row_id, -score, window_of))
        window_of, score, row_id = window_of[order], score[order], row_id[order]
        starts = np.flatnonzero(np.diff(window_of, prepend=-1))
        counts = np.diff(np.append(starts, len(window_of)))
        rank = np.arange(len(window_of)) - np.repeat(starts, counts)
        best = rank < w.keep
        self.scores[numbers[window_of[best]], rank[best]] = score[best]
        self.ids[numbers[window_of[best]], rank[best]] = row_id[best]
        full = numbers[window_of[starts[counts >= w.keep]]]
        self.low[full] = self.scores[full, -1]
        self.worst_id[full] = self.ids[full, -1]

    def best(self) -> pa.RecordBatch:
        window, slot = np.nonzero(self.scores != _NO_SCORE)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(window.astype(np.int32)),
                pa.array(self.scores[window, slot]),
                pa.array(self.ids[window, slot]),
            ],
            names=["window", "score", "vec_id"],
        )


def _whole_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int):
    """``vec_id, label, vec`` of the rows that take part, one per id, and the dimensions."""
    vector = F.col(f"`{vector_col}`")
    dims = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    limit = min(2**27, isqrt(2**56 // max(1, dims)))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.col(f"`{label_col}`").cast("bigint").alias("label"),
        whole_vectors(vector, scale, limit).cast("array<int>").alias("vec"),
    ).dropna()
    repeated = rows.groupBy("vec_id").count().where("count > 1")
    if not repeated.isEmpty():
        least = F.min(F.struct("label", "vec")).alias("least")
        rows = rows.groupBy("vec_id").agg(least).select("vec_id", "least.*")
    return rows, dims


def _extents(rows: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and the least and greatest value in every dimension.

    Each batch gives one value per dimension, and Spark adds these up.
    """

    def measure(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column("vec"), dims)
                columns = [
                    pa.array(np.arange(dims, dtype=np.int32)),
                    pa.array(np.full(dims, len(own))),
                    pa.array(own.min(axis=0)),
                    pa.array(own.max(axis=0)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "low", "high"])

    parts = rows.select("vec").mapInArrow(measure, "dim int, n bigint, low bigint, high bigint")
    sums = parts.groupBy("dim").agg(F.sum("n"), F.min("low"), F.max("high")).collect()
    sums.sort(key=lambda row: row[0])
    if not sums:
        return 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    return sums[0][1], np.array([r[2] for r in sums]), np.array([r[3] for r in sums])


def _placer(lows: np.ndarray, highs: np.ndarray, bits: int) -> Callable[[Batches], Batches]:
    """Adds each row's place along the curve, widest dimensions first."""
    extent = highs - lows + 1
    widest = np.argsort(-extent, kind="stable")

    def place(batches: Batches) -> Batches:
        for batch in batches:
            cells = ((_matrix(batch.column("vec"), len(lows)) - lows) << bits) // extent
            keys = pa.array(curve_keys(cells[:, widest], bits), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, keys], names=[*batch.schema.names, "key"]
            )

    return place


def _cutter(rows_per_block: int) -> Callable[[Batches], Batches]:
    """Numbers blocks: a new one starts with a label and after ``rows_per_block`` rows."""

    def cut(batches: Batches) -> Batches:
        block = (TaskContext.get().partitionId() << 32) - 1
        label, room = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = _numbers(batch, "label")
            blocks = np.empty(len(labels), np.int64)
            ends = [*(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
            at = 0
            while at < len(labels):
                if room == 0 or labels[at] != label:
                    block, label, room = block + 1, labels[at], rows_per_block
                end = min(next(e for e in ends if e > at), at + room)
                blocks[at:end] = block
                room -= end - at
                at = end
            names = ["label", "vec_id", "vec"]
            columns = [pa.array(blocks), *[batch.column(n) for n in names]]
            yield pa.RecordBatch.from_arrays(columns, names=["block", *names])

    return cut


def _zoner(dims: int) -> Callable[[Batches], Batches]:
    def zone(batches: Batches) -> Batches:
        for block, label, ids, vectors in _pieces(batches, dims):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.array([label]),
                    pa.array([len(ids)], pa.int32()),
                    pa.array([int(ids.min())]),
                    _lists(vectors.min(axis=0, keepdims=True)),
                    _lists(vectors.max(axis=0, keepdims=True)),
                ],
                names=["block", "label", "n", "first_id", "lows", "highs"],
            )

    return zone


def build_blocks(
    vectors: DataFrame,
    path: str,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    bits: int = BITS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> Blocks:
    """Write vectors below ``path`` in blocks along a Hilbert curve, with their zone maps.

    Rows are sorted by label, place on the curve and id, and dealt to tasks by ranges of all three,
    so neither a hot label nor a vector that a third of all rows share fills a task.
    """
    spark = vectors.sparkSession
    rows, dims = _whole_rows(vectors, id_col, vector_col, label_col, scale)
    n, lows, highs = _extents(rows, dims)
    parts = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_PART))
    order = ["label", "key", "vec_id"]
    placed = rows.mapInArrow(
        _placer(lows, highs, bits), "vec_id bigint, label bigint, vec array<int>, key binary"
    )
    (
        placed.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_cutter(rows_per_block), _ROWS)
        .write.option("parquet.block.size", 4 << 20)
        .parquet(f"{path}/rows")
    )
    blocks = spark.read.schema(_ROWS).parquet(f"{path}/rows")
    blocks.mapInArrow(_zoner(dims), _ZONES).write.parquet(f"{path}/zones")
    return Blocks(blocks, spark.read.schema(_ZONES).parquet(f"{path}/zones"), dims)


def _with_floor(dims: int, every: int, keep: int) -> Callable[[Batches], Batches]:
    """The anchors, each with the score of the ``keep``-th best other row of its own block.

    At least so many rows score that much or more, which is where the search for the best starts.
    """

    def anchors(batches: Batches) -> Batches:
        for block, label, ids, vectors in _pieces(batches, dims):
            chosen = np.flatnonzero(ids % every == 0)
            for at in range(0, len(chosen), _WINDOWS_AT_ONCE):
                own = chosen[at : at + _WINDOWS_AT_ONCE]
                scores = _products(vectors[own], vectors)
                scores[np.arange(len(own)), own] = _NO_SCORE
                floor = np.full(len(own), _NO_SCORE)
                if len(ids) > keep:
                    floor = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
                columns = [
                    pa.array(np.full(len(own), block)),
                    pa.array(np.full(len(own), label)),
                    pa.array(ids[own]),
                    _lists(vectors[own]),
                    pa.array(floor),
                ]
                names = ["block", "label", "vec_id", "vec", "floor"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return anchors


def blocks_to_read(blocks: Blocks, windows: Windows) -> DataFrame:
    """``block``: those whose zone map says that they may serve a window."""
    shared = blocks.zones.sparkSession.sparkContext.broadcast(windows)
    dims = blocks.dims

    def choose(batches: Batches) -> Batches:
        search = BlockSearch(shared.value)
        for batch in batches:
            lows, highs = _matrix(batch.column("lows"), dims), _matrix(batch.column("highs"), dims)
            labels, ids = _numbers(batch, "label"), _numbers(batch, "first_id")
            served = [len(search.served(*zone)) > 0 for zone in zip(labels, ids, lows, highs)]
            yield batch.select(["block"]).filter(pa.array(served, pa.bool_()))

    zones = blocks.zones.select("block", "label", "first_id", "lows", "highs")
    return zones.mapInArrow(choose, "block bigint")


def _stretches(numbers: list[int], most: int) -> list[tuple[int, int]]:
    """Numbers in order as at most so many stretches, put together where gaps are least."""
    gaps = sorted(range(1, len(numbers)), key=lambda i: numbers[i - 1] - numbers[i])[: most - 1]
    cuts = [0, *sorted(gaps), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:])]


def _chosen(chosen: DataFrame) -> Optional[Column]:
    """A condition on ``block`` that holds for all chosen blocks, in a form that Parquet can use.

    The blocks are listed if they are few, otherwise the parts they are in; what is read beyond
    them is passed over by its bounds. None says that nothing is chosen.
    """
    some = chosen.distinct().limit(BLOCKS_LISTED + 1).collect()
    if not some:
        return None
    block = F.col("block")
    if len(some) <= BLOCKS_LISTED:
        spans = _stretches(sorted(row[0] for row in some), STRETCHES)
    else:
        part = F.shiftright("block", 32).alias("part")
        parts = chosen.select(part).distinct().limit(BLOCKS_LISTED + 1).collect()
        if len(parts) > BLOCKS_LISTED:
            return F.lit(True)
        spans = _stretches(sorted(row[0] for row in parts), STRETCHES)
        spans = [(a << 32, (b + 1 << 32) - 1) for a, b in spans]
    condition = F.lit(False)
    for first, last in spans:
        condition = condition | block.between(first, last)
    return condition


def best_rows(blocks: Blocks, windows: Windows) -> Optional[DataFrame]:
    """``window, score, vec_id, rank``: the best rows of each window; None if no block serves one.

    Zone maps choose the blocks; these alone are read. Every task keeps the best of its blocks, and
    only those are shuffled.
    """
    condition = _chosen(blocks_to_read(blocks, windows))
    if condition is None:
        return None
    shared = blocks.rows.sparkSession.sparkContext.broadcast(windows)
    dims = blocks.dims

    def scan(batches: Batches) -> Batches:
        search = BlockSearch(shared.value)
        for _, label, ids, vectors in _pieces(batches, dims):
            search.read(label, ids, vectors)
        yield search.best()

    found = blocks.rows.where(condition).mapInArrow(scan, _BEST)
    place = F.row_number().over(Window.partitionBy("window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= windows.keep)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE,
    most_share: int = MOST_SHARE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    bits: int = BITS,
    rows_per_block: int = ROWS_PER_BLOCK,
    anchors_per_round: int = ANCHORS_PER_ROUND,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of whole vectors ``floor(scale * x)``, higher ones first, ties by
    id. Anchors are the rows whose id is divisible by ``anchor_every``; their positives the best
    ``positives`` other rows of the same label. For each of these, the best ``negatives`` rows of
    other labels are given whose score is from ``least_share`` to ``most_share`` hundredths of the
    positive's. The result is exact.

    Rows are stored as blocks along a Hilbert curve within their label. Interval arithmetic on a
    block's zone map bounds the scores that an anchor can have in it, and a window reads the blocks
    whose bounds meet it; while it reads, its worst kept score rules out more. Anchors come in
    rounds of at most ``anchors_per_round`` and a block, near each other on the curve; a round's
    vectors are broadcast, and what a task keeps of it is bounded. Blocks, anchors and each round's
    rows are written to the folder that executors share.

    Defined cases: rows with a null id, label or vector, with a null or non-finite component, or
    one of more than 2**27 in size (less beyond 4 dimensions: 2**56 over their number, square root)
    take no part; a shorter vector goes on with zeros; of rows with one id the one with the least
    label, then vector, counts. A positive score below 0 has no negatives, nor has an anchor
    without positives. An empty table gives no rows. Other columns are not looked at.
    """
    require(vectors, [id_col, vector_col, label_col])
    spark = vectors.sparkSession
    path = shared_folder(spark)
    blocks = build_blocks(
        vectors, f"{path}/blocks", id_col, vector_col, label_col, scale, bits, rows_per_block
    )
    blocks.rows.mapInArrow(
        _with_floor(blocks.dims, anchor_every, positives), _ANCHORS
    ).write.parquet(f"{path}/anchors")
    anchors = spark.read.schema(_ANCHORS).parquet(f"{path}/anchors")
    schema = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
        "positive_score bigint, negative_score bigint"
    )
    bounds = measure_id_ranges(anchors, "block", anchors_per_round).bounds
    for first, last in zip([None, *bounds], [*bounds, None]):
        chosen = F.lit(True)
        if first is not None:
            chosen = chosen & (F.col("block") > first)
        if last is not None:
            chosen = chosen & (F.col("block") <= last)
        found = _round(
            blocks, anchors.where(chosen), positives, negatives, least_share, most_share
        )
        if found is not None:
            found.write.mode("append").parquet(f"{path}/found")
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/found")
    remove_folder(spark, f"{path}/blocks")
    remove_folder(spark, f"{path}/anchors")
    return spark.read.schema(schema).parquet(f"{path}/found")


def _round(
    blocks: Blocks,
    anchors: DataFrame,
    positives: int,
    negatives: int,
    least_share: int,
    most_share: int,
) -> Optional[DataFrame]:
    """The negatives of some anchors; the driver holds these and their positives."""
    own = anchors.select("label", "vec_id", "vec", "floor").toArrow().combine_chunks()
    if not own.num_rows:
        return None
    own = own.to_batches()[0]
    facts = (_matrix(own.column("vec"), blocks.dims), _numbers(own, "label"), _numbers(own, "vec_id"))
    n = own.num_rows
    same = Windows(
        *facts, np.arange(n), _numbers(own, "floor"), np.full(n, _NO_ID), positives, True
    )
    nearest = best_rows(blocks, same)
    if nearest is None:
        return None
    nearest = nearest.select("window", "score", "vec_id").toArrow()
    anchor, score, positive = (nearest.column(i).to_numpy() for i in range(3))
    low, high = -(-least_share * score // 100), most_share * score // 100
    open_ = np.flatnonzero(low <= high)
    windows = Windows(*facts, anchor[open_], low[open_], high[open_], negatives, False)
    if not len(open_):
        return None
    found = best_rows(blocks, windows)
    if found is None:
        return None
    pairs = pa.table(
        {
            "window": pa.array(np.arange(len(open_), dtype=np.int32)),
            "anchor_id": facts[2][anchor[open_]],
            "positive_id": positive[open_],
            "positive_score": score[open_],
        }
    )
    pairs = blocks.rows.sparkSession.createDataFrame(pairs)
    return found.join(F.broadcast(pairs), "window").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``, with every seventh label moved on."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))


ORACLE_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL
      AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           list_inner_product(a.v, r.v)::BIGINT AS score
    FROM kept a JOIN kept r ON a.vec_id <> r.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id
                          ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LEAST_SHARE} * positive_score <= 100 * score
  AND 100 * score <= {MOST_SHARE} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
