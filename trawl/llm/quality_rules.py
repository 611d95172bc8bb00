"""Rule statistics of documents, judged by an isolation forest."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import SPACES, require, stored, table, with_columns

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

# The forest is fitted on at most so many labelled rows of good quality; the threshold is
# calibrated on all labelled rows.
SAMPLE_ROWS = 20_000
TREES = 150
TREE_ROWS = 256
SEED = 20
SCORE_BINS = 4_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATS = ", ".join(f"{c} bigint" for c in COUNTS) + ", features array<double>"

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _repeat_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words covered by windows whose word sequence is found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    number = {word: i for i, word in enumerate(dict.fromkeys(words), 1)}
    codes = np.fromiter(map(number.__getitem__, words), np.uint64, n)
    mixed = np.zeros(n - window + 1, np.uint64)
    for i in range(window):
        mixed = (mixed + codes[i : n - window + 1 + i]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    ordered = np.sort(mixed)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    starts = np.flatnonzero(np.isin(mixed, again))
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def _without(raw: bytes, removed: bytes) -> int:
    """How many bytes of ``removed`` there are in ``raw``."""
    return len(raw) - len(raw.translate(None, removed))


def rule_statistics(text: str | None) -> tuple:
    """The base counts of a text, and the ratios that the forest looks at."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup_lines += line in seen
            seen.add(line)
    lines = len(seen) + dup_lines
    repeats = _repeat_words(words)
    upper, lower = _without(raw, _UPPER), _without(raw, _LOWER)
    distinct = len(set(words))
    some = n + 5.0
    features = [
        symbols / some,
        (symbols - text.count("|")) / some,
        text.count("|") / some,
        text.count("!") / some,
        upper / (upper + lower + 20.0),
        max(0.5, math.log(distinct + 1.0) / math.log(n + 2.0)),
        math.log((word_chars + 25.0) / some),
        dup_lines / (lines + 3.0),
        math.log1p(dup_lines),
        repeats / some,
    ]
    return n, word_chars, symbols, dup_lines, repeats, features


@dataclass(frozen=True)
class _Tree:
    feature: np.ndarray
    split: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray


def _mean_path(n: int) -> float:
    """Mean depth of a leaf in a random binary search tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


class IsolationForest:
    """Random splits of small samples; rows that few splits set apart are anomalous.

    A row that lies outside the range a node has seen, in the feature that the node splits by, is
    set apart there and then; so features that hardly vary among good rows count as well.
    """

    def __init__(self, rows: np.ndarray, trees: int = TREES, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        size = min(TREE_ROWS, len(rows))
        self._norm = _mean_path(size) or 1.0
        self._depth = max(1, math.ceil(math.log2(max(size, 2))))
        self._trees = [
            self._grow(rows[rng.choice(len(rows), size, replace=False)], rng)
            for _ in range(trees)
        ]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> _Tree:
        nodes: list[list[float]] = []

        def add(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, 0.0, 0.0, at, at, depth + _mean_path(len(part))])
            low, high = part.min(axis=0), part.max(axis=0)
            if depth < self._depth and len(part) > 1 and (high > low).any():
                f = int(rng.integers(rows.shape[1]))
                split = rng.uniform(low[f], high[f])
                below = part[:, f] < split
                left = add(part[below], depth + 1) if below.any() else -1
                right = add(part[~below], depth + 1) if not below.all() else -1
                left, right = (right if left < 0 else left), (left if right < 0 else right)
                nodes[at] = [f, split, low[f], high[f], left, right, depth]
            return at

        add(rows, 0)
        columns = list(zip(*nodes))
        kinds = (int, float, float, float, int, int, float)
        return _Tree(*[np.array(c, dtype=kind) for c, kind in zip(columns, kinds)])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher for anomalous rows; about 0.5 for ordinary ones."""
        if not len(rows):
            return np.zeros(0)
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for tree in self._trees:
            at = np.zeros(len(rows), dtype=int)
            path = np.full(len(rows), -1.0)
            for _ in range(self._depth + 1):
                f = tree.feature[at]
                value = rows[every, np.maximum(f, 0)]
                inner = (f >= 0) & (path < 0)
                outside = inner & ((value < tree.low[at]) | (value > tree.high[at]))
                path = np.where(outside | ((f < 0) & (path < 0)), tree.path[at], path)
                down = np.where(value < tree.split[at], tree.left[at], tree.right[at])
                at = np.where(inner & ~outside, down, at)
            total += path
        return 2.0 ** (-total / len(self._trees) / self._norm)


@dataclass(frozen=True)
class QualityModel:
    """A fitted forest, if there were rows to fit it on, and the score from which rows go."""

    forest: IsolationForest | None
    threshold: float


def _stats_udf():
    @F.pandas_udf(_STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        rows = [rule_statistics(t) for t in texts]
        return pd.DataFrame(rows, columns=[*COUNTS, "features"])

    return stats.asNondeterministic()


def _base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"]
    )


def _best_threshold(counts: list[tuple[int, int, int]]) -> float:
    """The lower edge of the bin from which rejecting makes the most of both labels' rates.

    A rejected good row weighs twice a kept bad one. Without rows of both labels nothing goes.
    """
    good = np.zeros(SCORE_BINS + 1)
    bad = np.zeros(SCORE_BINS + 1)
    for quality, b, n in counts:
        (good if quality else bad)[b] += n
    if not good.sum() or not bad.sum():
        return 2.0
    kept_good = np.append(0, np.cumsum(good)) / good.sum()
    gone_bad = 1 - np.append(0, np.cumsum(bad)) / bad.sum()
    gain = 2 * kept_good + gone_bad
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(best[len(best) // 2]) / SCORE_BINS


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fits the forest on labelled good rows and calibrates its threshold on all labelled rows.

    Documents that fail the base rules are left out of both, since the forest has no say on them.
    ``sample_rows`` bounds the good rows that the forest is grown from; which ones is decided by a
    hash of their ids. An id with several labels counts as its worst one. The statistics of
    labelled documents are stored once, without texts.
    """
    stats = docs.select(
        F.col(f"`{id_col}`").alias("id"), _stats_udf()(F.col(f"`{text_col}`")).alias("stats")
    )
    stats = stats.where(~_base_failed(F.col("stats"))).select("id", "stats.features")
    labelled = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg(F.min(label_col).cast("int").alias("quality"))
    )
    rows = stored(stats.join(labelled, "id").select("id", "quality", "features"))
    sample = (
        rows.where("quality = 1")
        .orderBy(F.xxhash64("id"), "id", "features")
        .limit(sample_rows)
        .select("features")
        .collect()
    )
    if not sample:
        return QualityModel(None, 2.0)
    forest = IsolationForest(np.array([r[0] for r in sample]))
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("int")
    def score_bin(features: pd.Series) -> pd.Series:
        scores = shared.value.scores(np.array(features.tolist()))
        return pd.Series(np.floor(scores * SCORE_BINS).astype("int32"))

    counts = rows.groupBy("quality", score_bin("features").alias("bin")).count().collect()
    return QualityModel(forest, _best_threshold([tuple(r) for r in counts]))


def judge_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``score`` and ``kept`` (replacing such columns).

    Words are runs without ASCII white space. ``n_dup_lines`` counts lines with a word that equal
    an earlier line, ``n_repeat_words`` the words in 5-word windows found at least twice. A text
    fails the base rules with fewer than 10 words or more than a fifth of its words repeated; of the
    others the forest rejects those whose score reaches the model's threshold.

    Defined cases: null and empty texts have no words and fail; every row is judged by itself, so
    repeated rows get equal results; an empty table gives an empty one.
    """
    require(docs, [text_col])
    shared = docs.sparkSession.sparkContext.broadcast(model.forest)

    @F.pandas_udf(f"{_STATS}, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = [rule_statistics(t) for t in texts]
        frame = pd.DataFrame(rows, columns=[*COUNTS, "features"])
        forest = shared.value
        frame["score"] = 0.0
        if forest is not None and len(frame):
            frame["score"] = forest.scores(np.array(frame["features"].tolist()))
        return frame

    judged = docs.withColumn("_judged", judge.asNondeterministic()(F.col(f"`{text_col}`")))
    failed = _base_failed(F.col("_judged"))
    rejected = F.floor(F.col("_judged.score") * SCORE_BINS) >= model.threshold * SCORE_BINS
    new = {c: F.col(f"_judged.{c}") for c in COUNTS}
    new |= {"score": F.col("_judged.score"), "base_failed": failed, "kept": ~failed & ~rejected}
    return with_columns(judged, new).drop("_judged")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, model).select("doc_id", *COUNTS, "base_failed", "kept", "score")
