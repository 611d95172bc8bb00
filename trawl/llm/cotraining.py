"""A quality classifier of two views, text and metadata, that teach each other."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import SPACES, fold, require, stored, table, with_columns
from trawl.llm.hashing import split_words

HELD_OUT_FOLD = 0
CALIBRATION_FOLD = 1

# The views are fitted on at most so many labelled and so many unlabelled documents.
LABELLED_ROWS = 20_000
POOL_ROWS = 20_000
ROUNDS = 4
# A view passes on documents it is so sure of, in each round at most this share of the pool.
SURE = 0.98
SHARE_OF_POOL = 0.1

SHAPES = 48
SOURCES = 32
LANGS = 12
KNOWN_WORDS = 100_000
# Longer words count as so many pieces of this many characters.
PIECE_CHARS = 64

_RUN = re.compile(r"(.)\1*")


class _Shapes(dict):
    """The bucket of a word's or a piece's shape: its kinds of characters, runs of one kind made one."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        kinds = "".join(
            "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
            for c in word.decode("utf-8", "replace")
        )
        shape = _RUN.sub(r"\1", kinds)
        found = xxhash.xxh32_intdigest(shape.encode("utf-8")) % SHAPES
        self[word] = found
        return found


def _pieces(word: bytes) -> list[bytes]:
    """A long word in pieces, so that texts without spaces are described whole."""
    if len(word) <= PIECE_CHARS:
        return [word]
    chars = word.decode("utf-8", "replace")
    cuts = range(0, len(chars), PIECE_CHARS)
    return [chars[i : i + PIECE_CHARS].encode("utf-8") for i in cuts]


def content_features(text: str | None, shapes: _Shapes) -> list[float]:
    """What the words of a text look like, and how much of it repeats."""
    words = split_words(text)
    n = len(words)
    counts = Counter(words)
    histogram = [0.0] * SHAPES
    for word, times in counts.items():
        for piece in _pieces(word):
            histogram[shapes[piece]] += times
    some, all_pieces = n + 5.0, sum(histogram) + 5.0
    pairs = len(set(zip(words, words[1:], words[2:])))
    most = max(counts.values(), default=0)
    return [
        *[math.sqrt(h / all_pieces) for h in histogram],
        math.log(len(counts) + 1.0) / math.log(n + 2.0),
        (pairs + 3.0) / (max(n - 2, 0) + 3.0),
        most / some,
        min(sum(map(len, words)) / some, 20.0),
        math.log1p(n),
        float(n < 10),
    ]


def metadata_features(
    text: str | None, lang: str | None, source: str | None, n_chars: float | None
) -> list[float]:
    """Where a page comes from, its size and its layout in lines."""
    text = text or ""
    size = len(text) if n_chars is None or math.isnan(n_chars) else max(float(n_chars), 0.0)
    lines = [len(line) for line in text.split("\n") if line.strip(SPACES)]
    of_source, of_lang = [0.0] * SOURCES, [0.0] * LANGS
    of_source[xxhash.xxh32_intdigest((source or "").encode()) % SOURCES] = 1.0
    of_lang[xxhash.xxh32_intdigest((lang or "").encode()) % LANGS] = 1.0
    mean = sum(lines) / max(len(lines), 1)
    return [
        *of_source,
        *of_lang,
        math.log1p(size),
        math.log1p(len(lines)),
        math.log1p(mean),
        math.log1p(max(lines, default=0)),
        (text.count("\n") + 1 - len(lines)) / (len(lines) + 2.0),
    ]


N_CONTENT = SHAPES + 6
N_METADATA = SOURCES + LANGS + 5


def _logistic(features: np.ndarray, good: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights by Newton's method, the last being the constant."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, x.T @ (good - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _margin(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip(features @ weights[:-1] + weights[-1], -30, 30)


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


@dataclass
class TwoViews:
    """Weights of both views, their calibration, how they combine, and the score to keep from."""

    means: np.ndarray
    scales: np.ndarray
    content: np.ndarray
    metadata: np.ndarray
    content_scale: np.ndarray
    metadata_scale: np.ndarray
    combined: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Columns: calibrated content view, calibrated metadata view, both combined."""
        x = (rows - self.means) / self.scales
        a = _margin(_margin(x[:, :N_CONTENT], self.content)[:, None], self.content_scale)
        b = _margin(_margin(x[:, N_CONTENT:], self.metadata)[:, None], self.metadata_scale)
        both = _margin(np.stack([a, b], axis=1), self.combined)
        return np.stack([_chance(a), _chance(b), _chance(both)], axis=1)


def cotrain(
    rows: np.ndarray,
    good: np.ndarray,
    calibration: np.ndarray,
    pool: np.ndarray,
    rounds: int = ROUNDS,
) -> TwoViews | None:
    """Fits the views. ``calibration`` marks the labelled rows that only calibrate.

    In each round both views are fitted to the labelled rows and what the other view has passed on.
    Each then passes on the documents of the pool it is surest of: at most a share of the pool, and
    of each label in the proportion of the labelled rows. None without rows of both labels.
    """
    fit = ~calibration
    if len(set(good[fit])) < 2 or len(set(good[calibration])) < 2:
        return None
    means, scales = rows.mean(axis=0), rows.std(axis=0)
    scales[scales < 1e-9] = 1.0
    x, free = (rows - means) / scales, (pool - means) / scales
    views = (slice(0, N_CONTENT), slice(N_CONTENT, None))
    learnt: list[dict[int, float]] = [{}, {}]
    weights: list[np.ndarray] = []
    for step in range(rounds + 1):
        weights = []
        for view, taught in zip(views, learnt):
            own = np.array(sorted(taught), dtype=int)
            more = np.array([taught[i] for i in own])
            features = np.vstack([x[fit][:, view], free[own][:, view]])
            weights.append(_logistic(features, np.append(good[fit], more)))
        if step == rounds or not len(free):
            break
        for me, view in enumerate(views):
            chance = _chance(_margin(free[:, view], weights[me]))
            most = SHARE_OF_POOL * len(free)
            for label, sure in ((1.0, chance), (0.0, 1 - chance)):
                share = (good[fit] == label).mean()
                for i in np.argsort(-sure, kind="stable")[: int(most * share)]:
                    if sure[i] >= SURE:
                        learnt[1 - me].setdefault(int(i), label)
    held = x[calibration]
    margins = [_margin(held[:, view], w)[:, None] for view, w in zip(views, weights)]
    scaled = [_logistic(m, good[calibration], 1e-2) for m in margins]
    both = np.stack([_margin(m, s) for m, s in zip(margins, scaled)], axis=1)
    combined = _logistic(both, good[calibration], 1e-2)
    model = TwoViews(means, scales, *weights, *scaled, combined, 0.5)
    model.threshold = _threshold(model.scores(rows[calibration])[:, 2], good[calibration])
    return model


def _threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """Where kept good rows, weighing twice, and rejected bad ones are most; no score ties it."""
    order = np.argsort(scores, kind="stable")
    ordered, label = scores[order], good[order]
    lost = np.append(0, np.cumsum(label)) / label.sum()
    gone = np.append(0, np.cumsum(1 - label)) / (1 - label).sum()
    cuts = np.append(True, ordered[1:] != ordered[:-1])
    gain = np.where(np.append(cuts, True), gone - 2 * lost, -np.inf)
    best = int(gain.argmax())
    low = ordered[best - 1] if best else 0.0
    high = ordered[best] if best < len(ordered) else 1.0
    return float((low + high) / 2)


def _features(
    text: str | None, lang: str | None, source: str | None, n_chars: float | None, shapes: _Shapes
) -> list[float]:
    return content_features(text, shapes) + metadata_features(text, lang, source, n_chars)


def fit_two_views(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    labelled_rows: int = LABELLED_ROWS,
    pool_rows: int = POOL_ROWS,
    rounds: int = ROUNDS,
) -> TwoViews | None:
    """Co-trains on documents outside the held-out fold; those of one fold calibrate.

    ``docs`` has the columns ``text, lang, source, n_chars``. A hash of the ids picks at most
    ``labelled_rows`` labelled ids and ``pool_rows`` others. An id with several labels counts as
    its worst one. Without labels of both kinds there is no model.
    """
    known = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg(F.min(label_col).cast("double").alias("good"))
        .where(F.col("id").isNotNull())
    )
    usable = fold(F.col("id")) != HELD_OUT_FOLD
    some = known.where(usable).orderBy(F.xxhash64("id"), "id").limit(labelled_rows)
    others = (
        docs.select(F.col(f"`{id_col}`").alias("id"))
        .where(F.col("id").isNotNull() & usable)
        .join(known, "id", "left_anti")
        .distinct()
        .orderBy(F.xxhash64("id"), "id")
        .limit(pool_rows)
        .withColumn("good", F.lit(None).cast("double"))
    )
    picked = stored(some.unionByName(others))
    columns = ["text", "lang", "source", "n_chars"]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *columns).join(F.broadcast(picked), "id")

    def describe(batches):
        shapes = _Shapes()
        for frame in batches:
            features = [
                _features(*row, shapes) for row in frame[columns].itertuples(index=False, name=None)
            ]
            yield pd.DataFrame({"id": frame["id"], "good": frame["good"], "features": features})

    kind = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("good", T.DoubleType()),
            T.StructField("features", T.ArrayType(T.FloatType())),
        ]
    )
    found = rows.withColumn("n_chars", F.col("n_chars").cast("double")).mapInPandas(describe, kind)
    calibrates = (fold(F.col("id")) == CALIBRATION_FOLD).alias("calibrates")
    # An id may stand on many rows: no more of them come to the driver than ids were asked for.
    described = found.select("good", "features", calibrates, "id")
    ordered = described.orderBy(F.xxhash64("id"), "id", "features")
    sample = ordered.limit(labelled_rows + pool_rows).toPandas()
    if sample.empty:
        return None
    sample = sample.sort_values(["id", "good"], kind="stable")
    features = np.array(sample["features"].tolist(), dtype=float)
    good = sample["good"].to_numpy(dtype=float)
    labelled = ~np.isnan(good)
    return cotrain(
        features[labelled],
        good[labelled],
        sample["calibrates"].to_numpy(dtype=bool)[labelled],
        features[~labelled],
        rounds,
    )


def classify(docs: DataFrame, model: TwoViews | None) -> DataFrame:
    """``docs`` with ``content_score, metadata_score, score, kept`` (replacing such columns).

    Scores are the calibrated probabilities of good quality by text, by metadata and by both; a
    document is kept if the last reaches the model's threshold. Texts are read whole.

    Defined cases: null texts count as empty, null languages and sources as a value of their own,
    a null ``n_chars`` as the text's length; without a model every score is 0.5 and all are kept;
    rows are judged one by one, so repeated rows get equal scores; empty tables give empty ones.
    """
    require(docs, ["text", "lang", "source", "n_chars"])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["content_score", "metadata_score", "score"]
    kind = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    @F.pandas_udf(kind)
    def judge(
        texts: pd.Series, langs: pd.Series, sources: pd.Series, sizes: pd.Series
    ) -> pd.DataFrame:
        if shared.value is None or not len(texts):
            return pd.DataFrame(np.full((len(texts), 3), 0.5), columns=names)
        shapes = _Shapes()
        rows = [_features(*row, shapes) for row in zip(texts, langs, sources, sizes)]
        return pd.DataFrame(shared.value.scores(np.array(rows)), columns=names)

    columns = (F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars").cast("double"))
    judged = docs.withColumn("_judged", judge.asNondeterministic()(*columns))
    threshold = 0.0 if model is None else model.threshold
    new = {n: F.col(f"_judged.{n}") for n in names}
    new["kept"] = F.col("_judged.score") >= threshold
    return with_columns(judged, new).drop("_judged")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_two_views(docs, table(spark, sf_dir, "labels"))
    held_out = fold(F.col("doc_id")) == HELD_OUT_FOLD
    return classify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "content_score", "metadata_score", "score", "kept"
    )
