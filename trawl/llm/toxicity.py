"""Toxicity from a learned lexicon, matched by Levenshtein automata, and the words around a hit."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import fold, require, stored, table, with_columns

HELD_OUT_FOLD = 0

# The lexicon and the weights are learned from at most so many labelled documents.
SAMPLE_ROWS = 30_000
# A lexicon term follows at least so many different words in toxic documents, and this share of all
# the words it follows are in toxic ones. Counting neighbours and not documents keeps a group of
# copies from making all of its words terms.
LEAST_NEIGHBOURS = 4
LEAST_SHARE = 0.8
# Context words count from so many hits on.
LEAST_CONTEXT_HITS = 5
CONTEXT_WORDS = 5

# Bounds on what a worker remembers; results don't depend on them.
KNOWN_WORDS = 150_000
KNOWN_STEPS = 200_000
DOCS_PER_BATCH = 200

# The marks that close what a mark opens, in the ways of several languages.
_CLOSERS = {
    '"': '"',
    "“": "”",
    "”": "”",
    "„": "“”",
    "«": "»",
    "»": "«»",
    "‹": "›",
    "›": "‹›",
    "‘": "’",
    "‚": "‘’",
}
_OPENERS = {c: [o for o, closers in _CLOSERS.items() if c in closers] for c in "\"“”«»‹›‘’"}
_MARKS = "\"“”„«»‹›‘’‚"
_MARK = re.compile(f"[{_MARKS}]")
# Characters beyond ASCII that stand between words: punctuation and spaces of the basic plane.
_BETWEEN = "".join(
    re.escape(c) for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c)[0] in "PZ"
)
_GAPS = re.compile(f"[{_BETWEEN}]+")
_WORD = re.compile(f"[^\x00-\x2f\x3a-\x60\x7b-\x7f{_BETWEEN}]+")
_TO_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
N_FEATURES = 7
# Features that only ever speak for toxicity: different words hit outside quotes.
N_EVIDENCE = 5


def _words(text: str | None) -> list[bytes]:
    lowered = (text or "").lower()
    if not lowered.isascii():
        lowered = _GAPS.sub(" ", lowered)
    return lowered.encode("utf-8", "replace").translate(_TO_WORDS).split()


def quotations(text: str) -> list[tuple[int, int]]:
    """Places of the marks of all outermost quotations, in order.

    A closing mark ends the last quotation open that it fits; marks left open inside go. An
    apostrophe between letters is no mark. A straight mark opens only before a word and not right
    after one, and closes only after something else than white space.
    """
    stack: list[tuple[str, int]] = []
    opened = dict.fromkeys(_CLOSERS, 0)
    found: list[tuple[int, int]] = []
    for match in _MARK.finditer(text):
        mark, at = match.group(), match.start()
        before, after = text[at - 1 : at] if at else "", text[at + 1 : at + 2]
        if mark == "’" and before.isalnum() and after.isalnum():
            continue
        fits = [o for o in _OPENERS.get(mark, ()) if opened[o]]
        if fits and not (mark == '"' and (not before or before.isspace())):
            while True:
                opener, start = stack.pop()
                opened[opener] -= 1
                if opener in fits:
                    break
            while found and found[-1][0] > start:
                found.pop()
            found.append((start, at))
        elif mark in _CLOSERS and not (
            mark == '"' and (before.isalnum() or not after or after.isspace())
        ):
            stack.append((mark, at))
            opened[mark] += 1
    return found


def allowed_edits(term: str) -> int:
    """Edits by which a word may differ from a term: short terms must match as they are."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """The Levenshtein automata of all terms, intersected with the trie of the terms.

    A state is a set of trie nodes, each with the fewest edits that lead to it. Reading a character
    keeps it (an extra character in the word), follows it (a match) or follows every other branch
    (a wrong one); branches may also be followed without reading (a missing one). States and steps
    are worked out when a word first needs them and remembered.
    """

    def __init__(self, terms: Iterable[str]) -> None:
        self._children: list[dict[str, int]] = [{}]
        self._most: list[int] = [0]
        self._term: dict[int, int] = {}
        for term in sorted(set(terms)):
            edits, node = allowed_edits(term), 0
            self._most[0] = max(self._most[0], edits)
            for char in term:
                if char not in self._children[node]:
                    self._children[node][char] = len(self._children)
                    self._children.append({})
                    self._most.append(0)
                node = self._children[node][char]
                self._most[node] = max(self._most[node], edits)
            self._term[node] = edits
        self._forget()

    def _forget(self) -> None:
        self._steps: dict[tuple[int, str], int] = {}
        self._numbers: dict[tuple[tuple[int, int], ...], int] = {}
        self._states: list[tuple[tuple[int, int], ...]] = []
        self._start = self._number({0: 0})

    def _number(self, edits: dict[int, int]) -> int:
        """The number of a state, after adding the nodes reached by skipping their characters."""
        todo = list(edits)
        while todo:
            node = todo.pop()
            for child in self._children[node].values():
                e = edits[node] + 1
                if e <= self._most[child] and e < edits.get(child, 9):
                    edits[child] = e
                    todo.append(child)
        key = tuple(sorted(edits.items()))
        if key not in self._numbers:
            self._numbers[key] = len(self._states)
            self._states.append(key)
        return self._numbers[key]

    def _step(self, state: int, char: str) -> int:
        after: dict[int, int] = {}
        for node, edits in self._states[state]:
            if edits < self._most[node]:
                after[node] = min(after.get(node, 9), edits + 1)
            for branch, child in self._children[node].items():
                e = edits + (branch != char)
                if e <= self._most[child]:
                    after[child] = min(after.get(child, 9), e)
        self._steps[state, char] = number = self._number(after)
        return number

    def distance(self, word: str) -> int | None:
        """Edits to the nearest term that allows as many, None if there is none."""
        if len(self._steps) > KNOWN_STEPS:
            self._forget()
        state = self._start
        for char in word:
            at = self._steps.get((state, char))
            state = self._step(state, char) if at is None else at
            if not self._states[state]:
                return None
        found = [e for node, e in self._states[state] if e <= self._term.get(node, -1)]
        return min(found, default=None)


class _Known(dict):
    """Distances of words already met."""

    def __init__(self, automaton: LexiconAutomaton) -> None:
        super().__init__()
        self._automaton = automaton

    def __missing__(self, word: bytes) -> int | None:
        found = self._automaton.distance(word.decode("utf-8", "replace"))
        self[word] = found
        return found


class ToxicityModel:
    """Terms, weights of context words, and the weights of a document's features."""

    def __init__(self, terms: Iterable[str], context: Mapping[str, float] | None = None) -> None:
        self.terms = sorted(set(terms))
        self.context = dict(context or {})
        self.weights = np.zeros(N_FEATURES + 1)
        self._known: _Known | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": None}

    def hits(self, text: str | None) -> list[tuple[str, int, bool, list[str]]]:
        """Of each hit: the word, its distance, whether it is quoted, and the words around it."""
        if self._known is None or len(self._known) > KNOWN_WORDS:
            self._known = _Known(LexiconAutomaton(self.terms))
        known = self._known
        found = {w.decode("utf-8", "replace") for w in set(_words(text)) if known[w] is not None}
        if not found:
            return []
        lowered = text.lower()
        words = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(lowered)]
        quotes = quotations(lowered)
        opens = [start for start, _ in quotes]
        hits = []
        for i, (word, start, end) in enumerate(words):
            if word in found:
                near = words[max(0, i - CONTEXT_WORDS) : i] + words[i + 1 : i + 1 + CONTEXT_WORDS]
                last = bisect_left(opens, start) - 1
                quoted = last >= 0 and quotes[last][1] >= end
                around = [w for w, _, _ in near if w not in found]
                hits.append((word, known[word.encode("utf-8", "replace")], quoted, around))
        return hits

    def features(self, text: str | None) -> list[float]:
        hits = self.hits(text)
        if not hits:
            return [0.0] * N_FEATURES
        open_words = {(word, distance) for word, distance, in_quotes, _ in hits if not in_quotes}
        by_distance = [sum(d == e for _, d in open_words) for e in range(3)]
        quoted = len({word for word, _, in_quotes, _ in hits if in_quotes})
        around = sum(self.context.get(w, 0.0) for _, _, _, near in hits for w in near)
        return [
            float(len(open_words) > 0),
            float(by_distance[0] > 0),
            *map(float, np.log1p(by_distance)),
            float(np.log1p(quoted)),
            float(np.clip(around / len(hits), -3, 3)),
        ]

    def fit(self, features: np.ndarray, toxic: np.ndarray, penalty: float = 0.05) -> None:
        """Logistic regression; evidence that would count against toxicity is left out."""
        used = np.ones(features.shape[1], dtype=bool)
        while True:
            weights = self._newton(features * used, toxic, penalty)
            against = used[:N_EVIDENCE] & (weights[:N_EVIDENCE] < 0)
            if not against.any():
                break
            used[:N_EVIDENCE] &= ~against
        self.weights = weights

    @staticmethod
    def _newton(features: np.ndarray, toxic: np.ndarray, penalty: float) -> np.ndarray:
        x = np.hstack([features, np.ones((len(features), 1))])
        w = np.zeros(x.shape[1])
        ridge = np.full(x.shape[1], penalty)
        ridge[-1] = 1e-3
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (toxic - p) - ridge * w
            curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            step = np.linalg.solve(curve, slope)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        return w

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _neighbours(train: DataFrame, toxic: int, wanted: frozenset[bytes] | None) -> DataFrame:
    """``word, n``: the different words that come before a word in documents of one label."""

    def pairs(batches):
        for frame in batches:
            for i in range(0, len(frame), DOCS_PER_BATCH):
                rows = set()
                for text in frame["text"].iloc[i : i + DOCS_PER_BATCH]:
                    words = _words(text)
                    rows.update(
                        (word, before)
                        for before, word in zip([b"", *words], words)
                        if wanted is None or word in wanted
                    )
                yield pd.DataFrame(list(rows), columns=["word", "before"])

    texts = train.where(F.col("toxic") == toxic).select("text")
    found = texts.mapInPandas(pairs, "word binary, before binary").distinct()
    counted = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.decode("word", "UTF-8").alias("word"), "n")


def _lexicon(train: DataFrame) -> list[str]:
    toxic = {
        r["word"]: r["n"]
        for r in _neighbours(train, 1, None).where(F.col("n") >= LEAST_NEIGHBOURS).collect()
    }
    if not toxic:
        return []
    wanted = frozenset(w.encode("utf-8") for w in toxic)
    clean = {r["word"]: r["n"] for r in _neighbours(train, 0, wanted).collect()}
    return [w for w, n in toxic.items() if n >= LEAST_SHARE * (n + clean.get(w, 0))]


def _context(train: DataFrame, model: ToxicityModel) -> dict[str, float]:
    """Log-odds of the words around hits that also occur around hits in clean documents."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def around(batches):
        for frame in batches:
            rows = [
                (word, int(toxic))
                for text, toxic in zip(frame["text"], frame["toxic"])
                for _, _, _, near in shared.value.hits(text)
                for word in near
            ]
            yield pd.DataFrame(rows, columns=["word", "toxic"])

    near = train.select("text", "toxic").mapInPandas(around, "word string, toxic int")
    counts = near.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    rows = counts.where(
        (F.col("toxic") + F.col("clean") >= LEAST_CONTEXT_HITS) & (F.col("clean") >= 2)
    ).collect()
    all_toxic = sum(r["toxic"] for r in rows) + 1.0
    all_clean = sum(r["clean"] for r in rows) + 1.0
    return {
        r["word"]: float(
            np.clip(
                np.log((r["toxic"] + 1) / all_toxic) - np.log((r["clean"] + 1) / all_clean), -2, 2
            )
        )
        for r in rows
    }


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """Learns from labelled documents outside the held-out fold.

    ``sample_rows`` bounds the labelled ids; a hash decides which. An id with several labels is
    toxic if one says so. The sample's texts are stored once. Without toxic or without clean rows
    the model has no terms and scores every text by the share of toxic rows.
    """
    labelled = (
        labels.where(F.col(label_col).isNotNull() & (fold(F.col(f"`{id_col}`")) != HELD_OUT_FOLD))
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg(F.max(label_col).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    train = stored(texts.join(F.broadcast(labelled), "id").select("text", "toxic"))
    model = ToxicityModel(_lexicon(train))
    model.context = _context(train, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def featured(batches):
        for frame in batches:
            rows = [shared.value.features(t) for t in frame["text"]]
            yield pd.DataFrame({"features": rows, "toxic": frame["toxic"].astype("int32")})

    rows = train.mapInPandas(featured, "features array<double>, toxic int").groupBy(
        "features", "toxic"
    ).count().collect()
    if rows:
        times = np.array([r["count"] for r in rows])
        model.fit(
            np.repeat(np.array([r["features"] for r in rows]), times, axis=0),
            np.repeat(np.array([r["toxic"] for r in rows], dtype=float), times),
        )
    return model


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (replacing such columns).

    The score is the probability of the label. Nothing but the text goes into it: the lexicon terms
    found in it, up to two edits away for long terms, whether they stand in quotes, and the words
    around them.

    Defined cases: null and empty texts have no hits and get the score of texts without hits; each
    row is scored by itself, so repeated rows get equal scores; an empty table gives an empty one.
    """
    require(docs, [text_col])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = [shared.value.features(t) for t in texts]
        return pd.Series(shared.value.scores(np.array(rows).reshape(len(rows), N_FEATURES)))

    scored = docs.withColumn("_score", score.asNondeterministic()(F.col(f"`{text_col}`")))
    new = {"score": F.col("_score"), "predicted": (F.col("_score") >= 0.5).cast("int")}
    return with_columns(scored, new).drop("_score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = fold(F.col("doc_id")) == HELD_OUT_FOLD
    return score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )
