"""Language-model scores: word counts with smoothing, and the likelihood of subword lattices."""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import fold, require, stored, table, with_columns
from trawl.llm.hashing import split_lower

HELD_OUT_FOLD = 1
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
# Rounds in which piece scores are fitted to the training words, and what every piece has at least.
ROUNDS = 2
PIECE_PRIOR = 0.5
# At most so many of the most frequent training words are broadcast, with counts and marginals.
FREQUENT_WORDS = 200_000
# Counts are told apart by this many steps per doubling when the frequent words are chosen.
STEPS_PER_DOUBLING = 8
# Words a worker counts before it passes them on, or remembers.
COUNTED_WORDS = 100_000
KNOWN_WORDS = 80_000
TEXTS_AT_ONCE = 200
CODES_AT_ONCE = 100_000

_START = "▁"


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - 2**63


def read_pieces(path: str) -> list[str]:
    """Pieces of a vocabulary file in its order, best first, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


class SubwordLattice:
    """All segmentations of words into pieces, weighted by the pieces' log probabilities.

    A word is written with a start mark. Besides pieces of the vocabulary, every character may be
    spelt by its bytes, so each word has a segmentation. Numbers: the pieces, then 256 bytes, then
    the end of a text. The recursions run over many words of one length at a time.
    """

    def __init__(self, pieces: Sequence[str], log_probs: np.ndarray) -> None:
        self._bytes = len(pieces)
        self.end = self._bytes + 256
        self._log = np.append(log_probs, -np.inf)
        hashes, numbers = [], []
        for places, codes in _by_length(pieces):
            rolled = np.zeros(len(codes), np.uint64)
            for i in range(codes.shape[1]):
                rolled = _roll(rolled, codes[:, i])
                hashes.append(rolled)
                whole = i == codes.shape[1] - 1
                numbers.append(places if whole else np.full(len(places), -1))
        hashed, number = np.concatenate(hashes), np.concatenate(numbers)
        order = np.lexsort((number, hashed))  # of a prefix that is a piece too, the piece
        last = np.append(hashed[order][1:] != hashed[order][:-1], True)
        self._prefixes, self._piece = hashed[order][last], number[order][last]
        # Where prefixes with these leading bits begin, and how many places there are to look at.
        self._shift = np.uint64(64 - max(8, len(self._prefixes).bit_length() + 2))
        begins = np.arange((1 << (64 - int(self._shift))) + 1, dtype=np.uint64) << self._shift
        self._begins = np.searchsorted(self._prefixes, begins[:-1]).astype(np.int32)
        after = np.append(self._begins[1:], len(self._prefixes))
        self._places = int((after - self._begins).max())

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are those of a prefix, and the places of these prefixes."""
        at = self._begins[hashes >> self._shift]
        last = len(self._prefixes) - 1
        found = np.minimum(at, last)
        for i in range(1, self._places):
            nearer = self._prefixes[found] < hashes
            if not nearer.any():
                break
            found = np.where(nearer, np.minimum(at + i, last), found)
        known = np.flatnonzero(self._prefixes[found] == hashes)
        return known, found[known]

    def end_score(self) -> float:
        return float(self._log[self.end])

    def _edges(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``start, end, words, pieces``: which words have which piece there, from left to right."""
        size = codes.shape[1]
        for start in range(size):
            words = np.arange(len(codes))
            rolled = np.zeros(len(codes), np.uint64)
            for i in range(start, size):
                rolled = _roll(rolled, codes[words, i])
                known, at = self._find(rolled)
                words, rolled, piece = words[known], rolled[known], self._piece[at]
                if not len(words):
                    break
                some = piece >= 0
                if some.any():
                    yield start, i + 1, words[some], piece[some]

    def _spelt(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Log probability of spelling each character; which character it is; their bytes."""
        chars, which = np.unique(codes, return_inverse=True)
        spelling = [
            np.frombuffer(chr(c).encode("utf-8", "replace"), np.uint8).astype(int) + self._bytes
            for c in chars.tolist()
        ]
        score = np.array([self._log[numbers].sum() for numbers in spelling])
        which = which.reshape(codes.shape)
        return score[which], which, spelling

    def _forward(self, codes: np.ndarray, edges: list, spelt: np.ndarray) -> np.ndarray:
        forward = np.full((len(codes), codes.shape[1] + 1), -np.inf)
        forward[:, 0] = 0.0
        todo = iter(edges)
        edge = next(todo, None)
        for start in range(codes.shape[1]):
            forward[:, start + 1] = np.logaddexp(
                forward[:, start + 1], forward[:, start] + spelt[:, start]
            )
            while edge is not None and edge[0] == start:
                _, end, words, piece = edge
                reached = forward[words, start] + self._log[piece]
                forward[words, end] = np.logaddexp(forward[words, end], reached)
                edge = next(todo, None)
        return forward

    def marginals(self, words: Sequence[str]) -> np.ndarray:
        """Natural log of each word's sum over all segmentations, by the forward recursion."""
        out = np.zeros(len(words))
        for places, codes in _by_length([_START + word for word in words]):
            spelt = self._spelt(codes)[0]
            out[places] = self._forward(codes, self._edges(codes), spelt)[:, -1]
        return out

    def expected(self, words: Sequence[str], times: np.ndarray, totals: np.ndarray) -> None:
        """Adds how often each piece is expected in so many occurrences of the words."""
        for places, codes in _by_length([_START + word for word in words]):
            spelt, which, spelling = self._spelt(codes)
            edges = list(self._edges(codes))
            forward = self._forward(codes, edges, spelt)
            backward = np.full(forward.shape, -np.inf)
            backward[:, -1] = 0.0
            todo = reversed(edges)
            edge = next(todo, None)
            for start in range(codes.shape[1] - 1, -1, -1):
                backward[:, start] = backward[:, start + 1] + spelt[:, start]
                while edge is not None and edge[0] == start:
                    _, end, own, piece = edge
                    reached = backward[own, end] + self._log[piece]
                    backward[own, start] = np.logaddexp(backward[own, start], reached)
                    edge = next(todo, None)
            whole, often = forward[:, -1], times[places]
            for start, end, own, piece in edges:
                part = forward[own, start] + self._log[piece] + backward[own, end] - whole[own]
                part = often[own] * np.exp(part)
                totals += np.bincount(piece, part, len(totals))
            part = forward[:, :-1] + spelt + backward[:, 1:] - whole[:, None]
            part = often[:, None] * np.exp(part)
            for char, n in enumerate(np.bincount(which.ravel(), part.ravel(), len(spelling))):
                np.add.at(totals, spelling[char], n)


def _roll(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ codes) * np.uint64(0x9E3779B97F4A7C15)
    return hashes ^ (hashes >> np.uint64(32))


def _by_length(words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where words of one length stand, and their characters' codes, one row a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts):
        size = int(sizes[group[0]]) if len(group) else 0
        step = max(1, CODES_AT_ONCE // max(1, size))
        for i in range(0, len(group) if size else 0, step):
            places = group[i : i + step]
            text = "".join([words[k] for k in places.tolist()])
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            yield places, codes.reshape(len(places), size).astype(np.uint64)


@dataclass(frozen=True)
class LanguageModel:
    """``counts``: stored ``word, n`` of the training words. ``texts`` counts their documents."""

    counts: DataFrame
    texts: int
    tokens: int
    distinct: int
    pieces: list[str]
    log_probs: np.ndarray


def _word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` of all words; a task sums up many documents before it passes words on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counter.update(split_lower(text.as_py()))
                if len(counter) >= COUNTED_WORDS:
                    yield _counted(counter)
                    counter.clear()
        yield _counted(counter)

    found = texts.mapInArrow(count, "word binary, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counter: Counter[bytes]) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "word": pa.array(counter.keys(), pa.binary()),
            "n": pa.array(counter.values(), pa.int64()),
        }
    )


def _refit(
    counts: DataFrame, pieces: list[str], log_probs: np.ndarray, texts: int
) -> np.ndarray:
    """One round of expectation and maximisation over all training words."""
    shared = counts.sparkSession.sparkContext.broadcast((pieces, log_probs))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = SubwordLattice(*shared.value)
        totals = np.zeros(len(shared.value[1]))
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            lattice.expected(words, batch.column("n").to_numpy().astype(float), totals)
        used = np.flatnonzero(totals)
        yield pa.record_batch({"piece": pa.array(used), "n": pa.array(totals[used])})

    rows = (
        counts.mapInArrow(expect, "piece bigint, n double").groupBy("piece").agg(F.sum("n")).collect()
    )
    totals = np.full(len(log_probs), PIECE_PRIOR)
    for piece, n in rows:
        totals[piece] += n
    totals[-1] += texts
    return np.log(totals / totals.sum())


def fit_language_model(
    texts: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, rounds: int = ROUNDS
) -> LanguageModel:
    """Counts the words of all training texts and fits the pieces' scores to them.

    The vocabulary is given; its order gives the scores to begin with (by Zipf's law), bytes and the
    end of a text coming last. Each round spreads every word's count over its segmentations. Only
    one number per piece comes to the driver.
    """
    column = texts.select(F.col(f"`{text_col}`").alias("text"))
    counts = stored(_word_counts(column))
    n_texts = column.count()
    row = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    pieces = read_pieces(vocabulary)
    weights = 1.0 / np.arange(10, len(pieces) + 267)
    log_probs = np.log(weights / weights.sum())
    for _ in range(rounds):
        log_probs = _refit(counts, pieces, log_probs, n_texts)
    some = int(n_texts > 0)
    return LanguageModel(
        counts, n_texts, (row[0] or 0) + n_texts, row[1] + some, pieces, log_probs
    )


def _frequent_words(model: LanguageModel, most: int) -> tuple[int, pa.Table]:
    """The least count of a frequent word, and ``word, n, marginal`` of all words of that count on.

    These are at most ``most``, and any other word has no more than about ``1 / most`` of the tokens.
    """
    step = F.floor(F.log2("n") * STEPS_PER_DOUBLING)
    steps = (
        model.counts.groupBy(step.alias("step"))
        .agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
        .orderBy(F.desc("step"))
        .collect()
    )
    taken, least = 0, model.tokens + 1
    for row in steps:
        taken += row["words"]
        if taken > most:
            break
        least = row["least"]
    shared = model.counts.sparkSession.sparkContext.broadcast((model.pieces, model.log_probs))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = SubwordLattice(*shared.value)
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            marginals = pa.array(lattice.marginals(words))
            yield pa.record_batch([*batch.columns, marginals], names=["word", "n", "marginal"])

    frequent = model.counts.where(F.col("n") >= least).select("word", "n")
    return least, frequent.mapInArrow(weigh, "word binary, n bigint, marginal double").toArrow()


def score_texts(
    docs: DataFrame,
    model: LanguageModel,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    frequent_words: int = FREQUENT_WORDS,
) -> DataFrame:
    """``docs`` with ``n_tokens, n_known, train_tokens, base_score, score`` (replacing such columns).

    ``keep`` names the columns of ``docs`` that come along, all by default; they are stored once.

    Tokens are the words between ASCII white space, with A-Z lower-cased, and one end of the text.
    ``base_score`` adds up log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens: c counts the token, N
    all and V the different training tokens. ``score`` is log10 of the text's probability when
    pieces are drawn one after another: a word's probability is summed over all its segmentations
    by the forward recursion, and the end of the text is a draw as well.

    Defined cases: null and empty texts have only their end; without training texts every count is
    0; each row is scored by itself, repeated rows alike; an empty table gives an empty one.

    At most ``frequent_words`` of the most frequent training words are broadcast with their counts
    and marginals. Those of the others that a document has travel as hashes and meet their counts in
    a join, no key of which has more than about ``1 / frequent_words`` of the training tokens; a
    worker works their marginals out as it meets them. The number changes the plan only.
    """
    require(docs, [text_col])
    spark = docs.sparkSession
    least, frequent = _frequent_words(model, frequent_words)
    bottom = math.log10(model.tokens + 0.5 * (model.distinct + 1))
    shared = spark.sparkContext.broadcast(
        (frequent, model.pieces, model.log_probs, math.log10(model.texts + 0.5), model.texts > 0)
    )
    kind = T.StructType(
        [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("known", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rare", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )

    @F.arrow_udf(kind)
    def read(texts: pa.Array) -> pa.Array:
        frequent, pieces, log_probs, end_base, end_known = shared.value
        if not memory:
            memory["lattice"] = SubwordLattice(pieces, log_probs)
            logged = np.log10(frequent["n"].to_numpy() + 0.5).tolist()
            marginals = frequent["marginal"].to_pylist()
            memory["often"] = dict(zip(frequent["word"].to_pylist(), zip(logged, marginals)))
            memory["known"] = {}
        lattice, often, known_words = memory["lattice"], memory["often"], memory["known"]
        rare, times, ends = array("q"), array("i"), [0]
        numbers: list[tuple[int, int, float, float]] = []
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            counters = [Counter(split_lower(t.as_py())) for t in texts[i : i + TEXTS_AT_ONCE]]
            _remember(known_words, lattice, set().union(*counters).difference(often))
            for counted in counters:
                base, score, known = end_base, lattice.end_score(), int(end_known)
                for word, n in counted.items():
                    found = often.get(word)
                    if found is None:
                        score += n * known_words[word]
                        rare.append(_hash(word))
                        times.append(n)
                    else:
                        base += n * found[0]
                        score += n * found[1]
                        known += n
                ends.append(len(rare))
                numbers.append((counted.total() + 1, known, base, score / math.log(10)))
        columns = list(zip(*numbers)) if numbers else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        arrays = [pa.array(column, k) for column, k in zip(columns, kinds)]
        for flat in (rare, times):
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), np.asarray(flat)))
        return pa.StructArray.from_arrays(arrays, names=kind.names)

    memory: dict = {}
    others = list(docs.columns if keep is None else keep)
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("own"),
        read.asNondeterministic()(F.col(f"`{text_col}`")).alias("read"),
    )
    found = stored(marked.withColumn("row", F.monotonically_increasing_id()))
    tokens = found.select("row", F.inline(F.arrays_zip("read.rare", "read.times"))).toDF(
        "row", "key", "times"
    )
    counts = (
        model.counts.where(F.col("n") < least)
        .select(_hash_column("word").alias("key"), "n")
    )
    logged = F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    rare = (
        tokens.join(counts, "key", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * logged).alias("rare_base"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    added = found.select("row", "own", "read.n_tokens", "read.known", "read.base", "read.score")
    joined = added.join(rare, "row", "left")
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(bottom)
    named = joined.select(
        *[F.col("own").getField(c).alias(c) for c in others],
        F.col("n_tokens").alias("_n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("_known"),
        base.alias("_base"),
        F.col("score").alias("_score"),
    )
    new = {
        "n_tokens": F.col("_n_tokens"),
        "n_known": F.col("_known"),
        "train_tokens": F.lit(model.tokens).cast("bigint"),
        "base_score": F.col("_base"),
        "score": F.col("_score"),
    }
    return with_columns(named, new).drop("_n_tokens", "_known", "_base", "_score")


def _remember(known: dict[bytes, float], lattice: SubwordLattice, used: set[bytes]) -> None:
    """Adds the marginal of each word to the known ones, or starts these anew."""
    new = list(used.difference(known))
    if len(known) + len(new) > KNOWN_WORDS:
        known.clear()
        new = list(used)
    marginals = lattice.marginals([word.decode("utf-8", "replace") for word in new])
    known.update(zip(new, marginals.tolist()))


@F.arrow_udf(T.LongType())
def _hash_column(words: pa.Array) -> pa.Array:
    return pa.array([_hash(w.as_py()) for w in words], pa.int64())


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id")) == HELD_OUT_FOLD
    model = fit_language_model(docs.where(~held_out))
    return score_texts(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )
