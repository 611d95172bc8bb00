"""Finding and cutting out passages of benchmark items with a generalised suffix automaton."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trawl.llm.common import free_names, require, table, with_columns

WINDOW = 10
# Benchmark text that goes in one automaton; a larger benchmark is matched in several rounds.
CHARS_PER_AUTOMATON = 16_000_000

# ASCII digits and letters and everything beyond ASCII make words.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_FOUND = "n_words bigint, spans array<struct<first int, after int>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TO_WORDS).split()


class ItemAutomaton:
    """Suffix automaton of the word sequences of all items of a benchmark.

    A state stands for word sequences with the same ends; reading a document word by word keeps
    the length of the longest sequence that ends at the word and occurs in an item. A window ends
    there if it is as long as that or shorter, and the state that holds the suffix of a window's
    length knows the items.
    """

    def __init__(self, items: Sequence[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self._next: list[dict[int, int]] = [{}]
        self._link = [-1]
        self._length = [0]
        sequences = []
        for name, text in items:
            words = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            if words:
                sequences.append((name, words))
                last = 0
                for word in words:
                    last = self._extend(last, word)
        self.least = min((min(window, len(words)) for _, words in sequences), default=window)
        self._ends: list[dict[int, set[str]]] = [{} for _ in self._link]
        for name, words in sequences:
            size = min(window, len(words))
            for state, length in self._read(words):
                if length >= size:
                    self._ends[self._holding(state, size)].setdefault(size, set()).add(name)
        self._inherit()
        n = len(self.ids)
        pairs = {a * n + b for _, words in sequences for a, b in zip(words, words[1:])}
        self._pairs = np.array(sorted(pairs), dtype=np.int64)

    def _extend(self, last: int, word: int) -> int:
        known = self._next[last].get(word)
        if known is not None:
            if self._length[known] == self._length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._add(self._length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self._next[at]:
            self._next[at][word] = state
            at = self._link[at]
        if at >= 0:
            target = self._next[at][word]
            fits = self._length[target] == self._length[at] + 1
            self._link[state] = target if fits else self._split(at, word, target)
        return state

    def _add(self, length: int, following: dict[int, int], link: int) -> int:
        self._next.append(following)
        self._length.append(length)
        self._link.append(link)
        return len(self._link) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        short = self._add(self._length[at] + 1, dict(self._next[target]), self._link[target])
        self._link[target] = short
        while at >= 0 and self._next[at].get(word) == target:
            self._next[at][word] = short
            at = self._link[at]
        return short

    def _read(self, words: Sequence[int]):
        """The state and the longest matching length after each word."""
        state = length = 0
        for word in words:
            while state and word not in self._next[state]:
                state = self._link[state]
                length = self._length[state]
            if word in self._next[state]:
                state = self._next[state][word]
                length += 1
            yield state, length

    def _holding(self, state: int, size: int) -> int:
        """The state that holds the suffix of ``size`` words."""
        while self._length[self._link[state]] >= size:
            state = self._link[state]
        return state

    def _inherit(self) -> None:
        """Give every state the windows of its suffixes: ``(size, items)``, shortest first."""
        self._windows: list[tuple[tuple[int, frozenset[str]], ...]] = [()] * len(self._link)
        for state in sorted(range(1, len(self._link)), key=self._length.__getitem__):
            own = tuple((n, frozenset(names)) for n, names in sorted(self._ends[state].items()))
            self._windows[state] = self._windows[self._link[state]] + own
        del self._ends

    def find(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered stretches ``(first, after)`` of a document's words, and the items found."""
        codes = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for first, after in self._runs(codes):
            for i, (state, length) in enumerate(self._read(codes[first:after].tolist()), first + 1):
                for size, names in self._windows[state]:
                    if size > length:
                        break
                    items |= names
                    start = i - size
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i))
        return spans, items

    def _runs(self, codes: np.ndarray):
        """Stretches whose neighbouring words are neighbours in some item: no match leaves one."""
        if not len(codes) or not self.ids:
            return
        known = codes >= 0
        pair = codes[:-1] * len(self.ids) + codes[1:]
        at = np.searchsorted(self._pairs, pair)
        joined = np.zeros(len(codes), dtype=bool)
        if len(self._pairs):
            at[at == len(self._pairs)] = 0
            joined[1:] = (self._pairs[at] == pair) & known[:-1] & known[1:]
        starts = np.flatnonzero(known & ~joined)
        last = known.copy()
        last[:-1] &= ~joined[1:]
        ends = np.flatnonzero(last) + 1
        for first, after in zip(starts.tolist(), ends.tolist()):
            if after - first >= self.least:
                yield first, after


def _automata(benchmark: DataFrame, id_col: str, text_col: str, window: int, chars: int):
    """Automata over bounded parts of the benchmark, one at a time."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
        F.col(f"`{text_col}`").alias("text"),
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // chars) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for i in range(parts):
        rows = items.where(part == i).collect()
        yield ItemAutomaton([(r["item"], r["text"]) for r in rows], window)


def _finder(spark: SparkSession, automaton: ItemAutomaton):
    shared = spark.sparkContext.broadcast(automaton)

    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        automaton = shared.value
        rows = []
        for text in texts:
            words = words_of(text)
            spans, items = automaton.find(words)
            rows.append((len(words), [{"first": a, "after": b} for a, b in spans], sorted(items)))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return find.asNondeterministic()


@F.pandas_udf(StringType())
def _cut(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
    """Texts without the words of the spans and what stands between these words."""
    return pd.Series([_without(text, spans) for text, spans in zip(texts, all_spans)])


def _without(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    words = [m.span() for m in _WORD.finditer(text)]
    left, at = [], 0
    for first, after in sorted((s["first"], s["after"]) for s in spans):
        start, end = words[first][0], words[after - 1][1]
        left.append(text[at : max(at, start)])
        at = max(at, end)
    return "".join([*left, text[at:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_words: int = 1,
    least_coverage: float = 0.0,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    chars_per_automaton: int = CHARS_PER_AUTOMATON,
) -> DataFrame:
    """``docs`` marked with the benchmark passages they hold, and a text without them.

    Words are runs of ASCII digits and letters and of characters beyond ASCII, with A-Z
    lower-cased. A window is ``window`` consecutive words of an item, or the whole of a shorter
    item; document words inside an occurrence of a window are hit. New columns, which replace ones
    of the same name: ``n_words, n_hit, items`` (ids of the items found, sorted as strings),
    ``n_items, contaminated`` and ``clean_text``, from which every stretch of hit words is cut that
    has at least ``least_words`` words or makes up ``least_coverage`` of the document's words.

    Defined cases: null and empty texts have no words and stay as they are; items without words are
    in no document; items of one id count once; a null id counts as ''; empty tables give no rows
    or no hits. Each document is judged by itself, so repeated rows get equal results.

    The benchmark is measured first. Up to ``chars_per_automaton`` characters make one automaton,
    which is broadcast; a larger benchmark is matched in as many rounds. Documents are not
    shuffled, and within them only stretches whose neighbouring words are neighbours in some item
    are read by the automaton.
    """
    require(docs, [text_col])
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    found = docs
    rounds = []
    for automaton in _automata(
        benchmark, item_id_col, item_text_col, window, chars_per_automaton
    ):
        name = free_names(docs, f"found_{len(rounds)}")[0]
        found = found.withColumn(name, _finder(spark, automaton)(text))
        rounds.append(name)
    words_, spans_, items_, cut_ = free_names(docs, "n_words", "spans", "items", "cut")
    merged = _merge([F.col(f"{name}.spans") for name in rounds])
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[f"{n}.items" for n in rounds]))))
    found = found.withColumns(
        {words_: F.col(f"{rounds[0]}.n_words"), spans_: merged, items_: items}
    )
    length = lambda s: s["after"] - s["first"]
    n_hit = F.aggregate(spans_, F.lit(0).cast("bigint"), lambda n, s: n + length(s))
    to_cut = F.filter(
        spans_,
        lambda s: (length(s) >= least_words)
        | (length(s) >= F.lit(least_coverage) * F.col(words_)),
    )
    kept = found.withColumn(cut_, to_cut)
    clean = F.when(F.size(cut_) > 0, _cut(text, F.col(cut_))).otherwise(text)
    marked = with_columns(
        kept,
        {
            "n_words": F.col(words_),
            "n_hit": n_hit,
            "items": F.col(items_),
            "n_items": F.size(items_).cast("bigint"),
            "contaminated": F.size(spans_) > 0,
            "clean_text": clean,
        },
    )
    return marked.drop(*rounds, words_, spans_, items_, cut_)


def _merge(spans: list[Column]) -> Column:
    """Overlapping stretches of several rounds made one; those of one round are apart already."""
    if len(spans) == 1:
        return spans[0]
    words = F.array_sort(
        F.array_distinct(
            F.flatten(
                F.transform(
                    F.flatten(F.array(*spans)), lambda s: F.sequence(s["first"], s["after"] - 1)
                )
            )
        )
    )
    one = F.transform(words, lambda w: F.struct(w.alias("first"), (w + 1).alias("after")))
    start = F.expr("cast(array() as array<struct<first: int, after: int>>)")

    def join(made: Column, s: Column) -> Column:
        last = F.element_at(made, -1)
        longer = F.struct(last["first"].alias("first"), s["after"].alias("after"))
        touching = (F.size(made) > 0) & (F.try_element_at(made, F.lit(-1))["after"] == s["first"])
        return F.when(
            touching, F.concat(F.slice(made, 1, F.size(made) - 1), F.array(longer))
        ).otherwise(F.concat(made, F.array(s)))

    return F.aggregate(one, start, join)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark")
    joined = F.array_join("items", ",").cast("binary")
    return decontaminate(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(joined, 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE_SQL = """
WITH split AS (
    SELECT 'doc' AS kind, doc_id::VARCHAR AS id, text FROM documents
    UNION ALL SELECT 'item', item_id::VARCHAR, text FROM benchmark
), worded AS (
    SELECT kind, id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
    FROM split
), items AS (
    SELECT id, words, least(10, len(words)) AS size FROM worded
    WHERE kind = 'item' AND len(words) > 0
), windows AS (
    SELECT DISTINCT id AS item, size, array_to_string(words[i:i + size - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
), sizes AS (
    SELECT DISTINCT size FROM windows
), doc_windows AS (
    SELECT id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
    FROM (SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM worded, sizes WHERE kind = 'doc' AND len(words) >= size)
), found AS (
    SELECT d.id, d.i, d.size, w.item FROM doc_windows d JOIN windows w USING (size, win)
), hits AS (
    SELECT id, count(DISTINCT place) AS n_hit
    FROM (SELECT id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT id, i, size FROM found))
    GROUP BY id
), named AS (
    SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT id, item FROM found) GROUP BY id
)
SELECT id::BIGINT AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN hits USING (id) LEFT JOIN named USING (id)
WHERE kind = 'doc'
"""
