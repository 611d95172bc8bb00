"""Removing passages that an earlier document has, located by Aho-Corasick automata."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import free_names, require, table, with_columns
from trawl.llm.hashing import (
    Words,
    find_words,
    least_of_runs,
    mix,
    runs,
    text_slices,
    word_hashes,
)

WINDOW = 13
# Words of an anchor: every window is looked up by one of the runs of so many words within it.
ANCHOR_WORDS = 4
# Anchors of more documents are looked up window by window, so that no lookup gathers them all.
HOT_DOCUMENTS = 2_000
# Phrases that are compiled into one automaton; results don't depend on it.
ROWS_PER_AUTOMATON = 4_000

_PHRASES = T.StructType(
    [
        T.StructField("route", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("stop", T.IntegerType()),
        T.StructField("phrase", T.BinaryType()),
    ]
)
_ARROW_PHRASES = pa.schema(
    [
        ("route", pa.int64()),
        ("id", pa.int64()),
        ("place", pa.int64()),
        ("start", pa.int32()),
        ("stop", pa.int32()),
        ("phrase", pa.binary()),
    ]
)
_ARROW_CUT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


class Windows(NamedTuple):
    """The windows of several texts: text, first word and anchor of each."""

    text: np.ndarray
    start: np.ndarray
    anchor: np.ndarray


def window_starts(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and the first word of every window; none goes from one text into the next."""
    n = np.maximum(np.diff(words.first) - window + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    return text, np.arange(len(text)) + (words.first[:-1] - (np.cumsum(n) - n))[text]


def find_windows(words: Words, hashes: np.ndarray, window: int) -> Windows:
    """All windows with their anchors.

    The anchor is the least hash of a run of words within the window, so equal windows have equal
    anchors wherever they are, and neighbouring windows mostly share one.
    """
    size = min(ANCHOR_WORDS, window)
    best = least_of_runs(mix(runs(hashes, size, seed=1)), window - size + 1)
    text, start = window_starts(words, window)
    return Windows(text, start, best[start])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it in a column."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = columns[0][1:] != columns[0][:-1]
        for column in columns[1:]:
            new[1:] |= column[1:] != column[:-1]
    return new


def _anchor_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(), batch.column("text")
            for begin, end in text_slices(texts):
                words = find_words(texts.slice(begin, end - begin))
                found = find_windows(words, word_hashes(words), window)
                new = _changes(found.text, found.anchor)
                text, anchor = found.text[new], found.anchor[new]
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                new = _changes(text, anchor)
                yield pa.record_batch(
                    {
                        "anchor": pa.array(anchor[new].view(np.int64)),
                        "id": pa.array(ids[begin:end][text[new]]),
                    }
                )

    return rows


def _recurring_rows(hot_documents: int):
    """``id, anchor, hot`` where an anchor has two ids or more; rows come by anchor, then id.

    Only the rows of one anchor are kept at hand, and these up to ``hot_documents``.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = ids = np.zeros(0, np.int64)
        streaming = None

        def out(anchor: np.ndarray, doc: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch(
                {"id": pa.array(doc), "anchor": pa.array(anchor), "hot": pa.array(hot)}
            )

        def closed(anchor: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
            begins = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            ends = np.append(begins[1:], len(anchor))
            keep = np.repeat(doc[begins] != doc[ends - 1], ends - begins)
            hot = np.repeat(ends - begins > hot_documents, ends - begins)
            return out(anchor[keep], doc[keep], hot[keep])

        for batch in batches:
            anchor, doc = batch.column("anchor").to_numpy(), batch.column("id").to_numpy()
            if streaming is not None and len(anchor):
                same = int(np.searchsorted(anchor != streaming, True))
                if same:
                    yield out(anchor[:same], doc[:same], np.ones(same, bool))
                if same == len(anchor):
                    continue
                streaming, anchor, doc = None, anchor[same:], doc[same:]
            anchors, ids = np.append(anchors, anchor), np.append(ids, doc)
            if not len(anchors):
                continue
            last = len(anchors) - int(np.searchsorted(anchors[::-1] != anchors[-1], True))
            if last:
                yield closed(anchors[:last], ids[:last])
            anchors, ids = anchors[last:], ids[last:]
            if len(anchors) > hot_documents and ids[0] != ids[-1]:
                streaming = anchors[-1]
                yield out(anchors, ids, np.ones(len(ids), bool))
                anchors = ids = np.zeros(0, np.int64)
        if len(anchors):
            yield closed(anchors, ids)

    return rows


def _phrase_rows(window: int):
    """The candidate windows of documents, as phrases for the automata or as settled stretches.

    Of equal windows in a batch only that of the least id has to be looked up; the others are
    settled. Neighbouring windows of one anchor travel as one phrase.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("anchors").is_valid())
            texts = batch.column("text")
            parts = [
                _candidates(batch.slice(begin, end - begin), begin, window)
                for begin, end in text_slices(texts)
            ]
            if parts:
                yield from _to_phrases(batch, parts, window)

    return rows


def _candidates(batch: pa.RecordBatch, row: int, window: int) -> tuple[Words, list[np.ndarray]]:
    """The words of a slice of documents, and its windows with an anchor that recurs.

    Of each window: row in the whole batch, first word, hash, anchor, and if the anchor is hot.
    """
    words = find_words(batch.column("text"))
    hashes = word_hashes(words)
    found = find_windows(words, hashes, window)
    anchors, hot = batch.column("anchors"), batch.column("hot")
    # One number for a document and an anchor; where two meet, a window is looked up in vain.
    salt = mix(np.arange(1, len(batch) + 1, dtype=np.uint64))
    lengths = anchors.value_lengths().to_numpy(zero_copy_only=False)
    listed = anchors.flatten().to_numpy().view(np.uint64) + np.repeat(salt, lengths)
    new = _changes(found.text, found.anchor)
    stretch = np.cumsum(new) - 1
    text, anchor = found.text[new], found.anchor[new]
    wanted = np.isin(anchor + salt[text], listed)
    is_hot = np.isin(anchor, hot.flatten().to_numpy().view(np.uint64))
    at = np.flatnonzero(wanted[stretch])
    start, stretch = found.start[at], stretch[at]
    content = runs(hashes, window, seed=2)[start]
    return words, [row + text[stretch], start, content, anchor[stretch], is_hot[stretch]]


def _to_phrases(batch: pa.RecordBatch, parts: list, window: int) -> list[pa.RecordBatch]:
    ids, places = (batch.column(c).to_numpy() for c in ("id", "place"))
    joined = b"".join(words.joined for words, _ in parts)
    letters = np.cumsum([0, *(len(words.joined) for words, _ in parts)]).tolist()
    counts = np.cumsum([0, *(words.first[-1] for words, _ in parts)]).tolist()
    bounds = np.concatenate([w.start[:-1] + n for (w, _), n in zip(parts, letters)])
    bounds = np.append(bounds, letters[-1])
    first = np.concatenate([w.first[:-1] + n for (w, _), n in zip(parts, counts)])
    of, start, content, anchor, hot = (
        np.concatenate(c) for c in zip(*(columns for _, columns in parts))
    )
    start = start + np.repeat(counts[:-1], [len(columns[0]) for _, columns in parts])
    settled = _settled(joined, bounds, ids[of], start, content, window)
    batches = []
    for kind in (False, True):
        chosen = np.flatnonzero(settled == kind)
        if not len(chosen):
            continue
        o, s, a, h = of[chosen], start[chosen], anchor[chosen], hot[chosen]
        new = _changes(o, s - np.arange(len(s)))
        if not kind:
            new |= _changes(a) | h
        begins = np.flatnonzero(new)
        doc, begin = o[begins], s[begins]
        stop = s[np.append(begins[1:], len(chosen)) - 1] + window
        keys = np.where(h, content[chosen], a)[begins].view(np.int64)
        phrases = pa.nulls(len(doc), pa.binary())
        if not kind:
            spans = zip(bounds[begin].tolist(), (bounds[stop] - 1).tolist())
            phrases = pa.array([joined[b:e] for b, e in spans], pa.binary())
        own = first[doc]
        numbers = (places[doc] if kind else keys, ids[doc], places[doc], begin - own, stop - own)
        arrays = [pa.array(c, f.type) for c, f in zip(numbers, _ARROW_PHRASES)]
        batches.append(pa.RecordBatch.from_arrays([*arrays, phrases], schema=_ARROW_PHRASES))
    return batches


def _settled(
    joined: bytes,
    bounds: np.ndarray,
    ids: np.ndarray,
    start: np.ndarray,
    content: np.ndarray,
    window: int,
) -> np.ndarray:
    """Which windows are, word for word, one of a lesser id in the same batch."""
    order = np.lexsort((ids, content))
    new = _changes(content[order])
    least = np.zeros(len(order), np.int64)
    least[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.flatnonzero(ids > ids[least])
    own, other = start[later], start[least[later]]
    # Neighbouring windows with neighbouring counterparts are compared as one.
    begins = np.flatnonzero(_changes(own - np.arange(len(own)), other - own))
    ends = np.append(begins[1:], len(later))[: len(begins)] - 1
    spans = (
        edge.tolist()
        for words in (own, other)
        for edge in (bounds[words[begins]], bounds[words[ends] + window])
    )
    equal = [joined[a:b] == joined[c:d] for a, b, c, d in zip(*spans)]
    settled = np.zeros(len(ids), bool)
    settled[later] = np.repeat(np.array(equal, bool), ends - begins + 1)
    return settled


class PhraseShard:
    """Confirms the windows that recur among phrases and finds all their occurrences."""

    def __init__(self, window: int) -> None:
        self._window = window
        self._route: int | None = None
        self._seen: dict[bytes, int] = {}

    def find(self, rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        """``id, place, start, stop`` of stretches that a phrase of a lesser id has.

        Rows ``(route, id, place, start, phrase)`` come by route and id, and equal windows have
        equal routes. The windows of the last route are remembered, as it may go on.
        """
        route, seen = self._route, self._seen
        recurring: dict[bytes, int] = {}
        repeating: dict[int, None] = {}
        last = -1
        for number, begin, end, phrase_begin in self._may_recur(rows):
            row = rows[number]
            if number != last:
                last = number
                if row[0] != route:
                    route, seen = row[0], {}
                doc, phrase = row[1], row[4]
            window = phrase[begin - phrase_begin : end - phrase_begin]
            known = seen.setdefault(window, doc)
            if known < doc:
                recurring[window] = known
                repeating[number] = None
        self._route, self._seen = route, seen
        return self._locate([rows[i] for i in repeating], recurring) if recurring else []

    def _may_recur(self, rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        """Row, begin, end and begin of the row's phrase, for every window that may recur.

        These are the ones whose hash two ids have. Of the first route, if it goes on, and of the
        last one, which may go on, they are all.
        """
        n = self._window
        words = find_words(pa.array([row[4] for row in rows], pa.binary()))
        text, start = window_starts(words, n)
        content = runs(word_hashes(words), n, seed=2)[start]
        routes = np.array([row[0] for row in rows], np.int64)
        ids = np.array([row[1] for row in rows], np.int64)[text]
        order = np.argsort(content, kind="stable")
        new = _changes(content[order])
        begins = np.flatnonzero(new)
        several = np.zeros(len(text), bool)
        if len(text):
            ordered = ids[order]
            differ = np.minimum.reduceat(ordered, begins) < np.maximum.reduceat(ordered, begins)
            several[order] = differ[np.cumsum(new) - 1]
        open_rows = routes == routes[-1]
        if self._route is not None:
            open_rows |= routes == self._route
        at = np.flatnonzero(several | open_rows[text])
        text, start = text[at], start[at]
        columns = (text, words.start[start], words.start[start + n] - 1, words.start[words.first[text]])
        return zip(*(column.tolist() for column in columns))

    def _locate(self, rows: list, recurring: dict[bytes, int]) -> list[tuple[int, int, int, int]]:
        """Compiles the confirmed windows and finds them in the phrases that repeat some."""
        codes = _Codes()
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, doc in recurring.items():
            automaton.add_word(tuple(map(codes.__getitem__, window.split(b" "))), doc)
        automaton.make_automaton()
        hits: dict[bytes, list[tuple[int, int]]] = {}
        found = []
        for _, doc, place, start, phrase in rows:
            inside = hits.get(phrase)
            if inside is None:
                coded = tuple(map(codes.get, phrase.split(b" "), repeat(0)))
                inside = hits[phrase] = list(automaton.iter(coded))
            low = high = -1
            for end, least in inside:
                if least >= doc:
                    continue
                begin = end - self._window + 1
                if begin > high:
                    if high >= 0:
                        found.append((doc, place, start + low, start + high))
                    low = begin
                high = end + 1
            if high >= 0:
                found.append((doc, place, start + low, start + high))
        return found


class _Codes(dict):
    """Numbers of words from 1, given as they are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self) + 1
        return code


def _located_rows(window: int, rows_per_automaton: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = PhraseShard(window)
        for batch in batches:
            settled = batch.column("phrase").is_null()
            open_rows = batch.filter(pc.invert(settled))
            lists = (open_rows.column(c) for c in ("route", "id", "place", "start"))
            lists = (column.to_numpy().tolist() for column in lists)
            found = []
            todo = list(zip(*lists, open_rows.column("phrase").to_pylist()))
            for i in range(0, len(todo), rows_per_automaton):
                found += shard.find(todo[i : i + rows_per_automaton])
            columns = list(zip(*found)) if found else [[]] * 4
            names = ["id", "place", "start", "stop"]
            yield batch.filter(settled).select(names)
            yield pa.record_batch(
                [pa.array(c, _ARROW_PHRASES.field(n).type) for c, n in zip(columns, names)], names=names
            )

    return rows


@F.arrow_udf(
    T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
)
def _cut(places: pa.Array, texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Words outside the spans of a document's own text, joined by a space."""
    parts = [
        _cut_slice(*(column.slice(begin, end - begin) for column in (places, texts, spans)))
        for begin, end in text_slices(texts)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], _ARROW_CUT)


def _cut_slice(places: pa.Array, texts: pa.Array, spans: pa.Array) -> pa.Array:
    words = find_words(texts)
    of = np.repeat(np.arange(len(texts)), spans.value_lengths().fill_null(0).to_numpy())
    place, start, stop = (column.to_numpy() for column in spans.flatten().flatten())
    own = place == places.to_numpy()[of]
    begin = words.first[of[own]]
    n = words.first[-1]
    depth = np.bincount(begin + start[own], minlength=n + 1)
    depth -= np.bincount(begin + stop[own], minlength=n + 1)
    keep = np.cumsum(depth[:n]) == 0
    n_words = np.diff(words.first)
    n_kept = np.diff(np.append(0, np.cumsum(keep))[words.first])
    letters = np.repeat(keep, np.diff(words.start))
    # No space after the last word that stays.
    last = np.flatnonzero(keep)[np.cumsum(n_kept)[n_kept > 0] - 1]
    letters[words.start[last + 1] - 1] = False
    bounds = np.append(0, np.cumsum(letters))[words.start[words.first]]
    kept = pa.Array.from_buffers(
        pa.string(),
        len(texts),
        [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(words.joined[letters])],
    )
    numbers = (n_words, n_words - n_kept)
    return pa.StructArray.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), kept], fields=list(_ARROW_CUT))


def drop_repeated_passages(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_documents: int = HOT_DOCUMENTS,
    rows_per_automaton: int = ROWS_PER_AUTOMATON,
) -> DataFrame:
    """``docs`` without the words of passages that a document with a lesser id has.

    Words stand between ASCII white space. A word goes if a run of ``window`` words that covers it
    also starts in a document with a lesser id; runs are judged on the input. New columns, which
    replace ones of the same name: ``n_words``, ``n_removed``, ``kept_text`` (the words that stay,
    joined by one space).

    Defined cases: null and empty texts have no words; a text of fewer words than a run, and one
    with a null id, keeps all its words; rows that share an id are not lesser than each other, so
    repeated rows keep what their first keeps; an empty table gives an empty one. Ids are integers.

    Every run is looked up by an anchor, four of its words chosen by hash. Anchors with one id only
    are sorted out first. Documents then send the phrases around the others to the shard of the
    anchor, which confirms what recurs, compiles it into an automaton and locates every occurrence.
    Phrases of very common anchors go to shards run by run, and of equal runs in a batch of
    documents only the least is sent. Texts are shuffled once, by id, and that shuffle serves both
    joins. ``hot_documents`` and ``rows_per_automaton`` change the plan only, not the result.
    """
    require(docs, [id_col, text_col])
    spark = docs.sparkSession
    own_id = F.col(f"`{id_col}`").cast("bigint")
    text = F.col(f"`{text_col}`")
    place_, own_place_, cut_ = free_names(docs, "place", "own_place", "cut")
    base = docs.withColumn(own_place_, F.xxhash64(own_id, text))
    texts = base.select(own_id.alias("id"), F.col(own_place_).alias("place"), text.alias("text"))
    anchors = (
        texts.where("id IS NOT NULL")
        .select("id", "text")
        .mapInArrow(_anchor_rows(window), "anchor bigint, id bigint")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "id")
        .mapInArrow(_recurring_rows(hot_documents), "id bigint, anchor bigint, hot boolean")
        .groupBy("id")
        .agg(
            F.collect_set("anchor").alias("anchors"),
            F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot"),
        )
    )
    # A left join, like the last one: both then read the same shuffle of the texts.
    spans = (
        texts.join(anchors.hint("shuffle_hash"), "id", "left")
        .select("id", "place", "text", "anchors", "hot")
        .mapInArrow(_phrase_rows(window), _PHRASES)
        .repartition("route")
        .sortWithinPartitions("route", "id")
        .mapInArrow(_located_rows(window, rows_per_automaton), "id bigint, place bigint, start int, stop int")
        .groupBy("id")
        .agg(F.collect_list(F.struct("place", "start", "stop")).alias("spans"))
    )
    joined = texts.join(spans.hint("shuffle_hash"), "id", "left")
    cut = joined.select("id", "place", _cut("place", "text", "spans").alias(cut_))
    new = {
        "n_words": F.col(f"{cut_}.n_words"),
        "n_removed": F.col(f"{cut_}.n_removed"),
        "kept_text": F.col(f"{cut_}.kept"),
    }
    if {c.lower() for c in docs.columns} <= {id_col.lower(), text_col.lower()}:
        return with_columns(cut.withColumn(id_col, F.col("id")), new).select(id_col, *new)
    once = cut.dropDuplicates(["place"]).select(F.col("place").alias(place_), cut_)
    back = base.join(once, F.col(own_place_) == F.col(place_))
    return with_columns(back, new).drop(own_place_, place_, cut_)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_passages(docs).select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = """
WITH worded AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                               lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM worded WHERE len(words) >= 13)
), firsts AS (
    SELECT win, min(doc_id) AS first FROM windows GROUP BY win
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
    FROM windows JOIN firsts USING (win) WHERE first < doc_id
), words AS (
    SELECT doc_id, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM worded
), counted AS (
    SELECT w.doc_id, count(g.place) AS n_removed,
           string_agg(word, ' ' ORDER BY w.place) FILTER (WHERE g.place IS NULL) AS kept
    FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place GROUP BY w.doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM worded d LEFT JOIN counted c ON c.doc_id = d.doc_id
"""
