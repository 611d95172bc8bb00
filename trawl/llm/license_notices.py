"""Fuzzy search for short licence notices: exact seeds, then matching with a bounded error."""

from __future__ import annotations

import re
from collections import OrderedDict, defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import require, table


class Notice(NamedTuple):
    """A notice as its words, lower-cased; words in braces have to stand as they are."""

    label: str
    words: str


# Phrases of the contract, and the labels of their places.
BASE = (
    Notice("mit", "under the {mit} license"),
    Notice("apache-2", "apache license version {2}"),
    Notice("cc-by-nc", "{cc by nc}"),
)

# Words of common notices. What tells one licence from another is in braces.
NOTICES = BASE + (
    Notice("agpl", "gnu {affero} general public license"),
    Notice("all-rights-reserved", "all rights reserved"),
    Notice("apache-2", "apache license {2 0}"),
    Notice("apache-2", "http www apache org licenses license {2 0}"),
    Notice("artistic", "under the terms of the {artistic} license"),
    Notice("boost", "boost software license version {1 0}"),
    Notice("bsd", "under the {bsd} license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification"),
    Notice("cc-by-nc", "creative commons attribution {noncommercial}"),
    Notice("cc-by-nc", "creative commons attribution {non commercial}"),
    Notice("cc-by-nd", "{cc by nd}"),
    Notice("cc-by-nd", "creative commons attribution {noderivatives}"),
    Notice("cc-by-sa", "{cc by sa}"),
    Notice("cc-by-sa", "creative commons attribution {sharealike}"),
    Notice("cc0", "{cc0 1 0} universal"),
    Notice("epl", "eclipse public license"),
    Notice("gpl", "gnu general public license"),
    Notice("gpl-2", "gnu general public license version {2}"),
    Notice("gpl-3", "gnu general public license version {3}"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice("isc", "under the {isc} license"),
    Notice("lgpl", "gnu {lesser} general public license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("mpl", "mozilla public license"),
    Notice("unlicense", "free and unencumbered software released into the {public domain}"),
    Notice("zlib", "under the {zlib} license"),
)

# One edit is allowed for every so many characters of a notice, and no more than so many edits.
CHARS_PER_EDIT = 10
MOST_EDITS = 4

# Windows whose matches a worker remembers.
_REMEMBERED = 20_000

# Digits, letters and everything beyond ASCII make words.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_TO_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())

_SPAN = "label string, notice int, first_word int, n_words int, first int, after int, edits int"
FOUND = f"n_words bigint, spans array<struct<{_SPAN.replace(' ', ':').replace(',:', ',')}>>"


class Span(NamedTuple):
    """A place of a notice: words from 0, characters of the text as it is (end exclusive)."""

    label: str
    notice: int
    first_word: int
    n_words: int
    first: int
    after: int
    edits: int


def _phrase(notice: Notice) -> str:
    return notice.words.replace("{", "").replace("}", "")


def pieces_of(phrase: str, edits: int) -> list[tuple[int, str]]:
    """A phrase cut into ``edits + 1`` pieces of like length, with their places.

    So many edits cannot touch all of them: a match holds one of the pieces as it is.
    """
    n = edits + 1
    cuts = [len(phrase) * i // n for i in range(n + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class _Search:
    """One notice: its phrase, how many edits it bears, and the pattern that verifies a window."""

    def __init__(self, notice: Notice) -> None:
        self.label = notice.label
        self.phrase = _phrase(notice)
        self.edits = min(MOST_EDITS, len(self.phrase) // CHARS_PER_EDIT)
        if "{" in notice.words and not re.sub(r"\{.*?\}| ", "", notice.words):
            self.edits = 0  # nothing but words that have to stand as they are
        parts = [p for p in re.split(r"(\{.*?\})", notice.words) if p]
        bound = "" if not self.edits else f"{{e<={self.edits}}}"
        body = "".join(
            regex.escape(p[1:-1], literal_spaces=True)
            if p[0] == "{"
            else f"(?:{regex.escape(p, literal_spaces=True)}){bound}"
            for p in parts
        )
        self.pattern = regex.compile(f"(?b)(?<= ){body}(?= )")
        self._known: OrderedDict[str, tuple[int, int, int] | None] = OrderedDict()

    def best(self, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of the match with the fewest edits, if it has few enough."""
        if window in self._known:
            self._known.move_to_end(window)
            return self._known[window]
        found = self._match(window)
        self._known[window] = found
        if len(self._known) > _REMEMBERED:
            self._known.popitem(last=False)
        return found

    def _match(self, window: str) -> tuple[int, int, int] | None:
        at = window.find(f" {self.phrase} ")
        if at >= 0:
            return at + 1, at + 1 + len(self.phrase), 0
        match = self.pattern.search(window) if self.edits else None
        if match is None or sum(match.fuzzy_counts) > self.edits:
            return None
        return match.start(), match.end(), sum(match.fuzzy_counts)


class NoticeFinder:
    """Finds notices in texts; built once in a worker."""

    def __init__(self, notices: Sequence[Notice]) -> None:
        self.searches = [_Search(notice) for notice in notices]
        seeds: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, search in enumerate(self.searches):
            for place, piece in pieces_of(search.phrase, search.edits):
                seeds[piece].append((number, place))
        self._seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self._seeds.add_word(piece, (len(piece), uses))
        if seeds:
            self._seeds.make_automaton()

    def find(self, text: str | None) -> tuple[int, list[Span]]:
        """The number of words, and the places of notices in order.

        Of places of one notice that overlap, the one with fewer edits counts, then the first one.
        """
        words = (text or "").encode("utf-8", "replace").translate(_TO_WORDS).split()
        line = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
        spans = [
            (first, after, edits, number)
            for number, starts in self._candidates(line).items()
            for first, after, edits in self._places(line, self.searches[number], starts)
        ]
        return len(words), self._on_text(text or "", line, sorted(spans))

    def _candidates(self, line: str) -> dict[int, list[int]]:
        """Where notices may start, by the seeds that stand in the line."""
        starts: dict[int, list[int]] = defaultdict(list)
        if len(self._seeds):
            for end, (length, uses) in self._seeds.iter(line):
                for number, place in uses:
                    starts[number].append(end + 1 - length - place)
        return starts

    @staticmethod
    def _places(line: str, search: _Search, starts: list[int]) -> list[tuple[int, int, int]]:
        """Verified places of one notice.

        Seeds of one place hint at starts at most two times the edits apart; each such group is
        one window, never longer than the notice and a few edits.
        """
        most = search.edits
        found: set[tuple[int, int, int]] = set()
        starts.sort()
        i = 0
        while i < len(starts):
            low = high = starts[i]
            while i < len(starts) and starts[i] <= low + 2 * most:
                high = starts[i]
                i += 1
            begin = max(0, low - most - 1)
            window = line[begin : high + len(search.phrase) + most + 1]
            if match := search.best(window):
                found.add((match[0] + begin, match[1] + begin, match[2]))
        kept: list[tuple[int, int, int]] = []
        for place in sorted(found):
            if kept and place[0] < kept[-1][1]:
                if place[2] < kept[-1][2]:
                    kept[-1] = place
            else:
                kept.append(place)
        return kept

    def _on_text(
        self, text: str, line: str, spans: list[tuple[int, int, int, int]]
    ) -> list[Span]:
        if not spans:
            return []
        places = [match.span() for match in _WORD.finditer(text)]
        found = []
        word = seen = 0
        for first, after, edits, number in spans:
            word += line.count(" ", seen, first)
            seen = first
            n_words = line.count(" ", first, after) + 1
            chars = places[word - 1][0], places[word + n_words - 2][1]
            label = self.searches[number].label
            found.append(Span(label, number, word - 1, n_words, *chars, edits))
        return found


@lru_cache(maxsize=4)
def _finder(notices: tuple[Notice, ...]) -> NoticeFinder:
    return NoticeFinder(notices)


def scan_notices(
    docs: DataFrame, notices: Sequence[Notice] = NOTICES, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words, spans, labels, score``: the licence notices in each whole text.

    A-Z are lower-cased; words are runs of digits, letters and characters beyond ASCII, and what
    stands between words makes no difference. A notice may be misspelt by one edit of a character
    for every ten it has, four at most, except in the words that tell it from other licences; it
    starts and ends with a word. ``spans`` gives for each place the label, the number of the
    notice, its first word and number of words, its characters in the text, and its edits.
    ``labels`` are the different labels in order; ``score`` is 1 for a place without edits, less by
    the share of characters edited, that of the best place, and 0 without any.

    A notice is cut into one piece more than it bears edits, so one piece stands unchanged in any
    match. All pieces are looked up in one pass over the text; a window around each is then matched
    with a bounded error. Windows have a bounded length, so the work grows with the text.

    Defined cases: a null or empty text and one of spaces have no words and no spans; every row is
    a document of its own; columns of the names above are replaced; an empty table gives none.
    """
    require(docs, [text_col])
    chosen = tuple(Notice(*notice) for notice in notices)

    @F.pandas_udf(FOUND)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = _finder(chosen)
        for batch in texts:
            rows = [finder.find(text) for text in batch]
            yield pd.DataFrame(rows, columns=["n_words", "spans"])

    lengths = F.lit([len(_phrase(n)) for n in chosen] or [1]).cast("array<double>")
    closeness = F.transform("found.spans", lambda s: 1 - s.edits / F.get(lengths, s.notice))
    names = ("n_words", "spans", "labels", "score")
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]
    found = docs.select(F.struct(*own).alias("own"), find(F.col(f"`{text_col}`")).alias("found"))
    return found.select(
        "own.*",
        "found.*",
        F.array_sort(F.array_distinct("found.spans.label")).alias("labels"),
        F.coalesce(F.array_max(closeness), F.lit(0.0)).alias("score"),
    )


def op12_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notices of every document; base places are those of the first notices without edits."""
    scanned = scan_notices(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: (s.notice < len(BASE)) & (s.edits == 0))
    placed = scanned.withColumn("base", base)
    labels = F.array_sort(F.array_distinct(F.col("base.label")))
    return placed.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.first_word").cast("bigint").alias("first_word"),
        F.array_max("base.first_word").cast("bigint").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
