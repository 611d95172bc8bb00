"""Tokenising text with built-in column functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public 179-word English stop list that the ranked results depend on.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Words too common in the encyclopedia corpus to carry meaning.
CORPUS_STOPWORDS = """
category references also external links may first see history people one two part thumb including
second following many however would became
""".split()

STOPWORDS = frozenset(ENGLISH_STOPWORDS) | frozenset(CORPUS_STOPWORDS)

# Fixed value: an optional # or @ start, then 2 to 24 word characters, each of which may follow
# one apostrophe or hyphen. "Word character" is spelt out because \w is ASCII-only in Java.
WORD_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}"


def tokenize(text: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """Lower-cased tokens of ``text`` in reading order, repeats kept; null text gives null."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    stop = sorted(stopwords)
    return F.filter(tokens, lambda token: ~token.isin(stop)) if stop else tokens


def token_counts(text: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """``array<struct<term, tf>>`` with one entry per distinct token of ``text``.

    Counting inside the row needs no shuffle: the tokens are sorted, the places where a new word
    begins are kept, and the distance between two such places is the count.
    """
    ordered = F.sort_array(tokenize(text, stopwords))
    # A one-element array is the way to name an intermediate value inside a column expression.
    return F.get(F.transform(F.array(ordered), _run_lengths), F.lit(0))


def _run_lengths(words: Column) -> Column:
    size = F.size(words)
    places = F.sequence(F.lit(1), F.greatest(size, F.lit(1)))

    def begins(place: Column) -> Column:
        changed = F.get(words, place - 1) != F.get(words, place - 2)
        return (place <= size) & ((place == 1) | changed)

    def to_counts(begin: Column) -> Column:
        return F.transform(
            begin,
            lambda place, i: F.struct(
                F.get(words, place - 1).alias("term"),
                (F.coalesce(F.get(begin, i + 1), size + 1) - place).cast("long").alias("tf"),
            ),
        )

    return F.get(F.transform(F.array(F.filter(places, begins)), to_counts), F.lit(0))
