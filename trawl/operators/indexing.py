"""Inverted indexes as tables: term frequencies, document frequencies, numbered postings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import STOPWORDS, token_counts, tokenize
from trawl.operators import segments as parts
from trawl.operators.numbering import IdRanges, deal, measure_id_ranges, number_rows
from trawl.operators.segments import Segment, TermFilter

# Fixed value: terms are spread over 124 buckets, unless an index is too small to fill them.
TERM_BUCKETS = 124

# Different terms that the links to a page are taken to use.
TERMS_PER_PAGE = 10

# Postings offered in one row when lists are read as a whole.
POSTINGS_PER_BLOCK = 300_000


class Derivation(NamedTuple):
    """What postings are computed from: frequencies, and the ``doc_id, text`` these come from.

    Frequencies may bring their ``doc_range``, found once for a document and not for each posting.
    ``n_postings`` is about their number, where it can be told without reading texts.
    """

    frequencies: DataFrame
    ranges: IdRanges
    texts: Optional[DataFrame] = None
    n_postings: Optional[int] = None


@dataclass(frozen=True)
class FieldIndex:
    """Index of one field.

    ``all_postings``: ``term, doc_id, tf, posting_no, df, term_total, doc_range``. The two
    statistics are repeated on every posting of a term: sorted by term they take next to no room in
    Parquet, and ranking then needs no second join to reach them. ``doc_range`` numbers the ranges
    of document ids used to cut large groups. ``min_df`` only hides terms of so few documents from
    readers; adding documents and merging start from all postings. An index not yet stored knows
    how it is ``derived``; a stored one is made up of ``segments``, whose blocks of documents are
    ``ids_per_block`` ids wide.
    """

    all_postings: DataFrame
    ranges: int = 1
    derived: Optional[Derivation] = None
    min_df: int = 0
    segments: tuple[Segment, ...] = ()
    ids_per_block: Optional[int] = None

    def frequent(self, rows: DataFrame) -> DataFrame:
        """The rows whose term is found in more than ``min_df`` documents."""
        return rows.where(F.col("df") > self.min_df) if self.min_df else rows

    @property
    def postings(self) -> DataFrame:
        return self.frequent(self.all_postings)

    @property
    def term_stats(self) -> DataFrame:
        """``term, df, term_total``: one row per term."""
        if self.segments:
            return self.statistics()
        if self.derived is not None:
            return self.frequent(term_statistics(_summed(self.derived.frequencies)))
        first = self.postings.where(F.col("posting_no") == 1)
        return first.select("term", "df", "term_total")

    def statistics(self, wanted: Optional[TermFilter] = None) -> DataFrame:
        """``term, df, term_total`` of the wanted terms of a stored index."""
        return self.frequent(parts.statistics(self.segments, wanted))

    def counts(self, wanted: Optional[TermFilter] = None) -> DataFrame:
        """``term, doc_id, tf, doc_range, doc_block`` of the wanted terms of a stored index."""
        return parts.counts(self.segments, wanted)

    def first_postings(self, wanted: Optional[TermFilter], first: int) -> DataFrame:
        """The first so many postings of each wanted term of a stored index, numbered."""
        numbered = _number(parts.counts(self.segments, wanted, first), self.ranges)
        return numbered.where(F.col("posting_no") <= first)

    def only(self, terms: DataFrame) -> DataFrame:
        """Postings of the terms in ``terms`` (one column ``term``), worked out for them alone."""
        if self.derived is None:
            return self.postings.join(terms, "term", "left_semi")
        wanted = self.derived.frequencies.join(terms, "term", "left_semi")
        return number_postings(wanted, self.derived.ranges, self.min_df).postings

    def frequencies_of(self, terms: DataFrame) -> DataFrame:
        """``term, doc_id, tf`` of the terms in ``terms``, before repeated documents are added up."""
        wanted = self.derived.frequencies.join(terms, "term", "left_semi")
        return wanted.where(F.col("doc_id").isNotNull()).select("term", "doc_id", "tf")


@dataclass(frozen=True)
class SearchIndex:
    """The three field indexes of a corpus."""

    title: FieldIndex
    body: FieldIndex
    anchor: FieldIndex


def term_frequencies(
    docs: DataFrame, text: str = "text", doc_id: str = "id", stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """``term, doc_id, tf`` for every distinct token of every row; involves no shuffle.

    A document id on several rows gives several rows per term here; ``build_index`` adds them up.
    """
    counts = token_counts(F.col(text), stopwords)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.inline(counts)).select(
        "term", "doc_id", "tf"
    )


def anchor_links(corpus: DataFrame) -> DataFrame:
    """``src, dst, text``: one row per link in the nested anchor lists; links to nowhere are left out."""
    link = F.explode("anchor_text").alias("link")
    return (
        corpus.select(F.col("id").cast("long").alias("src"), link)
        .where(F.col("link.id").isNotNull())
        .select("src", F.col("link.id").alias("dst"), F.col("link.text").alias("text"))
    )


def anchor_frequencies(links: DataFrame, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """``term, doc_id, tf``: how often a term is used in links pointing to a page.

    Links with the same text to the same page are counted before that text is tokenised, once.
    Counts are combined on the map side, so a page that a third of all links point to costs one
    row per text and map task.
    """
    alike = (
        links.where(F.col("dst").isNotNull())
        .groupBy(F.col("dst").alias("doc_id"), "text")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    counted = alike.select(
        "doc_id", "uses", F.inline(token_counts(F.col("text"), stopwords))
    )
    return counted.groupBy("term", "doc_id").agg(F.sum(F.col("tf") * F.col("uses")).alias("tf"))


def term_statistics(frequencies: DataFrame) -> DataFrame:
    """``term, df, term_total`` of term frequencies with one row per term and document."""
    return frequencies.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("term_total")
    )


def _summed(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))


def _number(
    postings: DataFrame, ranges: int, totals: Optional[Mapping[str, Column]] = None
) -> DataFrame:
    """Adds ``posting_no`` and totals per term to rows with ``term, doc_id, doc_range``."""
    return number_rows(
        postings,
        group=["term"],
        pieces={"doc_range": True} if ranges > 1 else {},
        order=[F.asc("doc_id")],
        number="posting_no",
        totals=totals,
    )


_TOTALS = {"df": lambda: F.count(F.col("doc_id")), "term_total": lambda: F.sum("tf")}
_POSTING = ["term", "doc_id", "tf", "posting_no", "df", "term_total", "doc_range"]


def join_segments(segments: Sequence[Segment], min_df: int, ids_per_block: int) -> FieldIndex:
    """The index that stored segments make up together."""
    ranges = len(parts.common_ranges(segments))
    if len(segments) == 1:
        numbered = parts.numbered(segments[0])
    else:
        totals = {name: total() for name, total in _TOTALS.items()}
        numbered = _number(parts.counts(segments), ranges, totals)
    return FieldIndex(
        numbered.select(*_POSTING),
        ranges=ranges,
        min_df=min_df,
        segments=tuple(segments),
        ids_per_block=ids_per_block,
    )


def with_ranges(frequencies: DataFrame, ranges: IdRanges) -> DataFrame:
    if "doc_range" in frequencies.columns:
        return frequencies
    return frequencies.withColumn("doc_range", ranges.of(F.col("doc_id")))


def number_postings(
    frequencies: DataFrame,
    ranges: IdRanges,
    min_df: int = 0,
    texts: Optional[DataFrame] = None,
    n_postings: Optional[int] = None,
) -> FieldIndex:
    """Sum up and number postings with a single shuffle of them.

    Rows are placed by term and range of document ids. Both the sum over repeated documents and
    the numbering use that placing, and one range of one term is all that a task has to sort.
    """
    ranged = len(ranges) > 1
    placed = with_ranges(frequencies, ranges)
    key = ["term", "doc_range"] if ranged else ["term"]
    summed = (
        deal(placed, ranges, *key)
        .groupBy("term", "doc_range", "doc_id")
        .agg(F.sum("tf").alias("tf"))
        # Always so; asking for it makes the tally need what the rows do: one shuffle for both.
        .where(F.col("tf").isNotNull())
    )
    numbered = _number(summed, len(ranges), {name: total() for name, total in _TOTALS.items()})
    derived = Derivation(frequencies, ranges, texts, n_postings)
    return FieldIndex(
        numbered.select(*_POSTING), ranges=len(ranges), derived=derived, min_df=min_df
    )


def build_index(
    docs: DataFrame,
    text: str,
    doc_id: str = "id",
    min_df: int = 0,
    stopwords: Iterable[str] = STOPWORDS,
    rows_per_range: Optional[int] = None,
) -> FieldIndex:
    """Index one text column of a table of documents."""
    docs = docs.select(doc_id, text)
    ranges = measure_id_ranges(docs, doc_id, rows_per_range)
    number = F.col(doc_id).cast("long")
    placed = docs.select(
        number.alias("doc_id"), ranges.of(number).alias("doc_range"), F.col(text).alias("text")
    )
    # Chosen before the tokens are exploded, the range is found once for a document.
    frequencies = placed.select(
        "doc_id", "doc_range", F.inline(token_counts(F.col("text"), stopwords))
    ).select("term", "doc_id", "tf", "doc_range")
    if ranges.crowded:  # a document id repeated so often is summed up ahead of the shuffle
        frequencies = frequencies.groupBy("term", "doc_id", "doc_range").agg(
            F.sum("tf").alias("tf")
        )
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return number_postings(frequencies, ranges, min_df, texts)


def build_anchor_index(
    links: DataFrame,
    min_df: int = 0,
    stopwords: Iterable[str] = STOPWORDS,
    rows_per_range: Optional[int] = None,
) -> FieldIndex:
    """Index link texts under the page they point to; ``links`` is ``src, dst, text``."""
    # A page has one posting a term, however many links point to it.
    ranges = measure_id_ranges(links.select("dst").distinct(), "dst", rows_per_range)
    texts = links.select(F.col("dst").alias("doc_id"), "text")
    frequencies = anchor_frequencies(links, stopwords)
    n_postings = TERMS_PER_PAGE * (ranges.n_rows or 0)
    return number_postings(frequencies, ranges, min_df, texts, n_postings)


def merge_index(
    first: FieldIndex,
    second: FieldIndex,
    min_df: Optional[int] = None,
    rows_per_range: Optional[int] = None,
) -> FieldIndex:
    """Merge two partial indexes; a document found in both has its frequencies added up.

    Positions and statistics are worked out anew from all postings, the hidden ones included. The
    result hides terms as the part that hides more does, unless ``min_df`` is given.
    """
    if min_df is None:
        min_df = max(first.min_df, second.min_df)
    both = _counts(first).unionByName(_counts(second))
    if first.derived and second.derived and rows_per_range is None:
        bounds = {*first.derived.ranges.bounds, *second.derived.ranges.bounds}
        counted = [part.derived.ranges.n_rows for part in (first, second)]
        n_rows = None if None in counted else sum(counted)
        ranges = IdRanges(tuple(sorted(bounds)), n_rows=n_rows)
    else:
        ranges = measure_id_ranges(both, "doc_id", rows_per_range)
    return number_postings(both, ranges, min_df)


def _counts(index: FieldIndex) -> DataFrame:
    """``term, doc_id, tf`` of an index, from before it was numbered."""
    if index.derived is not None:
        return index.derived.frequencies.select("term", "doc_id", "tf")
    if index.segments:
        return index.counts().select("term", "doc_id", "tf")
    return index.all_postings.select("term", "doc_id", "tf")


def add_documents(
    index: FieldIndex,
    docs: DataFrame,
    text: str,
    doc_id: str = "id",
    stopwords: Iterable[str] = STOPWORDS,
    rows_per_range: Optional[int] = None,
) -> FieldIndex:
    """Add a batch of documents to an index, which goes on hiding terms as it did."""
    new = build_index(docs, text, doc_id, stopwords=stopwords, rows_per_range=rows_per_range)
    return merge_index(index, new, rows_per_range=rows_per_range)


def posting_blocks(index: FieldIndex, block_size: int = POSTINGS_PER_BLOCK) -> DataFrame:
    """``term, block_no, postings``: posting lists in document order, cut into blocks.

    Reading the blocks of a term in turn reads its whole list. A block is bounded, a list is not.
    """
    block = F.floor((F.col("posting_no") - 1) / block_size).cast("int").alias("block_no")
    entry = F.struct("posting_no", "doc_id", "tf")
    return (
        index.postings.groupBy("term", block)
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(
            "term",
            "block_no",
            F.transform("entries", lambda e: F.struct(e.doc_id, e.tf)).alias("postings"),
        )
    )


def build_search_index(
    corpus: DataFrame,
    body_min_df: int = 0,
    stopwords: Iterable[str] = STOPWORDS,
    rows_per_range: Optional[int] = None,
) -> SearchIndex:
    """Title, body and anchor indexes of a corpus; ``body_min_df`` hides rare terms of the body."""
    return SearchIndex(
        title=build_index(
            corpus, "title", stopwords=stopwords, rows_per_range=rows_per_range
        ),
        body=build_index(
            corpus,
            "text",
            min_df=body_min_df,
            stopwords=stopwords,
            rows_per_range=rows_per_range,
        ),
        anchor=build_anchor_index(
            anchor_links(corpus), stopwords=stopwords, rows_per_range=rows_per_range
        ),
    )
