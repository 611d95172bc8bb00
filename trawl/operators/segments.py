"""Segments: parts of a stored index that are written once and read together.

A segment keeps the postings of its own documents, numbered within a range of document ids, beside
what it knows of its terms and of blocks of documents. Adding documents writes a segment and leaves
the others alone; statistics are summed up when they are read, and positions in a whole list are
worked out for those readers only that ask for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Optional, Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.numbering import MAX_RANGES, ROWS_PER_RANGE, IdRanges
from trawl.session import BROADCAST_ROWS

# Document ids whose postings of a term share one row of bounds.
IDS_PER_BLOCK = 128

# Postings that one task numbers when whole terms are placed together.
POSTINGS_PER_TASK = 1_000_000


class TermFilter(Protocol):
    """Which terms are wanted, in a form that lets storage skip folders and pages.

    ``n_terms`` counts them if they are few.
    """

    n_terms: Optional[int]

    def rows_in(self, rows: DataFrame, buckets: int) -> DataFrame: ...


@dataclass(frozen=True)
class Segment:
    """One written part of an index; each table is in folders by ``term_bucket``.

    ``postings``: ``term, doc_id, tf, doc_range, doc_block, place`` (position in its range), and
    ``piece_n, piece_tf`` on the first one of a term's postings in a range, if they are ``marked``;
    ``pieces``: ``term, doc_range, n, tf_sum``; ``bounds``: ``term, doc_block, n, least_tf,
    most_tf``; ``repeated``: ``term, n``, postings of documents that an earlier segment has posted
    for the term, if there are any. ``documents`` is ``doc_id``.
    """

    path: str
    postings: DataFrame
    pieces: DataFrame
    bounds: DataFrame
    documents: DataFrame
    repeated: Optional[DataFrame]
    buckets: int
    ranges: IdRanges
    n_postings: int
    first_id: Optional[int]
    last_id: Optional[int]
    marked: bool = False

    def rows(self, table: DataFrame, wanted: Optional[TermFilter]) -> DataFrame:
        return table if wanted is None else wanted.rows_in(table, self.buckets)


def block_of(doc_id: Column, ids_per_block: int) -> Column:
    return F.floor(doc_id / ids_per_block).cast("bigint")


def overlapping(segments: Sequence[Segment]) -> bool:
    """Whether a document may have postings of one term in several segments."""
    return any(segment.repeated is not None for segment in segments)


def common_ranges(segments: Sequence[Segment]) -> IdRanges:
    """Ranges of document ids for all segments together: the bounds of all, or a part of them."""
    bounds = sorted({bound for segment in segments for bound in segment.ranges.bounds})
    step = -(-len(bounds) // (MAX_RANGES - 1)) or 1
    return IdRanges(tuple(bounds[::step]))


def counts(
    segments: Sequence[Segment],
    wanted: Optional[TermFilter] = None,
    first: Optional[int] = None,
) -> DataFrame:
    """``term, doc_id, tf, doc_range, doc_block``, a document's frequencies added up.

    ``first`` leaves out postings that are sure not to be among so many first ones of their term.
    """
    ranges = common_ranges(segments)
    found = []
    for segment in segments:
        rows = segment.rows(segment.postings, wanted)
        if first is not None:
            rows = _first_rows(segment, rows, wanted, first)
        if len(segments) > 1:
            rows = rows.withColumn("doc_range", ranges.of(F.col("doc_id")))
        found.append(rows.select("term", "doc_id", "tf", "doc_range", "doc_block"))
    rows = reduce(DataFrame.unionByName, found)
    if not overlapping(segments):
        return rows
    return rows.groupBy("term", "doc_id").agg(
        F.sum("tf").alias("tf"),
        F.max("doc_range").alias("doc_range"),
        F.max("doc_block").alias("doc_block"),
    )


def _first_rows(
    segment: Segment, rows: DataFrame, wanted: Optional[TermFilter], first: int
) -> DataFrame:
    """The first so many postings of each term in a segment; with other segments they only move up.

    Pieces tell which ranges of documents a term's first postings lie in: so many ranges at most.
    """
    rows = rows.where(F.col("place") <= first)
    if len(segment.ranges) == 1:
        return rows
    earlier = (
        Window.partitionBy("term")
        .orderBy("doc_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = segment.rows(segment.pieces, wanted).select(
        "term", "doc_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    pieces = pieces.where(F.col("_before") < first)
    few = wanted is not None and wanted.n_terms is not None
    if few and wanted.n_terms * first <= BROADCAST_ROWS:
        pieces = F.broadcast(pieces)
    found = rows.join(pieces, ["term", "doc_range"])
    return found.where(F.col("place") + F.col("_before") <= first).drop("_before")


def numbered(segment: Segment) -> DataFrame:
    """``term, doc_id, tf, doc_range, posting_no, df, term_total`` of a segment by itself.

    Places in a range are stored, and the pieces tell what comes before it, so no postings are
    counted. Terms that a task holds at ease are placed as a whole, with the pieces that their first
    postings tell; only more frequent ones are placed by range, and joined with pieces there.
    """
    columns = ["term", "doc_id", "tf", "doc_range", "posting_no", "df", "term_total"]
    if not segment.marked:
        return _by_pieces(segment.postings, segment.pieces).select(*columns)
    if segment.n_postings <= ROWS_PER_RANGE:
        return _by_term(segment, segment.postings).select(*columns)
    sizes = segment.pieces.groupBy("term").agg(F.sum("n").alias("n"))
    # No more than one term for each so many postings.
    frequent = sizes.where(F.col("n") > ROWS_PER_RANGE).select("term")
    if segment.n_postings // ROWS_PER_RANGE <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)
    others = _by_term(segment, segment.postings.join(frequent, "term", "left_anti"))
    chosen = [t.join(frequent, "term", "left_semi") for t in (segment.postings, segment.pieces)]
    return others.select(*columns).unionByName(_by_pieces(*chosen).select(*columns))


def _by_term(segment: Segment, postings: DataFrame) -> DataFrame:
    n_tasks = -(-segment.n_postings // POSTINGS_PER_TASK)
    cores = postings.sparkSession.sparkContext.defaultParallelism
    ordered = Window.partitionBy("term").orderBy("doc_range")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = ordered.rangeBetween(Window.unboundedPreceding, -1)
    rows = postings.select("term", "doc_id", "tf", "doc_range", "place", "piece_n", "piece_tf")
    return rows.repartition(max(cores, n_tasks), "term").withColumns(
        {
            "posting_no": F.col("place") + F.coalesce(F.sum("piece_n").over(earlier), F.lit(0)),
            "df": F.sum("piece_n").over(whole),
            "term_total": F.sum("piece_tf").over(whole),
        }
    )


def _by_pieces(postings: DataFrame, pieces: DataFrame) -> DataFrame:
    ordered = Window.partitionBy("term").orderBy("doc_range")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "term",
        "doc_range",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("n").over(whole).alias("df"),
        F.sum("tf_sum").over(whole).alias("term_total"),
    )
    rows = postings.select("term", "doc_id", "tf", "doc_range", "place")
    return rows.join(offsets, ["term", "doc_range"]).withColumn(
        "posting_no", F.col("place") + F.col("_before")
    )


def statistics(segments: Sequence[Segment], wanted: Optional[TermFilter] = None) -> DataFrame:
    """``term, df, term_total`` over all segments: a document in several of them counts once."""
    known = [s.rows(s.pieces, wanted).select("term", "n", "tf_sum") for s in segments]
    none = F.lit(0).cast("bigint").alias("tf_sum")
    known += [
        s.rows(s.repeated, wanted).select("term", (-F.col("n")).alias("n"), none)
        for s in segments
        if s.repeated is not None
    ]
    rows = reduce(DataFrame.unionByName, known)
    return rows.groupBy("term").agg(F.sum("n").alias("df"), F.sum("tf_sum").alias("term_total"))


def bounds(segments: Sequence[Segment], wanted: Optional[TermFilter] = None) -> DataFrame:
    """``term, doc_block, n, least_tf, most_tf``; a block may have a row in several segments."""
    columns = ["term", "doc_block", "n", "least_tf", "most_tf"]
    return reduce(
        DataFrame.unionByName, [s.rows(s.bounds, wanted).select(*columns) for s in segments]
    )
