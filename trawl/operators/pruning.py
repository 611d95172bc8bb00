"""Leaving out blocks of documents that cannot reach a query's best results.

A stored index knows for every term and block of document ids the greatest and the least frequency
in the block. So no document of a block can score more than the sum of what the query's terms can
add there, and once a query has enough documents that score better, the block need not be read.
The result is that of a search over all postings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Optional

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators import segments as parts
from trawl.operators.indexing import FieldIndex
from trawl.operators.segments import TermFilter
from trawl.session import BROADCAST_ROWS

# The blocks read first hold at least so many times the documents wanted.
SEED_FACTOR = 2

# Stretches of blocks that are named in a plan, for storage to pass over what lies between.
STRETCHES = 20

# More blocks than fit a broadcast are kept as bits, so many words of 64 in a row, and the most rows.
PAGE_WORDS = 64
MOST_PAGES = 50_000

# Scores are sums of floats in any order, so bounds are compared with a little to spare.
_SLACK = 1e-6
_RELATIVE_SLACK = 1e-9


@dataclass(frozen=True)
class FieldScore:
    """What a field adds to a score: ``points(uses, tf, df)``, rising or falling with ``tf``."""

    index: FieldIndex
    stage: int
    points: Callable[[Column, Column, Column], Column]


@dataclass(frozen=True)
class ChosenBlocks:
    """The blocks of documents that a batch of queries has to read.

    ``table``: ``query_id, doc_block, n_postings``; ``condition`` holds on ``doc_block`` for all of
    them, in a form that storage can use. ``n_postings`` counts the postings they hold. ``pages``
    hold many blocks as bits: ``query_id, page, words``.
    """

    table: DataFrame
    condition: Column
    n_blocks: int
    n_postings: int
    pages: Optional[DataFrame] = None

    def of(self, matches: DataFrame) -> DataFrame:
        """The matches (``query_id, doc_block``) that lie in the blocks of their query."""
        if self.pages is not None:
            page, word, bit = _place_of(F.col("doc_block"))
            found = matches.withColumn("page", page).join(
                F.broadcast(self.pages), ["query_id", "page"]
            )
            return found.where(F.getbit(F.get("words", word), bit) == 1).drop("page", "words")
        table = self.table.select("query_id", "doc_block")
        table = F.broadcast(table) if self.n_blocks <= BROADCAST_ROWS else table
        return matches.join(table, ["query_id", "doc_block"], "left_semi")


def block_tops(
    terms: DataFrame, wanted: TermFilter, fields: Sequence[FieldScore], boost: Column
) -> DataFrame:
    """``query_id, doc_block, top, n_postings, n_docs`` for each block with a term of a query.

    ``top`` is at least the score of any document in the block. A document need not have all the
    terms found in its block, so no term takes away from it. Rows of several segments are added up,
    which is too much at most: no ``points`` grow faster than ``tf``. ``n_docs`` is the least number
    of documents that the block is sure to have.
    """
    tops = []
    for field in fields:
        segments = field.index.segments
        known = field.index.statistics(wanted).select("term", "df")
        asked = F.broadcast(known.join(F.broadcast(terms), "term"))
        ends = [field.points(F.col("uses"), F.col(tf), F.col("df")) for tf in ("most_tf", "least_tf")]
        top = F.greatest(F.lit(0.0), *ends)
        rows = parts.bounds(segments, wanted).join(asked, "term")
        tops.append(rows.select("query_id", "doc_block", top.alias("top"), "n"))
    return (
        reduce(DataFrame.unionByName, tops)
        .groupBy("query_id", "doc_block")
        .agg(
            (F.sum("top") + F.greatest(F.lit(0.0), boost)).alias("top"),
            F.sum("n").alias("n_postings"),
            F.max("n").alias("n_docs"),
        )
    )


def _seeds(tops: DataFrame, limit: int) -> DataFrame:
    """The most promising blocks of each query, until they hold some times ``limit`` documents."""
    wanted = SEED_FACTOR * limit
    order = Window.partitionBy("query_id").orderBy(F.desc("top"), "doc_block")
    first = tops.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted)
    before = F.coalesce(F.sum("n_docs").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return first.withColumn("before", before).where(F.col("before") < wanted).drop("place", "before")


def _stretches(blocks: list[int]) -> Column:
    """A condition on ``doc_block`` that holds for all the blocks, as a few stretches of them."""
    widest = sorted(range(1, len(blocks)), key=lambda i: blocks[i - 1] - blocks[i])
    cuts = [0, *sorted(widest[: STRETCHES - 1]), len(blocks)]
    block = F.col("doc_block")
    spans = [block.between(blocks[a], blocks[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]
    return reduce(lambda one, other: one | other, spans, F.lit(False))


def _place_of(block: Column) -> tuple[Column, Column, Column]:
    """Page, word in it and bit of that for a block of documents."""
    word = F.shiftright(block, 6)
    page = F.floor(word / PAGE_WORDS).cast("bigint")
    return page, F.pmod(word, F.lit(PAGE_WORDS)).cast("int"), block.bitwiseAND(63).cast("int")


def _pages(table: DataFrame) -> Optional[DataFrame]:
    """``query_id, page, words``: blocks as bits, held by the driver; None if the pages are many."""
    page, word, bit = _place_of(F.col("doc_block"))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("bits")
    words = table.groupBy("query_id", page.alias("page"), word.alias("word")).agg(bits)
    known = F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("known")
    every = F.sequence(F.lit(0), F.lit(PAGE_WORDS - 1))
    none = F.lit(0).cast("bigint")
    rows = words.groupBy("query_id", "page").agg(known).select(
        "query_id",
        "page",
        F.transform(every, lambda i: F.coalesce(F.col("known")[i], none)).alias("words"),
    )
    some = rows.limit(MOST_PAGES + 1).toArrow()
    return table.sparkSession.createDataFrame(some) if some.num_rows <= MOST_PAGES else None


def _settled(table: DataFrame) -> ChosenBlocks:
    """The blocks in ``table``, held by the driver if they, or their bits, fit a broadcast anyway."""
    # Postings of a null document are in no result.
    known = F.col("doc_block").isNotNull()
    table = table.select("query_id", "doc_block", "n_postings").where(known)
    some = table.limit(BROADCAST_ROWS + 1).toArrow()
    if some.num_rows > BROADCAST_ROWS:
        counts = table.agg(F.count(F.lit(1)), F.sum("n_postings"))
        return ChosenBlocks(table, F.lit(True), *counts.first(), _pages(table))
    blocks = sorted(set(some.column("doc_block").to_pylist()))
    n_postings = sum(some.column("n_postings").to_pylist())
    local = table.sparkSession.createDataFrame(some)
    return ChosenBlocks(local, _stretches(blocks), some.num_rows, n_postings)


def choose_blocks(
    tops: DataFrame, scored: Callable[[ChosenBlocks], DataFrame], limit: int
) -> ChosenBlocks:
    """The blocks that may hold one of a query's best ``limit`` documents.

    The most promising blocks are ``scored`` first (``query_id, score``). If a query finds enough
    documents there, the last of the best is what a block has to be able to reach. The driver
    receives one number per query, and the blocks if they are few.
    """
    tops = tops.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
        best = scored(_settled(_seeds(tops, limit))).withColumn("place", place)
        least = best.where(F.col("place") == limit).select("query_id", "score").toArrow()
        kept = tops
        if least.num_rows:
            reached = F.broadcast(tops.sparkSession.createDataFrame(least))
            spare = F.col("score") - (_SLACK + _RELATIVE_SLACK * F.abs("score"))
            kept = tops.join(reached, "query_id", "left")
            kept = kept.where(F.col("score").isNull() | (F.col("top") >= spare))
        return _settled(kept)
    finally:
        tops.unpersist()


def reads(tops: DataFrame, chosen: ChosenBlocks) -> DataFrame:
    """``query_id, blocks, blocks_read, postings, postings_read``: what pruning spares a query."""
    read = chosen.table.select("query_id", "doc_block", F.lit(1).alias("read"))
    marked = tops.join(read, ["query_id", "doc_block"], "left")
    was_read = F.col("read").isNotNull()
    none = F.lit(0).cast("bigint")
    return marked.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.count("read").alias("blocks_read"),
        F.sum("n_postings").alias("postings"),
        F.sum(F.when(was_read, F.col("n_postings")).otherwise(none)).alias("postings_read"),
    )
