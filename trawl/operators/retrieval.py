"""Ranked retrieval for batches of queries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.scoring import (
    BM25_K1,
    FALLBACK_CORPUS_SIZE,
    TOP_K,
    SearchWeights,
    bm25_idf,
    bm25_saturation,
    classic_idf,
    rank_boost,
)
from trawl.functions.text import STOPWORDS, tokenize
from trawl.operators.indexing import FieldIndex, SearchIndex
from trawl.operators.numbering import deal, number_rows
from trawl.operators.pruning import ChosenBlocks, FieldScore, block_tops, choose_blocks, reads
from trawl.operators.segments import TermFilter, common_ranges, overlapping
from trawl.session import BROADCAST_ROWS
from trawl.sources.index_store import Folders, Vocabulary

# Up to this many different terms are written into the plan, where the scan can use them.
TERMS_IN_PLAN = 1_000

# Query terms beyond the broadcast limit are joined by shuffle, a term in parts of so many postings.
POSTINGS_PER_PART = 500_000

# Spark trims each task's rows to the best k ahead of the shuffle for k up to this default limit.
_TRIMMED_BY_SPARK = 1_000
_TRIM_PARTS = 256

# Larger than any token position, so that fields come before positions in ``first``.
_STAGE = 2**32

# Scores are compared after rounding, so that the order of adding floats cannot decide a rank.
_SCORE_DIGITS = 9


@dataclass(frozen=True)
class QueryTerms:
    """Terms of a batch of queries, and what is known of them.

    ``table``: ``query_id, term, uses, qpos``, where ``uses`` counts the term in the query and
    ``qpos`` is its first position there. ``small`` says that the table was counted and fits a
    broadcast; ``n_rows`` counts it and ``n_queries`` the queries with terms. ``vocabulary``
    selects the terms in stored postings if they are few.
    """

    table: DataFrame
    small: bool
    n_rows: int
    n_queries: int
    vocabulary: Optional[Vocabulary] = None

    @property
    def wanted(self) -> TermFilter:
        """What selects the terms, or the folders they are in, in stored tables."""
        return self.vocabulary or Folders(self.table, self.small)


def query_terms(queries: DataFrame, stopwords: Iterable[str] = STOPWORDS) -> QueryTerms:
    """Tokenise ``query_id, query``. Empty and all-stop-word queries give no rows."""
    tokens = F.posexplode(tokenize(F.col("query"), stopwords)).alias("pos", "term")
    table = (
        queries.select("query_id", tokens)
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("uses"), F.min("pos").alias("qpos"))
    )
    hashed = F.xxhash64("term").alias("hash")
    some = table.select("query_id", "term", hashed).limit(TERMS_IN_PLAN + 1).collect()
    if len(some) <= TERMS_IN_PLAN:
        vocabulary = Vocabulary({row["term"]: row["hash"] for row in some})
        n_queries = len({row["query_id"] for row in some})
        return QueryTerms(table, True, len(some), n_queries, vocabulary)
    n_rows, n_queries = table.agg(F.count(F.lit(1)), F.count_distinct("query_id")).first()
    # A large batch may ask for few different terms.
    different = table.select("term", hashed).distinct().limit(TERMS_IN_PLAN + 1).collect()
    vocabulary = None
    if len(different) <= TERMS_IN_PLAN:
        vocabulary = Vocabulary({row["term"]: row["hash"] for row in different})
    return QueryTerms(table, n_rows <= BROADCAST_ROWS, n_rows, n_queries, vocabulary)


def each_term(terms: QueryTerms) -> QueryTerms:
    """The terms with one row each, that of their least query: a posting is then matched once."""
    least = [F.min(c).alias(c) for c in ("query_id", "uses", "qpos")]
    table = terms.table.groupBy("term").agg(*least).select(*terms.table.columns)
    return replace(terms, table=table)


def matching_postings(
    terms: QueryTerms,
    index: FieldIndex,
    max_postings: Optional[int] = None,
    chosen: Optional[ChosenBlocks] = None,
) -> DataFrame:
    """Each query term with its postings: ``query_id, uses, qpos`` and the columns of a posting.

    On request, only the first ``max_postings`` of a term are read; ``df`` still counts all of them.
    A stored index numbers postings in that case only, as nothing else needs their positions.
    ``chosen`` restricts a small batch to some blocks of documents of a stored index.
    """
    if index.segments:
        found = _stored_matches(terms, index, max_postings, chosen)
    else:
        found = _derived_matches(terms, index, max_postings)
    # No document id is null; said here, later joins on it need no check that sets plans apart.
    return found.where(F.col("doc_id").isNotNull())


def _stored_matches(
    terms: QueryTerms,
    index: FieldIndex,
    max_postings: Optional[int],
    chosen: Optional[ChosenBlocks],
) -> DataFrame:
    wanted = terms.wanted
    if max_postings is None:
        postings = index.counts(wanted)
    else:
        postings = index.first_postings(wanted, max_postings)
    if chosen is not None:
        postings = postings.where(chosen.condition)
    known = index.statistics(wanted).select("term", "df")
    if terms.small:
        asked = F.broadcast(known.join(F.broadcast(terms.table), "term"))
        found = postings.join(asked, "term")
        return found if chosen is None else chosen.of(found)
    asked = terms.table.join(known, "term")
    if max_postings is not None or overlapping(index.segments):
        return postings.join(asked, "term")
    # A term meets each of its pieces apart, so a frequent one is dealt out by ranges of documents
    # and a rare one is not copied.
    found = []
    for segment in index.segments:
        pieces = segment.rows(segment.pieces, wanted).select("term", "doc_range")
        rows = segment.rows(segment.postings, wanted).select(
            "term", "doc_id", "tf", "doc_range", "doc_block"
        )
        found.append(rows.join(asked.join(pieces, "term"), ["term", "doc_range"]))
    both = reduce(DataFrame.unionByName, found)
    if len(found) == 1:
        return both
    return both.withColumn("doc_range", common_ranges(index.segments).of(F.col("doc_id")))


def _derived_matches(
    terms: QueryTerms, index: FieldIndex, max_postings: Optional[int]
) -> DataFrame:
    postings = index.postings
    if index.derived is not None and terms.small:
        postings = index.only(F.broadcast(terms.table.select("term").distinct()))
    if max_postings is not None:
        postings = postings.where(F.col("posting_no") <= max_postings)
    postings = postings.select("term", "doc_id", "tf", "posting_no", "df", "doc_range")
    if terms.small:
        return postings.join(F.broadcast(terms.table), "term")
    # Frequent terms, in queries or in documents, are joined in parts; rare ones are not copied.
    n_parts = F.ceil(F.col("df") / POSTINGS_PER_PART).cast("int")
    part = F.pmod(F.col("posting_no"), n_parts.cast("bigint")).cast("int").alias("part")
    asked = terms.table.join(index.term_stats.select("term", "df"), "term")
    parts = F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("part")
    asked = asked.select(*terms.table.columns, parts)
    return postings.select("*", part).join(asked, ["term", "part"])


def _points(matches: DataFrame, stage: int, points: Column) -> DataFrame:
    """Contributions of one field.

    ``first`` tells when a search going field by field and token by token would meet a document.
    """
    first = F.lit(stage * _STAGE).cast("bigint") + F.col("qpos")
    return matches.select(
        "query_id", "doc_id", points.alias("points"), first.alias("first"), "doc_range"
    )


def accumulate(points: DataFrame, terms: QueryTerms) -> DataFrame:
    """Add up contributions: ``query_id, doc_id, score, first, doc_range``.

    For a small batch, rows are placed by document alone, which serves the sum as well as joins
    on the document that follow; a document then has at most three rows per query term. Postings
    of one document lie far apart, so there is next to nothing to combine beforehand.
    """
    placed = points.repartition("doc_id") if terms.small else points
    return placed.groupBy("query_id", "doc_id").agg(
        F.sum("points").alias("score"),
        F.min("first").alias("first"),
        F.max("doc_range").alias("doc_range"),
    )


def rank_top(scores: DataFrame, limit: int) -> DataFrame:
    """The best ``limit`` documents per query, ties in the order of first being met."""
    order = [F.round("score", _SCORE_DIGITS).desc(), F.asc("first"), F.asc("doc_id")]

    def best(rows: DataFrame, *group: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return rows.withColumn("rank", place).where(F.col("rank") <= limit)

    if limit > _TRIMMED_BY_SPARK:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(_TRIM_PARTS))
        scores = best(scores.withColumn("_part", part), "query_id", "_part").drop("_part", "rank")
    return best(scores, "query_id")


def rank_all(scores: DataFrame, ranges: int) -> DataFrame:
    """Number every document per query when scores are whole numbers (match counts).

    Equal scores are common, so a query's documents are cut by score, first term and range of
    document ids, unless the index is small.
    """
    pieces = {"score": False, "first": True, "doc_range": True} if ranges > 1 else {}
    return number_rows(
        scores,
        group=["query_id"],
        pieces=pieces,
        order=[F.desc("score"), F.asc("first"), F.asc("doc_id")],
        number="rank",
    )


def attach_titles(ranked: DataFrame, titles: DataFrame, at_most: Optional[int]) -> DataFrame:
    """``query_id, rank, doc_id, title, score``; unknown documents are titled ``N/A``.

    A null title of a known document stays null. A result of ``at_most`` so many rows that it is
    sure to fit a broadcast first picks its titles out of the title table, which then need not be
    shuffled.
    """
    known = titles.select(F.col("id").alias("doc_id"), "title", F.lit(True).alias("known"))
    if at_most is not None and at_most <= BROADCAST_ROWS:
        # Asking for the score makes this branch need what the other one does: one shuffle for both.
        ids = ranked.where(F.col("score").isNotNull()).select("doc_id").distinct()
        known = known.join(F.broadcast(ids), "doc_id", "left_semi")
    title = F.when(F.col("known"), F.col("title")).otherwise("N/A").alias("title")
    return ranked.join(known, "doc_id", "left").select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", title, "score"
    )


def corpus_size(pagerank: DataFrame) -> Column:
    """Number of rows of the rank table as a scalar, or the fixed fallback when it is empty."""
    rows = F.count(F.lit(1))
    size = F.when(rows > 0, rows).otherwise(FALLBACK_CORPUS_SIZE)
    return pagerank.agg(size.alias("n")).scalar()


def _few_matches(terms: QueryTerms, fields: Sequence[FieldScore]) -> bool:
    """Whether the stored statistics say that the documents found are sure to fit a broadcast."""
    if terms.vocabulary is None or not all(f.index.segments for f in fields):
        return False
    lists = [f.index.statistics(terms.vocabulary).select("df") for f in fields]
    total = reduce(DataFrame.unionByName, lists).agg(F.sum("df")).first()[0] or 0
    return total <= BROADCAST_ROWS


def _sum_fields(
    terms: QueryTerms,
    fields: Sequence[FieldScore],
    max_postings: Optional[int],
    chosen: Optional[ChosenBlocks],
) -> DataFrame:
    if terms.small and max_postings is None and all(f.index.derived for f in fields):
        return _sum_derived(terms, fields)
    points = [
        _points(
            matching_postings(terms, field.index, max_postings, chosen),
            field.stage,
            field.points(F.col("uses"), F.col("tf"), F.col("df")),
        )
        for field in fields
    ]
    return accumulate(reduce(DataFrame.unionByName, points), terms)


def _sum_derived(terms: QueryTerms, fields: Sequence[FieldScore]) -> DataFrame:
    """As ``accumulate``, for a small batch over all postings of indexes not stored.

    Nothing here asks for positions in a list, so no list is sorted. Frequencies of all fields are
    placed by document once, which serves the sum over repeated documents, that over a query's
    terms, and joins on the document that follow.
    """
    wanted = F.broadcast(terms.table.select("term").distinct())
    rows = [
        field.index.frequencies_of(wanted).withColumn("stage", F.lit(field.stage))
        for field in fields
    ]
    # Most rows are of the field with most documents; a document meets each query at most once.
    ranges = max((f.index.derived.ranges for f in fields), key=lambda r: r.n_rows or 0)
    counts = (
        deal(reduce(DataFrame.unionByName, rows), ranges, "doc_id")
        .groupBy("doc_id", "stage", "term")
        .agg(F.sum("tf").alias("tf"))
        # Always so; asking for it makes the count need what the rows do: one shuffle for both.
        .where(F.col("tf").isNotNull())
    )
    known = counts.groupBy("stage", "term").agg(F.count(F.lit(1)).alias("df"))
    frequent = [(F.col("stage") == f.stage) & (F.col("df") > f.index.min_df) for f in fields]
    asked = known.where(reduce(or_, frequent)).join(F.broadcast(terms.table), "term")
    points = F.coalesce(
        *[
            F.when(
                F.col("stage") == f.stage, f.points(F.col("uses"), F.col("tf"), F.col("df"))
            )
            for f in fields
        ]
    )
    first = F.col("stage").cast("bigint") * _STAGE + F.col("qpos")
    scores = (
        counts.join(F.broadcast(asked), ["stage", "term"])
        .groupBy("query_id", "doc_id")
        .agg(F.sum(points).alias("score"), F.min(first).alias("first"))
    )
    return scores.withColumn("doc_range", fields[0].index.derived.ranges.of(F.col("doc_id")))


def _may_prune(terms: QueryTerms, fields: Sequence[FieldScore], max_postings: Optional[int]) -> bool:
    """Whether blocks can be left out: a small batch over stored fields with blocks alike."""
    if max_postings is not None:
        raise ValueError("a search reads either the first postings or the blocks that count")
    widths = {field.index.ids_per_block for field in fields}
    return terms.small and len(widths) == 1 and None not in widths


def _fused_fields(
    index: SearchIndex, weights: SearchWeights, n_docs: Column, k1: float
) -> list[FieldScore]:
    def bm25(uses: Column, tf: Column, df: Column) -> Column:
        return uses * (bm25_idf(df, n_docs) * bm25_saturation(tf, k1)) * weights.body

    return [
        FieldScore(index.title, 0, lambda uses, tf, df: uses * weights.title),
        FieldScore(index.anchor, 1, lambda uses, tf, df: uses * tf * weights.anchor),
        FieldScore(index.body, 2, bm25),
    ]


def _most_boost(pagerank: DataFrame, weights: SearchWeights) -> Column:
    """The most that the rank of any document can add to its score."""
    return pagerank.agg((rank_boost(F.max("pagerank")) * weights.pagerank).alias("boost")).scalar()


def search(
    queries: DataFrame,
    index: SearchIndex,
    pagerank: DataFrame,
    titles: DataFrame,
    weights: SearchWeights = SearchWeights(),
    limit: int = TOP_K,
    max_postings: Optional[int] = None,
    n_docs: Optional[int] = None,
    k1: float = BM25_K1,
    stopwords: Iterable[str] = STOPWORDS,
    prune: bool = False,
) -> DataFrame:
    """Fused ranking: title matches, anchor frequencies, body BM25 and a PageRank boost.

    ``prune`` leaves out blocks of documents that cannot be among a query's best, with the same
    result. It takes a stored index and a batch of queries that fits a broadcast; others are
    searched in full.
    """
    terms = query_terms(queries, stopwords)
    n = F.lit(n_docs) if n_docs is not None else corpus_size(pagerank)
    fields = _fused_fields(index, weights, n, k1)
    ranks = pagerank.select(F.col("id").alias("doc_id"), "pagerank")
    boost = rank_boost(F.col("pagerank")) * weights.pagerank

    def scored(chosen: Optional[ChosenBlocks], few: bool) -> DataFrame:
        scores = _sum_fields(terms, fields, max_postings, chosen)
        own = ranks
        if few:
            # The documents found pick their ranks out, so the rank table is not shuffled. Asking
            # for the score makes this branch need what the other one does: one shuffle for both.
            found = scores.where(F.col("score").isNotNull()).select("doc_id").distinct()
            own = ranks.join(F.broadcast(found), "doc_id", "left_semi")
        boosted = scores.join(own, "doc_id", "left")
        return boosted.withColumn("score", F.col("score") + boost).drop("pagerank")

    if prune and _may_prune(terms, fields, max_postings):
        tops = block_tops(terms.table, terms.wanted, fields, _most_boost(pagerank, weights))
        chosen = choose_blocks(
            tops, lambda seeds: scored(seeds, seeds.n_postings <= BROADCAST_ROWS), limit
        )
        scores = scored(chosen, chosen.n_postings <= BROADCAST_ROWS)
    else:
        scores = scored(None, _few_matches(terms, fields))
    return attach_titles(rank_top(scores, limit), titles, terms.n_queries * limit)


def search_reads(
    queries: DataFrame,
    index: SearchIndex,
    pagerank: DataFrame,
    weights: SearchWeights = SearchWeights(),
    limit: int = TOP_K,
    n_docs: Optional[int] = None,
    k1: float = BM25_K1,
    stopwords: Iterable[str] = STOPWORDS,
) -> DataFrame:
    """``query_id, blocks, blocks_read, postings, postings_read`` of a pruned fused search."""
    terms = query_terms(queries, stopwords)
    n = F.lit(n_docs) if n_docs is not None else corpus_size(pagerank)
    fields = _fused_fields(index, weights, n, k1)
    if not _may_prune(terms, fields, None):
        raise ValueError("pruning takes a stored index and a batch that fits a broadcast")
    ranks = pagerank.select(F.col("id").alias("doc_id"), "pagerank")
    boost = rank_boost(F.col("pagerank")) * weights.pagerank

    def scored(chosen: ChosenBlocks) -> DataFrame:
        boosted = _sum_fields(terms, fields, None, chosen).join(ranks, "doc_id", "left")
        return boosted.withColumn("score", F.col("score") + boost)

    tops = block_tops(terms.table, terms.wanted, fields, _most_boost(pagerank, weights))
    return reads(tops, choose_blocks(tops, scored, limit))


def search_body(
    queries: DataFrame,
    index: FieldIndex,
    titles: DataFrame,
    limit: int = TOP_K,
    max_postings: Optional[int] = None,
    n_docs: int = FALLBACK_CORPUS_SIZE,
    stopwords: Iterable[str] = STOPWORDS,
    prune: bool = False,
) -> DataFrame:
    """TF-IDF ranking over the body; ``prune`` as for ``search``."""
    terms = query_terms(queries, stopwords)
    weight = lambda uses, tf, df: uses * (tf * classic_idf(df, F.lit(n_docs)))
    fields = [FieldScore(index, 0, weight)]
    chosen = None
    if prune and _may_prune(terms, fields, max_postings):
        tops = block_tops(terms.table, terms.wanted, fields, F.lit(0.0))
        chosen = choose_blocks(tops, lambda seeds: _sum_fields(terms, fields, None, seeds), limit)
    scores = _sum_fields(terms, fields, max_postings, chosen)
    return attach_titles(rank_top(scores, limit), titles, terms.n_queries * limit)


def search_matches(
    queries: DataFrame,
    index: FieldIndex,
    titles: DataFrame,
    max_postings: Optional[int] = None,
    stopwords: Iterable[str] = STOPWORDS,
) -> DataFrame:
    """Every document ranked by how many query tokens the field holds, each use counted."""
    terms = query_terms(queries, stopwords)
    fields = [FieldScore(index, 0, lambda uses, tf, df: uses)]
    scores = _sum_fields(terms, fields, max_postings, None)
    at_most = None if max_postings is None else terms.n_rows * max_postings
    return attach_titles(rank_all(scores, index.ranges), titles, at_most)


def search_title(
    queries: DataFrame, index: SearchIndex, titles: DataFrame, **options: object
) -> DataFrame:
    return search_matches(queries, index.title, titles, **options)


def search_anchor(
    queries: DataFrame, index: SearchIndex, titles: DataFrame, **options: object
) -> DataFrame:
    return search_matches(queries, index.anchor, titles, **options)


def response_pairs(results: DataFrame) -> DataFrame:
    """Results as the pairs a client sees: ``query_id, rank``, the id as a string, the title."""
    return results.select("query_id", "rank", F.col("doc_id").cast("string").alias("id"), "title")
