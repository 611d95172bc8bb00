"""Registered queries over the sample tables, each with its DuckDB counterpart."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions import tokenize
from trawl.operators import evaluation, features, indexing, links, retrieval
from trawl.plans import oracle
from trawl.plans.sample import SampleViews
from trawl.session import shared_folder
from trawl.sources import index_store
from trawl.sources.corpus import preview

try:
    import trawl.llm.registry as corpus_queries
except ImportError as missing:  # the subpackage, or a package that it needs, is not there
    warnings.warn(f"corpus queries are left out: {missing}", stacklevel=1)
    corpus_queries = None

# Thresholds of the queries whose feature they are.
MIN_DF = 2
BODY_MIN_DF = 50
MAX_POSTINGS = 100
BLOCK_SIZE = 100
# Small enough to cut the sample tables into several ranges.
ROWS_PER_RANGE = 300
# Narrow enough to cut the sample tables into many blocks.
IDS_PER_BLOCK = 16
# Cuts other than the usual ones.
OTHER_CUTS = {"cuts": (2, 7), "f1_cut": 15}

_POSTING = ["term", "doc_id", "tf", "posting_no", "df", "term_total"]


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    """Summing floats in another order gives other last digits, so results are rounded."""
    return rows.withColumns({c: F.round(c, 6) for c in columns})


def _index(views: SampleViews) -> indexing.SearchIndex:
    docs = views.documents()
    return indexing.SearchIndex(
        title=indexing.build_index(docs, "title"),
        body=indexing.build_index(docs, "text"),
        anchor=indexing.build_anchor_index(views.links()),
    )


def _pagerank(views: SampleViews) -> DataFrame:
    return links.pagerank(links.link_edges(views.links()))


def _pageviews(views: SampleViews, mode: str = "last") -> DataFrame:
    return features.build_pageviews(views.log_lines(), views.titles(), mode)


def _search(views: SampleViews) -> DataFrame:
    return retrieval.search(views.queries(), _index(views), _pagerank(views), views.titles())


def _search_body(views: SampleViews) -> DataFrame:
    index = indexing.build_index(views.documents(), "text")
    return retrieval.search_body(views.queries(), index, views.titles())


def tokenize_documents(views: SampleViews) -> DataFrame:
    tokens = views.table("documents").select("doc_id", tokenize(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


def tf_postings_body(views: SampleViews) -> DataFrame:
    return indexing.term_frequencies(views.documents())


def term_stats_body(views: SampleViews) -> DataFrame:
    return indexing.term_statistics(indexing.term_frequencies(views.documents()))


def postings_body(views: SampleViews) -> DataFrame:
    index = indexing.build_index(views.documents(), "text", min_df=BODY_MIN_DF)
    return index.postings.select(*_POSTING)


def postings_body_min_df(views: SampleViews) -> DataFrame:
    index = indexing.build_index(
        views.documents(), "text", min_df=MIN_DF, rows_per_range=ROWS_PER_RANGE
    )
    return index.postings.select(*_POSTING)


def postings_title(views: SampleViews) -> DataFrame:
    return indexing.build_index(views.documents(), "title").postings.select(*_POSTING)


def postings_anchor(views: SampleViews) -> DataFrame:
    index = indexing.build_anchor_index(
        indexing.anchor_links(views.linked_pages()), rows_per_range=ROWS_PER_RANGE * 50
    )
    return index.postings.select(*_POSTING)


def _postings_of_terms(views: SampleViews, max_postings: int | None) -> DataFrame:
    index = indexing.build_index(views.documents(), "text")
    terms = retrieval.each_term(retrieval.query_terms(views.queries()))
    found = retrieval.matching_postings(terms, index, max_postings)
    return found.select("term", "doc_id", "tf", "posting_no")


def posting_lookup(views: SampleViews) -> DataFrame:
    """The first postings of each term: the cut is the feature."""
    return _postings_of_terms(views, MAX_POSTINGS)


def posting_lookup_all(views: SampleViews) -> DataFrame:
    return _postings_of_terms(views, None)


def posting_lists(views: SampleViews) -> DataFrame:
    index = indexing.build_index(views.documents(), "text")
    entries = F.transform("postings", lambda p: F.concat_ws(":", p.doc_id, p.tf))
    return indexing.posting_blocks(index, BLOCK_SIZE).select(
        "term",
        F.col("block_no").cast("bigint").alias("block_no"),
        F.array_join(entries, " ").alias("postings"),
    )


def _by_language(views: SampleViews) -> tuple[DataFrame, DataFrame]:
    docs = views.documents()
    english = F.col("lang") == "en"
    return docs.where(english), docs.where(~english | F.col("lang").isNull())


def _merged(views: SampleViews, min_df: int) -> DataFrame:
    english, others = _by_language(views)
    merged = indexing.merge_index(
        indexing.build_index(english, "text", min_df=min_df),
        indexing.build_index(others, "text", min_df=min_df),
    )
    return merged.postings.select(*_POSTING)


def _grown(views: SampleViews, min_df: int) -> DataFrame:
    english, others = _by_language(views)
    index = indexing.build_index(english, "text", min_df=min_df)
    return indexing.add_documents(index, others, "text").postings.select(*_POSTING)


def index_merge(views: SampleViews) -> DataFrame:
    return _merged(views, 0)


def index_merge_min_df(views: SampleViews) -> DataFrame:
    return _merged(views, MIN_DF)


def index_add(views: SampleViews) -> DataFrame:
    return _grown(views, 0)


def index_add_min_df(views: SampleViews) -> DataFrame:
    return _grown(views, MIN_DF)


def _store(views: SampleViews) -> indexing.SearchIndex:
    """The three indexes written to the shared folder and opened again."""
    path = shared_folder(views.spark)
    index_store.write_search_index(_index(views), path, ids_per_block=IDS_PER_BLOCK)
    return index_store.read_search_index(views.spark, path)


def _store_body(views: SampleViews, docs: DataFrame, min_df: int = 0) -> str:
    path = shared_folder(views.spark)
    index = indexing.build_index(docs, "text", min_df=min_df, rows_per_range=ROWS_PER_RANGE)
    index_store.write_index(index, path, ids_per_block=IDS_PER_BLOCK)
    return path


def _read_body(views: SampleViews, path: str) -> DataFrame:
    return index_store.read_index(views.spark, path).postings.select(*_POSTING)


def _grown_store(views: SampleViews, min_df: int) -> str:
    english, others = _by_language(views)
    path = _store_body(views, english, min_df)
    index_store.append_documents(others, path, "text")
    return path


def index_stored(views: SampleViews) -> DataFrame:
    """All postings of an index written to the shared folder and read back."""
    return _read_body(views, _store_body(views, views.documents()))


def index_add_stored(views: SampleViews) -> DataFrame:
    """Documents added to a stored index as a segment of their own."""
    return _read_body(views, _grown_store(views, 0))


def index_add_stored_min_df(views: SampleViews) -> DataFrame:
    return _read_body(views, _grown_store(views, MIN_DF))


def index_merge_stored(views: SampleViews) -> DataFrame:
    """Two stored indexes made one without rewriting either."""
    english, others = _by_language(views)
    path = shared_folder(views.spark)
    parts = [_store_body(views, docs) for docs in (english, others)]
    index_store.merge_stored(views.spark, *parts, path)
    return _read_body(views, path)


def index_compacted(views: SampleViews) -> DataFrame:
    """The segments of a grown index merged into one."""
    path = _grown_store(views, 0)
    index_store.compact_index(views.spark, path, per_tier=2)
    return _read_body(views, path)


def term_stats_stored(views: SampleViews) -> DataFrame:
    """Statistics summed over the segments of a grown index."""
    stats = index_store.read_term_stats(views.spark, _grown_store(views, 0))
    return stats.select("term", "df", "term_total")


def posting_lookup_stored(views: SampleViews) -> DataFrame:
    """The first postings of each term, out of the segments of a grown index."""
    index = index_store.read_index(views.spark, _grown_store(views, 0))
    terms = retrieval.each_term(retrieval.query_terms(views.queries()))
    found = retrieval.matching_postings(terms, index, MAX_POSTINGS)
    return found.select("term", "doc_id", "tf", "posting_no")


def search_stored(views: SampleViews) -> DataFrame:
    index = _store(views)
    found = retrieval.search(views.queries(), index, _pagerank(views), views.titles())
    return _rounded(found, "score")


def search_pruned(views: SampleViews) -> DataFrame:
    """The fused search without the blocks of documents that cannot count."""
    index = _store(views)
    found = retrieval.search(
        views.queries(), index, _pagerank(views), views.titles(), prune=True
    )
    return _rounded(found, "score")


def search_body_pruned(views: SampleViews) -> DataFrame:
    """As above, over the segments of a grown index."""
    index = index_store.read_index(views.spark, _grown_store(views, 0))
    found = retrieval.search_body(views.queries(), index, views.titles(), prune=True)
    return _rounded(found, "score")


def search(views: SampleViews) -> DataFrame:
    return _rounded(_search(views), "score")


def search_body(views: SampleViews) -> DataFrame:
    return _rounded(_search_body(views), "score")


def search_title(views: SampleViews) -> DataFrame:
    index = indexing.build_index(views.documents(), "title", rows_per_range=ROWS_PER_RANGE)
    return retrieval.search_matches(views.queries(), index, views.titles())


def search_anchor(views: SampleViews) -> DataFrame:
    index = indexing.build_anchor_index(views.links())
    return retrieval.response_pairs(
        retrieval.search_matches(views.queries(), index, views.titles())
    )


def search_odd_queries(views: SampleViews) -> DataFrame:
    """Empty queries, stop words only and unknown words beside ordinary ones."""
    index = indexing.build_index(views.documents(), "text")
    return _rounded(retrieval.search_body(views.odd_queries(), index, views.titles()), "score")


def link_edges(views: SampleViews) -> DataFrame:
    return links.link_edges(indexing.anchor_links(views.linked_pages()))


def link_vertices(views: SampleViews) -> DataFrame:
    return links.link_graph(views.links())[1]


def pagerank6(views: SampleViews) -> DataFrame:
    return _rounded(_pagerank(views), "pagerank")


def pageviews_last(views: SampleViews) -> DataFrame:
    return _pageviews(views)


def pageviews_two_logs(views: SampleViews) -> DataFrame:
    """A log taken in after another one, without reading the first again."""
    lines = views.log_lines()
    half = F.col("line_no") % 2 == 0
    first = features.last_views(lines.where(half))
    both = features.merge_views(first, features.last_views(lines.where(~half)))
    return features.titled_views(both, views.titles())


def preview_documents(views: SampleViews) -> DataFrame:
    """First and random rows: few of them are the feature."""
    docs = views.table("documents").select("doc_id", "lang", "source", "n_chars")
    return preview(docs, key=["doc_id"], order="doc_id")


def pageviews_long_numbers(views: SampleViews) -> DataFrame:
    """Views of 19 digits and ids with zeros in front."""
    return features.build_pageviews(views.log_lines(long_numbers=True), views.titles())


def pageviews_sum(views: SampleViews) -> DataFrame:
    return _pageviews(views, "sum")


def titles_last(views: SampleViews) -> DataFrame:
    return features.build_titles(views.renamed_pages(), "row_order")


def lookup_pagerank(views: SampleViews) -> DataFrame:
    found = features.lookup_pagerank(views.requests(), _pagerank(views))
    return _rounded(found, "pagerank")


def lookup_pageviews(views: SampleViews) -> DataFrame:
    return features.lookup_pageviews(views.requests(), _pageviews(views))


def enrich_results(views: SampleViews) -> DataFrame:
    ranks = _pagerank(views)
    results = retrieval.search(views.queries(), _index(views), ranks, views.titles())
    enriched = features.enrich(results, ranks, _pageviews(views))
    return _rounded(enriched, "score", "pagerank")


def metrics_fixed(views: SampleViews) -> DataFrame:
    metrics = evaluation.metrics_fixed(views.queries(), _search(views), views.qrels())
    return _rounded(metrics, *metrics.columns[2:])


def metrics_list(views: SampleViews) -> DataFrame:
    metrics = evaluation.metrics_list(views.queries(), _search_body(views), views.qrels())
    return _rounded(metrics, *metrics.columns[2:])


def metrics_fixed_other_cuts(views: SampleViews) -> DataFrame:
    metrics = evaluation.metrics_fixed(
        views.queries(), _search_body(views), views.qrels(), **OTHER_CUTS
    )
    return _rounded(metrics, *metrics.columns[2:])


def metrics_list_other_cuts(views: SampleViews) -> DataFrame:
    metrics = evaluation.metrics_list(
        views.queries(), _search_body(views), views.string_qrels(), ap_cut=9, **OTHER_CUTS
    )
    return _rounded(metrics, *metrics.columns[2:])


def metrics_summary_fixed(views: SampleViews) -> DataFrame:
    metrics = evaluation.metrics_fixed(views.queries(), _search_body(views), views.qrels())
    means = evaluation.summarize(metrics)
    return _rounded(means, *means.columns[1:])


def metrics_summary_list(views: SampleViews) -> DataFrame:
    metrics = evaluation.metrics_list(views.queries(), _search(views), views.qrels())
    means = evaluation.summarize(metrics)
    return _rounded(means, *means.columns[1:])


def display_query(views: SampleViews) -> DataFrame:
    shown = evaluation.display_query(F.col("text")).alias("shown")
    return views.table("conversations").select("conv_id", "turn", shown)


_QUERIES = [
    tokenize_documents,
    tf_postings_body,
    term_stats_body,
    postings_body,
    postings_body_min_df,
    postings_title,
    postings_anchor,
    posting_lookup,
    posting_lookup_all,
    posting_lists,
    index_merge,
    index_merge_min_df,
    index_add,
    index_add_min_df,
    index_stored,
    index_add_stored,
    index_add_stored_min_df,
    index_merge_stored,
    index_compacted,
    term_stats_stored,
    posting_lookup_stored,
    search_stored,
    search_pruned,
    search_body_pruned,
    preview_documents,
    pageviews_two_logs,
    search,
    search_body,
    search_title,
    search_anchor,
    search_odd_queries,
    link_edges,
    link_vertices,
    pagerank6,
    pageviews_last,
    pageviews_sum,
    pageviews_long_numbers,
    titles_last,
    lookup_pagerank,
    lookup_pageviews,
    enrich_results,
    metrics_fixed,
    metrics_list,
    metrics_fixed_other_cuts,
    metrics_list_other_cuts,
    metrics_summary_fixed,
    metrics_summary_list,
    display_query,
]


def entry(spark: SparkSession) -> DataFrame:
    """The fused search, over the smallest sample tables."""
    return search(SampleViews(spark, "/root/testdata/sf0.001"))


def _bind(
    query: Callable[[SampleViews], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(SampleViews(spark, sf_dir))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query, called with a session and a folder of sample tables."""
    registered = {query.__name__: _bind(query) for query in _QUERIES}
    return registered | (corpus_queries.queries() if corpus_queries else {})


def oracle_sql() -> dict[str, str]:
    """Where SQL can express a query, a statement giving the same rows in DuckDB."""
    statements = oracle.statements(MIN_DF, BODY_MIN_DF, MAX_POSTINGS, BLOCK_SIZE)
    return statements | (corpus_queries.oracle_sql() if corpus_queries else {})
