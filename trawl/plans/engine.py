"""Building a search engine's tables once, and serving batches of queries from them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Optional

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.text import STOPWORDS
from trawl.operators import features, indexing, links, retrieval
from trawl.operators.indexing import SearchIndex
from trawl.sources.index_store import (
    SEGMENTS_PER_TIER,
    append_documents,
    append_links,
    compact_index,
    read_search_index,
    write_index,
)


@dataclass(frozen=True)
class Engine:
    """The stored tables of a search engine."""

    index: SearchIndex
    titles: DataFrame
    pagerank: DataFrame
    pageviews: DataFrame

    def search(self, queries: DataFrame, **options: object) -> DataFrame:
        return retrieval.search(queries, self.index, self.pagerank, self.titles, **options)

    def search_body(self, queries: DataFrame, **options: object) -> DataFrame:
        return retrieval.search_body(queries, self.index.body, self.titles, **options)

    def search_title(self, queries: DataFrame, **options: object) -> DataFrame:
        return retrieval.search_title(queries, self.index, self.titles, **options)

    def search_anchor(self, queries: DataFrame, **options: object) -> DataFrame:
        return retrieval.search_anchor(queries, self.index, self.titles, **options)

    def lookup_pagerank(self, requests: DataFrame, **options: object) -> DataFrame:
        return features.lookup_pagerank(requests, self.pagerank, **options)

    def lookup_pageviews(self, requests: DataFrame, **options: object) -> DataFrame:
        return features.lookup_pageviews(requests, self.pageviews, **options)

    def enrich(self, results: DataFrame, **options: object) -> DataFrame:
        return features.enrich(results, self.pagerank, self.pageviews, **options)


def build_engine(
    corpus: DataFrame,
    log_lines: DataFrame,
    path: str,
    body_min_df: int = 0,
    buckets: Optional[int] = None,
    stopwords: Iterable[str] = STOPWORDS,
    page_links: Optional[DataFrame] = None,
) -> None:
    """Write indexes, titles, PageRank and page views below ``path``.

    ``corpus`` is ``id, title, text, anchor_text``; ``page_links`` (``src, dst, text``) replaces
    the last of these if given. ``log_lines`` is ``line, line_no``. A column ``row_order`` of the
    corpus decides between titles of one id; ``read_corpus`` gives it. ``grow_engine`` adds to it.
    """
    spark = corpus.sparkSession
    if page_links is None:
        page_links = indexing.anchor_links(corpus)
    title = indexing.build_index(corpus, "title", stopwords=stopwords)
    write_index(title, f"{path}/index/title", buckets)
    body = indexing.build_index(corpus, "text", min_df=body_min_df, stopwords=stopwords)
    write_index(body, f"{path}/index/body", buckets)
    anchor = indexing.build_anchor_index(page_links, stopwords=stopwords)
    write_index(anchor, f"{path}/index/anchor", buckets)
    write_feature(_titles(corpus), f"{path}/titles")
    links.link_edges(page_links).write.parquet(f"{path}/edges/batch=0")
    _rank_pages(spark, path)
    write_feature(features.last_views(log_lines), f"{path}/last_views")
    _show_views(spark, path)


def grow_engine(
    spark: SparkSession,
    path: str,
    corpus: DataFrame,
    log_lines: Optional[DataFrame] = None,
    stopwords: Iterable[str] = STOPWORDS,
    page_links: Optional[DataFrame] = None,
    per_tier: int = SEGMENTS_PER_TIER,
) -> None:
    """Add a batch of pages, and a later log if there is one, to the engine in ``path``.

    Indexes get a segment each, merged with others of like size now and then. A page with a new
    title takes it on; a page of the log takes on its last line. Ranks depend on all links and are
    worked out anew, from the stored edges of all batches.
    """
    if page_links is None:
        page_links = indexing.anchor_links(corpus)
    append_documents(corpus, f"{path}/index/title", "title", stopwords=stopwords)
    append_documents(corpus, f"{path}/index/body", "text", stopwords=stopwords)
    append_links(page_links, f"{path}/index/anchor", stopwords=stopwords)
    for field in ("title", "body", "anchor"):
        compact_index(spark, f"{path}/index/{field}", per_tier)
    add_titles(spark, corpus, f"{path}/titles")
    batch = spark.read.parquet(f"{path}/edges").agg(F.max("batch")).first()[0] + 1
    links.link_edges(page_links).write.parquet(f"{path}/edges/batch={batch}")
    _rank_pages(spark, path)
    if log_lines is not None:
        known = read_feature(spark, f"{path}/last_views")
        log_no = (known.agg(F.max("log_no")).first()[0] or 0) + 1
        views = features.merge_views(known, features.last_views(log_lines, log_no))
        write_feature(views, f"{path}/last_views")
    _show_views(spark, path)


def add_titles(spark: SparkSession, corpus: DataFrame, path: str) -> None:
    """Take the titles of new pages into a stored table; known pages get their new ones."""
    new = _titles(corpus)
    known = read_feature(spark, path).join(new.select("id"), "id", "left_anti")
    write_feature(known.unionByName(new), path)


def _titles(corpus: DataFrame) -> DataFrame:
    return features.build_titles(corpus, "row_order" if "row_order" in corpus.columns else None)


def _rank_pages(spark: SparkSession, path: str) -> None:
    """Ranks over the edges of all batches; the same edge may come with several of them."""
    edges = links.link_edges(spark.read.parquet(f"{path}/edges").select("src", "dst"))
    write_feature(links.pagerank(edges), f"{path}/pagerank")


def _show_views(spark: SparkSession, path: str) -> None:
    views = read_feature(spark, f"{path}/last_views")
    write_feature(
        features.titled_views(views, read_feature(spark, f"{path}/titles")), f"{path}/pageviews"
    )


def write_feature(feature: DataFrame, path: str) -> None:
    """Write a table of one row per ``id``, sorted so that looking up few ids reads little.

    It becomes the latest version of the table; earlier ones stay for readers still at work.
    """
    spark = feature.sparkSession
    by_id = feature.repartitionByRange("id").sortWithinPartitions("id")
    by_id.write.parquet(f"{path}/version={_version(spark, path) + 1}")


def _version(spark: SparkSession, path: str) -> int:
    """The latest version of a feature table, 0 if there is none."""
    try:
        versions = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0
    return versions.agg(F.max("version")).first()[0] or 0


def read_feature(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of a feature table."""
    return spark.read.parquet(f"{path}/version={_version(spark, path)}")


def open_engine(spark: SparkSession, path: str) -> Engine:
    return Engine(
        index=read_search_index(spark, f"{path}/index"),
        titles=read_feature(spark, f"{path}/titles"),
        pagerank=read_feature(spark, f"{path}/pagerank"),
        pageviews=read_feature(spark, f"{path}/pageviews"),
    )
