"""Every registered query against its DuckDB statement, on the smallest sample tables."""

from __future__ import annotations

import os
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as registered
from tests.conftest import SAMPLE
from trawl.operators import retrieval
from trawl.plans.engine import build_engine, open_engine
from trawl.plans.sample import SampleViews

duckdb = pytest.importorskip("duckdb")

STATEMENTS = registered.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SAMPLE):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SAMPLE}/{file}'")
    return connection


def table(columns, rows):
    """Columns by name and rows in any order, floats to five places."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return round(value, 5) if isinstance(value, float) else value

    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


NAMES = [query.__name__ for query in registered._QUERIES]


def test_every_query_has_a_statement():
    assert set(NAMES) <= set(registered.queries()) and set(NAMES) <= set(STATEMENTS)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, database, name):
    frame = registered.queries()[name](spark, SAMPLE)
    result = database.execute(STATEMENTS[name])
    wanted = table([d[0] for d in result.description], result.fetchall())
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == wanted
    assert wanted[1]


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    """The engine over the sample tables, written and opened again."""
    views = SampleViews(spark, SAMPLE)
    docs = views.documents()
    path = str(tmp_path_factory.mktemp("engine"))
    build_engine(docs, views.log_lines(), path, buckets=16, page_links=views.links())
    return views, open_engine(spark, path)


@pytest.mark.parametrize("name", ["search", "search_body", "search_title", "search_anchor"])
def test_stored_search(engine, database, name):
    views, opened = engine
    found = getattr(opened, name)(views.queries())
    if name == "search_anchor":
        found = retrieval.response_pairs(found)
    else:
        found = found.withColumn("score", F.round("score", 6))
    result = database.execute(STATEMENTS[name])
    wanted = table([d[0] for d in result.description], result.fetchall())
    assert table(found.columns, [tuple(r) for r in found.collect()]) == wanted


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_one_query_picks_its_ranks_out(engine):
    views, opened = engine
    one = views.queries().where("query_id = 0")
    assert plan_of(opened.search(one)).count("LeftSemi, BuildRight") >= 2  # of ranks and of titles


def test_any_batch_reads_the_folders_of_its_terms_only(engine, monkeypatch):
    views, opened = engine
    monkeypatch.setattr(retrieval, "TERMS_IN_PLAN", 2)
    one = views.queries().where("query_id = 0")
    assert re.search(r"PartitionFilters: \[.*term_bucket#\d+ IN(SET)? ", plan_of(opened.search_body(one)))


def test_entry(spark):
    assert registered.entry(spark).columns == ["query_id", "rank", "doc_id", "title", "score"]
