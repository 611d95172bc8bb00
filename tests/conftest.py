from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def toy(spark):
    """Four linked pages with known answers; page 9 is a link target without a document."""
    from trawl.schemas import CORPUS

    return spark.createDataFrame(
        [
            (1, "alpha page", "alpha beta alpha", [(2, "beta"), (3, "gamma alpha")]),
            (2, "beta page", "beta gamma", [(3, "gamma")]),
            (3, "gamma alpha", "alpha gamma gamma gamma", [(1, "alpha")]),
            (4, "delta page", "delta", [(9, "alpha")]),
        ],
        CORPUS,
    )


@pytest.fixture(scope="session")
def toy_titles(toy):
    return toy.select("id", "title")


@pytest.fixture(scope="session")
def toy_ranks(toy):
    from trawl.operators.indexing import anchor_links
    from trawl.operators.links import link_edges, pagerank

    return pagerank(link_edges(anchor_links(toy)))


@pytest.fixture(scope="session")
def toy_index(toy):
    from trawl.operators.indexing import build_search_index

    return build_search_index(toy, body_min_df=0)
