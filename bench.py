"""Times the main jobs on the sample tables and prints one line of JSON.

Building the stored tables and searching them are timed apart. A search entry is one batch of all
queries; ``queries_per_batch`` says how many that are.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trawl.operators import evaluation, features, indexing, links
from trawl.plans.engine import open_engine, write_feature
from trawl.plans.sample import SampleViews
from trawl.sources.index_store import write_index

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = _session()
    views = SampleViews(spark, FOLDER)
    docs, page_links, queries = views.documents(), views.links(), views.queries()
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> None:
        start = time.perf_counter()
        result = job()
        if isinstance(result, DataFrame):
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    # Not timed: the first job pays for starting the JVM's code generation.
    indexing.build_index(docs, "title").postings.write.format("noop").mode("overwrite").save()

    def index(field: str, build: Callable[[], indexing.FieldIndex]) -> Callable[[], None]:
        return lambda: write_index(build(), f"{root}/index/{field}")

    timed("index_title", index("title", lambda: indexing.build_index(docs, "title")))
    timed("index_body", index("body", lambda: indexing.build_index(docs, "text")))
    timed("index_anchor", index("anchor", lambda: indexing.build_anchor_index(page_links)))
    timed("titles", lambda: write_feature(features.build_titles(docs), f"{root}/titles"))
    ranks = lambda: links.pagerank(links.link_edges(page_links))
    timed("pagerank", lambda: write_feature(ranks(), f"{root}/pagerank"))
    page_views = features.build_pageviews(views.log_lines(), views.titles())
    timed("pageviews", lambda: write_feature(page_views, f"{root}/pageviews"))

    engine = open_engine(spark, root)
    timed("search", lambda: engine.search(queries))
    timed("search_body", lambda: engine.search_body(queries))
    timed("search_title", lambda: engine.search_title(queries))
    timed("search_anchor", lambda: engine.search_anchor(queries))
    one = queries.orderBy("query_id").limit(1)
    timed("search_one_query", lambda: engine.search(one))
    timed("search_one_query_pruned", lambda: engine.search(one, prune=True))
    timed("search_body_one_query", lambda: engine.search_body(one))
    timed("lookup_pagerank", lambda: engine.lookup_pagerank(views.requests()))
    timed("lookup_pageviews", lambda: engine.lookup_pageviews(views.requests()))
    timed("enrich_results", lambda: engine.enrich(engine.search(queries)))
    timed(
        "metrics_fixed",
        lambda: evaluation.metrics_fixed(queries, engine.search(queries), views.qrels()),
    )
    timed(
        "metrics_list",
        lambda: evaluation.metrics_list(queries, engine.search(queries), views.qrels()),
    )
    print(
        json.dumps(
            {
                "metric": "total wall time of the listed jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "queries_per_batch": queries.count(),
            }
        )
    )


if __name__ == "__main__":
    main()
