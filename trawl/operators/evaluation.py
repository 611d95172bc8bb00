"""Scoring ranked results against relevance judgements."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.rounding import round_exact

# The usual cuts of the measures, and of a query on display.
CUTS_PRECISION = (5, 10)
CUT_F1 = 30
CUT_AVERAGE_PRECISION = 40
DISPLAY_CHARS = 27

# Queries that are run one by one to be timed.
TIMED_QUERIES = 1_000


def _harmonic(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), 2.0 / (1.0 / a + 1.0 / b)).otherwise(0.0)


def _ratio(part: Column, whole: Column, if_none: float) -> Column:
    return F.when(whole > 0, part / whole).otherwise(if_none)


def _judged(
    queries: DataFrame, results: DataFrame, qrels: DataFrame, deepest: int, aggregates
) -> DataFrame:
    """One row per query: ``query_id, n_relevant`` and ``aggregates`` over its best results.

    Results are cut to the deepest rank any measure looks at before anything else, which bounds
    every group below. Ids are compared as strings, so a judgement may be of any kind of id.
    """
    doc_id = F.col("doc_id").cast("string").alias("doc_id")
    relevant = qrels.select("query_id", doc_id).distinct()
    top = results.where(F.col("rank") <= deepest).select("query_id", doc_id, "rank")
    marked = top.join(
        relevant.withColumn("relevant", F.lit(True)), ["query_id", "doc_id"], "left"
    ).withColumn("hit", F.coalesce("relevant", F.lit(False)))
    so_far = (
        Window.partitionBy("query_id")
        .orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = F.sum(F.col("hit").cast("int")).over(so_far) / F.col("rank")
    per_query = marked.withColumn("running", running).groupBy("query_id").agg(*aggregates)
    counts = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    return (
        queries.select("query_id", "query")
        .join(counts, "query_id", "left")
        .join(per_query, "query_id", "left")
        .withColumn("n_relevant", F.coalesce("n_relevant", F.lit(0)))
    )


def _hits(k: int) -> Column:
    return F.sum(F.when(F.col("hit") & (F.col("rank") <= k), 1).otherwise(0)).alias(f"hits_{k}")


def _different_hits(k: int) -> Column:
    hit = F.when(F.col("hit") & (F.col("rank") <= k), F.col("doc_id"))
    return F.size(F.collect_set(hit)).alias(f"hits_{k}")  # at most k ids


def _returned(k: int) -> Column:
    return F.sum(F.when(F.col("rank") <= k, 1).otherwise(0)).alias(f"returned_{k}")


def metrics_fixed(
    queries: DataFrame,
    results: DataFrame,
    qrels: DataFrame,
    cuts: Sequence[int] = CUTS_PRECISION,
    f1_cut: int = CUT_F1,
) -> DataFrame:
    """Precision at ``cuts``, F1 at ``f1_cut`` and quality per query, precision being hits by k.

    Columns are named after the cuts: ``p5, p10, f1_30, quality``. Hits are counted as a set, and a
    query without results or relevant documents scores 0. Quality combines the first precision
    with F1.
    """
    depths = sorted({*cuts, f1_cut})
    judged = _judged(queries, results, qrels, depths[-1], [_different_hits(k) for k in depths])

    def precision(k: int) -> Column:
        return F.coalesce(f"hits_{k}", F.lit(0)) / F.lit(float(k))

    deep = precision(f1_cut)
    recall = _ratio(F.coalesce(f"hits_{f1_cut}", F.lit(0)), F.col("n_relevant"), 0.0)
    f1 = F.when(deep + recall > 0, 2 * deep * recall / (deep + recall)).otherwise(0.0)
    name = f"f1_{f1_cut}"
    precisions = [precision(k).alias(f"p{k}") for k in cuts]
    rows = judged.select("query_id", "query", *precisions, f1.alias(name))
    both = F.col(f"p{cuts[0]}") + F.col(name)
    quality = F.when(both > 0, 2 * F.col(f"p{cuts[0]}") * F.col(name) / both).otherwise(0.0)
    return rows.withColumn("quality", quality)


def metrics_list(
    queries: DataFrame,
    results: DataFrame,
    qrels: DataFrame,
    cuts: Sequence[int] = CUTS_PRECISION,
    f1_cut: int = CUT_F1,
    ap_cut: int = CUT_AVERAGE_PRECISION,
) -> DataFrame:
    """Precision at ``cuts``, recall and F1 at ``f1_cut``, average precision and quality per query.

    Columns are named after the cuts: ``p5, p10, r30, f1_30, ap40, quality``, and rounded to three
    places. Precision divides by the results returned within k, recall is 1 when nothing is
    relevant, average precision is the mean over the hits found, and combined measures start from
    rounded ones, quality from the first precision.
    """
    depths = sorted({*cuts, f1_cut})
    running = F.when(F.col("hit") & (F.col("rank") <= ap_cut), F.col("running"))
    aggregates = [measure(k) for k in depths for measure in (_hits, _returned)]
    aggregates.append(F.avg(running).alias("mean_precision"))
    judged = _judged(queries, results, qrels, max(depths[-1], ap_cut), aggregates)

    def precision(k: int) -> Column:
        return round_exact(_ratio(F.col(f"hits_{k}"), F.col(f"returned_{k}"), 0.0))

    recall = _ratio(F.coalesce(f"hits_{f1_cut}", F.lit(0)), F.col("n_relevant"), 1.0)
    names = [*[f"p{k}" for k in cuts], f"r{f1_cut}", f"f1_{f1_cut}", f"ap{ap_cut}", "quality"]
    return (
        judged.withColumns(
            {f"p{k}": precision(k) for k in depths}
            | {
                f"r{f1_cut}": round_exact(recall),
                f"ap{ap_cut}": round_exact(F.coalesce("mean_precision", F.lit(0.0))),
            }
        )
        .withColumn(f"f1_{f1_cut}", round_exact(_harmonic(F.col(f"p{f1_cut}"), F.col(f"r{f1_cut}"))))
        .withColumn("quality", round_exact(_harmonic(F.col(f"p{cuts[0]}"), F.col(f"f1_{f1_cut}"))))
        .select("query_id", "query", *names)
    )


def evaluate(
    queries: DataFrame,
    results: DataFrame,
    qrels: DataFrame,
    style: str = "fixed",
    **cuts: object,
) -> DataFrame:
    """Measures per query, in one of the two styles, at its usual cuts or at given ones."""
    if style not in ("fixed", "list"):
        raise ValueError(f"style must be 'fixed' or 'list', not {style!r}")
    measure = metrics_fixed if style == "fixed" else metrics_list
    return measure(queries, results, qrels, **cuts)


def summarize(metrics: DataFrame) -> DataFrame:
    """Number of queries and the mean of every measure; queries without results count as 0."""
    measures = [c for c in metrics.columns if c not in ("query_id", "query")]
    return metrics.agg(
        F.count(F.lit(1)).alias("n_queries"), *[F.avg(c).alias(f"avg_{c}") for c in measures]
    )


def run_timed(
    queries: DataFrame, search: Callable[[DataFrame], DataFrame], at_most: int = TIMED_QUERIES
) -> tuple[DataFrame, DataFrame]:
    """Run every query by itself: ``(results, times)``, times being ``query_id, seconds, error``.

    ``search`` is called with one query at a time (``query_id, query``) and its rows are fetched, as
    a client would wait for them. A query that fails has no results and no seconds; the error says
    why. The results of one query have to fit the driver, and there may be ``at_most`` queries.
    """
    spark = queries.sparkSession
    asked = queries.select("query_id", "query")
    rows = asked.orderBy("query_id").limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"more than {at_most} queries to be run one by one")
    times, found, schema = [], [], None
    for row in rows:
        one = spark.createDataFrame([row], asked.schema)
        start = time.perf_counter()
        try:
            result = search(one)
            own = result.collect()
        except Exception as failure:  # noqa: BLE001 - whatever it is, the next query is run
            times.append((row["query_id"], None, f"{type(failure).__name__}: {failure}"[:200]))
            continue
        times.append((row["query_id"], time.perf_counter() - start, None))
        schema = result.schema
        found += own
    kind = asked.schema["query_id"].dataType.simpleString()
    schema = schema or f"query_id {kind}, rank bigint, doc_id bigint, title string, score double"
    timed = spark.createDataFrame(times, f"query_id {kind}, seconds double, error string")
    return spark.createDataFrame(found, schema), timed


def with_seconds(metrics: DataFrame, times: DataFrame) -> DataFrame:
    """Measures per query with ``seconds``; those of a query that failed are all 0, it counts on."""
    joined = metrics.join(times.select("query_id", "seconds", "error"), "query_id", "left")
    failed = F.col("error").isNotNull()
    measures = [c for c in metrics.columns if c not in ("query_id", "query")]
    kept = [F.when(failed, 0.0).otherwise(F.col(c)).alias(c) for c in measures]
    seconds = F.coalesce("seconds", F.lit(0.0)).alias("seconds")
    return joined.select("query_id", "query", *kept, seconds)


def display_query(query: Column) -> Column:
    """A query as shown in a report: the first 27 characters and two dots if it is longer."""
    cut = F.concat(F.substring(query, 1, DISPLAY_CHARS), F.lit(".."))
    return F.when(F.length(query) > DISPLAY_CHARS, cut).otherwise(query)
