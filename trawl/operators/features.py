"""Per-document features: titles, page views, and looking them up."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.session import BROADCAST_ROWS

# Fixed value of the page-view log: the wanted domain, which may be given otherwise.
LOG_DOMAIN = "en.wikipedia"

# Up to this many different ids are written into the plan, where the scan can use them.
IDS_IN_PLAN = 50
ROWS_LOOKED_AT = 1_000
# Spark passes at most this many values of one IN list on to Parquet as exact comparisons.
_IN_LIST = 10

# All characters that separate the fields of a line, Unicode spaces included.
_SPACES = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def build_titles(corpus: DataFrame, order: Optional[str] = None) -> DataFrame:
    """``id, title``, one row per id; if an id repeats, its row with the highest ``order`` wins.

    Without an ``order`` column the last row wins, in the order the table is read.
    """
    place = F.col(order) if order else F.monotonically_increasing_id()
    rows = corpus.select(F.col("id").cast("long").alias("id"), "title", place.alias("place"))
    return rows.groupBy("id").agg(F.max_by("title", "place").alias("title"))


def parse_pageviews(lines: DataFrame, domain: str = LOG_DOMAIN) -> DataFrame:
    """``id, views, line_no`` of the well-formed lines of ``line, line_no`` in the wanted domain.

    A line has the domain, a name, the page id, a field not looked at, and the views, then perhaps
    more. Lines without the domain cost one plain search; the others are split once. Numbers are
    those that a BIGINT holds.
    """
    bare = F.regexp_replace("line", f"^[{_SPACES}]+", "")
    fields = lines.where(F.col("line").contains(domain)).select(
        F.split(bare, f"[{_SPACES}]+", 6).alias("f"), "line_no"
    )

    def number(i: int) -> Column:
        field = F.get("f", F.lit(i))
        return F.when(field.rlike("^[+-]?[0-9]+$"), field.try_cast("bigint"))

    parsed = fields.where(F.get("f", F.lit(0)) == domain).select(
        number(2).alias("id"), number(4).alias("views"), "line_no"
    )
    return parsed.where(F.col("id").isNotNull() & F.col("views").isNotNull())


def build_pageviews(lines: DataFrame, titles: DataFrame, mode: str = "last") -> DataFrame:
    """``id, views`` per titled page: its last line in the log, or all its lines added up.

    Views are combined per page before they meet the titles; both steps use the same key.
    """
    if mode not in ("last", "sum"):
        raise ValueError(f"mode must be 'last' or 'sum', not {mode!r}")
    views = F.max_by("views", "line_no") if mode == "last" else F.sum("views")
    per_page = parse_pageviews(lines).groupBy("id").agg(views.alias("views"))
    return per_page.join(titles.select("id"), "id", "left_semi")


def last_views(lines: DataFrame, log_no: int = 0) -> DataFrame:
    """``id, views, log_no, line_no``: the last line of every page in a log, and where it stood.

    Kept as it is, such a table takes in later logs without reading the earlier ones again.
    """
    return _last(parse_pageviews(lines).withColumn("log_no", F.lit(log_no).cast("bigint")))


def merge_views(known: DataFrame, new: DataFrame) -> DataFrame:
    """Last lines of two tables of them: the greater ``log_no, line_no`` of a page wins."""
    return _last(known.unionByName(new))


def _last(rows: DataFrame) -> DataFrame:
    place = F.struct("log_no", "line_no")
    latest = F.max_by(F.struct("views", "log_no", "line_no"), place).alias("latest")
    return rows.groupBy("id").agg(latest).select("id", "latest.*")


def titled_views(known: DataFrame, titles: DataFrame) -> DataFrame:
    """``id, views`` of the titled pages in a table of last lines."""
    return known.select("id", "views").join(titles.select("id"), "id", "left_semi")


def look_up(
    requests: DataFrame,
    features: DataFrame,
    value: str,
    default: Column,
    check_size: bool = True,
) -> DataFrame:
    """``request_id, pos, doc_id, <value>`` for requests of ``request_id, ids``.

    Order and repeats of the asked ids are kept in ``pos``. An id that is no number or has no
    feature gets the default. ``check_size`` counts the asked ids first, up to what fits a
    broadcast: few ids pick their rows out of the feature table, which then need not be shuffled.
    """
    asked = requests.select("request_id", F.posexplode("ids").alias("pos", "doc_id")).withColumns(
        {
            "id": F.col("doc_id").cast("string").try_cast("bigint"),
            "doc_id": F.col("doc_id").cast("string"),
        }
    )
    found = _of_ids(features.select("id", value), asked if check_size else None)
    columns = ["request_id", "pos", "doc_id"]
    numbers = asked.where(F.col("id").isNotNull()).join(found, "id", "left")
    # What is no number takes no part in the join, where it would all go to one task.
    others = asked.where(F.col("id").isNull()).select(*columns, default.alias(value))
    return numbers.select(*columns, F.coalesce(value, default).alias(value)).unionByName(others)


def lookup_pagerank(
    requests: DataFrame, pagerank: DataFrame, check_size: bool = True
) -> DataFrame:
    return look_up(requests, pagerank, "pagerank", F.lit(0.0), check_size)


def lookup_pageviews(
    requests: DataFrame, pageviews: DataFrame, check_size: bool = True
) -> DataFrame:
    return look_up(requests, pageviews, "views", F.lit(0).cast("bigint"), check_size)


def enrich(
    results: DataFrame, pagerank: DataFrame, pageviews: DataFrame, check_size: bool = False
) -> DataFrame:
    """Ranked results with ``pagerank`` and ``views`` added, 0 where missing.

    ``check_size`` is as for look-ups. Counting runs the results, so it pays for stored ones only.
    """
    ids = results.select(F.col("doc_id").alias("id")) if check_size else None
    ranks = _of_ids(pagerank.select("id", F.col("pagerank").alias("_rank")), ids)
    views = _of_ids(pageviews.select("id", F.col("views").alias("_views")), ids)
    return (
        results.join(ranks.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .join(views.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select(
            *results.columns,
            F.coalesce("_rank", F.lit(0.0)).alias("pagerank"),
            F.coalesce("_views", F.lit(0)).alias("views"),
        )
    )


def _of_ids(features: DataFrame, ids: Optional[DataFrame]) -> DataFrame:
    """The features of ``ids``, if these are few: by a broadcast, or by naming them in the plan.

    Stored features are sorted by id, so a scan for named ids reads the pages that may hold them.
    """
    if ids is None:
        return features
    ids = ids.where(F.col("id").isNotNull())
    some = ids.select("id").limit(ROWS_LOOKED_AT + 1).collect()
    few = sorted({row["id"] for row in some})
    if len(some) <= ROWS_LOOKED_AT and len(few) <= IDS_IN_PLAN:
        return features.where(_any_of(few))
    if ids.count() > BROADCAST_ROWS:
        return features
    return features.join(F.broadcast(ids.select("id").distinct()), "id", "left_semi")


def _any_of(ids: list[int]) -> Column:
    """``id`` is one of these, in lists short enough for storage to compare them exactly."""
    lists = [ids[i : i + _IN_LIST] for i in range(0, len(ids), _IN_LIST)]
    return reduce(or_, [F.col("id").isin(own) for own in lists], F.lit(False))
