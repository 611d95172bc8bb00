"""Page-view logs: text, compressed or not, one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trawl.sources.corpus import file_order


def read_pageview_log(spark: SparkSession, *paths: str) -> DataFrame:
    """``line, line_no``; ``line_no`` sorts lines as they stand in the files."""
    lines = spark.read.text(list(paths))
    return lines.select(lines["value"].alias("line"), file_order().alias("line_no"))
