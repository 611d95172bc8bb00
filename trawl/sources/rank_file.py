"""PageRank as gzip-compressed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.schemas import PAGERANK
from trawl.sources.corpus import file_order


def write_pagerank(pagerank: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``id,pagerank`` rows without header, highest rank first.

    The order runs through the part files by name, so no single task has to hold all rows.
    """
    ordered = pagerank.select("id", "pagerank").orderBy(F.desc("pagerank"), F.asc("id"))
    ordered.write.mode(mode).option("compression", "gzip").csv(path)


def read_pagerank(spark: SparkSession, *paths: str) -> DataFrame:
    """``id, pagerank`` of rows with a number in each of their first two fields.

    Further fields are not looked at, other rows are left out, and the last row of an id wins.
    """
    fields = T.StructType([T.StructField(f.name, T.StringType()) for f in PAGERANK])
    number = {f.name: F.trim(f.name).try_cast(f.dataType) for f in PAGERANK}
    rows = (
        spark.read.schema(fields)
        .csv(list(paths))
        .select("*", file_order().alias("row_order"))
        .withColumns(number)
        .where(F.col("id").isNotNull() & F.col("pagerank").isNotNull())
    )
    return rows.groupBy("id").agg(F.max_by("pagerank", "row_order").alias("pagerank"))
