"""Queries with the documents judged relevant for them, as one JSON object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.schemas import JUDGED_QUERIES


def read_judged_queries(spark: SparkSession, path: str) -> DataFrame:
    """``query_id, query, doc_ids`` of a file ``{query: [id, ...], ...}``, numbered in order."""
    whole = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", JUDGED_QUERIES)
    return whole.select(F.posexplode(parsed).alias("query_id", "query", "doc_ids"))


def relevant_documents(judged: DataFrame) -> DataFrame:
    """``query_id, doc_id``: one row per judgement, ids being strings as they stand in the file."""
    return judged.select("query_id", F.explode("doc_ids").alias("doc_id"))
