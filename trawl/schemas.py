"""Declared schemas of the engine's inputs."""

from __future__ import annotations

from pyspark.sql import types as T

ANCHOR = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])

CORPUS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("anchor_text", T.ArrayType(ANCHOR)),
    ]
)

PAGERANK = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("pagerank", T.DoubleType())]
)

JUDGED_QUERIES = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
