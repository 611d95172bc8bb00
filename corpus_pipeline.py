"""A pipeline that cleans, thins out and encodes a training corpus.

Each stage works on all that the one before kept; between stages, documents are written as Parquet
to the folder that driver and executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import byte_bpe, decontamination, line_dedup, ngram_join, quality_rules
from trawl.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Near copies share four fifths of their runs of five words.
NEAR_COPIES = ngram_join.Rule(words=5, percent=80)


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters as it now is."""
    columns = [F.col(f"`{c}`") for c in COLUMNS if c != "n_chars"]
    return docs.select(*columns, F.length("text").cast("bigint").alias("n_chars"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality_rules.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge_quality(docs, model).where("kept").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more have."""
    return _documents(line_dedup.drop_common_lines(docs))


def one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the one with the least id."""
    return ngram_join.keep_one_of_each(docs, rule=NEAR_COPIES).select(*COLUMNS)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that benchmark items have."""
    marked = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _documents(marked.withColumn("text", F.col("clean_text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document's tokens, with digests of them and of what they decode to."""
    coded = byte_bpe.encode(docs, decoded=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        "ids",
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_of_a_group),
    ("benchmark decontamination", cut_benchmark),
    ("byte-level BPE", encode),
]

# Neither the isolation forest nor the merges can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
