"""Reading and previewing a corpus of linked documents."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.schemas import CORPUS


def read_corpus(spark: SparkSession, *paths: str) -> DataFrame:
    """``id, title, text, anchor_text, row_order`` of Parquet files; raises if a path holds none.

    ``row_order`` sorts rows as they stand in the files.
    """
    files = spark.read.schema(CORPUS).parquet(*paths)
    return files.withColumn("row_order", file_order())


def spread(table: DataFrame) -> DataFrame:
    """Give every core a part of a table that has fewer files than there are cores.

    A file may hold a single row group, which one task then has to read; costly work on its rows
    should not be left to that task. Tables of many files are returned as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if len(table.inputFiles()) < cores else table


def file_order() -> Column:
    """Sort key that puts rows in the order of file name and place in the file.

    Counting within a partition alone would not do, as splits are handed out by size.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_titles(
    spark: SparkSession, *paths: str, skip_unreadable: bool = False
) -> DataFrame:
    """``id, title, row_order`` of Parquet files.

    A file that cannot be read is an error, unless ``skip_unreadable`` passes over such files;
    ``skipped_files`` then names them.
    """
    reader = spark.read.schema(CORPUS).option("ignoreCorruptFiles", skip_unreadable)
    files = reader.parquet(*paths)
    return files.select(
        F.col("id").cast("long").alias("id"), "title", file_order().alias("row_order")
    )


def skipped_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, length`` of the files from which no row can be read, be they damaged or empty."""
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    reader = spark.read.schema(CORPUS).option("ignoreCorruptFiles", True)
    read = reader.parquet(*paths).select(F.col("_metadata.file_path").alias("path")).distinct()
    plain = lambda path: F.regexp_replace(path, "^file:/+", "/")
    return listed.join(
        read.select(plain("path").alias("read")), plain(listed["path"]) == F.col("read"), "left_anti"
    )


def preview(
    table: DataFrame,
    seed: int = 0,
    head: int = 3,
    sample: int = 5,
    key: Optional[Sequence[str]] = None,
    order: Optional[str] = None,
) -> DataFrame:
    """A few first and a few random rows, as ``part`` ("first" or "random") and the columns.

    First rows are those least by ``order``, or the first ones read. The random ones are those with
    the least hash of the seed and the ``key`` columns (all, if none are given): the same seed
    gives the same rows however the table is dealt out. One pass keeps as many rows per task as are
    shown. The dtypes of the table are those of the result; its size is ``table.count()``.
    """
    first = (table.orderBy(order) if order else table).limit(head)
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.to_json(F.struct(*(key or table.columns)))))
    some = table.orderBy(hashed).limit(sample)
    labelled = [rows.select(F.lit(name).alias("part"), "*") for name, rows in
                (("first", first), ("random", some))]
    return labelled[0].unionByName(labelled[1])
