"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import use_checkpoint_dir

# White space in the sense of the operators' contracts.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; a null id has text ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def with_columns(docs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``docs`` with new columns, which take the place of columns of the same name."""
    taken = {name.lower() for name in new}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return docs.select(*kept, *[value.alias(name) for name, value in new.items()])


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores before them, so that ``docs`` has no such columns."""
    taken = {c.lower() for c in docs.columns}
    prefix = "_"
    while any(prefix + name in taken for name in names):
        prefix += "_"
    return [prefix + name for name in names]


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the driver and all executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder and read back: it survives the loss of executors."""
    path = shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_folder`` named, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def whole_vectors(vector: Column, scale: int, limit: int) -> Column:
    """``vector`` as whole numbers floor(scale * x); null if a component is null or not finite.

    So it is, too, if a component is ``limit`` or more in size once scaled.
    """
    fits = F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < F.lit(float(limit)))
    )
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(fits, scaled)


def require(docs: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in docs.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
