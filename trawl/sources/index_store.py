"""Writing, growing, reading and looking up indexes in Parquet."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from math import log
from operator import or_
from typing import Optional

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from trawl.functions.text import STOPWORDS
from trawl.operators import segments as parts
from trawl.operators.indexing import (
    TERM_BUCKETS,
    Derivation,
    FieldIndex,
    SearchIndex,
    build_anchor_index,
    build_index,
    join_segments,
    merge_index,
    with_ranges,
)
from trawl.operators.numbering import IdRanges, deal, measure_id_ranges
from trawl.operators.segments import IDS_PER_BLOCK, Segment, block_of
from trawl.session import BROADCAST_ROWS

# Spark passes at most this many values of one IN list on to Parquet as exact comparisons.
_IN_LIST = 10
# Beyond so many terms, comparing each of them exactly takes longer to compile than it spares.
_EXACT_TERMS = 50

# Postings that make a folder of terms worth having, and characters of text that make a posting.
POSTINGS_PER_BUCKET = 250_000
_CHARS_PER_POSTING = 8

# Segments of like size that are merged into one, and the size under which all are alike.
SEGMENTS_PER_TIER = 8
LEAST_TIER = 1_000_000

_POSTINGS = (
    "term string, doc_id bigint, tf bigint, place int, doc_range int, doc_block bigint, "
    "piece_n bigint, piece_tf bigint, term_bucket int"
)
_MARKED = f"{_POSTINGS}, block_n bigint, least_tf bigint, most_tf bigint, block_tf bigint"
_PIECES = "term string, doc_range int, n bigint, tf_sum bigint, term_bucket int"
_BOUNDS = (
    "term string, doc_block bigint, n bigint, least_tf bigint, most_tf bigint, tf_sum bigint, "
    "doc_range int, term_bucket int"
)
_REPEATED = "term string, n bigint, term_bucket int"
_MANIFEST = (
    "path string, buckets int, bounds array<bigint>, n_postings bigint, first_id bigint, "
    "last_id bigint, repeats boolean, min_df bigint, ids_per_block int, place int, marked boolean"
)
_MANIFEST_COLUMNS = pa.schema(
    {
        "path": pa.string(),
        "buckets": pa.int32(),
        "bounds": pa.list_(pa.int64()),
        "n_postings": pa.int64(),
        "first_id": pa.int64(),
        "last_id": pa.int64(),
        "repeats": pa.bool_(),
        "min_df": pa.int64(),
        "ids_per_block": pa.int32(),
        "place": pa.int32(),
        "marked": pa.bool_(),
    }
)


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _buckets_for(derived: Derivation) -> int:
    """As many folders as the texts are likely to fill, known without reading them in full."""
    n_postings = derived.n_postings
    if n_postings is None:
        if derived.texts is None:
            return TERM_BUCKETS
        chars = derived.texts.agg(F.sum(F.length("text"))).first()[0] or 0
        n_postings = chars // _CHARS_PER_POSTING
    return max(1, min(TERM_BUCKETS, n_postings // POSTINGS_PER_BUCKET))


def _derivation(index: FieldIndex) -> Derivation:
    if index.derived is not None:
        return index.derived
    counts = (index.counts() if index.segments else index.all_postings).select(
        "term", "doc_id", "tf"
    )
    return Derivation(counts, measure_id_ranges(counts, "doc_id"))


def placed_postings(derived: Derivation, buckets: int, ids_per_block: int) -> DataFrame:
    """Postings as a segment keeps them, from frequencies, by a single shuffle.

    Rows are placed by bucket of terms and range of documents, which is how files are written. The
    sum over repeated documents, the numbering and the sorting all work on that placing; a task
    has one bucket of one range at a time, however frequent its terms are. The first posting of a
    piece (a term's postings in a range) and that of a block tell what there is in all of it; others
    have nulls there.
    """
    key = ["term_bucket", "doc_range"]
    rows = with_ranges(derived.frequencies, derived.ranges).withColumn(
        "term_bucket", term_bucket(F.col("term"), buckets)
    )
    if len(derived.ranges) == 1:  # a constant, by which Spark does not know rows to be placed
        key, rows = ["term_bucket"], rows.drop("doc_range")
    summed = (
        deal(rows, derived.ranges, *key)
        .groupBy(*key, "term", "doc_id")
        .agg(F.sum("tf").cast("bigint").alias("tf"))
    )
    ends = Window.unboundedPreceding, Window.unboundedFollowing
    # Blocks of ids are in the order of ids, so both windows and the files ask for one sorting.
    piece = Window.partitionBy(*key, "term").orderBy("doc_block", "doc_id")
    block = Window.partitionBy(*key, "term", "doc_block").orderBy("doc_id")
    whole_piece, whole_block = piece.rowsBetween(*ends), block.rowsBetween(*ends)
    starts = F.col("place") == 1, F.row_number().over(block) == 1
    marks = {
        "piece_n": (starts[0], F.count(F.lit(1)).over(whole_piece)),
        "piece_tf": (starts[0], F.sum("tf").over(whole_piece)),
        "block_n": (starts[1], F.count(F.lit(1)).over(whole_block)),
        "least_tf": (starts[1], F.min("tf").over(whole_block)),
        "most_tf": (starts[1], F.max("tf").over(whole_block)),
        "block_tf": (starts[1], F.sum("tf").over(whole_block)),
    }
    return (
        summed.withColumn("doc_block", block_of(F.col("doc_id"), ids_per_block))
        .withColumn("place", F.row_number().over(piece))
        .withColumns({name: F.when(first, value) for name, (first, value) in marks.items()})
        .sortWithinPartitions(*key, "term", "doc_block", "doc_id")
        .withColumn("doc_range", F.col("doc_range") if len(derived.ranges) > 1 else F.lit(0))
        .select("term", "doc_id", "tf", "place", "doc_range", "doc_block", *marks, "term_bucket")
    )


def _write_segment(
    index: FieldIndex, root: str, buckets: Optional[int], ids_per_block: int
) -> Segment:
    """Write postings, then what can be told from them: bounds of blocks, pieces, documents."""
    spark = index.all_postings.sparkSession
    derived = _derivation(index)
    buckets = buckets or _buckets_for(derived)
    name = f"segments/{uuid.uuid4().hex}"
    path = f"{root}/{name}"
    placed = placed_postings(derived, buckets, ids_per_block)
    placed.write.partitionBy("term_bucket").parquet(f"{path}/postings")

    # Blocks and pieces stand on their first postings: they are read there and shuffled no more.
    postings = spark.read.schema(_MARKED).parquet(f"{path}/postings")
    blocks = postings.where(F.col("block_n").isNotNull()).select(
        "term",
        "doc_block",
        F.col("block_n").alias("n"),
        "least_tf",
        "most_tf",
        F.col("block_tf").alias("tf_sum"),
        "doc_range",
        "term_bucket",
    )
    _write_in_place(blocks, ["doc_range", "term", "doc_block"], f"{path}/bounds")
    pieces = postings.where(F.col("piece_n").isNotNull()).select(
        "term",
        "doc_range",
        F.col("piece_n").alias("n"),
        F.col("piece_tf").alias("tf_sum"),
        "term_bucket",
    )
    _write_in_place(pieces, ["term", "doc_range"], f"{path}/pieces")
    texts = derived.texts if derived.texts is not None else postings
    documents = texts.select("doc_id").where("doc_id IS NOT NULL").distinct()
    documents.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(
        f"{path}/documents"
    )
    n = spark.read.schema(_PIECES).parquet(f"{path}/pieces").agg(F.sum("n")).first()[0] or 0
    ends = F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    first, last = spark.read.parquet(f"{path}/documents").agg(*ends).first()
    row = Row(
        path=name,
        buckets=buckets,
        bounds=list(derived.ranges.bounds),
        n_postings=n,
        first_id=first,
        last_id=last,
        repeats=False,
        marked=True,
    )
    return _open_segment(spark, root, row)


def _write_in_place(rows: DataFrame, order: list[str], path: str) -> None:
    """Write rows in folders by bucket, by the tasks that read them."""
    in_order = rows.sortWithinPartitions("term_bucket", *order)
    in_order.write.partitionBy("term_bucket").parquet(path)


def _write_sorted(rows: DataFrame, key: list[str], order: list[str], path: str) -> None:
    sorted_rows = rows.repartition(*key).sortWithinPartitions(*key, *order)
    sorted_rows.write.partitionBy("term_bucket").parquet(path)


def _open_segment(spark: SparkSession, root: str, row: Row) -> Segment:
    path = row.path if _is_absolute(row.path) else f"{root}/{row.path}"

    def table(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    return Segment(
        path=path,
        postings=table("postings", _POSTINGS),
        pieces=table("pieces", _PIECES),
        bounds=table("bounds", _BOUNDS),
        documents=table("documents", "doc_id bigint"),
        repeated=table("repeated", _REPEATED) if row.repeats else None,
        buckets=row.buckets,
        ranges=IdRanges(tuple(row.bounds)),
        n_postings=row.n_postings,
        first_id=row.first_id,
        last_id=row.last_id,
        marked=bool(row.marked),
    )


def _is_absolute(path: str) -> bool:
    return path.startswith("/") or "://" in path or path.startswith("file:")


def _latest(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """Number and rows of the latest manifest; 0 and no rows if there is none."""
    try:
        versions = spark.read.schema(f"{_MANIFEST}, version int").parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    newest = versions.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, []
    return newest, sorted(versions.where(F.col("version") == newest).collect(), key=lambda r: r.place)


def _write_manifest(
    spark: SparkSession, path: str, segments: Sequence[Segment], min_df: int, ids_per_block: int
) -> None:
    """Make these segments the index, all at once: a reader takes the latest manifest.

    Segments come first, so a job that fails on the way leaves the index as it was. Only one job at
    a time may change an index.
    """
    rows = {
        "path": [s.path.removeprefix(f"{path}/") for s in segments],
        "buckets": [s.buckets for s in segments],
        "bounds": [list(s.ranges.bounds) for s in segments],
        "n_postings": [s.n_postings for s in segments],
        "first_id": [s.first_id for s in segments],
        "last_id": [s.last_id for s in segments],
        "repeats": [s.repeated is not None for s in segments],
        "min_df": [min_df] * len(segments),
        "ids_per_block": [ids_per_block] * len(segments),
        "place": list(range(len(segments))),
        "marked": [s.marked for s in segments],
    }
    version = _latest(spark, path)[0] + 1
    manifest = spark.createDataFrame(pa.table(rows, _MANIFEST_COLUMNS)).coalesce(1)
    manifest.write.parquet(f"{path}/manifest/version={version}")


def write_index(
    index: FieldIndex,
    path: str,
    buckets: Optional[int] = None,
    mode: str = "errorifexists",
    ids_per_block: int = IDS_PER_BLOCK,
) -> None:
    """Write an index as one segment: folders by bucket of terms, sorted by term and document.

    A task writes one bucket of one range of document ids at a time: a frequent term runs on over
    several files, none of which depends on how frequent it is. A reader of few terms opens their
    folders only, and there their pages only. All postings are written; the threshold that hides
    rare terms is kept beside them and applied by readers. Without ``buckets``, their number goes
    by the length of the texts, or the pages linked to, 124 at most. ``mode`` may be "overwrite": the new segment takes the
    place of all others, whose files are left for readers still at work.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode must be 'errorifexists' or 'overwrite', not {mode!r}")
    spark = index.all_postings.sparkSession
    if mode == "errorifexists" and _latest(spark, path)[1]:
        raise ValueError(f"there is an index in {path} already")
    segment = _write_segment(index, path, buckets, ids_per_block)
    _write_manifest(spark, path, [segment], index.min_df, ids_per_block)


def read_index(spark: SparkSession, path: str) -> FieldIndex:
    rows = _latest(spark, path)[1]
    if not rows:
        raise ValueError(f"there is no index in {path}")
    segments = [_open_segment(spark, path, row) for row in rows]
    return join_segments(segments, rows[0].min_df, rows[0].ids_per_block)


def read_term_stats(spark: SparkSession, path: str) -> DataFrame:
    """``term, df, term_total`` of a written index."""
    return read_index(spark, path).term_stats.select("term", "df", "term_total")


def write_search_index(
    index: SearchIndex,
    path: str,
    buckets: Optional[int] = None,
    mode: str = "errorifexists",
    ids_per_block: int = IDS_PER_BLOCK,
) -> None:
    write_index(index.title, f"{path}/title", buckets, mode, ids_per_block)
    write_index(index.body, f"{path}/body", buckets, mode, ids_per_block)
    write_index(index.anchor, f"{path}/anchor", buckets, mode, ids_per_block)


def read_search_index(spark: SparkSession, path: str) -> SearchIndex:
    return SearchIndex(
        title=read_index(spark, f"{path}/title"),
        body=read_index(spark, f"{path}/body"),
        anchor=read_index(spark, f"{path}/anchor"),
    )


def _documents_in_both(first: Sequence[Segment], second: Sequence[Segment]) -> Optional[DataFrame]:
    """``doc_id`` of the documents that both have; None if there are none.

    Ranges of ids are compared first: new documents often have ids beyond all older ones, and then
    nothing is read.
    """
    pairs = [
        (a.documents, b.documents)
        for a in first
        for b in second
        if a.first_id is not None
        and b.first_id is not None
        and a.first_id <= b.last_id
        and b.first_id <= a.last_id
    ]
    if not pairs:
        return None
    shared = reduce(
        DataFrame.unionByName, [b.join(a, "doc_id", "left_semi") for a, b in pairs]
    ).distinct()
    n = shared.count()
    if n == 0:
        return None
    return F.broadcast(shared) if n <= BROADCAST_ROWS else shared


def _mark_repeated(segment: Segment, older: Sequence[Segment], shared: DataFrame) -> Segment:
    """Write how many postings per term ``segment`` has of documents that older ones posted too."""
    spark = segment.postings.sparkSession
    own = segment.postings.join(shared, "doc_id", "left_semi").select("term", "doc_id")
    others = [s.postings.join(shared, "doc_id", "left_semi").select("term", "doc_id") for s in older]
    both = own.join(reduce(DataFrame.unionByName, others), ["term", "doc_id"], "left_semi")
    counted = both.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    bucketed = counted.withColumn("term_bucket", term_bucket(F.col("term"), segment.buckets))
    _write_sorted(bucketed, ["term_bucket"], ["term"], f"{segment.path}/repeated")
    repeated = spark.read.schema(_REPEATED).parquet(f"{segment.path}/repeated")
    return replace(segment, repeated=repeated)


def append_index(new: FieldIndex, path: str, buckets: Optional[int] = None) -> None:
    """Add the postings of ``new`` to the index in ``path`` as a segment of its own.

    What is written are the new postings and what can be told from them; older segments are not
    touched, nor read unless the ids of old and new documents lie in the same range. A document
    found in both has its frequencies added up by readers. The index goes on hiding terms as it did.
    """
    spark = new.all_postings.sparkSession
    rows = _latest(spark, path)[1]
    if not rows:
        raise ValueError(f"there is no index in {path}")
    older = [_open_segment(spark, path, row) for row in rows]
    segment = _write_segment(new, path, buckets, rows[0].ids_per_block)
    shared = _documents_in_both(older, [segment])
    if shared is not None:
        segment = _mark_repeated(segment, older, shared)
    _write_manifest(spark, path, [*older, segment], rows[0].min_df, rows[0].ids_per_block)


def append_documents(
    docs: DataFrame,
    path: str,
    text: str,
    doc_id: str = "id",
    stopwords: Iterable[str] = STOPWORDS,
    rows_per_range: Optional[int] = None,
) -> None:
    """Add a batch of documents to the stored index of a text column."""
    append_index(
        build_index(docs, text, doc_id, stopwords=stopwords, rows_per_range=rows_per_range), path
    )


def append_links(
    links: DataFrame,
    path: str,
    stopwords: Iterable[str] = STOPWORDS,
    rows_per_range: Optional[int] = None,
) -> None:
    """Add a batch of links to a stored index of link texts."""
    append_index(
        build_anchor_index(links, stopwords=stopwords, rows_per_range=rows_per_range), path
    )


def merge_stored(
    spark: SparkSession, first: str, second: str, path: str, min_df: Optional[int] = None
) -> None:
    """Make the index in ``path`` out of two stored ones.

    If no document is in both, their segments are taken over where they are and nothing is
    rewritten; otherwise, or if their blocks differ, all postings are merged anew. The result hides
    terms as the part that hides more does, unless ``min_df`` is given.
    """
    if _latest(spark, path)[1]:
        raise ValueError(f"there is an index in {path} already")
    one, two = read_index(spark, first), read_index(spark, second)
    if min_df is None:
        min_df = max(one.min_df, two.min_df)
    apart = one.ids_per_block == two.ids_per_block and not any(
        parts.overlapping(i.segments) for i in (one, two)
    )
    if apart and _documents_in_both(one.segments, two.segments) is None:
        _write_manifest(spark, path, [*one.segments, *two.segments], min_df, one.ids_per_block)
    else:
        write_index(merge_index(one, two, min_df), path, ids_per_block=one.ids_per_block)


def compact_index(
    spark: SparkSession,
    path: str,
    per_tier: int = SEGMENTS_PER_TIER,
    least_tier: int = LEAST_TIER,
) -> int:
    """Merge segments of like size where there are ``per_tier`` of them; returns how many it merged.

    Sizes are compared by powers of ``per_tier``, so a posting is rewritten about as often as its
    index grows by that factor, and an index has a bounded number of segments of each size. If a
    document is in several segments, all of them become one.
    """
    rows = _latest(spark, path)[1]
    segments = [_open_segment(spark, path, row) for row in rows]
    if parts.overlapping(segments):
        groups = [segments] if len(segments) >= per_tier else []
    else:
        tiers = defaultdict(list)
        for segment in segments:
            tiers[int(log(max(1, segment.n_postings / least_tier), per_tier))].append(segment)
        groups = [group for group in tiers.values() if len(group) >= per_tier]
    merged = 0
    for group in groups:
        min_df, ids_per_block = rows[0].min_df, rows[0].ids_per_block
        whole = join_segments(group, min_df, ids_per_block)
        new = _write_segment(whole, path, None, ids_per_block)
        segments = [new, *[s for s in segments if s not in group]]
        merged += len(group)
        _write_manifest(spark, path, segments, min_df, ids_per_block)
    return merged


class Vocabulary:
    """A short list of terms, in forms that storage can use to skip what holds none of them."""

    def __init__(self, hash_of_term: Mapping[str, int]) -> None:
        """``hash_of_term`` gives the ``xxhash64`` of each term."""
        self.n_terms = len(hash_of_term)
        self._hashes = set(hash_of_term.values())
        listed = [F.lit(term) for term in sorted(hash_of_term)]
        term = F.col("term")
        self._condition = term.isin(*listed)
        if _IN_LIST < len(listed) <= _EXACT_TERMS:
            # A long IN list reaches Parquet as one wide range, short ones as exact values.
            chunks = [
                term.isin(*listed[i : i + _IN_LIST]) for i in range(0, len(listed), _IN_LIST)
            ]
            self._condition &= reduce(or_, chunks)

    def rows_in(self, rows: DataFrame, buckets: int) -> DataFrame:
        """The rows of a stored table of terms that belong to one of the terms."""
        wanted = sorted({value % buckets for value in self._hashes})
        return rows.where(F.col("term_bucket").isin(wanted)).where(self._condition)


class Folders:
    """Too many terms to name them all; the folders they are in are few numbers."""

    n_terms = None

    def __init__(self, terms: DataFrame, small: bool = False) -> None:
        """``small`` says that ``terms`` fit a broadcast, which then picks their rows."""
        self._terms = terms
        self._small = small
        self._known: dict[int, list[int]] = {}

    def rows_in(self, rows: DataFrame, buckets: int) -> DataFrame:
        if buckets not in self._known:
            bucket = term_bucket(F.col("term"), buckets).alias("bucket")
            found = self._terms.select(bucket).distinct().collect()
            self._known[buckets] = sorted(row["bucket"] for row in found)
        rows = rows.where(F.col("term_bucket").isin(self._known[buckets]))
        if not self._small:
            return rows
        return rows.join(F.broadcast(self._terms.select("term").distinct()), "term", "left_semi")


class _OneTerm:
    n_terms = 1

    def __init__(self, term: str) -> None:
        self._term = term

    def rows_in(self, rows: DataFrame, buckets: int) -> DataFrame:
        place = F.col("term_bucket") == term_bucket(F.lit(self._term), buckets)
        return rows.where(place & (F.col("term") == self._term))


def posting_list(index: FieldIndex, term: str) -> DataFrame:
    """``doc_id, tf`` of one term, in document order; no rows for an unknown or hidden term."""
    if index.segments:
        wanted = _OneTerm(term)
        found = index.counts(wanted)
        if index.min_df:
            found = found.join(F.broadcast(index.statistics(wanted)), "term", "left_semi")
    else:
        found = index.postings.where(F.col("term") == term)
    return found.select("doc_id", "tf").orderBy("doc_id")
