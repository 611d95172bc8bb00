"""Numbering the rows of a group when one group may be a large part of all rows.

``row_number()`` over a group sorts the whole group in one task. Here a group is first cut into
pieces whose order is known (ranges of document ids, say). Rows are numbered inside their piece,
and each piece is moved up by the rows of the pieces before it. A task sees one piece at a time,
the result is the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows in a sorted group that one task handles at ease, beside those of other groups.
ROWS_PER_RANGE = 250_000

# Bounds that the driver holds: enough for 2 * 10**9 rows in pieces of that size.
MAX_RANGES = 10_000

# Documents whose postings one task handles at ease, and the most tasks they are dealt out to.
DOCS_PER_TASK = 5_000
MAX_TASKS = 10_000


@dataclass(frozen=True)
class IdRanges:
    """Upper bounds (inclusive) that cut document ids into ranges of like size.

    ``crowded`` says that the rows of one single id would overfill a range, ``n_rows`` how many rows
    were measured.
    """

    bounds: tuple[int, ...] = ()
    crowded: bool = False
    n_rows: Optional[int] = field(default=None, compare=False)

    def __len__(self) -> int:
        return len(self.bounds) + 1

    def of(self, doc_id: Column) -> Column:
        """Number of the range a document id falls in.

        The bounds are halved again and again, so that an id is compared with 14 of them at most,
        and the expression stays a constant of fixed form however many there are.
        """
        if not self.bounds:
            return F.lit(0)
        # One literal that is split and folded once: a literal for each bound takes long to plan.
        ends = F.split(F.lit(",".join(map(str, self.bounds))), ",").cast("array<bigint>")
        strides = [1 << i for i in reversed(range(len(self.bounds).bit_length()))]

        def stride_on(passed: Column, stride: Column) -> Column:
            further = passed + stride
            return F.when(F.get(ends, further - 1) < doc_id, further).otherwise(passed)

        # Past the last bound, and for a null id, a comparison is null and nothing is passed.
        number = F.aggregate(F.lit(strides), F.lit(0), stride_on)
        return F.coalesce(number, F.lit(0))  # never null, so joins on it need no null check


def measure_id_ranges(
    rows: DataFrame, doc_id: str, rows_per_range: Optional[int] = None
) -> IdRanges:
    """Cut the ids in column ``doc_id`` into ranges of about ``rows_per_range`` rows.

    Reads a single column, and only its row count if one range will do. The driver receives at
    most 9,999 numbers.
    """
    ids = rows.select(doc_id)
    n_rows = ids.count()
    wanted = min(MAX_RANGES, -(-n_rows // (rows_per_range or ROWS_PER_RANGE)))
    if wanted <= 1:
        return IdRanges(n_rows=n_rows)
    cuts = [i / wanted for i in range(1, wanted)]
    (bounds,) = ids.agg(F.percentile_approx(doc_id, cuts, F.lit(10 * wanted))).first()
    different = tuple(sorted(set(bounds)))
    return IdRanges(different, crowded=len(different) < len(bounds), n_rows=n_rows)


def deal(rows: DataFrame, ranges: IdRanges, *key: str) -> DataFrame:
    """Place rows by ``key``, dealt to as many tasks as the documents in ``ranges`` call for.

    Left to itself, Spark gives a task 64 MB of them as they are shuffled, which postings unfold
    tenfold and more when they are summed up and sorted.
    """
    if ranges.n_rows is None:
        return rows.repartition(*key)
    wanted = -(-ranges.n_rows // DOCS_PER_TASK)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(min(MAX_TASKS, max(cores, wanted)), *key)


def number_rows(
    rows: DataFrame,
    group: Sequence[str],
    pieces: Mapping[str, bool],
    order: Sequence[Column],
    number: str,
    totals: Optional[Mapping[str, Column]] = None,
) -> DataFrame:
    """Add ``number`` = exact 1-based position of each row in its group.

    ``pieces`` maps the columns that cut a group to "ascending?", and must agree with ``order``.
    ``totals`` are aggregates added per group: a count or sum given per piece and summed up. Without
    pieces, plain windows over the group are used: choose that only where groups are known to be
    small. ``rows`` placed by group and pieces beforehand are not shuffled again.
    """
    totals = dict(totals or {})
    if not pieces:
        ordered = Window.partitionBy(*group).orderBy(*order)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return rows.withColumns(
            {name: total.over(whole) for name, total in totals.items()}
            | {number: F.row_number().over(ordered).cast("bigint")}
        )

    key = [*group, *pieces]
    tally = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), *[t.alias(name) for name, t in totals.items()]
    )
    ordered = Window.partitionBy(*group).orderBy(
        *[F.asc(c) if up else F.desc(c) for c, up in pieces.items()]
    )
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = tally.withColumns(
        {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
        | {name: F.sum(name).over(whole) for name in totals}
    ).drop("_rows")
    inside = Window.partitionBy(*key).orderBy(*order)
    return (
        rows.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, key)
        .withColumn(number, F.col("_inside") + F.col("_before"))
        .drop("_inside", "_before")
    )
