"""Removing lines that many documents share, with built-in column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import SPACES, ascii_lower, free_names, require, with_columns

MIN_DOCS = 10
MIN_CHARS = 1


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    """A line's key as 32 hexadecimal digits; lines are lower-cased by the caller."""
    return F.md5(F.trim(line, F.lit(SPACES)).cast("binary"))


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """The distinct keys of a text's lines of at least ``min_chars`` characters once stripped."""
    long_enough = F.filter(
        _lines(ascii_lower(text)), lambda line: F.length(F.trim(line, F.lit(SPACES))) >= min_chars
    )
    return F.array_distinct(F.transform(long_enough, _key))


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents have.

    A text is split at line feeds; lines are compared stripped of ASCII white space and with A-Z
    lower-cased, and those of fewer than ``min_chars`` characters stay. A common line goes in every
    document, all of its repeats included. The columns are those of ``docs`` with ``text_col``
    replaced, and ``n_lines`` (before), ``n_dropped``; columns of these names are replaced.

    Defined cases: a null or empty text has one empty line and becomes an empty text; each row is a
    document, also one with a null id or the id of another row; an empty table gives an empty one.

    Documents are first counted per key, combined per task, so a line found everywhere sends one
    row per task. Only lines with a common key meet their documents again, and the texts are
    shuffled once, placed by id and content: neither a hot id nor a hot text fills a task.
    """
    require(docs, [id_col, text_col])
    place_, hex_, key_, docs_, drops_, lines_, kept_, text_, dropped_ = free_names(
        docs, "place", "hex", "key", "docs", "drops", "lines", "kept", "text", "dropped"
    )
    text = F.col(f"`{text_col}`")
    own_id = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    place = F.xxhash64(own_id, text)
    keyed = docs.select(
        place.alias(place_), F.explode(line_keys(text, min_chars)).alias(hex_)
    ).select(place_, F.unhex(hex_).alias(key_))
    common = (
        keyed.groupBy(key_)
        .agg(F.count(F.lit(1)).alias(docs_))
        .where(F.col(docs_) >= min_docs)
        .select(key_)
    )
    drops = (
        keyed.join(common, key_, "left_semi")
        .groupBy(place_)
        .agg(F.collect_set(F.lower(F.hex(key_))).alias(drops_))
    )
    joined = docs.withColumn(place_, place).join(drops, place_, "left")
    lines = _lines(text)
    kept = F.filter(
        lines, lambda line: ~F.array_contains(F.col(drops_), _key(ascii_lower(line)))
    )
    has_drops = F.col(drops_).isNotNull()
    marked = joined.withColumns(
        {
            lines_: F.size(lines).cast("bigint"),
            kept_: F.when(has_drops, kept),
        }
    )
    new_text = F.when(has_drops, F.array_join(kept_, "\n")).otherwise(
        F.coalesce(text, F.lit(""))
    )
    dropped = F.when(has_drops, F.col(lines_) - F.size(kept_)).otherwise(F.lit(0))
    result = marked.withColumns({text_: new_text, dropped_: dropped.cast("bigint")})
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    columns[text_col] = F.col(text_)
    out = with_columns(
        result, {"n_lines": F.col(lines_), "n_dropped": F.col(dropped_)}
    )
    plain = [columns[c].alias(c) for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(*plain, "n_lines", "n_dropped")


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_common_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = """
WITH docs AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, generate_subscripts(lines, 1) AS place, unnest(lines) AS line FROM docs
), keyed AS (
    SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1
    GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(common.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key)
GROUP BY doc_id
"""
