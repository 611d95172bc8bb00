"""The corpus queries and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from trawl.llm import (
    byte_bpe,
    centroid_clusters,
    cotraining,
    decontamination,
    hard_negatives,
    lattice_lm,
    license_notices,
    line_dedup,
    ngram_join,
    pii,
    quality_rules,
    substring_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_line_dedup": (line_dedup.op1_line_dedup, line_dedup.ORACLE_SQL),
    "op2_substring_dedup": (substring_dedup.op2_substring_dedup, substring_dedup.ORACLE_SQL),
    "op3_toxicity": (toxicity.op3_toxicity, None),
    "op4_benchmark_decontamination": (
        decontamination.op4_benchmark_decontamination,
        decontamination.ORACLE_SQL,
    ),
    "op5_quality_rules": (quality_rules.op5_quality_rules, None),
    "op6_pii": (pii.op6_pii, None),
    "op7_quality_classifier": (cotraining.op7_quality_classifier, None),
    "op8_lattice_lm": (lattice_lm.op8_lattice_lm, None),
    "op9_ngram_jaccard_join": (ngram_join.op9_ngram_jaccard_join, ngram_join.ORACLE_SQL),
    "op10_byte_bpe": (byte_bpe.op10_byte_bpe, None),
    "op11_hard_negatives": (hard_negatives.op11_hard_negatives, hard_negatives.ORACLE_SQL),
    "op12_license_notices": (license_notices.op12_license_notices, None),
    "op13_centroid_clusters": (
        centroid_clusters.op13_centroid_clusters,
        centroid_clusters.ORACLE_SQL,
    ),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql is not None}
