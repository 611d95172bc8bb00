"""Scoring formulas as column arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide the ranking.
BM25_K1 = 1.2
FALLBACK_CORPUS_SIZE = 6_348_910
TOP_K = 100


@dataclass(frozen=True)
class SearchWeights:
    """How much each part adds to a fused score."""

    # Fixed values.
    title: float = 0.1
    anchor: float = 0.1
    body: float = 25.0
    pagerank: float = 0.01


def bm25_idf(df: Column, n_docs: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_saturation(tf: Column, k1: float = BM25_K1) -> Column:
    """BM25 term saturation without length normalisation (b = 0)."""
    return tf * (k1 + 1) / (tf + k1)


def classic_idf(df: Column, n_docs: Column) -> Column:
    return F.log10(n_docs / df)


def rank_boost(pagerank: Column) -> Column:
    """``log10(rank + 1)`` for positive ranks, 0 for missing or other ones."""
    return F.when(pagerank > 0, F.log10(pagerank + 1)).otherwise(0.0)
