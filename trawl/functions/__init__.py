"""Column functions."""

from trawl.functions.rounding import round_exact
from trawl.functions.scoring import (
    BM25_K1,
    FALLBACK_CORPUS_SIZE,
    TOP_K,
    SearchWeights,
    bm25_idf,
    bm25_saturation,
    classic_idf,
    rank_boost,
)
from trawl.functions.text import (
    CORPUS_STOPWORDS,
    ENGLISH_STOPWORDS,
    STOPWORDS,
    WORD_PATTERN,
    token_counts,
    tokenize,
)

__all__ = [
    "BM25_K1",
    "CORPUS_STOPWORDS",
    "ENGLISH_STOPWORDS",
    "FALLBACK_CORPUS_SIZE",
    "STOPWORDS",
    "TOP_K",
    "WORD_PATTERN",
    "SearchWeights",
    "bm25_idf",
    "bm25_saturation",
    "classic_idf",
    "rank_boost",
    "round_exact",
    "token_counts",
    "tokenize",
]
