from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from tests.conftest import SAMPLE
from trawl.functions import STOPWORDS, token_counts, tokenize

# A word has one start character and 2 to 24 further ones.
FEWEST, MOST = 2, 24

ODD_TEXTS = [
    "",
    "an ox it is",
    "#tag @user it's x-y-z a--b rock'n'roll",
    "a" * 60,
    "İstanbul's ΣΟΦΟΣ straße",
    "x²³ ½½½ ⅷⅷⅷ ٣٤٥",
    "café naïve",
    "zero‍width joiner",
    "the category history also first-class may-be",
    "under_score __init__ C3-PO",
    "naïve 東京都庁 дом-музей",
]


def letter_or_number(char):
    return char == "_" or unicodedata.category(char)[0] in "LN"


def python_tokens(text):
    """Words that are no stop words, read character by character."""
    text = text.lower() + "  "
    tokens, begin = [], None
    place = units = 0
    while place < len(text) - 1:
        char = text[place]
        if begin is None:
            if char in "#@" or letter_or_number(char):
                begin, units = place, 0
            place += 1
            continue
        joined = char in "'-" and letter_or_number(text[place + 1])
        if units < MOST and (joined or letter_or_number(char)):
            units += 1
            place += 1 + joined
        elif units >= FEWEST:
            tokens.append(text[begin:place])
            begin = None
        else:  # too short: go on behind the character it began with
            place, begin = begin + 1, None
    return [token for token in tokens if token not in STOPWORDS]


def test_tokens_agree_with_python_on_odd_texts(spark):
    rows = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "i int, text string")
    got = {r["i"]: r["tokens"] for r in rows.select("i", tokenize(F.col("text")).alias("tokens")).collect()}
    assert got == {i: python_tokens(text) for i, text in enumerate(ODD_TEXTS)}


def test_tokens_agree_with_python_on_documents(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    for row in docs.select("text", tokenize(F.col("text")).alias("tokens")).collect():
        assert row["tokens"] == python_tokens(row["text"])


def test_null_text_gives_no_tokens(spark):
    row = spark.range(1).select(tokenize(F.lit(None).cast("string")).alias("t"), token_counts(F.lit(None).cast("string")).alias("c")).first()
    assert row["t"] is None and not row["c"]


def test_stop_words_can_be_replaced(spark):
    row = spark.range(1).select(tokenize(F.lit("the cat sat"), ["cat"]).alias("a"), tokenize(F.lit("the cat sat"), []).alias("b")).first()
    assert row["a"] == ["the", "sat"] and row["b"] == ["the", "cat", "sat"]


def test_token_counts(spark):
    rows = spark.createDataFrame([(0, "bee ant bee cow ant bee"), (1, ""), (2, "solo")], "i int, text string")
    got = {r["i"]: [tuple(c) for c in r["c"]] for r in rows.select("i", token_counts(F.col("text")).alias("c")).collect()}
    assert got == {0: [("ant", 2), ("bee", 3), ("cow", 1)], 1: [], 2: [("solo", 1)]}
