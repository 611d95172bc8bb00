"""Documents that operators have to cope with, and plain versions of what they compute."""

from __future__ import annotations

import random

SPACES = " \t\n\x0b\x0c\r"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 800

ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "Same text here\nand a line\n\nend"),
    (6, "Same text here\nand a line\n\nend"),
    (6, "Same text here\nand a line\n\nend"),
    (6, "another text of the same id"),
    (None, "no id at all"),
    (None, None),
    (7, LONG),
    (8, "é" * 3000),
    (9, "ÉCOLE École écOle \x00 \x1c \x85 　 x"),
]
# Names that the operators use for their own results.
CLASHES = "n_lines n_words n_tokens n_hit score kept ids spans items component_id held_out n_ip"


def documents(spark, rows, clashes: bool = False):
    table = spark.createDataFrame(
        [(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    if clashes:
        from pyspark.sql import functions as F

        table = table.withColumns({name: F.lit("mine") for name in CLASHES.split()})
    return table


def random_texts(seed: int, n: int, vocabulary: int = 40, longest: int = 60) -> list[str]:
    """Texts over few words, some of them near copies of earlier ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts: list[str] = []
    for _ in range(n):
        if texts and rng.random() < 0.5:
            own = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            cut = rng.randrange(4)
            own = own[cut:] or own
        else:
            own = [rng.choice(words) for _ in range(rng.randrange(1, longest))]
        texts.append(rng.choice([" ", " ", " ", "\n"]).join(own) if rng.random() < 0.2 else " ".join(own))
    return texts


def split(text):
    """Words between ASCII white space."""
    for c in SPACES[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in (text or "").split(" ") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
