"""Personal data: base patterns, and further spans selected by boosted trees among candidates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import require, stored, table, with_columns

KINDS = ("email", "ip", "card", "phone")

TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
# Slopes are added up as whole multiples of a unit, which are exact in any order.
UNIT = 2.0**24
LEAST_PRECISION = 0.995
LEAST_SCORE = 0.5

# The base patterns. A run of digits is only tried from its start, and an address from
# its @, which finds the same matches without trying every character of a long run.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_MAY_BE = re.compile(r"[0-9@]|[(\[](?:at|AT)[)\]]")

# Generators of candidates: anything that might be of a kind, spans overlapping each other.
_GENERATORS = (
    ("email", re.compile(r"[^\s@,;:<>()\[\]\"']{1,64}@[^\s@,;:<>()\[\]\"']{1,255}")),
    (
        "email",
        re.compile(
            r"[A-Za-z0-9._%+-]{1,64}[ ]?[(\[](?:at|AT)[)\]][ ]?[A-Za-z0-9-]{1,63}"
            r"(?:[ ]?(?:\.|[(\[](?:dot|DOT)[)\]])[ ]?[A-Za-z0-9-]{1,63}){1,8}"
        ),
    ),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){2,7}")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,22}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])[+(]?[0-9](?:[ ()./-]{0,3}[0-9]){6,17}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\([0-9]{2,4}\)[ ]?)?[0-9]{3}[-. ][0-9]{4}(?![0-9])")),
)
N_FEATURES = 26

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    doubled = [(int(d) * 2 - 9 if d > "4" else int(d) * 2) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    free = 0
    for match in _AT.finditer(text):
        start = match.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            free = match.end()
            yield "email", start, free


def base_spans(text: str | None) -> list[Span]:
    """Spans of the base patterns that pass their checks, by kind and start."""
    text = text or ""
    spans = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for match in _IP.finditer(text):
        parts = [p.lstrip("0") for p in match.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _digits(match.group())
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match.group())) <= 15:
                spans.append(("phone", *match.span()))
    return spans


def candidates(text: str | None) -> list[Span]:
    """Spans of all generators, trimmed of closing punctuation."""
    text = text or ""
    if not _MAY_BE.search(text):
        return []
    found = set()
    for kind, pattern in _GENERATORS:
        for match in pattern.finditer(text):
            start, end = match.span()
            while end > start and text[end - 1] in ".!?-":
                end -= 1
            if end > start:
                found.add((kind, start, end))
    return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def span_features(text: str, span: Span) -> list[float]:
    """Format of a span and what stands around it."""
    kind, start, end = span
    value = text[start:end]
    digits = _digits(value)
    groups = [g for g in re.split("[^0-9]+", value) if g]
    sizes = [len(g) for g in groups] or [0]
    before = text[max(0, start - 24) : start]
    after = text[end : end + 24]
    last_word = before.split()[-1] if before.split() else ""
    next_word = after.split()[0] if after.split() else ""
    tail = value.rsplit(".", 1)[-1]
    return [
        *[float(kind == k) for k in KINDS],
        float(len(value)),
        float(len(digits)),
        len(digits) / len(value),
        float(len(groups)),
        float(max(sizes)),
        float(min(sizes)),
        float(value.count(".")),
        float(value.count("-")),
        float(value.count(" ")),
        float(value.count("(") + value.count(")")),
        float(value.startswith("+")),
        float(value.count("@")),
        float(sum(c.isalpha() for c in value)),
        float(len(tail)) if tail.isalpha() else 0.0,
        float(13 <= len(digits) <= 19 and _luhn(digits)),
        float(max((int(g) if len(g) < 9 else 10**9) for g in groups) if groups else 0),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] == "+"),
        float(last_word[-1:] in (":", "=", "#")),
        float(len(last_word)),
        float(len(next_word)),
    ]


def _best_split(slope: np.ndarray, curve: np.ndarray) -> tuple[int, int]:
    """Feature and bin that split a node best, from its sums by feature and bin."""
    g, h = slope[0].sum(), curve[0].sum()
    best, found = 1e-6, (0, BINS)
    for f in range(len(slope)):
        left_g, left_h = np.cumsum(slope[f])[:-1], np.cumsum(curve[f])[:-1]
        right_g, right_h = g - left_g, h - left_h
        gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - g**2 / (h + 1)
        if gain.max() > best:
            best, found = float(gain.max()), (f, int(gain.argmax()))
    return found


def _halves(slope: np.ndarray, curve: np.ndarray, f: int, split: int) -> list[tuple[float, float]]:
    """Slope and curve of the two sides of a split."""
    cut = split + 1
    return [
        (slope[f, :cut].sum(), curve[f, :cut].sum()),
        (slope[f, cut:].sum(), curve[f, cut:].sum()),
    ]


@dataclass
class BoostedTrees:
    """Gradient boosting on the logistic loss, with trees of one depth over binned features."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0
    threshold: float = 2.0
    growing: tuple[int, np.ndarray, np.ndarray] | None = None

    def _binned(self, rows: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(e, rows[:, f], "right") for f, e in enumerate(self.edges)], axis=1
        )

    def fit(self, rows: np.ndarray, wanted: np.ndarray) -> None:
        self.edges = [
            np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
            for f in range(rows.shape[1])
        ]
        binned, ones = self._binned(rows), np.ones(len(rows))
        self.grow(len(rows), float(wanted.sum()), lambda: self.sums(binned, ones, wanted))

    def grow(self, n: int, n_wanted: float, sums: Callable[[], np.ndarray]) -> None:
        """Adds the trees, level by level; ``sums`` adds up all rows for the trees as they are."""
        share = np.clip(n_wanted / n, 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        inner = 2**DEPTH - 1
        for _ in range(TREES):
            feature, split = np.zeros(inner, dtype=int), np.full(inner, BINS)
            for level in range(DEPTH):
                self.growing = (level, feature, split)
                slope, curve = np.moveaxis(sums() / UNIT, -1, 0)
                for i, at in enumerate(range(2**level - 1, 2 ** (level + 1) - 1)):
                    feature[at], split[at] = _best_split(slope[i], curve[i])
            last = range(2 ** (DEPTH - 1))
            ends = [_halves(slope[i], curve[i], feature[i - len(last)], split[i - len(last)]) for i in last]
            g, h = np.moveaxis(np.array(ends).reshape(-1, 2), -1, 0)
            self.trees.append((feature, split, RATE * g / (h + 1)))
        self.growing = None

    def sums(self, binned: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Slope and curve of the loss by node of the level that grows, feature and bin.

        A row stands for ``n`` candidates, ``wanted`` of which are. Sums are of whole numbers, so
        that neither order nor placing of rows can change a tree.
        """
        level, feature, split = self.growing
        p = 1 / (1 + np.exp(-self._margin(binned)))
        values = np.rint((wanted - n * p) * UNIT), np.rint(n * p * (1 - p) * UNIT)
        node = np.zeros(len(binned), dtype=int)
        for _ in range(level):
            node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > split[node])
        node -= 2**level - 1
        out = np.zeros((2**level, binned.shape[1], BINS, 2), dtype=np.int64)
        for f in range(binned.shape[1]):
            cell = node * BINS + binned[:, f]
            for i, value in enumerate(values):
                out[:, f, :, i] = np.bincount(cell, value, 2**level * BINS).reshape(-1, BINS)
        return out

    def _margin(self, binned: np.ndarray) -> np.ndarray:
        margin = np.full(len(binned), self.start)
        for tree in self.trees:
            margin += tree[2][self._leaves(binned, tree)]
        return margin

    @staticmethod
    def _leaves(binned: np.ndarray, tree) -> np.ndarray:
        feature, split, _ = tree
        node = np.zeros(len(binned), dtype=int)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > split[node])
        return node - (2**DEPTH - 1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._margin(self._binned(rows))))

    def calibrate(self, scores: np.ndarray, wanted: np.ndarray) -> None:
        """The least score from which on enough of the held-out candidates are wanted ones."""
        order = np.argsort(-scores, kind="stable")
        precision = np.cumsum(wanted[order]) / np.arange(1, len(order) + 1)
        ends = np.append(scores[order][1:] != scores[order][:-1], True)
        good = np.flatnonzero(ends & (precision >= LEAST_PRECISION))
        self.threshold = max(LEAST_SCORE, float(scores[order][good[-1]])) if len(good) else 2.0


def _overlaps(a: Span, b: Span) -> bool:
    return a[1] < b[2] and b[1] < a[2]


def _beyond_ascii(domain: str) -> str:
    """A domain with one letter that base patterns don't take."""
    return re.sub("[A-Za-z]", "\u00fc", domain, count=1)


def _rewritten(kind: str, value: str) -> list[tuple[str, int]]:
    """Other forms of a base span that base patterns don't find, and near misses, labelled 1 and 0.

    Near misses have the same characters but fail what the kind needs: a check digit, a whole
    domain, the grouping of a telephone number and not that of a date, a decimal or a plain number.
    """
    if kind == "email":
        local, _, domain = value.rpartition("@")
        letters = "".join(c for c in local if c.isalpha()) or local
        ends = domain.split(".")[-2:]
        short = [ends[0], ends[1][:2]]
        forms = []
        for name, parts in ((local, domain.split(".")), (letters, ends), (letters, short)):
            forms += [
                (f"{name} (at) {' (dot) '.join(parts)}", 1),
                (f"{name} [at] {' [dot] '.join(parts)}", 1),
                (f"{name}(at){'(dot)'.join(parts)}", 1),
                (f"{name} (AT) {'.'.join(parts)}", 1),
                (f"{name}@{_beyond_ascii('.'.join(parts))}", 1),
                (f"{name}@{parts[0]}", 0),
                (f"{name}@{_beyond_ascii(parts[0])}", 0),
                (f"{name}@{parts[0]}/{parts[-1]}", 0),
            ]
        return forms
    groups = [g for g in re.split("[^0-9]+", value) if g]
    digits = "".join(groups)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 5) % 10)
        forms = []
        for number, wanted in ((digits, 1), (wrong, 0)):
            quads = [number[i : i + 4] for i in range(0, len(number), 4)]
            forms += [(".".join(quads), wanted), (number[:4] + "." + number[4:], wanted)]
            forms.append((f"{number[:4]}.{number[4:10]}.{number[10:]}", wanted))
        return [*forms, (wrong, 0), (" ".join(quads), 0), ("-".join(quads), 0)]
    if kind == "ip":
        high = [str(int(g.lstrip("0") or 0) + 256) for g in groups]
        return [
            (".".join([*groups[:3], high[3]]), 0),
            (".".join([high[0], *groups[1:]]), 0),
            (".".join(groups[:3]), 0),
        ]
    own = groups[1:]
    year, month, day = 1950 + int(digits) % 80, 1 + int(digits) % 12, 1 + int(digits) % 28
    forms = [
        (digits, 0),
        (digits[1:], 0),
        (digits[-7:], 0),
        (f"{digits[-7:-4]}.{digits[-4:]}", 0),
        (f"{digits[-7:-4]} {digits[-4:]}", 0),
        (f"{digits[-7]} {digits[-6:-3]} {digits[-3:]}", 0),
        (f"{year}-{month:02}-{day:02}", 0),
        (f"{day:02}.{month:02}.{year}", 0),
        (f"{month}/{day}/{year}", 0),
        (f"{year}-{year + 5}", 0),
        (".".join(digits), 0),
    ]
    if len(own) >= 2:
        forms += [
            (value[1:], 1),
            ("-".join(groups), 1),
            (f"({own[0]}) {'-'.join(own[1:])}", 1),
            ("-".join(own), 1),
        ]
    if len(own) >= 3:
        forms += [(".".join(own), 1), (" ".join(own), 1)]
    if [len(g) for g in own[-2:]] == [3, 4]:
        forms.append(("-".join(own[-2:]), 1))
    return forms


def _disproved(text: str, span: Span) -> bool:
    """Whether a candidate outside base spans cannot be of its kind."""
    kind, start, end = span
    n = len(_digits(text[start:end]))
    if kind == "ip":
        return True  # else it were a base span
    if kind == "card":
        return not (13 <= n <= 19 and _luhn(_digits(text[start:end])))
    if kind == "phone":
        glued = text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()
        return glued or not 7 <= n <= 15
    return False


def labelled_candidates(text: str | None) -> list[tuple[str, list[float], int]]:
    """``origin, features, wanted`` of the candidates of a text of which it is known.

    Wanted are the base spans written in other forms, each where the base span stands. Unwanted are
    near misses put there, candidates of another kind that the other forms make, and candidates of
    the text that cannot be of their kind. Nothing is said of the rest. The origin is the value that
    the forms come from.
    """
    spans = candidates(text)
    if not spans:
        return []
    base = base_spans(text)
    rows = [
        (text[s[1] : s[2]], span_features(text, s), 0)
        for s in spans
        if _disproved(text, s) and not any(_overlaps(s, b) for b in base)
    ]
    for kind, start, end in base:
        before, after = text[max(0, start - 64) : start], text[end : end + 64]
        origin, at = text[start:end], len(before)
        for form, wanted in _rewritten(kind, origin):
            place, whole = (kind, at, at + len(form)), before + form + after
            own_base = base_spans(whole)
            for s in candidates(whole):
                if not _overlaps(s, place) or any(_overlaps(s, b) for b in own_base):
                    continue
                if s == place or s[0] != kind or not wanted:
                    rows.append((origin, span_features(whole, s), int(wanted and s == place)))
    return rows


def _running(rows: DataFrame, group: str, piece: Column, order: Column, *counts: str) -> DataFrame:
    """``rows`` with ``upto_<count>``: counts added up within the group, in order.

    ``piece`` cuts a group into a bounded number of pieces, in the same order, so that a task sorts
    a piece and not a group.
    """
    rows = rows.withColumn("piece", piece)
    earlier = Window.partitionBy(group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(group, "piece").agg(*[F.sum(c).alias(c) for c in counts])
    before = before.select(
        group, "piece", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in counts]
    )
    inside = Window.partitionBy(group, "piece").orderBy(order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = {f"upto_{c}": F.sum(c).over(inside) + F.col(f"_{c}") for c in counts}
    # At most so many rows as there are pieces, whatever the input.
    return rows.join(F.broadcast(before), [group, "piece"]).withColumns(upto)


def _edges(features: DataFrame, n: int) -> list[np.ndarray]:
    """Quantiles of every feature over all ``n`` rows, as ``numpy.quantile`` gives them."""
    places = np.linspace(0, 1, BINS + 1)[1:-1] * (n - 1)
    low = np.floor(places).astype(int)
    high = np.minimum(low + 1, n - 1)
    values = features.select(F.posexplode("features").alias("f", "value"))
    values = values.groupBy("f", "value").agg(F.count(F.lit(1)).alias("n"))
    piece = F.floor(F.log2(F.col("value") + 1) * 8)  # no feature is less than 0
    ranked = _running(values, "f", piece, F.asc("value"), "n")
    wanted = F.lit(sorted({*low.tolist(), *high.tolist()})).cast("array<bigint>")
    upto = F.col("upto_n")
    ranked = ranked.where(F.exists(wanted, lambda r: (r >= upto - F.col("n")) & (r < upto)))
    found: dict[int, list[tuple[int, float]]] = {}
    for row in ranked.select("f", "upto_n", "value").collect():
        found.setdefault(row["f"], []).append((row["upto_n"], row["value"]))
    share = places - low
    edges = []
    for f in sorted(found):
        ends, at = (np.array(c) for c in zip(*sorted(found[f])))
        a, b = (at[np.searchsorted(ends, r, "right")] for r in (low, high))
        between = np.where(share >= 0.5, b - (b - a) * (1 - share), a + (b - a) * share)
        edges.append(np.unique(between))
    return edges


def _unpacked(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["bins"]), np.uint8).reshape(-1, N_FEATURES).astype(int)


def _grow_on(model: BoostedTrees, rows: DataFrame, n: int, n_wanted: int) -> None:
    """Grows the trees on all ``rows`` (``bins, n, wanted``), whose tasks add up their own ones."""

    def sums() -> np.ndarray:
        def partial(batches):
            total = 0
            for frame in batches:
                counts = frame["n"].to_numpy(float), frame["wanted"].to_numpy(float)
                total = total + model.sums(_unpacked(frame), *counts)
            if not isinstance(total, int):
                flat = total.reshape(-1, 2)
                cell = np.flatnonzero(flat.any(axis=1))
                yield pd.DataFrame({"cell": cell, "g": flat[cell, 0], "h": flat[cell, 1]})

        cells = rows.mapInPandas(partial, "cell int, g bigint, h bigint")
        cells = cells.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
        out = np.zeros((2 ** model.growing[0] * N_FEATURES * BINS, 2))
        out[cells["cell"]] = cells[["g", "h"]]
        return out.reshape(-1, N_FEATURES, BINS, 2)

    model.grow(n, n_wanted, sums)


def _calibrate_on(model: BoostedTrees, rows: DataFrame) -> None:
    """``calibrate`` on all held-out ``rows`` (``bins, n, wanted``)."""

    def score(batches):
        for frame in batches:
            scores = 1 / (1 + np.exp(-model._margin(_unpacked(frame))))
            yield pd.DataFrame({"score": scores, "n": frame["n"], "wanted": frame["wanted"]})

    scored = rows.mapInPandas(score, "score double, n bigint, wanted bigint").groupBy("score")
    scored = scored.agg(F.sum("n").alias("n"), F.sum("wanted").alias("wanted"))
    piece = -F.floor(F.col("score") * 1000)
    ranked = _running(scored.withColumn("all", F.lit(0)), "all", piece, F.desc("score"), "n", "wanted")
    good = ranked.where(F.col("upto_wanted") / F.col("upto_n") >= LEAST_PRECISION)
    least = good.agg(F.min("score")).first()[0]
    model.threshold = 2.0 if least is None else max(LEAST_SCORE, least)


def fit_pii(docs: DataFrame, text_col: str = "text") -> BoostedTrees:
    """Fits the trees on the candidates of which ``labelled_candidates`` knows what they are.

    All of them lie outside base spans, as do those the trees are asked about, and all different
    ones of all documents count once. They stay with the tasks, which send sums by node, feature and
    bin to the driver. A fifth of the values they come from calibrates the threshold. Without both
    labels the trees select nothing.
    """

    def label(batches):
        for frame in batches:
            rows = [row for text in frame["text"] for row in labelled_candidates(text)]
            yield pd.DataFrame(rows, columns=["value", "features", "wanted"])

    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    labelled = texts.mapInPandas(label, "value string, features array<double>, wanted int")
    hashed = labelled.withColumn("h", F.xxhash64("value", "features"))
    once = hashed.groupBy("h").agg(*[F.first(c).alias(c) for c in labelled.columns])
    held = F.pmod(F.xxhash64("value"), F.lit(5)) == 0
    once = stored(once.select("features", "wanted", held.alias("held")))
    counts = {
        (r["held"], r["wanted"]): r["count"] for r in once.groupBy("held", "wanted").count().collect()
    }
    model = BoostedTrees()
    n = [counts.get((False, label), 0) for label in (0, 1)]
    if not all(n):
        return model
    model.edges = _edges(once.where(~F.col("held")), sum(n))

    def pack(batches):
        for frame in batches:
            bins = model._binned(np.array(frame["features"].tolist())).astype(np.uint8)
            packed = [row.tobytes() for row in bins]
            yield pd.DataFrame({"bins": packed, "wanted": frame["wanted"], "held": frame["held"]})

    binned = once.mapInPandas(pack, "bins binary, wanted int, held boolean")
    # The trees cannot tell candidates of the same bins apart: one row with their counts.
    counted = binned.groupBy("bins", "held").agg(
        F.count(F.lit(1)).alias("n"), F.sum("wanted").alias("wanted")
    )
    rows = stored(counted)
    _grow_on(model, rows.where(~F.col("held")).select("bins", "n", "wanted"), sum(n), n[1])
    if any(is_held for is_held, _ in counts):
        _calibrate_on(model, rows.where("held").select("bins", "n", "wanted"))
    return model


def all_spans(text: str | None, model: BoostedTrees) -> tuple[list[Span], list[Span]]:
    """The base spans, and these with the selected candidates, which overlap no other span."""
    text = text or ""
    base = base_spans(text)
    if not model.trees:
        return base, base
    free = [s for s in candidates(text) if not any(_overlaps(s, b) for b in base)]
    chosen: list[Span] = []
    if free:
        scores = model.scores(np.array([span_features(text, s) for s in free]))
        for i in np.lexsort((np.arange(len(free)), -scores)):
            if scores[i] < model.threshold:
                break
            if not any(_overlaps(free[i], c) for c in chosen):
                chosen.append(free[i])
    order = {kind: i for i, kind in enumerate(KINDS)}
    return base, sorted([*base, *chosen], key=lambda s: (order[s[0]], s[1]))


def _redacted(text: str | None, spans: list[Span]) -> str | None:
    if text is None or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1:]):
        if end > at:
            out += [text[at : max(at, start)], f"<{kind}>" if start >= at else ""]
            at = end
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, model: BoostedTrees, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data found in their texts.

    New columns, which replace ones of the same name: ``base_spans`` and ``spans`` as
    ``kind:start:end`` joined by commas (code points, end exclusive; by kind, then start), the base
    counts ``n_email, n_ip, n_card, n_phone``, and ``redacted_text`` with spans replaced by their
    kind.

    Defined cases: null and empty texts have no spans, and a null stays null when redacted; rows are
    judged one by one, so repeated rows get equal results; an empty table gives an empty one.
    """
    require(docs, [text_col])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counts = [f"n_{kind}" for kind in KINDS]
    names = ["base_spans", "spans", "redacted_text", *counts]
    kind = T.StructType(
        [T.StructField(n, T.StringType()) for n in names[:3]]
        + [T.StructField(n, T.LongType()) for n in counts]
    )

    @F.pandas_udf(kind)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, spans = all_spans(text, shared.value)
            joined = [",".join(f"{k}:{a}:{b}" for k, a, b in s) for s in (base, spans)]
            of_kind = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            rows.append((*joined, _redacted(text, spans), *of_kind))
        return pd.DataFrame(rows, columns=names)

    found = docs.withColumn("_found", find.asNondeterministic()(F.col(f"`{text_col}`")))
    return with_columns(found, {n: F.col(f"_found.{n}") for n in names}).drop("_found")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_pii(docs, fit_pii(docs)).select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )
