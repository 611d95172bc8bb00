from __future__ import annotations

import random
from bisect import bisect_right
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from trawl.operators import evaluation
from trawl.operators.evaluation import display_query, evaluate, summarize


def measures(spark, cases, style, **cuts):
    """Measures of ``{name: (relevant, returned)}`` as ``{name: row}``."""
    queries = [(i, name) for i, name in enumerate(cases)]
    qrels = [(i, d) for i, (rel, _) in enumerate(cases.values()) for d in rel]
    results = [
        (i, rank, d)
        for i, (_, ret) in enumerate(cases.values())
        for rank, d in enumerate(ret, 1)
    ]
    table = evaluate(
        spark.createDataFrame(queries, "query_id int, query string"),
        spark.createDataFrame(results, "query_id int, rank int, doc_id int"),
        spark.createDataFrame(qrels, "query_id int, doc_id int"),
        style,
        **cuts,
    )
    return {r["query"]: r for r in table.collect()}, table


r10, r50 = list(range(10)), list(range(50))


# The answers, and the cuts they are for, of the public metric examples.
KNOWN = [
    ("p2", r10, [1, 2, 3], 1.0),
    ("p2", r10, [], 0.0),
    ("p5", [], [1, 2, 3], 0.0),
    ("r2", r10, [10, 5, 3], 0.1),
    ("r2", [], [10, 5, 3], 1.0),
    ("r2", r10, [], 0.0),
    ("f1_5", [], [1, 2, 3], 0.0),
    ("f1_2", r10, [], 0.0),
    ("f1_2", r10, [0, 1, 2], 0.333),
    ("f1_30", r50, r50[:5], 0.182),
    ("f1_30", r50, r50[:10], 0.333),
    ("f1_30", r50, r50[:30], 0.75),
    ("quality", r50, r50[:5], 0.308),
    ("quality", r50, r50[:10], 0.5),
    ("quality", r50, r50[:30], 0.857),
    ("quality", r50, [-1] * 5 + r50[5:30], 0.0),
]


@pytest.mark.parametrize("deep", [2, 5, 30])
def test_known_answers_at_their_cuts(spark, deep):
    mine = [k for k in KNOWN if k[0].endswith(str(deep)) or (deep == 30 and k[0] == "quality")]
    cases = {str(i): (relevant, returned) for i, (_, relevant, returned, _) in enumerate(mine)}
    got, _ = measures(spark, cases, "list", cuts=(5, 2), f1_cut=deep)
    assert [got[str(i)][k[0]] for i, k in enumerate(mine)] == [k[3] for k in mine]


# Further answers at the usual cuts.
def test_list_style_known_answers(spark):
    got, _ = measures(
        spark,
        {
            "none": (r10, []),
            "nothing relevant": ([], [1, 2, 3]),
            "neither": ([], []),
            "all good": (r10, [1, 2]),
            "one of ten": (r10, [10, 5]),
            "two of ten": (r10, [0, 1]),
            "5 of 50": (r50, list(range(5))),
            "10 of 50": (r50, list(range(10))),
            "30 of 50": (r50, list(range(30))),
            "late": (r50, [-1] * 5 + list(range(5, 30))),
            "ap": ([1, 2, 3], [1, 9, 3, 8]),
            "beyond": ([1], list(range(100, 140)) + [1]),
        },
        "list",
    )
    assert got["none"].p5 == 0.0 and got["none"].r30 == 0.0 and got["none"].f1_30 == 0.0
    assert got["nothing relevant"].p5 == 0.0 and got["nothing relevant"].r30 == 1.0
    assert got["nothing relevant"].f1_30 == 0.0 and got["neither"].r30 == 1.0
    assert got["all good"].p5 == 1.0 and got["one of ten"].r30 == 0.1
    assert got["two of ten"].f1_30 == 0.333
    assert [got[k].f1_30 for k in ("5 of 50", "10 of 50", "30 of 50")] == [0.182, 0.333, 0.75]
    assert [got[k].quality for k in ("5 of 50", "10 of 50", "30 of 50", "late")] == [
        0.308,
        0.5,
        0.857,
        0.0,
    ]
    assert got["ap"].ap40 == 0.833 and got["beyond"].ap40 == 0.0


def test_fixed_style(spark):
    got, table = measures(
        spark,
        {
            "three": ([1, 2, 3], [1, 9, 3]),
            "none": (r10, []),
            "nothing relevant": ([], [1]),
            "repeats": ([1, 2], [1, 1, 1]),
        },
        "fixed",
    )
    p30, r30 = 2 / 30, 2 / 3
    f1 = 2 * p30 * r30 / (p30 + r30)
    assert (got["three"].p5, got["three"].p10) == (0.4, 0.2)
    assert got["three"].f1_30 == pytest.approx(f1)
    assert got["three"].quality == pytest.approx(2 * 0.4 * f1 / (0.4 + f1))
    for name in ("none", "nothing relevant"):
        assert tuple(got[name])[2:] == (0.0, 0.0, 0.0, 0.0)
    assert got["repeats"].p5 == 0.2
    means = summarize(table).first()
    assert means.n_queries == 4 and means.avg_p5 == pytest.approx((0.4 + 0.2) / 4)


def by_definition(relevant, returned, cuts=(5, 10), deep=30, ap=40):
    """Measures from the places at which relevant documents stand, in exact fractions."""
    places = [i for i, d in enumerate(returned, 1) if d in set(relevant)]

    def found(k):
        return bisect_right(places, k)

    def share(part, whole, otherwise):
        return round(float(Fraction(part, whole)), 3) if whole else otherwise

    def both(a, b):
        a, b = Fraction(str(a)), Fraction(str(b))
        return round(float(2 * a * b / (a + b)), 3) if a and b else 0.0

    precision = {k: share(found(k), min(k, len(returned)), 0.0) for k in (*cuts, deep)}
    recall = share(found(deep), len(set(relevant)), 1.0)
    steps = [Fraction(n, place) for n, place in enumerate(places, 1) if place <= ap]
    mean = share(sum(steps), len(steps), 0.0)
    f1 = both(precision[deep], recall)
    return (*(precision[k] for k in cuts), recall, f1, mean, both(precision[cuts[0]], f1))


@pytest.mark.parametrize("cuts", [{}, {"cuts": (2, 7), "f1_cut": 15, "ap_cut": 9}])
def test_random_lists_agree_with_the_definitions(spark, cuts):
    rng = random.Random(3)
    cases = {}
    for i in range(60):
        relevant = rng.sample(range(120), rng.randint(0, 90))
        cases[f"q{i}"] = (relevant, rng.sample(range(120), rng.randint(0, 100)))
    got, _ = measures(spark, cases, "list", **cuts)
    for name, (relevant, returned) in cases.items():
        wanted = by_definition(relevant, returned, *cuts.values())
        assert tuple(got[name])[2:] == wanted, name


def test_judgements_may_be_strings(spark):
    queries = spark.createDataFrame([(0, "q")], "query_id int, query string")
    results = spark.createDataFrame([(0, 1, 7), (0, 2, 8)], "query_id int, rank int, doc_id long")
    judged = spark.createDataFrame([(0, "7"), (0, "doc-9")], "query_id int, doc_id string")
    row = evaluate(queries, results, judged, "list").first()
    assert (row.p5, row.r30) == (0.5, 0.5)


def test_unknown_style(spark):
    with pytest.raises(ValueError, match="style"):
        measures(spark, {"a": ([1], [1])}, "other")


def test_display(spark):
    rows = spark.createDataFrame([("x" * 27,), ("y" * 28,)], "q string")
    assert [r[0] for r in rows.select(display_query(F.col("q"))).collect()] == [
        "x" * 27,
        "y" * 27 + "..",
    ]


def test_queries_are_timed_one_by_one(spark):
    queries = spark.createDataFrame([(1, "a"), (2, "fails"), (3, "b")], "query_id int, query string")
    qrels = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "query_id int, doc_id int")
    asked = []

    def search(one):
        row = one.first()
        asked.append(row["query_id"])
        if row["query"] == "fails":
            raise RuntimeError("no answer")
        return one.select("query_id", F.lit(1).alias("rank"), F.lit(5).alias("doc_id"))

    results, times = evaluation.run_timed(queries, search)
    assert asked == [1, 2, 3] and results.count() == 2
    rows = {r["query_id"]: r for r in times.collect()}
    assert rows[1]["seconds"] > 0 and rows[1]["error"] is None
    assert rows[2]["seconds"] is None and rows[2]["error"] == "RuntimeError: no answer"
    metrics = evaluation.metrics_fixed(queries, results, qrels)
    timed = evaluation.with_seconds(metrics, times)
    by_query = {r["query_id"]: r for r in timed.collect()}
    assert by_query[2]["seconds"] == by_query[2]["quality"] == 0
    assert by_query[1]["p5"] == 0.2 and by_query[1]["seconds"] == rows[1]["seconds"]
    means = evaluation.summarize(timed).first()
    seconds = (rows[1]["seconds"] + rows[3]["seconds"]) / 3
    assert means["n_queries"] == 3 and abs(means["avg_seconds"] - seconds) < 1e-9
    with pytest.raises(ValueError):
        evaluation.run_timed(queries, search, at_most=2)


def test_timing_without_any_answer(spark):
    queries = spark.createDataFrame([(1, "a")], "query_id int, query string")

    def search(one):
        raise ValueError("down")

    results, times = evaluation.run_timed(queries, search)
    assert results.collect() == [] and times.first()["seconds"] is None
