from __future__ import annotations

from collections import Counter

from tests.llm.cases import LONG, ODD, SPACES, documents, lower
from trawl.llm.line_dedup import drop_common_lines


def plain(rows, min_docs, min_chars=1):
    def key(line):
        return lower(line.strip(SPACES))

    lines = [(t or "").split("\n") for _, t in rows]
    docs = Counter(k for own in lines for k in {key(x) for x in own} if len(k) >= min_chars)
    out = []
    for (i, _), own in zip(rows, lines):
        kept = [x for x in own if docs[key(x)] < min_docs]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(table, **options):
    rows = drop_common_lines(table, **options).collect()
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows], key=repr)


def test_odd_documents(spark):
    assert got(documents(spark, ODD), min_docs=3) == plain(ODD, 3)


def test_lines_are_compared_stripped_and_lowered(spark):
    rows = [(i, f"Own {i}\n  COMMON line\t\nÉ") for i in range(5)] + [(9, "common LINE\né")]
    found = got(documents(spark, rows), min_docs=6)
    assert found == plain(rows, 6) and found[0][3] == "Own 0\nÉ" and found[-1][3] == "é"


def test_shortest_lines_and_repeats_in_a_document(spark):
    rows = [(i, "ab\nab\nlonger") for i in range(3)] + [(5, "ab\nx")]
    assert got(documents(spark, rows), min_docs=3, min_chars=3) == plain(rows, 3, 3)
    assert got(documents(spark, rows), min_docs=4) == plain(rows, 4)


def test_columns_and_empty_table(spark):
    table = documents(spark, ODD, clashes=True)
    result = drop_common_lines(table)
    assert result.columns[:5] == table.columns[:5] and result.columns[-2:] == ["n_lines", "n_dropped"]
    assert {r.score for r in result.collect()} == {"mine"}
    assert drop_common_lines(documents(spark, [])).collect() == []


def test_a_very_long_line(spark):
    rows = [(i, LONG) for i in range(3)]
    assert got(documents(spark, rows), min_docs=3) == [(i, 1, 1, "") for i in range(3)]


def test_no_python_in_the_plan(spark):
    plan = drop_common_lines(documents(spark, ODD))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
