from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLE
from tests.test_text import python_tokens
from trawl.functions import FALLBACK_CORPUS_SIZE, SearchWeights
from trawl.operators import indexing, pruning, retrieval
from trawl.plans.sample import SampleViews
from trawl.sources import index_store


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def ranked(results, digits=6):
    rows = results.orderBy("query_id", "rank").collect()
    out = {}
    for row in rows:
        ranks = out.setdefault(row["query_id"], [])
        ranks.append((row["doc_id"], round(row["score"], digits)))
        assert row["rank"] == len(ranks)
    return out


def test_known_answers(spark, toy_index, toy_ranks, toy_titles):
    query = ask(spark, "alpha gamma")
    fused = retrieval.search(query, toy_index, toy_ranks, toy_titles)
    assert ranked(fused) == {0: [(3, 56.784548), (1, 30.298486), (2, 21.889626), (9, 0.101476)]}
    assert [r["title"] for r in fused.orderBy("rank").collect()] == [
        "gamma alpha",
        "alpha page",
        "beta page",
        "N/A",
    ]
    body = retrieval.search_body(query, toy_index.body, toy_titles)
    assert ranked(body) == {0: [(3, 26.006677), (1, 13.003338), (2, 6.501669)]}
    title = retrieval.search_title(query, toy_index, toy_titles)
    assert ranked(title) == {0: [(3, 2), (1, 1)]}
    anchor = retrieval.search_anchor(query, toy_index, toy_titles)
    assert ranked(anchor) == {0: [(3, 2), (1, 1), (9, 1)]}


def test_queries_without_a_hit_give_no_rows(spark, toy_index, toy_ranks, toy_titles):
    query = ask(spark, "", "   ", "the of and", "unknownword", None)
    assert retrieval.search(query, toy_index, toy_ranks, toy_titles).count() == 0
    assert retrieval.search_body(query, toy_index.body, toy_titles).count() == 0
    assert retrieval.search_title(query, toy_index, toy_titles).count() == 0


def test_repeated_tokens_count_again(spark, toy_index, toy_titles):
    title = retrieval.search_title(ask(spark, "alpha alpha page"), toy_index, toy_titles)
    assert ranked(title) == {0: [(1, 3), (3, 2), (2, 1), (4, 1)]}


def test_null_title_of_a_known_document_stays_null(spark, toy_index):
    titles = spark.createDataFrame([(3, None), (1, "one")], "id long, title string")
    rows = retrieval.search_title(ask(spark, "alpha page"), toy_index, titles).collect()
    assert {r["doc_id"]: r["title"] for r in rows} == {1: "one", 2: "N/A", 3: None, 4: "N/A"}


def test_response_pairs(spark, toy_index, toy_titles):
    rows = retrieval.response_pairs(
        retrieval.search_anchor(ask(spark, "alpha"), toy_index, toy_titles)
    )
    assert [tuple(r) for r in rows.orderBy("rank").collect()] == [
        (0, 1, "1", "alpha page"),
        (0, 2, "3", "gamma alpha"),
        (0, 3, "9", "N/A"),
    ]


def test_corpus_size(spark, toy_index, toy_ranks, toy_titles):
    none = toy_ranks.where("false")
    query = ask(spark, "gamma")
    default = retrieval.search(query, toy_index, none, toy_titles)
    fixed = retrieval.search(query, toy_index, none, toy_titles, n_docs=FALLBACK_CORPUS_SIZE)
    assert ranked(default) == ranked(fixed)


class PlainRanking:
    """What a document scores for a query, worked out document by document."""

    def __init__(self, titles, bodies, links):
        self.fields = {"title": {}, "body": {}, "anchor": {}}
        for field, rows in (
            ("title", titles),
            ("body", bodies),
            ("anchor", [(target, text) for _, target, text in links]),
        ):
            for doc, text in rows:
                counts = self.fields[field].setdefault(doc, Counter())
                counts.update(python_tokens(text or ""))
        self.holders = {
            field: self._holders(documents) for field, documents in self.fields.items()
        }

    @staticmethod
    def _holders(documents):
        found = {}
        for doc in sorted(documents):
            for term in documents[doc]:
                found.setdefault(term, []).append(doc)
        return found

    def _rank(self, query, parts, cut, limit, boost=lambda doc: 0.0):
        """``parts``: of each field looked at, the points of one use of a term in a document."""
        uses = Counter(python_tokens(query))
        places = {term: i for i, term in reversed(list(enumerate(python_tokens(query))))}
        rows = []
        for doc in {d for f, _ in parts for t in uses for d in self.holders[f].get(t, [])[:cut]}:
            met = [
                (stage, places[term], uses[term] * points(term, self.fields[field][doc][term]))
                for stage, (field, points) in enumerate(parts)
                for term in uses
                if doc in self.holders[field].get(term, [])[:cut]
            ]
            score = math.fsum(p for _, _, p in met) + boost(doc)
            rows.append((-round(score, 9), min(m[:2] for m in met), doc, round(score, 6)))
        return [(doc, score) for _, _, doc, score in sorted(rows)[:limit]]

    def _df(self, term):
        return len(self.holders["body"][term])

    def matches(self, field, query, cut):
        return self._rank(query, [(field, lambda term, tf: 1)], cut, None)

    def tfidf(self, query, cut, limit):
        def points(term, tf):
            return tf * math.log10(FALLBACK_CORPUS_SIZE / self._df(term))

        return self._rank(query, [("body", points)], cut, limit)

    def fused(self, query, ranks, cut, limit):
        weights, n = SearchWeights(), len(ranks)

        def bm25(term, tf):
            rare = math.log1p((n - self._df(term) + 0.5) / (self._df(term) + 0.5))
            return weights.body * rare * 2.2 * tf / (tf + 1.2)

        parts = [
            ("title", lambda term, tf: weights.title),
            ("anchor", lambda term, tf: weights.anchor * tf),
            ("body", bm25),
        ]
        boost = lambda doc: weights.pagerank * math.log10(1 + ranks.get(doc, 0))
        return self._rank(query, parts, cut, limit, boost)


@pytest.fixture(scope="module")
def sample(spark):
    views = SampleViews(spark, SAMPLE)
    docs = views.documents().collect()
    brute = PlainRanking(
        [(r["id"], r["title"]) for r in docs],
        [(r["id"], r["text"]) for r in docs],
        [tuple(r) for r in views.links().collect()],
    )
    queries = [tuple(r) for r in views.queries().collect()]
    ranks = {i: 0.5 + i % 7 for i in range(0, 180)}
    return views, brute, queries, ranks


@pytest.fixture(scope="module", params=["derived", "derived in ranges", "stored"])
def index(request, spark, sample, tmp_path_factory):
    views = sample[0]
    per_range = 30 if request.param == "derived in ranges" else None
    docs = views.documents()
    index = indexing.SearchIndex(
        title=indexing.build_index(docs, "title", rows_per_range=per_range),
        body=indexing.build_index(docs, "text", rows_per_range=per_range),
        anchor=indexing.build_anchor_index(
            views.links(), rows_per_range=per_range and per_range * 30
        ),
    )
    if request.param != "stored":
        return index
    path = str(tmp_path_factory.mktemp("index"))
    index_store.write_search_index(index, path, buckets=4)
    return index_store.read_search_index(spark, path)


@pytest.mark.parametrize("cut", [10, None])
def test_searches_agree_with_brute_force(spark, sample, index, cut):
    views, brute, queries, ranks = sample
    table = spark.createDataFrame(list(ranks.items()), "id long, pagerank double")
    args = {"max_postings": cut}
    asked = views.queries()
    fused = retrieval.search(asked, index, table, views.titles(), limit=20, **args)
    wanted = {i: brute.fused(q, ranks, cut, 20) for i, q in queries}
    assert ranked(fused) == {i: w for i, w in wanted.items() if w}
    tfidf = retrieval.search_body(asked, index.body, views.titles(), limit=20, **args)
    wanted = {i: brute.tfidf(q, cut, 20) for i, q in queries}
    assert ranked(tfidf) == {i: w for i, w in wanted.items() if w}
    for field, search in (("title", retrieval.search_title), ("anchor", retrieval.search_anchor)):
        wanted = {i: brute.matches(field, q, cut) for i, q in queries}
        assert ranked(search(asked, index, views.titles(), **args)) == {
            i: w for i, w in wanted.items() if w
        }


def test_large_batches_and_limits_take_the_other_ways(spark, sample, index, monkeypatch):
    """Neither broadcast nor terms in the plan, and a limit Spark does not trim for."""
    views, brute, queries, _ = sample
    monkeypatch.setattr(retrieval, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(retrieval, "TERMS_IN_PLAN", 0)
    monkeypatch.setattr(retrieval, "POSTINGS_PER_PART", 7)
    assert not retrieval.query_terms(views.queries()).small
    tfidf = retrieval.search_body(views.queries(), index.body, views.titles(), limit=1500)
    wanted = {i: brute.tfidf(q, None, 1500) for i, q in queries}
    assert ranked(tfidf) == {i: w for i, w in wanted.items() if w}
    monkeypatch.setattr(retrieval, "_TRIMMED_BY_SPARK", 1)
    tfidf = retrieval.search_body(views.queries(), index.body, views.titles(), limit=5)
    assert ranked(tfidf) == {i: w[:5] for i, w in wanted.items() if w}


def test_a_batch_equals_one_by_one(spark, sample, index):
    views, _, queries, _ = sample
    batch = ranked(retrieval.search_title(views.queries(), index, views.titles()))
    for i, query in queries[:3]:
        one = spark.createDataFrame([(i, query)], "query_id long, query string")
        alone = ranked(retrieval.search_title(one, index, views.titles()))
        assert alone.get(i) == batch.get(i)


def test_the_best_are_trimmed_before_the_shuffle(spark, sample, index):
    views = sample[0]
    top = retrieval.search_body(views.queries(), index.body, views.titles())
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 100, Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.fixture(scope="module")
def narrow(spark, sample, tmp_path_factory):
    """Stored in blocks of four ids, as one segment and as three."""
    views = sample[0]
    docs = views.documents()
    body = lambda rows: indexing.build_index(rows, "text", rows_per_range=40)
    path = str(tmp_path_factory.mktemp("narrow"))
    index = indexing.SearchIndex(
        title=indexing.build_index(docs, "title"),
        body=body(docs),
        anchor=indexing.build_anchor_index(views.links()),
    )
    index_store.write_search_index(index, f"{path}/whole", ids_per_block=4)
    thirds = [docs.where(F.col("id") % 3 == i) for i in range(3)]
    index_store.write_index(body(thirds[0]), f"{path}/parts", ids_per_block=4)
    for third in thirds[1:]:
        index_store.append_documents(third, f"{path}/parts", "text")
    whole = index_store.read_search_index(spark, f"{path}/whole")
    parts = indexing.SearchIndex(whole.title, index_store.read_index(spark, f"{path}/parts"), whole.anchor)
    return {"whole": whole, "parts": parts}


def test_a_pruned_fused_search_equals_a_whole_one(spark, sample, narrow):
    views, brute, queries, ranks = sample
    table = spark.createDataFrame(list(ranks.items()), "id long, pagerank double")
    for kind, limit in (("whole", 5), ("parts", 100)):
        fused = retrieval.search(
            views.queries(), narrow[kind], table, views.titles(), limit=limit, prune=True
        )
        wanted = {i: brute.fused(q, ranks, None, limit) for i, q in queries}
        assert ranked(fused) == {i: w for i, w in wanted.items() if w}


def test_a_pruned_body_search_equals_a_whole_one(spark, sample, narrow):
    views, brute, queries, _ = sample
    for kind, limit in (("whole", 1), ("parts", 3)):
        tfidf = retrieval.search_body(
            views.queries(), narrow[kind].body, views.titles(), limit=limit, prune=True
        )
        wanted = {i: brute.tfidf(q, None, limit) for i, q in queries}
        assert ranked(tfidf) == {i: w for i, w in wanted.items() if w}


def test_many_chosen_blocks_are_looked_up_as_bits(spark, monkeypatch):
    """More blocks than fit a broadcast: matches are not shuffled to meet them."""
    blocks = [-4097, -65, -1, 0, 1, 62, 63, 64, 4095, 4096, 300_000]
    rows = [(q, b, 1) for q in (1, 2) for b in blocks if (q, b) != (2, 63)] + [(1, None, 1)]
    table = spark.createDataFrame(rows, "query_id int, doc_block long, n_postings long")
    asked = [(q, b + d) for q in (1, 2, 3) for b in blocks for d in (-1, 0, 1)] + [(1, None), (None, 1)]
    matches = spark.createDataFrame(asked, "query_id int, doc_block long")
    wanted = sorted((q, b) for q, b in asked if b is not None and (q, b, 1) in rows)
    few = pruning._settled(table)
    assert few.pages is None and sorted(map(tuple, few.of(matches).collect())) == wanted
    monkeypatch.setattr(pruning, "BROADCAST_ROWS", 3)
    many = pruning._settled(table)
    found = many.of(matches)
    assert many.pages.count() < len(rows) and found.columns == matches.columns
    assert sorted(map(tuple, found.select("query_id", "doc_block").collect())) == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    monkeypatch.setattr(pruning, "MOST_PAGES", 2)
    rest = pruning._settled(table)
    assert rest.pages is None
    assert sorted(map(tuple, rest.of(matches).select("query_id", "doc_block").collect())) == wanted


def test_a_pruned_search_of_many_blocks_equals_a_whole_one(spark, sample, narrow, monkeypatch):
    views, brute, queries, ranks = sample
    monkeypatch.setattr(pruning, "BROADCAST_ROWS", 3)
    table = spark.createDataFrame(list(ranks.items()), "id long, pagerank double")
    args = views.queries(), narrow["whole"], table, views.titles()
    wanted = {i: brute.fused(q, ranks, None, 5) for i, q in queries}
    found = ranked(retrieval.search(*args, limit=5, prune=True))
    assert found == {i: w for i, w in wanted.items() if w}


def test_pruning_reads_less_and_says_so(spark, sample, narrow):
    views, _, queries, ranks = sample
    table = spark.createDataFrame(list(ranks.items()), "id long, pagerank double")
    few = retrieval.search_reads(views.queries(), narrow["whole"], table, limit=2).collect()
    for row in few:  # every posting of a query's terms is counted
        terms = set(python_tokens(dict(queries)[row["query_id"]]))
        held = [len(own.get(t, [])) for own in sample[1].holders.values() for t in terms]
        assert row["postings"] == sum(held) and row["blocks_read"] <= row["blocks"]
    assert all(0 < r["postings_read"] <= r["postings"] for r in few)
    assert sum(r["postings_read"] for r in few) < 0.6 * sum(r["postings"] for r in few)


def test_pruning_needs_all_postings(sample, narrow):
    views = sample[0]
    with pytest.raises(ValueError):
        retrieval.search_body(
            views.queries(), narrow["whole"].body, views.titles(), max_postings=3, prune=True
        )


def test_an_index_not_stored_is_searched_in_full(spark, toy_index, toy_titles):
    asked = ask(spark, "", "alpha gamma")
    pruned = retrieval.search_body(asked, toy_index.body, toy_titles, prune=True)
    assert ranked(pruned) == {1: [(3, 26.006677), (1, 13.003338), (2, 6.501669)]}


def test_scores_that_fall_with_the_frequency(spark, toy, toy_titles, folder):
    """A corpus taken for smaller than it is makes weights negative."""
    index_store.write_index(indexing.build_index(toy, "text"), f"{folder}/body", ids_per_block=1)
    stored = index_store.read_index(spark, f"{folder}/body")
    for limit in (1, 2):
        args = {"n_docs": 1, "limit": limit}
        found = [
            ranked(retrieval.search_body(ask(spark, "alpha gamma"), i, toy_titles, **args, prune=p))
            for i, p in ((stored, True), (stored, False))
        ]
        assert found[0] == found[1] and len(found[0][0]) == limit


def test_a_term_of_many_queries_matches_a_posting_once(spark):
    docs = spark.createDataFrame([(i, "tea cup") for i in range(5)], "id long, text string")
    asked = retrieval.query_terms(ask(spark, "tea", "tea cup tea", "cup", "tea"))
    terms = retrieval.each_term(asked)
    assert terms.table.columns == asked.table.columns
    found = retrieval.matching_postings(terms, indexing.build_index(docs, "text"))
    rows = sorted(tuple(r) for r in found.select("term", "doc_id", "tf").collect())
    assert rows == [(t, i, 1) for t in ("cup", "tea") for i in range(5)]


def test_a_batch_is_placed_by_document_once(spark):
    """Sums over documents and over a query's terms use one placing, and no list is sorted."""
    rows = [(i, f"word{i % 5} common") for i in range(40)] + [(7, "common"), (None, "common")]
    docs = spark.createDataFrame(rows, "id long, text string")
    queries = spark.createDataFrame([(1, "common word3"), (2, "word7 of")], "query_id int, query string")
    index = indexing.build_index(docs, "text")
    fields = [retrieval.FieldScore(index, 0, lambda uses, tf, df: uses * tf * df)]
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        scores = retrieval._sum_fields(retrieval.query_terms(queries), fields, None, None)
        scores = scores.select("query_id", "doc_id", "score")
        plan = scores._jdf.queryExecution().executedPlan().toString()
        got = {(r["query_id"], r["doc_id"]): r["score"] for r in scores.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Generate inline") == 1 and "Window" not in plan
    expected = {(1, i): 40.0 + (8 if i % 5 == 3 else 0) for i in range(40)} | {(1, 7): 80.0}
    assert got == expected
