from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLE
from tests.test_text import python_tokens
from trawl.operators import indexing
from trawl.operators.numbering import DOCS_PER_TASK, IdRanges, deal, measure_id_ranges
from trawl.plans.sample import SampleViews
from trawl.sources import index_store

COLUMNS = ["term", "doc_id", "tf", "posting_no", "df", "term_total"]


def postings(index):
    return sorted(tuple(r) for r in index.postings.select(*COLUMNS).collect())


def by_hand(docs, min_df=0):
    lists = {}
    for doc_id, text in docs:
        for term, tf in Counter(python_tokens(text)).items():
            lists.setdefault(term, Counter())[doc_id] += tf
    rows = []
    for term, list_ in lists.items():
        if len(list_) > min_df:
            total = sum(list_.values())
            for number, doc_id in enumerate(sorted(list_), 1):
                rows.append((term, doc_id, list_[doc_id], number, len(list_), total))
    return sorted(rows)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def expected(documents):
    return {m: by_hand([tuple(r) for r in documents.collect()], m) for m in (0, 2)}


@pytest.mark.parametrize("rows_per_range", [None, 7, 60])
@pytest.mark.parametrize("min_df", [0, 2])
def test_index_agrees_with_brute_force(documents, expected, rows_per_range, min_df):
    index = indexing.build_index(
        documents, "text", "doc_id", min_df=min_df, rows_per_range=rows_per_range
    )
    assert postings(index) == expected[min_df]


def test_statistics(documents, expected):
    frequencies = indexing.term_frequencies(documents, doc_id="doc_id")
    stats = sorted(tuple(r) for r in indexing.term_statistics(frequencies).collect())
    wanted = sorted({(term, df, total) for term, _, _, _, df, total in expected[0]})
    assert stats == wanted
    index = indexing.build_index(documents, "text", "doc_id")
    assert sorted(tuple(r) for r in index.term_stats.collect()) == wanted


def test_one_document_id_on_a_third_of_all_rows(spark):
    docs = [(i, f"word{i % 5} common") for i in range(200)] + [(77, "common hot")] * 100
    rows = spark.createDataFrame(docs, "id long, text string")
    assert measure_id_ranges(rows, "id", 20).crowded
    index = indexing.build_index(rows, "text", rows_per_range=20)
    assert index.ranges > 2
    assert postings(index) == by_hand(docs)


def test_id_ranges(spark):
    ranges = IdRanges(tuple(range(10, 1000, 10)))
    rows = spark.createDataFrame([(i,) for i in range(1100)], "id long")
    got = {r["id"]: r["n"] for r in rows.select("id", ranges.of(F.col("id")).alias("n")).collect()}
    assert got == {i: min(max(0, -(-i // 10) - 1), 99) for i in range(1100)}
    assert len(IdRanges()) == 1


def test_anchor_index_counts_links_to_a_page(spark):
    links = spark.createDataFrame(
        [(1, 5, "green tea"), (2, 5, "green"), (2, 5, "green green"), (3, 6, None), (4, 6, "tea")],
        "src long, dst long, text string",
    )
    rows = [r[:3] for r in postings(indexing.build_anchor_index(links))]
    assert rows == [("green", 5, 4), ("tea", 5, 1), ("tea", 6, 1)]
    assert [r[:3] for r in postings(indexing.build_anchor_index(links, rows_per_range=1))] == rows


def test_null_texts_and_anchor_lists_give_nothing(spark):
    corpus = spark.createDataFrame(
        [(1, None, None, None)],
        "id long, title string, text string, anchor_text array<struct<id: long, text: string>>",
    )
    index = indexing.build_search_index(corpus, body_min_df=0)
    for field in (index.title, index.body, index.anchor):
        assert field.postings.count() == 0


def test_merged_halves_equal_the_whole(documents, expected):
    even = documents.where("doc_id % 2 = 0")
    odd = documents.where("doc_id % 2 = 1")
    parts = [indexing.build_index(half, "text", "doc_id") for half in (even, odd)]
    assert postings(indexing.merge_index(*parts)) == expected[0]
    assert postings(indexing.merge_index(*parts, min_df=2, rows_per_range=500)) == expected[2]
    assert postings(indexing.add_documents(parts[0], odd, "text", "doc_id")) == expected[0]


def test_merge_adds_up_a_document_in_both(spark):
    docs = spark.createDataFrame([(1, "apple pear apple")], "id long, text string")
    index = indexing.build_index(docs, "text")
    assert [r[:3] for r in postings(indexing.merge_index(index, index))] == [
        ("apple", 1, 4),
        ("pear", 1, 2),
    ]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_blocks_in_turn_are_the_list(documents, expected, size):
    index = indexing.build_index(documents, "text", "doc_id")
    lists = {}
    for row in indexing.posting_blocks(index, size).orderBy("term", "block_no").collect():
        assert len(row["postings"]) <= size
        lists.setdefault(row["term"], []).extend(tuple(p) for p in row["postings"])
    wanted = {}
    for term, doc_id, tf, *_ in expected[0]:
        wanted.setdefault(term, []).append((doc_id, tf))
    assert lists == wanted


def test_index_round_trip(spark, documents, expected, folder):
    index = indexing.build_index(documents, "text", "doc_id", rows_per_range=60)
    index_store.write_index(index, folder + "/body", buckets=5)
    stored = index_store.read_index(spark, folder + "/body")
    assert (stored.segments[0].buckets, stored.ranges) == (5, index.ranges)
    assert postings(stored) == expected[0]
    stats = sorted(tuple(r) for r in index_store.read_term_stats(spark, folder + "/body").collect())
    assert stats == sorted({(r[0], r[4], r[5]) for r in expected[0]})
    term = max(expected[0], key=lambda r: r[4])[0]
    wanted = [(r[1], r[2]) for r in expected[0] if r[0] == term]
    for source in (index, stored):
        assert [tuple(r) for r in index_store.posting_list(source, term).collect()] == wanted
        assert index_store.posting_list(source, "no-such-term").count() == 0


def test_a_look_up_reads_one_folder_and_pushes_the_term_down(spark, documents, folder):
    index = indexing.build_index(documents, "text", "doc_id")
    index_store.write_index(index, folder + "/body", buckets=5)
    stored = index_store.read_index(spark, folder + "/body")
    plan = index_store.posting_list(stored, "thand")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan
    assert "EqualTo(term,thand)" in plan


def test_large_frequencies_and_ids_are_stored_as_they_are(spark, folder):
    docs = spark.createDataFrame([(2**40, "word " * 65536), (7, "word")], "id long, text string")
    index = indexing.build_index(docs, "text")
    index_store.write_index(index, folder + "/large", buckets=2)
    stored = index_store.read_index(spark, folder + "/large")
    assert postings(stored) == postings(index)
    assert postings(stored)[1][:3] == ("word", 2**40, 65536)


@pytest.mark.parametrize("store", [False, True])
def test_adding_to_an_index_that_hides_rare_terms(spark, folder, store):
    docs = [(i, "common") for i in range(1, 4)] + [(1, "rare"), (2, "seldom seldom"), (4, "seldom")]
    columns = "id long, text string"
    index = indexing.build_index(spark.createDataFrame(docs, columns), "text", min_df=1)
    if store:
        index_store.write_index(index, folder + "/thin", buckets=2)
        index = index_store.read_index(spark, folder + "/thin")
        assert index.min_df == 1
    assert {r[0] for r in postings(index)} == {"common", "seldom"}
    assert {r["term"] for r in index.term_stats.collect()} == {"common", "seldom"}
    new = [(10, "common rare fresh")]
    grown = indexing.add_documents(index, spark.createDataFrame(new, columns), "text")
    assert postings(grown) == by_hand(docs + new, 1)
    assert ("rare", 1, 1, 1, 2, 2) in postings(grown)


def test_links_to_nowhere_are_left_out(spark):
    corpus = spark.createDataFrame(
        [(1, None, None, [(None, "lost"), (2, "found")])],
        "id long, title string, text string, anchor_text array<struct<id: long, text: string>>",
    )
    links = indexing.anchor_links(corpus)
    assert [r["dst"] for r in links.collect()] == [2]
    loose = spark.createDataFrame([(1, None, "lost"), (1, 2, "found")], links.schema)
    assert [r[0] for r in postings(indexing.build_anchor_index(loose))] == ["found"]


def test_sum_of_frequencies_is_the_number_of_tokens(spark, documents):
    index = indexing.build_index(documents, "text", "doc_id")
    total = index.postings.agg(F.sum("tf")).first()[0]
    assert total == sum(len(python_tokens(r["text"])) for r in documents.collect())


def test_postings_are_shuffled_once(spark):
    """Numbering by ranges uses the postings twice but places them once."""
    index = indexing.build_index(SampleViews(spark, SAMPLE).documents(), "text", rows_per_range=50)
    index.postings.write.format("noop").mode("overwrite").save()
    rows = index.postings
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_postings_are_dealt_out_by_their_documents(spark):
    """More documents make more tasks: left to 64 MB a task, postings outgrow its memory."""
    rows = spark.createDataFrame([(i, f"w{i}") for i in range(8)], "doc_id long, term string")
    many = deal(rows, IdRanges(n_rows=100 * DOCS_PER_TASK), "term")
    assert many.rdd.getNumPartitions() == 100
    ranges = measure_id_ranges(rows, "doc_id")
    assert ranges.n_rows == 8 and len(ranges) == 1
    assert deal(many, ranges, "doc_id").rdd.getNumPartitions() == 8  # one a core at least


def test_ranges_do_not_tokenise_twice(spark):
    """The tally of ranges and the rows share one shuffle, also where totals are not asked for."""
    docs = [(i, f"word{i % 5} common") for i in range(40)]
    rows = spark.createDataFrame(docs, "id long, text string")
    index = indexing.build_index(rows, "text", rows_per_range=10)
    assert index.ranges > 1
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan = index.postings.select("term", "doc_id", "tf", "posting_no")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert text.count("Generate inline") == 1


def test_equal_links_are_tokenised_once(spark):
    links = [(i, 1, "alpha beta alpha") for i in range(50)] + [(9, 2, "beta"), (9, 1, None)]
    rows = spark.createDataFrame(links, "src long, dst long, text string")
    counted = indexing.anchor_frequencies(rows)
    assert sorted(tuple(r) for r in counted.collect()) == [
        ("alpha", 1, 100),
        ("beta", 1, 50),
        ("beta", 2, 1),
    ]
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [dst" in plan.split("Generate", 1)[1]  # below it: done before
