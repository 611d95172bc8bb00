from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_indexing import by_hand, postings
from trawl.operators import indexing
from trawl.operators import segments as parts
from trawl.operators.segments import overlapping
from trawl.sources import index_store

WORDS = "tea cup oak pine rock sand wind rain fire lake".split()


def texts(first, last, step=1):
    return [
        (i, " ".join(WORDS[(i * k + k // 2) % 10] for k in range(1, 2 + i % 6)) + f" own{i}")
        for i in range(first, last, step)
    ]


def table(spark, docs):
    return spark.createDataFrame(docs, "id long, text string")


def stored(spark, docs, path, min_df=0, rows_per_range=None):
    index = indexing.build_index(table(spark, docs), "text", min_df=min_df, rows_per_range=rows_per_range)
    index_store.write_index(index, path, buckets=3, ids_per_block=4)


def stats(index):
    return sorted(tuple(r) for r in index.term_stats.select("term", "df", "term_total").collect())


def expected_stats(docs, min_df=0):
    return sorted({(r[0], r[4], r[5]) for r in by_hand(docs, min_df)})


def test_one_exchange_over_postings(spark):
    index = indexing.build_index(table(spark, texts(0, 40)), "text", rows_per_range=9)
    assert index.ranges > 2
    plan = index_store.placed_postings(index.derived, 3, 4)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1


def test_one_exchange_over_postings_of_one_range(spark):
    index = indexing.build_index(table(spark, texts(0, 40)), "text")
    assert index.ranges == 1
    plan = index_store.placed_postings(index.derived, 3, 4)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1


def test_buckets_of_links_go_by_pages_and_not_by_all_their_texts(spark):
    """Links with the same text to the same page are one posting a term, however many they are."""
    links = spark.range(2000).selectExpr("id src", "id % 2 dst", "repeat('green tea ', 2000) text")
    derived = indexing.build_anchor_index(links).derived
    assert index_store._buckets_for(derived) == 1 and derived.n_postings < 250_000
    assert index_store._buckets_for(derived._replace(n_postings=None)) > 1


@pytest.mark.parametrize("min_df", [0, 2])
def test_appended_documents(spark, folder, min_df):
    """Ids that lie beyond the older ones, and ids in between them."""
    first, second, third = texts(0, 60, 2), texts(60, 70), texts(1, 21, 2)
    stored(spark, first, folder, min_df, rows_per_range=8)
    index_store.append_documents(table(spark, second), folder, "text")
    index_store.append_documents(table(spark, third), folder, "text", rows_per_range=3)
    index = index_store.read_index(spark, folder)
    docs = first + second + third
    assert len(index.segments) == 3 and not overlapping(index.segments)
    assert index.min_df == min_df and postings(index) == by_hand(docs, min_df)
    assert stats(index) == expected_stats(docs, min_df)
    # A segment holds the new postings and no others.
    sizes = [s.postings.count() for s in index.segments]
    assert sizes == [s.n_postings for s in index.segments] == [len(by_hand(d)) for d in (first, second, third)]
    cut = indexing.FieldIndex.first_postings(index, None, 3)
    wanted = [r[:4] for r in by_hand(docs) if r[3] <= 3]
    assert sorted(tuple(r) for r in cut.select("term", "doc_id", "tf", "posting_no").collect()) == wanted
    term = "tea"
    wanted = [r[1:3] for r in by_hand(docs, min_df) if r[0] == term]
    assert [tuple(r) for r in index_store.posting_list(index, term).collect()] == wanted


def test_a_document_in_several_segments_is_added_up(spark, folder):
    first, second, third = texts(0, 12), texts(6, 15), texts(3, 20, 4)
    stored(spark, first, folder, min_df=1)
    for docs in (second, third):
        index_store.append_documents(table(spark, docs), folder, "text")
    index = index_store.read_index(spark, folder)
    docs = first + second + third
    assert overlapping(index.segments)
    assert postings(index) == by_hand(docs, 1) and stats(index) == expected_stats(docs, 1)
    assert index_store.compact_index(spark, folder, per_tier=3) == 3
    index = index_store.read_index(spark, folder)
    assert len(index.segments) == 1 and not overlapping(index.segments)
    assert postings(index) == by_hand(docs, 1)


def test_segments_are_merged_by_tiers(spark, folder):
    parts = [texts(0, 60), texts(60, 62), texts(62, 64), texts(64, 66)]
    stored(spark, parts[0], folder)
    for part in parts[1:3]:
        index_store.append_documents(table(spark, part), folder, "text")
    assert index_store.compact_index(spark, folder, 3, least_tier=40) == 0
    large = index_store.read_index(spark, folder).segments[0]
    index_store.append_documents(table(spark, parts[3]), folder, "text")
    assert index_store.compact_index(spark, folder, 3, least_tier=40) == 3
    index = index_store.read_index(spark, folder)
    assert len(index.segments) == 2 and large.path in {s.path for s in index.segments}
    assert postings(index) == by_hand([d for part in parts for d in part])


def test_stored_indexes_are_merged_where_they_are(spark, folder):
    first, second = texts(0, 20), texts(20, 30)
    stored(spark, first, f"{folder}/a", min_df=1)
    stored(spark, second, f"{folder}/b")
    index_store.merge_stored(spark, f"{folder}/a", f"{folder}/b", f"{folder}/both")
    index = index_store.read_index(spark, f"{folder}/both")
    assert postings(index) == by_hand(first + second, 1)
    assert {s.path.rsplit("/segments/", 1)[0] for s in index.segments} == {f"{folder}/a", f"{folder}/b"}
    # A document in both: all postings are merged anew.
    index_store.merge_stored(spark, f"{folder}/a", f"{folder}/both", f"{folder}/twice", min_df=0)
    twice = index_store.read_index(spark, f"{folder}/twice")
    assert len(twice.segments) == 1 and postings(twice) == by_hand(first + first + second)


def test_appended_links_and_an_empty_batch(spark, folder):
    links = [(1, 5, "green tea"), (2, 5, "green"), (2, 6, None)]
    more = [(3, 5, "green oak"), (3, 7, "oak")]
    schema = "src long, dst long, text string"
    index = indexing.build_anchor_index(spark.createDataFrame(links, schema))
    index_store.write_index(index, folder)
    index_store.append_links(spark.createDataFrame(more, schema), folder)
    index_store.append_links(spark.createDataFrame([], schema), folder)
    found = postings(index_store.read_index(spark, folder))
    both = [(dst, text or "") for _, dst, text in links + more]
    assert found == by_hand(both) and found[0][:3] == ("green", 5, 3)


def test_an_index_is_not_written_over_unless_asked(spark, folder):
    stored(spark, texts(0, 3), folder)
    with pytest.raises(ValueError):
        stored(spark, texts(5, 9), folder)
    index = indexing.build_index(table(spark, texts(5, 9)), "text")
    index_store.write_index(index, folder, mode="overwrite")
    assert postings(index_store.read_index(spark, folder)) == by_hand(texts(5, 9))
    for call in (index_store.read_index, lambda s, p: index_store.append_index(index, p)):
        with pytest.raises(ValueError):
            call(spark, f"{folder}/none")


def test_few_buckets_for_short_texts(spark, folder):
    index_store.write_index(indexing.build_index(table(spark, texts(0, 5)), "text"), folder)
    assert index_store.read_index(spark, folder).segments[0].buckets == 1
    assert index_store.read_index(spark, folder).segments[0].bounds.agg(F.sum("n")).first()[0] == len(
        by_hand(texts(0, 5))
    )


def plan_of(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_lone_segment_is_numbered_by_its_places_and_pieces(spark, folder):
    docs = texts(0, 40)
    stored(spark, docs, folder, rows_per_range=9)
    index = index_store.read_index(spark, folder)
    assert index.ranges > 2 and postings(index) == by_hand(docs)
    assert "row_number" not in plan_of(index.postings)


def test_ranges_are_found_for_documents_and_not_for_postings(spark):
    index = indexing.build_index(table(spark, texts(0, 40)), "text", rows_per_range=9)
    plan = plan_of(index.all_postings)
    assert "aggregate(" in plan.split("Generate")[-1]
    assert "aggregate(" not in plan.split("Generate")[0]


def test_first_postings_of_a_segment_are_found_by_its_pieces(spark, folder):
    """So many rows of a term leave a segment, not so many of every range of documents."""
    docs, more = texts(0, 40), texts(20, 60, 3)
    stored(spark, docs, folder, rows_per_range=5)
    index_store.append_documents(table(spark, more), folder, "text", rows_per_range=5)
    index = index_store.read_index(spark, folder)
    assert all(len(segment.ranges) > 2 for segment in index.segments)
    for segment in index.segments:
        read = parts.counts([segment], None, 3).groupBy("term").count().agg(F.max("count")).first()[0]
        assert read == 3
    for wanted in (None, index_store.Vocabulary(hashes(spark, WORDS))):
        cut = index.first_postings(wanted, 3).select("term", "doc_id", "tf", "posting_no")
        rows = [r[:4] for r in by_hand(docs + more) if r[3] <= 3 and (wanted is None or r[0] in WORDS)]
        assert sorted(tuple(r) for r in cut.collect()) == sorted(rows)


def hashes(spark, terms):
    rows = spark.createDataFrame([(t,) for t in terms], "term string")
    return {r[0]: r[1] for r in rows.select("term", F.xxhash64("term")).collect()}


def test_folders_of_a_small_batch_give_its_terms_only(spark, folder):
    stored(spark, texts(0, 40), folder)
    index = index_store.read_index(spark, folder)
    asked = spark.createDataFrame([(1, "tea"), (2, "tea"), (2, "oak")], "query_id int, term string")
    found = index.counts(index_store.Folders(asked, small=True)).select("term").distinct()
    assert sorted(r[0] for r in found.collect()) == ["oak", "tea"]
    whole = index.counts(index_store.Folders(asked)).select("term").distinct()
    assert whole.count() > 2


def exchanges(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Join")


def test_blocks_and_pieces_are_those_of_the_postings(spark, folder):
    docs = texts(0, 40) + texts(0, 40, 7) + [(None, "tea tea")]
    stored(spark, docs, folder, rows_per_range=9)
    (segment,) = index_store.read_index(spark, folder).segments
    counted = [F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf_sum")]
    ends = [F.min("tf").alias("least_tf"), F.max("tf").alias("most_tf")]
    for table, key, values in (
        (segment.bounds, ["term_bucket", "doc_range", "term", "doc_block"], counted + ends),
        (segment.pieces, ["term_bucket", "doc_range", "term"], counted),
    ):
        wanted = segment.postings.groupBy(*key).agg(*values)
        found = table.select(*wanted.columns)
        assert found.count() > 9 and found.exceptAll(wanted).isEmpty()
        assert wanted.exceptAll(found).isEmpty()


def test_all_postings_of_a_lone_segment_are_shuffled_once(spark, folder, monkeypatch):
    docs = texts(0, 40) + texts(0, 40, 7)
    stored(spark, docs, folder, rows_per_range=9)
    index = index_store.read_index(spark, folder)
    assert index.ranges > 2 and postings(index) == by_hand(docs)
    assert exchanges(index.postings) == (1, 0)
    # Frequent terms are placed by range, and so is all of a segment whose postings tell no pieces.
    monkeypatch.setattr(parts, "ROWS_PER_RANGE", 5)
    index = index_store.read_index(spark, folder)
    assert exchanges(index.postings)[1] > 0 and postings(index) == by_hand(docs)
    older = [replace(s, marked=False) for s in index.segments]
    assert postings(indexing.join_segments(older, 0, 4)) == by_hand(docs)
