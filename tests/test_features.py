from __future__ import annotations

import bz2
import gzip
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from trawl.operators import features
from trawl.operators.features import last_views, merge_views, titled_views
from trawl.plans.engine import add_titles, build_engine, grow_engine, open_engine, read_feature, write_feature
from trawl.sources.corpus import preview, read_corpus, read_titles, skipped_files
from trawl.sources.judged_queries import read_judged_queries, relevant_documents
from trawl.sources.pageview_log import read_pageview_log
from trawl.sources.rank_file import read_pagerank, write_pagerank

LOG = [
    "en.wikipedia Tea 12 desktop 7 A1B2",
    "en.wikipedia Tea 12 mobile-web 3 C4",
    "de.wikipedia Tee 12 desktop 99 x",
    "en.wikipedia Short 25 desktop",
    "en.wikipedia Nobody null desktop 8 x",
    "en.wikipedia Bad x25 desktop 8 x",
    "en.wikipedia Bad 25 desktop many x",
    "en.wikipedia Bad 25 desktop 8.5 x",
    "  en.wikipedia\tTabs   25　desktop +5  ",
    "en.wikipedia Unknown 999 desktop 4 x",
    "en.wikipedia.org Other 25 desktop 6 x",
    "enxwikipedia Other 25 desktop 6 x",
    "Other en.wikipedia 25 desktop 6 x",
    "en.wikipedia Beyond 25 desktop 9223372036854775808 x",
    "",
]


@pytest.fixture
def titles(spark):
    return spark.createDataFrame([(12, "Tea"), (25, "Tabs"), (1000, "None")], "id long, title string")


def pairs(table):
    return sorted(tuple(r) for r in table.collect())


def test_pageviews_of_a_compressed_log(spark, titles, folder):
    with bz2.open(f"{folder}/log.bz2", "wt", encoding="utf-8") as out:
        out.write("\n".join(LOG) + "\n")
    lines = read_pageview_log(spark, f"{folder}/log.bz2")
    assert pairs(features.build_pageviews(lines, titles)) == [(12, 3), (25, 5)]
    assert pairs(features.build_pageviews(lines, titles, "sum")) == [(12, 10), (25, 5)]
    with pytest.raises(ValueError, match="mode"):
        features.build_pageviews(lines, titles, "first")


def test_long_numbers_are_read(spark, titles):
    lines = ["en.wikipedia Tea 000000000000000000012 desktop 9223372036854775807 x"]
    table = spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")
    assert pairs(features.build_pageviews(table, titles)) == [(12, 2**63 - 1)]


def test_later_files_win(spark, titles, folder):
    for name, views in (("a", 1), ("b", 2), ("c", 3)):
        with open(f"{folder}/{name}.txt", "w") as out:
            out.write(f"en.wikipedia Tea 12 desktop {views}0\nen.wikipedia Tea 12 desktop {views}\n")
    assert pairs(features.build_pageviews(read_pageview_log(spark, folder), titles)) == [(12, 3)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_look_ups_keep_order_and_repeats(spark, titles, monkeypatch, limit):
    monkeypatch.setattr(features, "BROADCAST_ROWS", limit)
    views = spark.createDataFrame([(12, 3), (25, 5)], "id long, views long")
    asked = spark.createDataFrame(
        [(1, ["12", "25", "1000", "999999999"]), (2, ["25", "x", "25", None]), (3, [])],
        "request_id int, ids array<string>",
    )
    for check in (False, True):
        found = features.lookup_pageviews(asked, views, check).orderBy("request_id", "pos").collect()
        assert [(r["request_id"], r["doc_id"], r["views"]) for r in found] == [
            (1, "12", 3),
            (1, "25", 5),
            (1, "1000", 0),
            (1, "999999999", 0),
            (2, "25", 5),
            (2, "x", 0),
            (2, "25", 5),
            (2, None, 0),
        ]
    ranks = spark.createDataFrame([(12, 1.5)], "id long, pagerank double")
    numbers = spark.createDataFrame([(1, [999, 12])], "request_id int, ids array<long>")
    found = features.lookup_pagerank(numbers, ranks).orderBy("pos").collect()
    assert [r["pagerank"] for r in found] == [0.0, 1.5]


def test_enrich(spark):
    results = spark.createDataFrame([(0, 1, 12), (0, 2, 13)], "query_id int, rank int, doc_id long")
    ranks = spark.createDataFrame([(12, 1.5)], "id long, pagerank double")
    views = spark.createDataFrame([(13, 9)], "id long, views long")
    for check in (False, True):
        rows = pairs(features.enrich(results, ranks, views, check))
        assert rows == [(0, 1, 12, 1.5, 0), (0, 2, 13, 0.0, 9)]


def test_titles_of_files_of_which_one_is_broken(spark, folder):
    columns = "id long, title string, text string"
    spark.createDataFrame([(1, "old", "x")], columns).coalesce(1).write.parquet(f"{folder}/c/a")
    spark.createDataFrame([(1, "new", "x"), (2, None, "x")], columns).coalesce(1).write.parquet(f"{folder}/c/b")
    os.makedirs(f"{folder}/c/z")
    with open(f"{folder}/c/z/part-0.parquet", "wb") as out:
        out.write(b"no parquet")
    parts = [f"{folder}/c/{name}" for name in "abz"]
    with pytest.raises(Exception, match="part-0.parquet"):
        read_titles(spark, *parts).collect()
    titles = features.build_titles(read_titles(spark, *parts, skip_unreadable=True), "row_order")
    assert pairs(titles) == [(1, "new"), (2, None)]
    skipped = skipped_files(spark, *parts).collect()
    assert [(os.path.basename(r["path"]), r["length"]) for r in skipped] == [("part-0.parquet", 10)]


def test_one_title_per_id(spark):
    pages = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, title string").coalesce(1)
    assert pairs(features.build_titles(pages)) == [(1, "b"), (2, "c")]


def test_a_corpus_read_from_files_decides_between_titles(spark, toy, folder):
    toy.coalesce(1).write.parquet(f"{folder}/a")
    toy.where("id = 1").withColumn("title", F.lit("newer")).write.parquet(f"{folder}/b")
    corpus = read_corpus(spark, f"{folder}/a", f"{folder}/b")
    assert corpus.count() == 5 and corpus.columns == [*toy.columns, "row_order"]
    titles = dict(pairs(features.build_titles(corpus, "row_order")))
    assert titles == {1: "newer", 2: "beta page", 3: "gamma alpha", 4: "delta page"}


def test_reading_a_missing_corpus_fails(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_corpus(spark, f"{folder}/nothing")


def test_preview(spark):
    table = spark.range(100).withColumn("square", F.col("id") * F.col("id"))
    rows = preview(table, seed=3).collect()
    assert [r["part"] for r in rows] == ["first"] * 3 + ["random"] * 5
    assert rows == preview(table, seed=3).collect()
    assert all(r["square"] == r["id"] ** 2 for r in rows)


def test_previews_are_the_same_however_rows_are_dealt_out(spark):
    table = spark.range(50).select("id", (F.col("id") % 3).alias("kind"))
    shown = [
        preview(t, seed=1, key=["id"], order="id").collect() for t in (table, table.repartition(7))
    ]
    assert shown[0] == shown[1] and [r["id"] for r in shown[0][:3]] == [0, 1, 2]
    assert shown[0] != preview(table, seed=2, key=["id"], order="id").collect()
    plan = preview(table, key=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Sort [" not in plan
    assert preview(table.where("false")).collect() == []


def test_later_logs_are_taken_in(spark):
    schema = "line_no long, line string"
    logs = [
        ["en.wikipedia a 1 desktop 5 x", "en.wikipedia b 2 desktop 6 x", "en.wikipedia a 1 desktop 7 x"],
        ["en.wikipedia b 2 desktop 1 x", "bad line"],
        [],
    ]
    known = None
    for number, lines in enumerate(logs):
        new = last_views(spark.createDataFrame(list(enumerate(lines)), schema), number)
        known = new if known is None else merge_views(known, new)
    assert sorted(tuple(r) for r in known.collect()) == [(1, 7, 0, 2), (2, 1, 1, 0)]
    # An earlier log that comes late changes no page of a later one.
    late = last_views(spark.createDataFrame([(9, "en.wikipedia b 2 desktop 99 x")], schema), 0)
    assert pairs(merge_views(known, late).select("id", "views")) == [(1, 7), (2, 1)]
    titles = spark.createDataFrame([(2, "two")], "id long, title string")
    assert pairs(titled_views(known, titles)) == [(2, 1)]


def test_a_look_up_of_few_ids_names_them_in_the_scan(spark, folder):
    feature = spark.range(1000).select("id", F.rand(1).alias("pagerank"))
    write_feature(feature, f"{folder}/ranks")
    stored = read_feature(spark, f"{folder}/ranks")
    asked = spark.createDataFrame([(1, ["3", "900", "x", "-5"])], "request_id int, ids array<string>")
    found = features.lookup_pagerank(asked, stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*In\(id, \[-5,3,900\]", plan), plan
    assert [r["pagerank"] > 0 for r in found.orderBy("pos").collect()] == [True, True, False, False]
    many = spark.createDataFrame([(1, [str(i) for i in range(0, 2000, 5)])], asked.schema)
    values = {r["doc_id"]: r["pagerank"] for r in features.lookup_pagerank(many, stored).collect()}
    plain = {str(r["id"]): r["pagerank"] for r in feature.collect()}
    assert values == {str(i): plain.get(str(i), 0.0) for i in range(0, 2000, 5)}


def test_a_feature_table_shows_its_latest_version(spark, folder):
    for value in (1, 2):
        write_feature(spark.range(3).withColumn("views", F.lit(value)), f"{folder}/views")
    rows = read_feature(spark, f"{folder}/views")
    assert rows.columns == ["id", "views"] and {r["views"] for r in rows.collect()} == {2}


def test_rank_file_round_trip(spark, folder):
    ranks = spark.createDataFrame([(i, 1.0 / (i % 50 + 1)) for i in range(500)], "id long, pagerank double")
    write_pagerank(ranks, f"{folder}/ranks")
    assert pairs(read_pagerank(spark, f"{folder}/ranks")) == pairs(ranks)
    rows = []
    for name in sorted(n for n in os.listdir(f"{folder}/ranks") if n.endswith(".csv.gz")):
        with gzip.open(f"{folder}/ranks/{name}", "rt") as lines:
            rows += [line.strip().split(",") for line in lines]
    assert rows == sorted(rows, key=lambda r: (-float(r[1]), int(r[0]))) and len(rows) == 500


def test_bad_rank_rows_are_dropped_and_the_last_wins(spark, folder):
    with gzip.open(f"{folder}/ranks.csv.gz", "wt") as out:
        out.write("1,0.5\n2\nx,3.0\n3,y\n4,0.25\n1,0.75\n5,1.5,more,fields\n")
    got = pairs(read_pagerank(spark, f"{folder}/ranks.csv.gz"))
    assert got == [(1, 0.75), (4, 0.25), (5, 1.5)]


def test_judged_queries(spark, folder):
    with open(f"{folder}/judged.json", "w") as out:
        json.dump({"green tea": ["12", "25"], "nothing": [], "odd": ["x", "7"]}, out)
    judged = read_judged_queries(spark, f"{folder}/judged.json")
    assert [(r["query_id"], r["query"]) for r in judged.collect()] == [
        (0, "green tea"),
        (1, "nothing"),
        (2, "odd"),
    ]
    assert pairs(relevant_documents(judged)) == [(0, "12"), (0, "25"), (2, "7"), (2, "x")]


def test_engine_from_build_to_answers(spark, toy, folder):
    log = ["en.wikipedia p 3 desktop 40 x", "en.wikipedia p 9 desktop 4 x"]
    lines = spark.createDataFrame(list(enumerate(log)), "line_no long, line string")
    build_engine(toy, lines, folder, body_min_df=0, buckets=3)
    engine = open_engine(spark, folder)
    query = spark.createDataFrame([(0, "alpha gamma")], "query_id long, query string")
    fused = engine.search(query)
    rows = engine.enrich(fused).orderBy("rank").collect()
    assert [(r["doc_id"], round(r["score"], 6), r["views"]) for r in rows] == [
        (3, 56.784548, 40),
        (1, 30.298486, 0),
        (2, 21.889626, 0),
        (9, 0.101476, 0),
    ]
    assert engine.search_body(query).count() == 3
    assert engine.search_title(query).count() == 2
    assert engine.search_anchor(query).count() == 3
    asked = spark.createDataFrame([(1, ["3", "9"])], "request_id int, ids array<string>")
    assert [r["views"] for r in engine.lookup_pageviews(asked).orderBy("pos").collect()] == [40, 0]
    assert engine.lookup_pagerank(asked).where("pagerank > 0").count() == 2


def test_a_grown_engine_equals_one_built_at_once(spark, toy, folder):
    log = ["en.wikipedia p 3 desktop 40 x", "en.wikipedia p 1 desktop 4 x"]
    later = ["en.wikipedia p 3 desktop 41 x", "en.wikipedia p 9 desktop 4 x"]
    schema = "line_no long, line string"
    lines = [spark.createDataFrame(list(enumerate(own)), schema) for own in (log, later)]
    build_engine(toy.where("id <= 2"), lines[0], f"{folder}/grown")
    grow_engine(spark, f"{folder}/grown", toy.where("id > 2"), lines[1])
    grown = open_engine(spark, f"{folder}/grown")
    query = spark.createDataFrame([(0, "alpha gamma")], "query_id long, query string")
    rows = grown.enrich(grown.search(query)).orderBy("rank").collect()
    assert [(r["doc_id"], round(r["score"], 6), r["views"]) for r in rows] == [
        (3, 56.784548, 41),
        (1, 30.298486, 4),
        (2, 21.889626, 0),
        (9, 0.101476, 0),
    ]
    assert pairs(grown.pageviews) == [(1, 4), (3, 41)]
    assert len(grown.index.body.segments) == 2


def test_a_page_that_comes_again_takes_on_its_new_title(spark, toy, folder):
    write_feature(features.build_titles(toy), f"{folder}/titles")
    again = toy.where("id = 1").withColumn("title", F.lit("omega page"))
    add_titles(spark, again, f"{folder}/titles")
    titles = dict(pairs(read_feature(spark, f"{folder}/titles")))
    assert titles == {1: "omega page", 2: "beta page", 3: "gamma alpha", 4: "delta page"}
