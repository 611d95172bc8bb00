from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from tests.conftest import SAMPLE
from tests.llm.test_decontamination import plain as hits
from tests.llm.test_line_dedup import plain as without_lines
from tests.llm.test_ngram_join import plain as groups
from tests.test_registered import table
from trawl.llm import byte_bpe, quality_rules, registry

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SAMPLE):
        connection.execute(
            f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SAMPLE}/{file}'"
        )
    return connection


def test_queries_are_registered():
    assert {n for n in registered.queries() if n.startswith("op")} == {
        n for n in registry.queries() if n != "pipeline"
    }
    assert "pipeline" in registered.queries() and len(registry.queries()) == 14


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_against_its_statement(spark, database, name):
    frame = registered.queries()[name](spark, SAMPLE)
    result = database.execute(registered.oracle_sql()[name])
    wanted = table([d[0] for d in result.description], result.fetchall())
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == wanted


def test_pipeline_against_plain_stages(spark, database):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    model = quality_rules.fit_quality(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    verdicts = {r.doc_id: r.kept for r in quality_rules.judge_quality(docs, model).collect()}
    rows = [r for r in rows if verdicts[r[0]]]
    rows = [(i, text) for i, _, _, text in without_lines(rows, 10)]
    stays = {c for _, _, c in groups(rows, 5, 80)}
    rows = [r for r in rows if r[0] in stays]
    items = database.execute("SELECT item_id, text FROM benchmark").fetchall()
    encoder = byte_bpe.PairEncoder()
    wanted = {}
    for i, text in rows:
        if not hits(text, items, 10)[1]:
            wanted[i] = byte_bpe.hashlib.sha256(encoder.encode(text)).hexdigest()
        else:
            wanted[i] = None
    got = corpus_pipeline.run(spark, SAMPLE).collect()
    assert {r.doc_id for r in got} == set(wanted) and len(got) == len(wanted)
    for r in got:
        assert wanted[r.doc_id] in (None, r.ids_sha256)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"
    empty = docs.where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, empty, SAMPLE)
        assert empty.columns == docs.columns
        assert empty.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SAMPLE).collect() == []
