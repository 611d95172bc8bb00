from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ODD, documents
from trawl.llm.decontamination import decontaminate
from trawl.llm.line_dedup import drop_common_lines
from trawl.llm.substring_dedup import drop_repeated_passages

# Names such as the operators might use on the way to their results.
NAMES = "_place _text _id _own_place _cut place cut id _key _hex _drops _lines _kept _n_words _spans _items _found_0 __text"


@pytest.mark.parametrize("operator", ["lines", "passages", "benchmark"])
def test_columns_of_any_name_come_through(spark, operator):
    table = documents(spark, ODD).withColumns(
        {name: F.concat(F.lit(name), F.coalesce("text", F.lit(""))) for name in NAMES.split()}
    )
    items = spark.createDataFrame([(1, "and a line"), (2, "one")], "item_id bigint, text string")
    applied = {
        "lines": lambda docs: drop_common_lines(docs, min_docs=3),
        "passages": lambda docs: drop_repeated_passages(docs, window=3),
        "benchmark": lambda docs: decontaminate(docs, items, window=3),
    }[operator]
    plain, mine = applied(documents(spark, ODD)), applied(table)
    assert set(mine.columns) == set(plain.columns) | set(NAMES.split())
    key = lambda row: repr(tuple(row))
    assert sorted(map(key, mine.select(*plain.columns).collect())) == sorted(map(key, plain.collect()))
    before = sorted(map(key, table.select(*NAMES.split()).collect()))
    assert sorted(map(key, mine.select(*NAMES.split()).collect())) == before
