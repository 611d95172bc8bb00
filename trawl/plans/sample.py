"""The engine's inputs as views over the sample tables.

The tables hold no titles, links, logs or judgements, so these are derived from whole tables:
a document's title is its first sentence, a line item links two documents, an event is a log line,
a click is a judgement, a benchmark text is a query and an order asks for three features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.sources.corpus import spread


class SampleViews:
    """Views over the Parquet tables in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    def _size_of(self, name: str) -> Column:
        return self.table(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    def documents(self) -> DataFrame:
        """``id, title, text, lang``."""
        return spread(self.table("documents")).select(
            F.col("doc_id").alias("id"), first_sentence(F.col("text")).alias("title"), "text", "lang"
        )

    def titles(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("id"), first_sentence(F.col("text")).alias("title")
        )

    def links(self) -> DataFrame:
        """``src, dst, text``: a tenth of the possible targets are no documents."""
        n = self._size_of("documents")
        pairs = spread(self.table("lineitem")).select(
            (F.col("l_orderkey") % n).alias("src"),
            (F.col("l_partkey") % F.floor(n * 1.1)).alias("dst"),
        )
        titles = self.titles().withColumnRenamed("id", "dst")
        text = F.coalesce("title", F.lit("missing page")).alias("text")
        return pairs.join(titles, "dst", "left").select("src", "dst", text)

    def linked_pages(self) -> DataFrame:
        """``id, anchor_text``: the links in the nested form of a corpus, one link per row."""
        anchor = F.struct(F.col("dst").alias("id"), "text")
        return self.links().select(F.col("src").alias("id"), F.array(anchor).alias("anchor_text"))

    def log_lines(self, long_numbers: bool = False) -> DataFrame:
        """``line, line_no``; on request with views of 19 digits and ids with zeros in front."""
        wanted = F.col("event_type").isin("view", "click")
        domain = F.when(wanted, "en.wikipedia").otherwise("de.wikipedia")
        no_id = F.get_json_object("props", "$.k") == "9"
        number, views = F.col("user_id").cast("string"), F.floor("value").cast("string")
        if long_numbers:
            number = F.concat(F.lit("00"), number)
            views = F.concat(F.lit("9"), F.lpad(views, 18, "0"))
        page_id = F.when(no_id, "null").otherwise(number)
        name = F.concat(F.lit("Page_"), F.col("user_id").cast("string"))
        line = F.concat_ws(" ", domain, name, page_id, F.lit("desktop"), views)
        return self.table("events").select(line.alias("line"), F.col("event_id").alias("line_no"))

    def queries(self) -> DataFrame:
        return self.table("benchmark").select(
            F.col("item_id").alias("query_id"), F.col("text").alias("query")
        )

    def qrels(self) -> DataFrame:
        """``query_id, doc_id``."""
        return (
            self.table("events")
            .where(F.col("event_type") == "click")
            .select(
                (F.col("user_id") % self._size_of("benchmark")).alias("query_id"),
                (F.col("event_id") % self._size_of("documents")).alias("doc_id"),
            )
        )

    def string_qrels(self) -> DataFrame:
        """As ``qrels``, with ids as strings and judgements of ids that are no numbers."""
        rows = self.qrels().select("query_id", F.col("doc_id").cast("string").alias("doc_id"))
        return rows.unionByName(
            rows.select("query_id", F.concat(F.lit("doc-"), "doc_id").alias("doc_id"))
        )

    def odd_queries(self) -> DataFrame:
        """Of every query an empty one, one of stop words, an unknown word, and the query twice."""
        forms = F.array(
            F.lit(""), F.lit("the of which"), F.lit("qqqunknown"), F.concat_ws(" ", "query", "query")
        )
        rows = self.queries().select("query_id", F.posexplode(forms).alias("form", "query"))
        return rows.select((F.col("query_id") * 4 + F.col("form")).alias("query_id"), "query")

    def requests(self) -> DataFrame:
        """``request_id, ids``: two numbers and a string that is none."""
        ids = F.array(
            F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus"
        )
        return self.table("orders").select(F.col("o_orderkey").alias("request_id"), ids.alias("ids"))

    def renamed_pages(self) -> DataFrame:
        """``id, title, row_order``: several titles per id."""
        return self.table("conversations").select(
            F.col("conv_id").alias("id"),
            first_sentence(F.col("text")).alias("title"),
            F.col("turn").alias("row_order"),
        )


def first_sentence(text: Column) -> Column:
    return F.substring_index(F.substring_index(text, "\n", 1), ".", 1)
