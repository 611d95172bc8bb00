"""The link graph and its PageRank."""

from __future__ import annotations

from typing import Optional

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.session import BROADCAST_ROWS, use_checkpoint_dir

# Fixed values of the rank computation.
RESET_PROBABILITY = 0.15
ITERATIONS = 6

# Out-links kept together in one row; a page with more has its links in several rows.
LINKS_PER_BLOCK = 100_000

# Iterations between two checkpoints.
CHECKPOINT_EVERY = 3


def link_edges(links: DataFrame) -> DataFrame:
    """Distinct ``src, dst`` of a table of links.

    Links of a page to itself are kept, links without a source or target are left out.
    """
    known = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return links.where(known).select("src", "dst").distinct()


def link_vertices(edges: DataFrame) -> DataFrame:
    """``id, out_degree`` of every end of an edge.

    This includes link targets that are no documents and leaves out pages without links.
    """
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("out")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")),
    )
    return edges.select(F.inline(ends)).groupBy("id").agg(F.sum("out").alias("out_degree"))


def link_graph(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(edges, vertices)`` of a table of links."""
    edges = link_edges(links)
    return edges, link_vertices(edges)


def _out_links(edges: DataFrame, heavy: Optional[DataFrame]) -> DataFrame:
    """Out-links as bounded arrays: ``id, block, out_degree, targets``."""
    if heavy is None:
        return (
            edges.groupBy(F.col("src").alias("id"))
            .agg(F.collect_list("dst").alias("targets"))
            .withColumn("out_degree", F.size("targets").cast("bigint"))
        )
    block = F.pmod(F.xxhash64("dst"), F.coalesce("blocks", F.lit(1))).cast("int")
    return (
        edges.join(heavy, edges["src"] == heavy["id"], "left")
        .groupBy(F.col("src").alias("id"), block.alias("block"))
        .agg(F.collect_list("dst").alias("targets"), F.first("out_degree").alias("of_heavy"))
        .withColumn("out_degree", F.coalesce("of_heavy", F.size("targets").cast("bigint")))
        .drop("of_heavy")
    )


def _iterate(
    ranks: DataFrame,
    vertices: DataFrame,
    out_links: DataFrame,
    heavy: Optional[DataFrame],
    reset: float,
) -> DataFrame:
    key = ["id"]
    if heavy is not None:  # a heavy page sends its rank to each of its blocks
        key = ["id", "block"]
        last = F.coalesce("blocks", F.lit(1)) - 1
        ranks = ranks.join(heavy.select("id", "blocks"), "id", "left").select(
            "id", "rank", F.explode(F.sequence(F.lit(0), last)).alias("block")
        )
    part = (F.col("rank") / F.col("out_degree")).alias("received")
    sent = ranks.join(out_links, key).select(F.explode("targets").alias("id"), part)
    nothing = vertices.select("id", F.lit(0.0).alias("received"))
    new_rank = reset + (1 - reset) * F.sum("received")
    return sent.unionByName(nothing).groupBy("id").agg(new_rank.alias("rank"))


def pagerank(
    edges: DataFrame,
    reset: float = RESET_PROBABILITY,
    iterations: int = ITERATIONS,
    links_per_block: int = LINKS_PER_BLOCK,
    checkpoint_every: int = CHECKPOINT_EVERY,
) -> DataFrame:
    """``id, pagerank`` after a fixed number of iterations over distinct ``src, dst`` edges.

    Every rank starts at 1; an iteration sets it to ``reset`` plus ``1 - reset`` times the rank
    received, a page passing equal parts of its rank to its targets. After the last iteration all
    ranks are scaled so that they sum to the number of vertices, which makes up for pages without
    out-links.

    Links are stored as bounded arrays per page, so an iteration joins ranks with pages, not with
    edges, and shuffles only the parts received, added up per task first. The computation runs
    when this is called, since the ranks are checkpointed on the way.
    """
    use_checkpoint_dir(edges.sparkSession)
    edges = edges.select("src", "dst").persist(StorageLevel.MEMORY_AND_DISK)
    vertices = link_vertices(edges).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [vertices, edges]
    try:
        heavy = _heavy_pages(vertices, links_per_block)
        # Kept as placed and sorted, out-links are neither shuffled nor sorted by an iteration.
        out_links = _out_links(edges, heavy).sortWithinPartitions("id")
        out_links = out_links.persist(StorageLevel.MEMORY_AND_DISK)
        kept.insert(0, out_links)
        ranks = vertices.select("id", F.lit(1.0).alias("rank"))
        for step in range(1, iterations + 1):
            ranks = _iterate(ranks, vertices, out_links, heavy, reset)
            if step == iterations or step % checkpoint_every == 0:
                ranks = ranks.checkpoint()
        n, total = ranks.agg(F.count(F.lit(1)), F.sum("rank")).first()
    finally:
        for table in kept:
            table.unpersist()
    scale = n / total if n else 1.0
    return ranks.select("id", (F.col("rank") * F.lit(scale)).alias("pagerank"))


def _heavy_pages(vertices: DataFrame, links_per_block: int) -> Optional[DataFrame]:
    """Pages with more links than go in a block, if any: ``id, out_degree, blocks``."""
    blocks = F.ceil(F.col("out_degree") / links_per_block).cast("int").alias("blocks")
    heavy = vertices.where(F.col("out_degree") > links_per_block).select(
        "id", "out_degree", blocks
    )
    n_heavy = heavy.count()
    if n_heavy == 0:
        return None
    return F.broadcast(heavy) if n_heavy <= BROADCAST_ROWS else heavy
