from __future__ import annotations

import pytest

from trawl.operators.indexing import anchor_links
from trawl.operators.links import link_edges, link_graph, pagerank
from trawl.session import use_checkpoint_dir


def ranks(table):
    return {r["id"]: r["pagerank"] for r in table.collect()}


def by_hand(edges, iterations):
    edges = set(edges)
    vertices = {v for edge in edges for v in edge}
    out = {v: [d for s, d in edges if s == v] for v in vertices}
    rank = dict.fromkeys(vertices, 1.0)
    for _ in range(iterations):
        received = dict.fromkeys(vertices, 0.0)
        for v, targets in out.items():
            for target in targets:
                received[target] += rank[v] / len(targets)
        rank = {v: 0.15 + 0.85 * received[v] for v in vertices}
    scale = len(vertices) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


def test_known_answer(toy_ranks):
    wanted = {1: 1.659438910, 2: 0.953308317, 3: 1.763620387, 4: 0.218818381, 9: 0.404814004}
    assert ranks(toy_ranks) == pytest.approx(wanted, abs=1e-9)


def test_graph_of_nested_anchor_lists(spark, toy):
    twice = toy.union(toy)
    edges, vertices = link_graph(anchor_links(twice))
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2), (1, 3), (2, 3), (3, 1), (4, 9)]
    assert sorted(tuple(r) for r in vertices.collect()) == [(1, 2), (2, 1), (3, 1), (4, 1), (9, 0)]


def test_self_links_are_kept(spark):
    links = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "src long, dst long, text string")
    assert [tuple(r) for r in link_edges(links).collect()] == [(1, 1)]


@pytest.mark.parametrize("links_per_block", [100_000, 10])
@pytest.mark.parametrize("iterations", [0, 1, 6])
def test_a_page_with_a_third_of_all_links(spark, links_per_block, iterations):
    edges = [(0, i) for i in range(1, 200)] + [(i, (i * 7) % 200) for i in range(1, 200)]
    edges += [(i, 0) for i in range(1, 200)]
    table = link_edges(spark.createDataFrame(edges, "src long, dst long"))
    got = ranks(pagerank(table, iterations=iterations, links_per_block=links_per_block))
    assert got == pytest.approx(by_hand(edges, iterations), abs=1e-9)
    assert sum(got.values()) == pytest.approx(200)


def test_many_heavy_pages_are_not_broadcast(spark, monkeypatch):
    from trawl.operators import links

    monkeypatch.setattr(links, "BROADCAST_ROWS", 0)
    edges = [(i, j) for i in range(20) for j in range(20) if (i + j) % 3]
    table = spark.createDataFrame(edges, "src long, dst long")
    assert ranks(pagerank(table, links_per_block=4)) == pytest.approx(by_hand(edges, 6), abs=1e-9)


def test_no_links(spark):
    assert pagerank(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_checkpoint_folder_of_the_session_is_kept(spark):
    use_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    use_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == before
