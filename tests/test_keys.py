"""Loops over keys: what they move, and keys that collide."""

import pytest
from pyspark.sql import functions as F

from tests import helpers
from tests.helpers import edge_frame
from videonet.operators import communities, influence, structure
from videonet.operators.keys import KeyedGraph
from videonet.operators.skew import hot_keys

HUBS = helpers.hub_graph()


def test_keys_that_collide_are_drawn_again(spark):
    tried = []

    def key(vertex_id, seed):
        tried.append(seed)
        return F.pmod(F.xxhash64(F.lit(seed), vertex_id), F.lit(40 if seed < 2 else 10**15))

    graph = KeyedGraph(edge_frame(spark, HUBS + [(None, "x"), ("y", None)]), key)
    assert max(tried) >= 2
    assert {r.id for r in graph.vertices.collect()} == set(helpers.nodes(HUBS))
    named = graph.named(graph.links("id", "other").select("id"))
    assert sorted(r.id for r in named.collect()) == sorted(a for a, _ in HUBS)


def test_components_move_numbers_only(spark, monkeypatch):
    """Names of vertices are read at the start and at the end; links between rounds are two numbers."""
    written, write = [], structure.write_through

    def noted(df, name):
        written.append((name, df.dtypes))
        return write(df, name)

    monkeypatch.setattr(structure, "write_through", noted)
    edges = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(40)]
    got = {r.id: r.component for r in structure.weak_components(edge_frame(spark, edges)).collect()}
    assert got == helpers.components(edges)
    links = [types for name, types in written if name == "links"]
    assert links and all(kind == "bigint" for types in links for _, kind in types)
    assert len(links) <= 2 * 12


@pytest.mark.parametrize("run", [
    lambda edges: communities.label_propagation(edges, 1), lambda edges: influence.pagerank(edges, max_iter=1)])
def test_messages_are_numbers(spark, monkeypatch, run):
    sent, send = [], communities.MessageRoutes.send

    def noted(self, state):
        rows = send(self, state)
        sent.append(dict(rows.dtypes))
        return rows

    monkeypatch.setattr(communities.MessageRoutes, "send", noted)
    assert run(edge_frame(spark, HUBS)).count() == len(helpers.nodes(HUBS))
    assert sent and "string" not in {kind for types in sent for kind in types.values()}


def test_hot_keys_are_those_of_many_rows(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") < 900, -F.col("id")).alias("k"))
    assert hot_keys(rows, "k", 1000) is None
    assert {(r.k, r._slices) for r in hot_keys(rows, "k", 100).collect()} == {(7, 5)}
