"""Strongly connected components against plain searches."""

import random

import pytest

from tests import helpers
from tests.helpers import edge_frame, hub_graph
from videonet.operators import strong

SLICES = [1_000_000, 3]


def mutual(edges):
    """Smallest vertex that reaches and is reached by each one."""
    back = [(b, a) for a, b in edges]
    return {v: min(set(helpers.distances(edges, v)[0]) & set(helpers.distances(back, v)[0])) for v in helpers.nodes(edges)}


def found(spark, edges, rows_per_slice=1_000_000):
    rows = strong.strong_components(edge_frame(spark, edges), rows_per_slice).collect()
    assert len(rows) == len({row.id for row in rows})
    return {row.id: row.component for row in rows}


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_hubs_tails_and_loops(spark, rows_per_slice):
    path = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(12)]
    edges = hub_graph() + path + [("p06", "p03"), ("p12", "n01"), ("q2", "q1"), ("q1", "q2"), ("z", "z")]
    assert found(spark, edges, rows_per_slice) == mutual(edges)


@pytest.mark.parametrize("seed,n,m", [(1, 60, 70), (2, 50, 90), (3, 30, 90)])
def test_random_graphs(spark, seed, n, m):
    rng = random.Random(seed)
    edges = [(f"v{rng.randrange(n):02d}", f"v{rng.randrange(n):02d}") for _ in range(m)]
    assert found(spark, edges) == mutual(edges)


def test_components_joined_by_dense_one_way_links(spark):
    """No vertex with one link in or out, so only the searches find anything."""
    groups = [[f"g{g}{i}" for i in range(5)] for g in range(4)]
    edges = [(a, b) for group in groups for a in group for b in group if a != b]
    edges += [(a, b) for g, group in enumerate(groups) for later in groups[:g] for a in group for b in later]
    assert found(spark, edges) == mutual(edges)


def test_no_edges_and_missing_ends(spark):
    assert found(spark, []) == {}
    assert found(spark, [("a", None), (None, "b")]) == {}
    assert found(spark, [("a", "a"), ("b", None)]) == {"a": "a"}


def test_rounds_do_not_follow_the_length_of_a_ring(spark, monkeypatch):
    n = 5000
    edges = [(f"r{i:04d}", f"r{(i + 1) % n:04d}") for i in range(n)] + [("r0100", "tail"), ("tail", "end")]
    rounds = []
    ends = strong._ends
    monkeypatch.setattr(strong, "_ends", lambda links: rounds.append(1) or ends(links))
    sends = []
    search = strong.MessageRoutes.send
    monkeypatch.setattr(strong.MessageRoutes, "send", lambda self, state: sends.append(1) or search(self, state))
    got = found(spark, edges)
    assert got.pop("tail") == "tail" and got.pop("end") == "end"
    assert set(got.values()) == {"r0000"} and len(got) == n
    assert len(rounds) + len(sends) < 200
