"""Graph algorithms against plain-Python answers, with and without sliced hubs."""

import random

import pytest
from pyspark.sql import functions as F

from tests import helpers
from tests.helpers import edge_frame, hub_graph
from videonet.operators import centrality, communities, influence, structure
from videonet.operators.degree import degree_table, vertex_set

SMALL = [("1", "2"), ("1", "2"), ("1", "3"), ("2", "3"), ("3", "1"), ("4", "3"), ("3", "5"), ("4", "4")]
HUBS = hub_graph()
# One value for "no hub is cut", one that cuts every vertex with more than 3 edges.
SLICES = [1_000_000, 3]


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_pagerank_known_values(spark):
    edges = edge_frame(spark, SMALL)
    one = {"1": .692771084, "2": .863453815, "3": 2.058232932, "4": .692771084, "5": .692771084}
    ten = {"1": .993637974, "2": .879940325, "3": 1.590111567, "4": .54267216, "5": .993637974}
    assert as_dict(influence.pagerank(edges, max_iter=1)) == pytest.approx(one, abs=1e-9)
    ranks = as_dict(influence.pagerank(edges, max_iter=10))
    assert ranks == pytest.approx(ten, abs=1e-9)
    assert sum(ranks.values()) == pytest.approx(5)


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_pagerank_on_hubs(spark, rows_per_slice):
    ranks = influence.pagerank(edge_frame(spark, HUBS), 0.2, 4, rows_per_slice=rows_per_slice)
    assert as_dict(ranks) == pytest.approx(helpers.pagerank(HUBS, 0.2, 4), abs=1e-9)


def test_pagerank_tolerance_stops_early_and_checks_arguments(spark):
    edges = edge_frame(spark, SMALL)
    loose = as_dict(influence.pagerank(edges, max_iter=50, tol=10.0))
    assert loose == pytest.approx(as_dict(influence.pagerank(edges, max_iter=1)), abs=1e-12)
    with pytest.raises(ValueError):
        influence.pagerank(edges, reset=1.0)
    with pytest.raises(ValueError):
        influence.pagerank(edges, max_iter=0)


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_push_gives_the_ranks_of_many_rounds(spark, rows_per_slice):
    edges = HUBS + [("n01", "dead end"), ("alone", "alone")]
    exact = helpers.pagerank(edges, 0.15, 300)
    for tol in (0.05, 0.002):
        got = as_dict(influence.pagerank_push(edge_frame(spark, edges), tol=tol, rows_per_slice=rows_per_slice))
        assert sum(got.values()) == pytest.approx(len(exact))
        assert sum(abs(got[v] - exact[v]) for v in exact) <= 2 * len(exact) * tol * 0.85 / 0.15


def test_push_sends_less_than_rounds_of_all(spark, monkeypatch):
    """The leaves of a star have nothing left after one round, while a ring goes on for long."""
    edges = [("x", "y"), ("y", "x")] + [(f"p{i:03d}", "end") for i in range(200)]
    sent = []
    send = influence.MessageRoutes.send

    def counted(self, state):
        rows = send(self, state)
        sent.append(rows.count())
        return rows

    monkeypatch.setattr(influence.MessageRoutes, "send", counted)
    pushed = as_dict(influence.pagerank_push(edge_frame(spark, edges), tol=0.001))
    push_rounds, pushes = len(sent), sum(sent)
    sent.clear()
    whole = as_dict(influence.pagerank(edge_frame(spark, edges), max_iter=push_rounds))
    assert pushed == pytest.approx(whole, abs=0.02)
    assert pushes == 200 + 2 * push_rounds and sum(sent) == 202 * push_rounds


def test_push_checks_arguments_and_convergence(spark):
    edges = edge_frame(spark, SMALL)
    for wrong in ({"tol": 0.0}, {"reset": 1.0}, {"max_iter": 0}):
        with pytest.raises(ValueError):
            influence.pagerank_push(edges, **wrong)
    with pytest.raises(RuntimeError):
        influence.pagerank_push(edges, tol=1e-9, max_iter=2)
    assert influence.pagerank_push(edge_frame(spark, [])).count() == 0


def test_normalized_pagerank(spark):
    ranks = as_dict(influence.pagerank_normalized(edge_frame(spark, SMALL), max_iter=100))
    pairs = helpers.simple(SMALL)
    vertices = helpers.nodes(pairs)
    out = {v: [b for a, b in pairs if a == v] for v in vertices}
    x = dict.fromkeys(vertices, 1 / 5)
    for _ in range(100):
        loose = sum(x[v] for v in vertices if not out[v])
        x = {
            v: 0.85 * (sum(x[a] / len(out[a]) for a, b in pairs if b == v) + loose / 5) + 0.15 / 5
            for v in vertices
        }
    assert ranks == pytest.approx(x, abs=1e-5)
    assert sum(ranks.values()) == pytest.approx(1)
    with pytest.raises(RuntimeError):
        influence.pagerank_normalized(edge_frame(spark, SMALL), max_iter=1)


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_label_propagation(spark, rows_per_slice):
    edges = HUBS + [("n01", "n01"), ("n02", "n02")]
    got = communities.label_propagation(edge_frame(spark, edges), 3, rows_per_slice)
    assert as_dict(got) == helpers.labels(edges, 3)


# Leaves at a hub and on a tree, two by two, with parallel edges, and loops.
LEAVES = (
    [(f"s{i}", "hub") for i in range(5)] + [("hub", "s0"), ("hub", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "t")]
    + [("t", "u"), ("t", "w")] + [("p1", "q1"), ("q2", "p2"), ("p3", "q3"), ("q3", "p3"), ("l", "l"), ("m", "m"), ("m", "x")]
)


@pytest.mark.parametrize("rows_per_slice", SLICES)
@pytest.mark.parametrize("rounds", [1, 2, 6])
def test_labels_of_leaves(spark, rounds, rows_per_slice):
    got = communities.label_propagation(edge_frame(spark, LEAVES), rounds, rows_per_slice)
    assert as_dict(got) == helpers.labels(LEAVES, rounds)


def test_leaves_send_in_the_first_round_only(spark, monkeypatch):
    sent, send = [], communities.MessageRoutes.send

    def noted(self, state):
        sent.append(state.count())
        return send(self, state)

    monkeypatch.setattr(communities.MessageRoutes, "send", noted)
    communities.label_propagation(edge_frame(spark, LEAVES), 3)
    neighbours = {}
    for a, b in LEAVES:
        neighbours.setdefault(a, set()).add(b)
        neighbours.setdefault(b, set()).add(a)
    inner = sum(len(others) > 1 or others == {v} for v, others in neighbours.items())
    assert sent == [len(neighbours), inner, inner]


def test_rounds_shuffle_votes_only(spark, monkeypatch):
    """Without hubs, labels come back to the partitions of the edges, so sending them shuffles nothing."""
    plans, send = [], communities.MessageRoutes.send

    def noted(self, state):
        rows = send(self, state)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    def steps(plan):
        """The plan's lines without what lies below its cached frames."""
        cached = None
        for line in plan.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            if cached is None or depth <= cached:
                cached = depth if "InMemoryTableScan" in line else None
                yield line

    monkeypatch.setattr(communities.MessageRoutes, "send", noted)
    # Else tables this small are sent to all tasks.
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        communities.label_propagation(edge_frame(spark, LEAVES), 3)
    finally:
        spark.conf.set(name, before)
    found = ["\n".join(steps(plan)) for plan in plans]
    assert len(found) == 3
    for plan in found:
        assert "Join" in plan and plan.count("InMemoryTableScan") == 2 and "Exchange" not in plan


def sparse_graph(n=60, seed=3):
    """Short chains and small trees with some parallel edges, where labels swing between two states for some rounds."""
    rng = random.Random(seed)
    names = [f"v{i:03d}" for i in range(n)]
    return [(rng.choice(names), rng.choice(names)) for _ in range(n - 10)] + [(names[0], names[1])] * 3 + LEAVES


@pytest.mark.parametrize("rounds, rows_per_slice", [(3, SLICES[0]), (4, SLICES[1]), (5, SLICES[0]), (7, SLICES[0])])
def test_labels_of_later_rounds(spark, rounds, rows_per_slice):
    edges = sparse_graph()
    got = communities.label_propagation(edge_frame(spark, edges), rounds, rows_per_slice)
    assert as_dict(got) == helpers.labels(edges, rounds)


def test_later_rounds_send_changed_votes_only(spark, monkeypatch):
    """Votes for the label of two rounds before are not sent again, and what was heard then is not shuffled."""
    edges, written, plans = sparse_graph(), [], []
    write, fill = communities.write_through, communities._filled

    def noted(df, name, *codec):
        stored = write(df, name, *codec)
        if name == "moved-votes":
            written.append(stored.count())
        return stored

    def filled(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return fill(df)

    monkeypatch.setattr(communities, "write_through", noted)
    monkeypatch.setattr(communities, "_filled", filled)
    communities.label_propagation(edge_frame(spark, edges), 6)
    labels = [{v: v for v in helpers.nodes(edges)}] + [helpers.labels(edges, n) for n in range(1, 6)]
    links = set(edges) | {(b, a) for a, b in edges}
    others = {v: {b for a, b in links if a == v} for v in labels[0]}
    leaves = {v for v, found in others.items() if len(found) == 1 and found != {v}}
    moved = [
        sum(a not in leaves and labels[n - 1][a] != labels[n - 3][a] for a, _ in links) for n in (3, 4, 5, 6)]
    assert written == moved and moved[1] < sum(a not in leaves for a, _ in links) / 2
    unions = [plan for plan in plans if "Union" in plan.split("InMemoryRelation")[0]]
    assert len(unions) == 4
    for plan in unions:
        assert "Exchange" not in plan.split("Union")[0]


def test_labels_where_keys_collide(spark):
    tried = []

    def key(vertex_id, seed):
        tried.append(seed)
        return F.pmod(F.xxhash64(F.lit(seed), vertex_id), F.lit(40 if seed < 2 else 10**15))

    got = communities.label_propagation(edge_frame(spark, HUBS + LEAVES), 3, key=key)
    assert max(tried) >= 2
    assert as_dict(got) == helpers.labels(HUBS + LEAVES, 3)


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_components(spark, rows_per_slice):
    path = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(30)]
    edges = path[:12] + path[13:] + HUBS + [("z1", "z1"), ("z3", "z2")]
    got = structure.weak_components(edge_frame(spark, edges), rows_per_slice)
    assert as_dict(got) == helpers.components(edges)
    assert structure.component_count(got).first()[0] == len(set(helpers.components(edges).values()))


def test_strong_connection(spark):
    cycle = [("a", "b"), ("b", "c"), ("c", "a")]
    assert structure.strongly_connected(edge_frame(spark, cycle))
    assert not structure.strongly_connected(edge_frame(spark, cycle + [("a", "d")]))
    assert not structure.strongly_connected(edge_frame(spark, cycle + [("x", "y"), ("y", "x")]))
    assert not structure.strongly_connected(edge_frame(spark, cycle + [("x", "x")]))
    assert structure.strongly_connected(edge_frame(spark, [("a", "a")]))


@pytest.mark.parametrize("rows_per_slice", SLICES)
def test_centrality(spark, rows_per_slice):
    edges = edge_frame(spark, HUBS)
    paths = centrality.shortest_paths(edges, vertex_set(edges), rows_per_slice)
    between = as_dict(centrality.betweenness(edges, paths=paths, rows_per_slice=rows_per_slice))
    assert between == pytest.approx(helpers.betweenness(HUBS), abs=1e-9)
    close = as_dict(centrality.closeness(edges, paths=paths))
    assert close == pytest.approx(helpers.closeness(HUBS), abs=1e-9)


def test_betweenness_of_a_path(spark):
    edges = edge_frame(spark, [("1", "2"), ("2", "3"), ("3", "4")])
    third = pytest.approx(1 / 3)
    assert as_dict(centrality.betweenness(edges, 4)) == {"1": 0, "2": third, "3": third, "4": 0}
    two = edge_frame(spark, [("1", "2")])
    assert as_dict(centrality.betweenness(two, 9)) == {"1": 0.0, "2": 0.0}
    with pytest.raises(ValueError):
        centrality.betweenness(edges)


def test_long_path_is_searched_with_one_state(spark):
    """Each level replaces the state, so a plan never refers to more than one earlier level."""
    edges = edge_frame(spark, [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)])
    paths = centrality.shortest_paths(edges, spark.createDataFrame([("000",)], "id string"))
    assert paths.depth == 41
    assert sorted((r.id, r.dist) for r in paths.table().collect()) == [(f"{i:03d}", i) for i in range(41)]
    assert structure.strongly_connected(edge_frame(spark, [(f"{i:03d}", f"{(i + 1) % 40:03d}") for i in range(40)]))


def test_closeness_from_sketches(spark):
    """Exact where counts are small; within the stated error, and some more, where they are not."""
    edges = helpers.edge_frame(spark, HUBS)
    assert as_dict(centrality.closeness_sketched(edges)) == pytest.approx(helpers.closeness(HUBS), abs=1e-9)
    assert as_dict(centrality.closeness_sketched(edges, rows_per_slice=3)) == pytest.approx(
        helpers.closeness(HUBS), abs=1e-9)
    large = sorted({(f"v{i}", f"v{(i * m + 1) % 3000}") for i in range(3000) for m in (2, 3)})
    exact = helpers.closeness(large)
    got = as_dict(centrality.closeness_sketched(helpers.edge_frame(spark, large)))
    errors = [abs(got[v] - exact[v]) / exact[v] for v in exact if exact[v]]
    assert set(got) == set(exact) and max(errors) < 0.12 and sum(errors) / len(errors) < 0.04
    one_step = as_dict(centrality.closeness_sketched(edges, max_rounds=1))
    n = len(one_step)
    senders = {}
    for a, b in set(HUBS):
        if a != b:
            senders.setdefault(b, set()).add(a)
    assert one_step == pytest.approx({v: len(senders.get(v, ())) / (n - 1) for v in one_step})
    assert centrality.closeness_sketched(edges.limit(0)).count() == 0


def test_sampled_closeness(spark):
    edges = edge_frame(spark, HUBS)
    n = len(helpers.nodes(HUBS))
    exact, sampled = as_dict(centrality.closeness(edges, n)), as_dict(centrality.closeness(edges, n // 2, seed=3))
    assert exact == pytest.approx(helpers.closeness(HUBS), abs=1e-9)
    assert set(sampled) <= set(exact) and max(sampled.values()) > 0


def test_sampled_pivots_scale_the_sum(spark):
    edges = edge_frame(spark, HUBS)
    n = len(helpers.nodes(HUBS))
    sampled = as_dict(centrality.betweenness(edges, num_pivots=n // 2, seed=3))
    assert set(sampled) == set(helpers.nodes(HUBS)) and max(sampled.values()) > 0


def test_reciprocity_and_summary(spark):
    edges = [("1", "2"), ("2", "1"), ("2", "3"), ("2", "3")]
    assert structure.reciprocity(edge_frame(spark, edges)).first().reciprocity == pytest.approx(2 / 3)
    loop = structure.reciprocity(edge_frame(spark, [("1", "1"), ("1", "2")])).first()
    assert (loop.num_edges, loop.num_mutual, loop.reciprocity) == (2, 0, 0.0)
    summary = structure.graph_summary(edge_frame(spark, edges)).first()
    assert (summary.num_nodes, summary.num_edges) == (3, 3)
    assert summary.density == pytest.approx(0.5) and summary.avg_degree == pytest.approx(2.0)


def test_percentiles_and_quartiles_with_many_equal_scores(spark):
    scores = [1.0] * 20 + [2.0, 3.0, 3.0, 5.0, 8.0] * 2
    rows = [(f"v{i:02d}", float(s)) for i, s in enumerate(scores)]
    ranks = spark.createDataFrame(rows, "id string, pagerank double")
    got = {r.id: r.percentile for r in influence.pagerank_percentile(ranks, rows_per_slice=4).collect()}
    want = {i: sum(s < score for s in scores) / (len(scores) - 1) for i, score in rows}
    assert got == pytest.approx(want)
    videos = spark.createDataFrame([(i, "x") for i, _ in rows], "id string, category string")
    row = influence.pagerank_quartiles(ranks, videos).first()
    assert (row.num_rows, row.min_rank, row.q1, row.median_rank, row.q3, row.max_rank) == (
        30, 1.0, 1.0, 1.0, 2.75, 8.0
    )


def test_degrees(spark):
    rows = degree_table(edge_frame(spark, HUBS)).collect()
    assert sum(r.outDegree for r in rows) == sum(r.inDegree for r in rows) == len(HUBS)
    got = degree_table(edge_frame(spark, [("a", "a"), ("a", None), (None, "a"), (None, None)]))
    table = sorted((r.id or "", r.outDegree, r.inDegree, r.total_degree) for r in got.collect())
    # As in an outer join, null sources and null targets do not meet.
    assert table == [("", 0, 2, 2), ("", 2, 0, 2), ("a", 2, 2, 4)]
