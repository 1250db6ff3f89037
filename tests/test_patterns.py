"""Patterns, samples and joins against brute force on graphs with hubs."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import edge_frame, hub_graph, id_frame, nodes, pairs_sharing
from videonet.operators import graph, patterns, sampling
from videonet.operators.skew import sliced_join

HUBS = hub_graph(seed=5, n=30, m=180)


def paths(edges, hops):
    found = [(a, b) for a, b in edges]
    for _ in range(hops - 1):
        found = [p + (b,) for p in found for a, b in edges if a == p[-1]]
    return sorted(found)


def tuples(df):
    return [tuple(row) for row in df.collect()]


@pytest.mark.parametrize("hops, limit", [(1, 30), (2, 1), (2, 47), (3, 200), (4, 1000)])
def test_first_paths(spark, hops, limit):
    got = patterns.path_matches(edge_frame(spark, HUBS), hops, limit)
    assert sorted(tuples(got)) == paths(HUBS, hops)[:limit]


def test_paths_with_conditions(spark):
    even = [n for n in nodes(HUBS) if int(n[1:]) % 2 == 0]
    got = patterns.path_matches(
        edge_frame(spark, HUBS), 2, 100, {0: id_frame(spark, even), 2: id_frame(spark, even)}
    )
    want = [p for p in paths(HUBS, 2) if p[0] in even and p[2] in even][:100]
    assert sorted(tuples(got)) == want


def test_common_recommendations(spark):
    triples = sorted(
        (c, a, b) for a, c in HUBS for b, d in HUBS if c == d and a < b
    )
    edges = edge_frame(spark, HUBS)
    for limit in (1, 40, 1000):
        got = patterns.common_recommendations(edges, max_results=limit)
        assert sorted((r[2], r[0], r[1]) for r in got.collect()) == triples[:limit]
    counts = {r.id: r.num_triples for r in patterns.common_counts_by_target(edges).collect()}
    assert sum(counts.values()) == len(triples)


def test_chain_counts(spark):
    edges = edge_frame(spark, HUBS)
    chains = paths(HUBS, 2)
    bridges = {r.id: r.num_chains for r in patterns.chain_counts_by_bridge(edges).collect()}
    starts = {r.id: r.num_chains for r in patterns.chain_counts_by_start(edges).collect()}
    assert sum(bridges.values()) == sum(starts.values()) == len(chains)
    assert all(bridges[b] == sum(p[1] == b for p in chains) for b in bridges)


@pytest.mark.parametrize(
    "least, rows_per_slice, limit", [(1, 10_000, 10**6), (2, 10_000, 10**6), (2, 2, 7), (3, 2, 10**6)]
)
def test_common_pairs(spark, monkeypatch, least, rows_per_slice, limit):
    monkeypatch.setattr(patterns, "SOURCES_AT_FIRST", 8)
    got = patterns.common_pairs(
        edge_frame(spark, HUBS), least, max_results=limit, rows_per_slice=rows_per_slice
    )
    want = sorted(pairs_sharing(HUBS, least).items())[:limit]
    assert [((r[0], r[1]), r[2]) for r in got.collect()] == want


def test_common_pairs_of_two_targets_that_everyone_links_to(spark):
    edges = [(f"s{i:04d}", target) for i in range(3000) for target in ("hub1", "hub2")]
    got = patterns.common_pairs(edge_frame(spark, edges), 2, max_results=4000).collect()
    assert [tuple(r) for r in got] == [
        (f"s{a:04d}", f"s{b:04d}", 2) for a in range(3) for b in range(a + 1, 3000)
    ][:4000]


def test_listings_beyond_a_thousand_rows(spark):
    edges = [(f"a{i:02d}", "hub") for i in range(60)] + [("hub", f"c{i:02d}") for i in range(60)]
    frame = edge_frame(spark, edges)
    want = [(f"a{i:02d}", "hub", f"c{j:02d}") for i in range(60) for j in range(60)]
    assert sorted(tuples(patterns.chains(frame, max_results=2500))) == want[:2500]
    triples = [(f"a{i:02d}", f"a{j:02d}", "hub") for i in range(60) for j in range(i + 1, 60)]
    assert sorted(tuples(patterns.common_recommendations(frame, max_results=1500))) == triples[:1500]


def test_counts_above_64_bit_products(spark):
    """Weights whose pairs a double or a 64-bit product cannot hold."""
    from videonet.operators import patterns as module

    weights = [("a", "t", 100_000_000), ("b", "t", 50_000_000), ("c", "t", 1), ("d", "u", 4 * 10**9), ("e", "u", 4 * 10**9)]
    original = module.weighted_edges
    module.weighted_edges = lambda edges: spark.createDataFrame(weights, "src string, dst string, weight long")
    try:
        got = {r.id: int(r.num_triples) for r in module.common_counts_by_target(None).collect()}
    finally:
        module.weighted_edges = original
    total, squares = 150_000_001, 100_000_000**2 + 50_000_000**2 + 1
    assert got == {"t": (total * total - squares) // 2, "u": 16 * 10**18}


def test_many_hot_keys_are_all_cut(spark):
    """1,500 keys of 40 rows at 10 rows a slice: all are listed, and no slice holds more rows than its share."""
    from videonet.operators.skew import SLICE, hot_slices, spread_rows

    rows = spark.range(60_000).select((F.col("id") % 1500).cast("string").alias("k"), "id")
    hot = hot_slices(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", rows_per_slice=10)
    assert hot.count() == 1500
    spread = spread_rows(rows, hot, "k", ["id"])
    assert spread.groupBy("k", SLICE).count().agg(F.max("count")).first()[0] < 30


def test_motif_links(spark):
    edges = edge_frame(spark, HUBS)
    got = sorted(tuples(patterns.motif_links(edges, [("a", "b"), ("c", "b"), ("b", "d")], max_results=10**6)))
    assert got == sorted((a, b, c, d) for a, b in HUBS for c, x in HUBS if x == b for y, d in HUBS if y == b)
    loops = sorted(tuples(patterns.motif_links(edges, [("a", "b"), ("b", "a")], max_results=10**6)))
    assert loops == sorted((a, b) for a, b in HUBS for c, d in HUBS if (c, d) == (b, a))
    with pytest.raises(ValueError):
        patterns.motif_links(edges, [("a", "b"), ("c", "d")])


def test_column_names_of_long_chains():
    assert [patterns.letters(i) for i in (0, 25, 26, 27, 52)] == ["a", "z", "aa", "ab", "ba"]


def test_common_pairs_forms_no_pairs_at_a_hub(spark):
    # 300 sources share one target and each has one of its own.
    edges = [(f"s{i:03d}", "hub") for i in range(300)] + [(f"s{i:03d}", f"t{i:03d}") for i in range(300)]
    edges += [("s000", "x"), ("s001", "x")]
    got = patterns.common_pairs(edge_frame(spark, edges), 2).collect()
    assert [tuple(r) for r in got] == [("s000", "s001", 2)]


def test_common_pairs_sets_hubs_aside(spark, monkeypatch):
    edges = [(f"s{i:03d}", "hub") for i in range(300)] + [("s000", "x"), ("s001", "x")]
    formed, write = [], patterns.write_through

    def counted(frame, name):
        frame = write(frame, name)
        if name == "met-pairs":
            formed.append(frame.count())
        return frame

    monkeypatch.setattr(patterns, "write_through", counted)
    assert [tuple(r) for r in patterns.common_pairs(edge_frame(spark, edges), 2).collect()] == [("s000", "s001", 2)]
    assert sum(formed) == 1


@pytest.mark.parametrize("least", [1, 2, 3])
def test_all_common_pairs(spark, least):
    got = patterns.common_pairs(edge_frame(spark, HUBS), least, max_results=None).collect()
    assert [((r[0], r[1]), r[2]) for r in got] == sorted(pairs_sharing(HUBS, least).items())


def test_limits_are_checked(spark):
    edges = edge_frame(spark, HUBS)
    with pytest.raises(ValueError):
        patterns.common_pairs(edges, 0)
    with pytest.raises(ValueError):
        patterns.chains(edges, max_results=0)
    with pytest.raises(ValueError):
        patterns.path_matches(edges, 0, 10)


def test_incident_and_induced_edges(spark):
    some = nodes(HUBS)[:8]
    edges, ids = edge_frame(spark, HUBS), id_frame(spark, some)
    either = [(a, b) for a, b in HUBS if a in some or b in some]
    both = [(a, b) for a, b in HUBS if a in some and b in some]
    assert sorted(tuples(graph.incident_edges(edges, ids).select("src", "dst"))) == sorted(either)
    assert sorted(tuples(graph.induced_edges(edges, ids).select("src", "dst"))) == sorted(both)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_equals_join(spark, how):
    rows = [("hot", i) for i in range(60)] + [(None, i) for i in range(9)]
    rows += [(f"k{i % 7}", i) for i in range(30)]
    fact = spark.createDataFrame(rows, "k string, x int")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), (None, 4)], "k string, y int")
    want = sorted(map(str, fact.join(dim, "k", how).collect()))
    got = sliced_join(fact, dim, "k", by=["x"], how=how, rows_per_slice=10)
    assert sorted(map(str, got.select("k", "x", "y").collect())) == want


def test_samples_do_not_depend_on_the_layout(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    spread = rows.repartition(13)
    for sample in (
        lambda df: sampling.sample_fraction(df, 0.1, ["id"], 4),
        lambda df: sampling.sample_up_to(df, 500, ["id"], 4),
        lambda df: sampling.sample_n(df, 500, ["id"], 4),
    ):
        first = {r.id for r in sample(rows).collect()}
        assert first == {r.id for r in sample(spread).collect()}
        assert 400 < len(first) < 600
    assert sampling.sample_fraction(rows, 1.0, ["id"], 1).count() == 5000
    assert sampling.sample_up_to(rows, 10**6, ["id"], 1).count() == 5000


def test_hub_subgraph_is_bounded(spark):
    edges = edge_frame(spark, HUBS)
    got = sampling.hub_subgraph(edges, 10).collect()
    assert len({v for r in got for v in (r.src, r.dst)}) <= 10
    empty = edges.filter(F.lit(False))
    assert sampling.hub_subgraph(empty, 10).count() == 0
    videos = id_frame(spark, [f"v{i}" for i in range(30)])
    assert sampling.hub_videos(empty, videos, 10).count() == 10


def test_hub_subgraph_keeps_its_hubs(spark):
    # Hubs have the last ids, so an order by id would drop them.
    edges = edge_frame(spark, [(f"z{h}", f"a{i:03d}") for h in range(5) for i in range(100)] + [("z0", "z1")])
    got = sampling.hub_subgraph(edges, 10).collect()
    assert {r.src for r in got} == {f"z{h}" for h in range(5)}
