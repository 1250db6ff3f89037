"""Whole-graph properties: components, connectivity, reciprocity, summary."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from videonet.operators.degree import degree_table, vertex_set
from videonet.operators.graph import MessageRoutes, enrich_metadata, simple_edges
from videonet.operators.keys import KeyedGraph
from videonet.operators.skew import ROWS_PER_SLICE, SLICE, copy_to_slices, hot_keys, sliced_join, spread_rows
from videonet.session import cut_lineage, write_through


def _at_parents(links: DataFrame, end: str, other: str, parents: DataFrame, rows_per_slice: int) -> DataFrame:
    """Links whose `end` is replaced by its parent where it has one; those that then join a vertex to itself are dropped."""
    hot = hot_keys(links, end, rows_per_slice)
    above = copy_to_slices(parents.withColumnRenamed("id", end), hot, end)
    moved = F.coalesce("parent", end).alias(end)
    return (
        spread_rows(links, hot, end, [other]).join(above, [end, SLICE], "left")
        .select(moved, other).filter(F.col(end) != F.col(other))
    )


def _roots(links: DataFrame, turn: int, rows_per_slice: int) -> DataFrame:
    """(id, parent): the root of every vertex that hangs on its first neighbour, directly or over others.

    First is by the id with some bits turned. Paths are halved until all end at a root.
    """
    a, b = F.col("a").bitwiseXOR(F.lit(turn)), F.col("b").bitwiseXOR(F.lit(turn))
    low = F.least(a, b)
    parents = write_through(
        links.select(F.greatest(a, b).alias("id"), low.alias("low")).groupBy("id").agg(F.min("low").alias("low"))
        .select(*[F.col(c).bitwiseXOR(F.lit(turn)).alias(n) for c, n in (("id", "id"), ("low", "parent"))]),
        "parents",
    )
    while True:
        hot = hot_keys(parents, "parent", rows_per_slice)
        above = copy_to_slices(parents.select(F.col("id").alias("parent"), F.col("parent").alias("above")), hot, "parent")
        halved = write_through(
            spread_rows(parents, hot, "parent", ["id"]).join(above, ["parent", SLICE], "left")
            .select("id", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")),
            "parents",
        )
        parents = halved.select("id", "parent")
        if halved.filter("moved").isEmpty():
            return parents


def weak_components(edges: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(id, component): the smallest vertex id of the weakly connected component.

    In each round every vertex hangs on the first of its neighbours before it, if
    there is one, in an order that each round draws anew; the trees that arise are
    merged into their roots, and links go on between roots. Of a vertex with a link,
    half the orders make something else its root, so the rounds grow with the
    logarithm of the graph size, not with its diameter. Vertices and links are
    64-bit keys; the smallest id is looked up once at the end.
    """
    graph = KeyedGraph(edges)
    links = graph.links("a", "b").filter("a <> b")
    turns = random.Random(0)
    merged = []
    while not links.isEmpty():
        parents = _roots(links, turns.getrandbits(64) - (1 << 63), rows_per_slice)
        merged.append(parents)
        for end, other in (("a", "b"), ("b", "a")):
            links = write_through(_at_parents(links, end, other, parents, rows_per_slice), "links")
    vertices = graph.vertices.select("id", "key")
    if not merged:
        return vertices.select("id", F.col("id").alias("component"))

    def looked_up(rows, key, other, roots):
        found = roots.select(F.col("id").alias(key), F.col("parent").alias("root"))
        rows = sliced_join(rows, found, key, [other], how="left", rows_per_slice=rows_per_slice)
        return rows.withColumn("root", F.coalesce("root", key))

    roots = merged.pop()
    while merged:
        before = looked_up(merged.pop(), "parent", "id", roots)
        roots = write_through(before.select("id", F.col("root").alias("parent")).union(roots), "roots")
    rooted = write_through(looked_up(vertices, "key", "id", roots).select("id", "root"), "rooted")
    lows = write_through(rooted.groupBy("root").agg(F.min("id").alias("component")), "lows")
    return sliced_join(rooted, lows, "root", ["id"], rows_per_slice=rows_per_slice).select("id", "component")


def component_count(components: DataFrame) -> DataFrame:
    return components.agg(F.countDistinct("component").alias("num_components"))


def _reached(edges: DataFrame, start: str, rows_per_slice: int) -> int:
    """Number of vertices reachable from `start`; edges are (sender, receiver).

    One state (id, level) is replaced in each round, so a round reads each vertex
    once; rounds grow with the distance of the farthest vertex.
    """
    state = edges.sparkSession.range(1).select(F.lit(start).alias("id"), F.lit(0).alias("level"))
    level = 0
    with MessageRoutes(edges, rows_per_slice) as routes:
        while True:
            level += 1
            sent = routes.send(state.filter(F.col("level") == level - 1).select("id"))
            state = cut_lineage(
                state.union(sent.select("receiver", F.lit(level)))
                .groupBy("id").agg(F.min("level").alias("level"))
            )
            if state.filter(F.col("level") == level).isEmpty():
                return state.count()


def strongly_connected(edges: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> bool:
    """Whether every vertex reaches every other one.

    A vertex without an in- or out-edge answers no at once; otherwise all
    vertices must be reachable from the smallest one forwards and backwards.
    """
    pairs = simple_edges(edges).filter(F.col("src") != F.col("dst")).persist()
    try:
        totals = degree_table(simple_edges(edges)).agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("start")
        ).first()
        if totals.n == 0:
            raise ValueError("connectivity is not defined for an empty graph")
        if totals.n == 1:
            return True
        inner = degree_table(pairs).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.least("inDegree", "outDegree")).alias("low")
        ).first()
        if inner.n < totals.n or inner.low == 0:
            return False
        for sender, receiver in (("src", "dst"), ("dst", "src")):
            links = pairs.select(F.col(sender).alias("sender"), F.col(receiver).alias("receiver"))
            if _reached(links, totals.start, rows_per_slice) < totals.n:
                return False
        return True
    finally:
        pairs.unpersist()


def reciprocity(edges: DataFrame) -> DataFrame:
    """Share of the distinct edges whose reverse exists; self-loops never count as mutual.

    Both directions of a pair meet in one group, so one shuffle is enough.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    pairs = (
        edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy(low.alias("low"), high.alias("high"))
        .agg(
            F.max((F.col("src") <= F.col("dst")).cast("bigint")).alias("there"),
            F.max((F.col("src") > F.col("dst")).cast("bigint")).alias("back"),
        )
    )
    num_edges = F.sum(F.col("there") + F.col("back"))
    mutual = F.sum(2 * F.col("there") * F.col("back"))
    return pairs.agg(
        num_edges.alias("num_edges"),
        mutual.alias("num_mutual"),
        F.try_divide(mutual.cast("double"), num_edges).alias("reciprocity"),
    )


def graph_summary(edges: DataFrame) -> DataFrame:
    """Nodes, distinct edges, density and average degrees."""
    totals = degree_table(simple_edges(edges)).agg(
        F.count(F.lit(1)).alias("num_nodes"),
        F.coalesce(F.sum("outDegree"), F.lit(0)).alias("num_edges"),
    )
    n, m = F.col("num_nodes").cast("double"), F.col("num_edges").cast("double")
    zero = F.lit(0.0)
    return totals.select(
        "num_nodes",
        "num_edges",
        F.when(n > 1, F.try_divide(m, n * (n - 1))).otherwise(zero).alias("density"),
        F.coalesce(F.try_divide(2 * m, n), zero).alias("avg_degree"),
        F.coalesce(F.try_divide(m, n), zero).alias("avg_in_degree"),
        F.coalesce(F.try_divide(m, n), zero).alias("avg_out_degree"),
    )


def top_nodes(edges: DataFrame, k: int = 5) -> DataFrame:
    """Highest degree in the simple graph."""
    return (
        degree_table(simple_edges(edges))
        .select("id", F.col("total_degree").alias("degree"))
        .orderBy(F.desc("degree"), "id")
        .limit(k)
    )


def node_attributes(
    edges: DataFrame,
    videos: DataFrame,
    snapshots: DataFrame,
    ranks: DataFrame,
    size_per_degree: int = 3,
) -> DataFrame:
    """Metadata, latest metrics, degrees, rank and display size of every vertex."""
    degrees = degree_table(simple_edges(edges)).select(
        "id",
        F.col("inDegree").alias("in_degree"),
        F.col("outDegree").alias("out_degree"),
        F.col("total_degree").alias("degree"),
    )
    rows = enrich_metadata(degrees, videos, snapshots).join(ranks, "id", "left")
    size = F.greatest(F.lit(10), F.least(F.lit(30), F.col("degree") * size_per_degree))
    return rows.withColumn("size", size)
