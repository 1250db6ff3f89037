"""Betweenness and closeness by breadth-first search from many pivots at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from videonet.operators.degree import degree_table, top_by_degree, vertex_set
from videonet.operators.graph import (
    MessageRoutes,
    enrich_metadata,
    induced_edges,
    simple_edges,
)
from videonet.operators.sampling import sample_n
from videonet.operators.search import check_limit
from videonet.operators.skew import ROWS_PER_SLICE
from videonet.session import cut_lineage, scratch_path


#: Registers of a sketch, as a power of two.
SKETCH_LG = 12


def top_degree_subgraph(edges: DataFrame, k: int = 100) -> DataFrame:
    """Distinct edges between the k videos of highest total degree."""
    # k rows, looked up for both ends: stored once.
    top = cut_lineage(top_by_degree(degree_table(edges), check_limit(k)).select("id"))
    return simple_edges(induced_edges(edges, top))


@dataclass
class ShortestPaths:
    """(pivot, id, dist, sigma) of all reached pairs, stored by distance; sigma counts the shortest paths."""

    reached: DataFrame
    depth: int

    def level(self, dist: int) -> DataFrame:
        """(pivot, id, sigma) at one distance; reads only that part of the table."""
        return self.reached.filter(F.col("dist") == dist).select("pivot", "id", "sigma")

    def table(self) -> DataFrame:
        return self.reached.select("pivot", "id", F.col("dist").cast("bigint").alias("dist"), "sigma")


def shortest_paths(
    edges: DataFrame, pivots: DataFrame, rows_per_slice: int = ROWS_PER_SLICE
) -> ShortestPaths:
    """Distances and numbers of shortest paths from every pivot, level by level.

    Each level is one join of its frontier with the edges. There is one state,
    spread over (pivot, id), and a level replaces it, so the reads of a level do
    not grow with the number of levels before it.
    """
    links = simple_edges(edges).select(
        F.col("src").alias("sender"), F.col("dst").alias("receiver")
    )
    # Path counts are doubles: they grow exponentially with the distance.
    state = cut_lineage(
        pivots.select(F.col("id").alias("pivot"), "id", F.lit(0).alias("dist"), F.lit(1.0).alias("sigma"))
    )
    dist = 0
    with MessageRoutes(links, rows_per_slice) as routes:
        while True:
            dist += 1
            sent = routes.send(state.filter(F.col("dist") == dist - 1).drop("dist")).select(
                "pivot", F.col("receiver").alias("id"), F.lit(dist).alias("dist"), "sigma"
            )
            known = F.col("dist") < dist
            state = cut_lineage(
                state.union(sent)
                .groupBy("pivot", "id")
                .agg(
                    F.min("dist").alias("dist"),
                    F.sum(F.when(known, F.col("sigma"))).alias("old"),
                    F.sum(F.when(~known, F.col("sigma"))).alias("new"),
                )
                .select("pivot", "id", "dist", F.coalesce("old", "new").alias("sigma"))
            )
            if state.filter(F.col("dist") == dist).isEmpty():
                break
    path = scratch_path(edges.sparkSession, "shortest-paths")
    state.write.partitionBy("dist").parquet(path)
    stored = edges.sparkSession.read.schema(state.schema).parquet(path)
    return ShortestPaths(stored, dist)


def _pivots(vertices: DataFrame, num_pivots: int | None, seed: int) -> DataFrame:
    """Vertices to search from. The number is required: the search holds up to one row per pivot and vertex."""
    if num_pivots is None:
        raise ValueError("give the number of pivots, or shortest paths that were searched before")
    return sample_n(vertices, check_limit(num_pivots), ["id"], seed)


def betweenness(
    edges: DataFrame,
    num_pivots: int | None = None,
    seed: int = 0,
    paths: ShortestPaths | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(id, betweenness) on the simple directed graph, normalised.

    `num_pivots` vertices are picked by hash and the sums scaled by n / num_pivots;
    with as many pivots as vertices the result is exact.
    """
    edges = cut_lineage(simple_edges(edges))
    vertices = cut_lineage(vertex_set(edges))
    n = vertices.count()
    if paths is None:
        paths = shortest_paths(edges, _pivots(vertices, num_pivots, seed), rows_per_slice)
    used = paths.level(0).count()
    scale = (1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0) * (n / used if used < n else 1.0)

    # Backwards: a vertex passes (1 + delta) / sigma to its predecessors, one level up.
    links = edges.select(F.col("dst").alias("sender"), F.col("src").alias("receiver"))
    parts: list[DataFrame] = []
    with MessageRoutes(links, rows_per_slice) as routes:
        below = paths.level(paths.depth - 1).withColumn("delta", F.lit(0.0))
        for dist in reversed(range(paths.depth - 1)):
            level = paths.level(dist)
            share = ((F.lit(1.0) + F.col("delta")) / F.col("sigma")).alias("share")
            got = (
                routes.send(below.select("pivot", "id", share))
                .groupBy("pivot", F.col("receiver").alias("id"))
                .agg(F.sum("share").alias("got"))
            )
            below = cut_lineage(
                level.join(got, ["pivot", "id"], "left").select(
                    "pivot",
                    "id",
                    "sigma",
                    (F.col("sigma") * F.coalesce("got", F.lit(0.0))).alias("delta"),
                )
            )
            parts.append(below)
    # The pivot itself does not lie between.
    inner = [part.filter(F.col("id") != F.col("pivot")).select("id", "delta") for part in parts]
    zero = vertices.select("id", F.lit(0.0).alias("delta"))
    total = reduce(DataFrame.union, inner, zero)
    return total.groupBy("id").agg((F.sum("delta") * scale).alias("betweenness"))


def closeness(
    edges: DataFrame,
    num_pivots: int | None = None,
    seed: int = 0,
    paths: ShortestPaths | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(id, closeness) from the distances towards each vertex.

    r / sum(d) * r / (n - 1), where r other vertices reach this one. With fewer
    pivots than vertices, r and the sum are scaled by n / num_pivots; a vertex
    that no pivot reaches is left out.
    """
    if paths is None:
        edges = cut_lineage(simple_edges(edges))
        vertices = cut_lineage(vertex_set(edges))
        paths = shortest_paths(edges, _pivots(vertices, num_pivots, seed), rows_per_slice)
    n, used = vertex_set(edges).count(), paths.level(0).count()
    sums = paths.table().groupBy("id").agg(
        F.count(F.lit(1)).alias("r"), F.sum("dist").alias("total"), F.min("dist").alias("nearest")
    )
    # The vertex itself, where it is a pivot, is at distance 0.
    near = (F.col("r") - (F.col("nearest") == 0).cast("int")) * F.lit(n / used if used < n else 1)
    total = F.col("total") * F.lit(n / used if used < n else 1)
    value = F.when(
        F.col("total") > 0, near / F.nullif(total, F.lit(0)) * near / F.lit(max(n - 1, 1))
    ).otherwise(0.0)
    return sums.select("id", value.alias("closeness"))


def closeness_sketched(
    edges: DataFrame, lg_registers: int = SKETCH_LG, max_rounds: int | None = None, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """(id, closeness) as `closeness` with all vertices as pivots, from one distinct-count sketch per vertex.

    The sketch of a vertex counts the vertices that reach it; each round adds the sketches of the senders of its
    links, so it counts those within one more step, and the growth of the counts gives the sum of distances. Only
    vertices whose count grew send in the next round. A vertex keeps a state of fixed size (at most
    2^lg_registers bytes), whatever the size of the graph; rounds go on until no count grows, or `max_rounds`, which
    leaves out longer distances.

    Counts are exact up to some hundreds of vertices. Beyond, they have a relative standard error of
    1.04 / sqrt(2^lg_registers), 1.6 % by default, and so has the number of vertices that reach one.
    """
    links = simple_edges(edges).select(F.col("src").alias("sender"), F.col("dst").alias("receiver"))
    links = cut_lineage(links)
    vertices = vertex_set(links.toDF("src", "dst"))
    own = F.hll_sketch_agg("id", lg_registers).alias("sketch")
    state = cut_lineage(
        vertices.groupBy("id").agg(own)
        .select("id", "sketch", F.lit(1).cast("bigint").alias("reached"), F.lit(0).cast("bigint").alias("total"),
                F.lit(True).alias("grew"))
    )
    rounds = 0
    with MessageRoutes(links, rows_per_slice) as routes:
        while max_rounds is None or rounds < max_rounds:
            rounds += 1
            sent = routes.send(state.filter("grew").select("id", "sketch")).select(F.col("receiver").alias("id"), "sketch")
            # Sketches for one receiver are united before they are shuffled.
            got = sent.groupBy("id").agg(F.hll_union_agg("sketch").alias("got"))
            united = F.when(F.col("got").isNull(), F.col("sketch")).otherwise(F.hll_union("sketch", "got"))
            now = F.greatest(F.hll_sketch_estimate(united), F.col("reached"))
            state = cut_lineage(
                state.join(got, "id", "left")
                .select("id", united.alias("sketch"), now.alias("reached"),
                        (F.col("total") + rounds * (now - F.col("reached"))).alias("total"),
                        (now > F.col("reached")).alias("grew"))
            )
            if state.filter("grew").isEmpty():
                break
    n = state.count()
    others, total = F.col("reached") - 1, F.col("total")
    value = F.when(total > 0, others / F.nullif(total, F.lit(0)) * others / F.lit(max(n - 1, 1))).otherwise(0.0)
    return state.select("id", value.alias("closeness"))


def degree_centrality(edges: DataFrame, k: int = 100) -> DataFrame:
    """Degrees inside the top-k subgraph; a member without edges there is left out."""
    return degree_table(top_degree_subgraph(edges, k))


def centrality_table(edges: DataFrame, videos: DataFrame, k: int = 100) -> DataFrame:
    """Degrees, betweenness, closeness and metadata in the top-k subgraph."""
    # At most k * k edges.
    subgraph = cut_lineage(top_degree_subgraph(edges, k))
    paths = shortest_paths(subgraph, vertex_set(subgraph))
    degrees = degree_table(subgraph).withColumnsRenamed(
        {"inDegree": "in_degree", "outDegree": "out_degree"}
    )
    rows = degrees.join(betweenness(subgraph, paths=paths), "id").join(
        closeness(subgraph, paths=paths), "id"
    )
    return enrich_metadata(rows, videos).withColumnRenamed("id", "video_id")


def top_by_metric(table: DataFrame, metric: str, k: int = 20) -> DataFrame:
    return table.orderBy(F.desc(metric), "video_id").limit(check_limit(k))
