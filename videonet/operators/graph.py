"""Graph building blocks: edge forms, lookups and message routes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.operators.degree import vertex_set
from videonet.operators.search import by_category, latest_snapshot
from videonet.operators.skew import (
    ROWS_PER_SLICE,
    SLICE,
    copy_to_slices,
    hot_keys,
    spread_rows,
)
from videonet.sources.layout import EdgeLayout

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class VideoGraph:
    vertices: DataFrame
    edges: DataFrame


def vertices_in_edges(videos: DataFrame, edges: DataFrame) -> DataFrame:
    """Videos that are an endpoint of some edge."""
    return videos.join(vertex_set(edges), "id", "left_semi")


def build_graph(edges: DataFrame, videos: DataFrame | None = None) -> VideoGraph:
    """Vertices are all endpoints, or the videos among them when videos are given."""
    pairs = edges.select("src", "dst")
    if videos is None:
        return VideoGraph(vertex_set(edges), pairs)
    return VideoGraph(vertices_in_edges(videos, edges), pairs)


def weighted_edges(edges: DataFrame) -> DataFrame:
    """One row per (src, dst) with the number of parallel edges."""
    return (
        edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def simple_edges(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst) with both ends present."""
    return (
        edges.select("src", "dst")
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .distinct()
    )


def edges_of_category(edges: DataFrame, videos: DataFrame, category: str | None) -> DataFrame:
    """Edges whose source is in the category."""
    if not category:
        return edges
    sources = by_category(videos, category).select(F.col("id").alias("src"))
    return edges.join(sources, "src", "left_semi")


def induced_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with both ends among the vertices."""
    return edges.join(vertices.select(F.col("id").alias("src")), "src", "left_semi").join(
        vertices.select(F.col("id").alias("dst")), "dst", "left_semi"
    ).select(*edges.columns)


def incident_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with at least one end among the vertices; duplicates kept."""
    ids = vertices.select("id").distinct()
    as_src = ids.select(F.col("id").alias("src"), F.lit(True).alias("src_hit"))
    as_dst = ids.select(F.col("id").alias("dst"), F.lit(True).alias("dst_hit"))
    return (
        edges.join(as_src, "src", "left")
        .join(as_dst, "dst", "left")
        .filter(F.col("src_hit").isNotNull() | F.col("dst_hit").isNotNull())
        .select(*edges.columns)
    )


def enrich_metadata(
    result: DataFrame, videos: DataFrame, snapshots: DataFrame | None = None, key: str = "id"
) -> DataFrame:
    """Add category and uploader, and the latest metrics when snapshots are given.

    Missing texts become Unknown and missing numbers 0.
    """
    info = videos.select(F.col("id").alias(key), "category", "uploader")
    rows = result.join(info, key, "left").withColumns(
        {name: F.coalesce(name, F.lit(UNKNOWN)) for name in ("category", "uploader")}
    )
    if snapshots is None:
        return rows
    latest = latest_snapshot(snapshots).select(
        F.col("video_id").alias(key),
        F.col("rate").alias("rating"),
        "views",
        F.col("ratings").alias("ratings_count"),
    )
    return rows.join(latest, key, "left").withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in ("rating", "views", "ratings_count")}
    )


# Edges that one task of a round handles.
EDGES_PER_PARTITION = 2_000_000


def message_partitions(spark: SparkSession, num_edges: int, per_partition: int = EDGES_PER_PARTITION) -> int:
    """Partitions of the routes of so many edges."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(num_edges / per_partition))


class MessageRoutes:
    """Edges laid out once, for steps that send vertex state along them.

    The edges (sender, receiver, ...) stay cached, hash-partitioned by sender.
    Senders with very many edges are cut into slices, and their state is copied
    to each slice, so no task holds all edges of a hub. The number of partitions
    follows the number of edges; the state is shuffled to match this layout.
    With `weight`, parallel edges are counted under that name once they are laid
    out, so that all edges are shuffled once.
    """

    def __init__(
        self, edges: DataFrame, rows_per_slice: int = ROWS_PER_SLICE, weight: str | None = None,
        per_partition: int = EDGES_PER_PARTITION,
    ):
        partitions = message_partitions(edges.sparkSession, edges.count(), per_partition)
        self._hot = hot_keys(edges, "sender", rows_per_slice)
        # Without hubs there is one slice only: partitioned by it too, the edges would be shuffled in each round,
        # as Spark leaves a constant out of the keys of a join.
        keys = ["sender"] if self._hot is None else ["sender", SLICE]
        laid = spread_rows(edges, self._hot, "sender", ["receiver"]).repartition(partitions, *keys)
        if weight is not None:
            laid = laid.groupBy("sender", "receiver", SLICE).agg(F.count(F.lit(1)).alias(weight))
        self.edges = laid.sortWithinPartitions(*keys).persist()

    @classmethod
    def stored(cls, layout: EdgeLayout) -> MessageRoutes:
        """Routes (sender, receiver, weight) of a stored layout: parallel edges share a bucket, so nothing is shuffled."""
        routes = cls.__new__(cls)
        hot = layout.hot("src")
        routes._hot = None if hot is None else hot.withColumnRenamed("src", "sender")
        keys = ["sender"] if hot is None else ["sender", SLICE]
        routes.edges = (
            layout.by("src").groupBy("src", SLICE, "dst").agg(F.count(F.lit(1)).alias("weight"))
            .select(F.col("src").alias("sender"), F.col("dst").alias("receiver"), "weight", SLICE)
            .sortWithinPartitions(*keys)
            .persist()
        )
        # Adaptive execution knows the partitioning of a cached frame only once it is filled.
        routes.edges.count()
        return routes

    @property
    def has_hubs(self) -> bool:
        """Whether some sender is cut into slices."""
        return self._hot is not None

    def send(self, state: DataFrame) -> DataFrame:
        """Edges joined with the state (id, ...) of their sender."""
        out = copy_to_slices(state.withColumnRenamed("id", "sender"), self._hot, "sender")
        return self.edges.join(out, ["sender", SLICE]).drop(SLICE)

    def __enter__(self) -> MessageRoutes:
        return self

    def __exit__(self, *error) -> None:
        self.edges.unpersist()
