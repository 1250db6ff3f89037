"""Whole numbers in place of vertex ids, for steps that move edges many times."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from videonet.session import write_through


def hashed(vertex_id: Column, seed: int) -> Column:
    """The 64-bit key of an id."""
    return F.xxhash64(F.lit(seed), vertex_id)


def stored_pairs(edges: DataFrame) -> DataFrame:
    """The ends (src, dst) of all edges with both ends present, stored once."""
    return write_through(
        edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull()), "pairs", "zstd"
    )


class KeyedGraph:
    """Edges with both ends present, stored once, and a 64-bit key for each vertex.

    A key is a hash of the id, so edges get their keys without a join. The keys are
    checked to differ; where two ids share one, another seed is tried.
    """

    def __init__(self, edges: DataFrame, key: Callable[[Column, int], Column] | None = None):
        make = key or hashed
        self.pairs = stored_pairs(edges)
        ends = self.pairs.select(F.expr("stack(2, src, 1L, dst, 0L) AS (id, out_edges)"))
        vertices = ends.groupBy("id").agg(F.sum("out_edges").alias("out_edges"))
        for seed in count():
            # (id, out_edges, key) of all vertices; parallel edges count.
            self.vertices = write_through(vertices.withColumn("key", make(F.col("id"), seed)), "vertex-keys")
            shared = self.vertices.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            if shared.isEmpty():
                break
        self._key = lambda name: make(F.col(name), seed)

    def links(self, src: str, dst: str) -> DataFrame:
        """The keys of both ends of every edge, under the given names; duplicates kept."""
        return self.pairs.select(self._key("src").alias(src), self._key("dst").alias(dst))

    def named(self, rows: DataFrame) -> DataFrame:
        """Rows (id, ...) of vertex keys with the ids themselves."""
        names = self.vertices.select(F.col("key").alias("_key"), F.col("id").alias("_id"))
        named = rows.withColumnRenamed("id", "_key").join(names, "_key")
        return named.select(F.col("_id").alias("id"), *[c for c in rows.columns if c != "id"])
