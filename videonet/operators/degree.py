"""Degrees of the directed multigraph. Edges are (src, dst) with duplicates kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDegree"))


def in_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDegree"))


def degree_table(edges: DataFrame) -> DataFrame:
    """id, outDegree, inDegree, total_degree of every vertex that has an edge.

    One scan and one shuffle, equal to the full outer join of both degrees. A
    null id never joins, so null sources and null targets stay separate rows.
    """
    ends = edges.select(
        F.expr("stack(2, src, 1L, 0L, dst, 0L, 1L) AS (id, out_edge, in_edge)")
    )
    null_side = F.when(F.col("id").isNull(), F.col("out_edge"))
    return (
        ends.groupBy("id", null_side.alias("null_side"))
        .agg(F.sum("out_edge").alias("outDegree"), F.sum("in_edge").alias("inDegree"))
        .select(
            "id",
            "outDegree",
            "inDegree",
            (F.col("outDegree") + F.col("inDegree")).alias("total_degree"),
        )
    )


def degree_summary(degrees: DataFrame) -> DataFrame:
    def zero_if_null(column):
        return F.coalesce(column, F.lit(0.0))

    return degrees.agg(
        F.count(F.lit(1)).alias("num_vertices"),
        zero_if_null(F.avg("total_degree")).alias("avg_total_degree"),
        zero_if_null(F.stddev("total_degree")).alias("std_total_degree"),
        F.coalesce(F.min("total_degree"), F.lit(0)).alias("min_total_degree"),
        F.coalesce(F.max("total_degree"), F.lit(0)).alias("max_total_degree"),
        zero_if_null(F.avg("outDegree")).alias("avg_out_degree"),
        F.coalesce(F.max("outDegree"), F.lit(0)).alias("max_out_degree"),
        zero_if_null(F.avg("inDegree")).alias("avg_in_degree"),
        F.coalesce(F.max("inDegree"), F.lit(0)).alias("max_in_degree"),
    )


def degree_histogram(degrees: DataFrame, bins: int = 20) -> DataFrame:
    """Vertices per exact total degree; the `bins` lowest degrees."""
    return (
        degrees.groupBy("total_degree")
        .agg(F.count(F.lit(1)).alias("num_vertices"))
        .orderBy("total_degree")
        .limit(bins)
    )


def describe_degrees(degrees: DataFrame) -> DataFrame:
    """count, mean, stddev, min and max of both degrees, one row per column."""
    columns = ["inDegree", "outDegree"]
    stats = degrees.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            function(name).alias(f"{label}_{name}")
            for name in columns
            for label, function in (
                ("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max)
            )
        ],
    )
    rows = ", ".join(
        f"'{name}', n, mean_{name}, std_{name}, min_{name}, max_{name}" for name in columns
    )
    return stats.select(
        F.expr(
            f"stack({len(columns)}, {rows}) AS"
            " (degree, num_vertices, mean, stddev, min_value, max_value)"
        )
    )


DEGREE_COLUMNS = {"total": "total_degree", "in": "inDegree", "out": "outDegree"}


def top_by_degree(degrees: DataFrame, k: int = 10, kind: str = "total") -> DataFrame:
    """An unknown kind means total."""
    column = DEGREE_COLUMNS.get(kind, "total_degree")
    return degrees.orderBy(F.desc(column), "id").limit(k)


def avg_total_degree(degrees: DataFrame) -> DataFrame:
    return degrees.agg(F.avg("total_degree").alias("avg_total_degree"))


def vertex_set(edges: DataFrame) -> DataFrame:
    """Distinct endpoints."""
    return edges.select(F.expr("stack(2, src, dst) AS (id)")).distinct()
