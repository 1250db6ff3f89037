"""PageRank and reports built on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from videonet.operators.degree import degree_table
from videonet.operators.graph import (
    UNKNOWN,
    MessageRoutes,
    enrich_metadata,
    simple_edges,
)
from videonet.operators.keys import KeyedGraph
from videonet.operators.ranks import cumulative_counts, group_quantiles
from videonet.operators.search import check_limit, latest_snapshot
from videonet.operators.skew import ROWS_PER_SLICE, sliced_join
from videonet.session import cut_lineage
from videonet.sources.layout import EdgeLayout

ROUNDS_PER_CHECKPOINT = 5


def _check(reset: float, max_iter: int) -> None:
    if not 0 < reset < 1:
        raise ValueError(f"reset probability must be between 0 and 1, got {reset}")
    if max_iter < 1:
        raise ValueError(f"need at least one iteration, got {max_iter}")


def _layout(weighted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Routes of the messages, and all vertices with their number of out-edges."""
    routes = weighted.select(
        F.col("src").alias("sender"), F.col("dst").alias("receiver"), "weight"
    )
    ends = weighted.select(F.expr("stack(2, src, weight, dst, 0L) AS (id, out_edges)"))
    return routes, ends.groupBy("id").agg(F.sum("out_edges").alias("out_edges"))


@contextmanager
def _routes_and_vertices(
    edges: DataFrame | EdgeLayout, rows_per_slice: int
) -> Iterator[tuple[MessageRoutes, DataFrame, Callable[[DataFrame], DataFrame]]]:
    """Routes of the multigraph and its vertices (id, out_edges), both cached within the block, and a step that
    gives rows the ids of the vertices: those of a frame of edges go by keys within the block."""
    if isinstance(edges, EdgeLayout):
        vertices = edges.vertices().select("id", F.col("outDegree").alias("out_edges")).persist()
        with MessageRoutes.stored(edges) as routes:
            yield routes, vertices, lambda rows: rows
        vertices.unpersist()
        return
    graph = KeyedGraph(edges)
    vertices = graph.vertices.select(F.col("key").alias("id"), "out_edges").persist()
    with MessageRoutes(graph.links("sender", "receiver"), rows_per_slice, weight="weight") as routes:
        yield routes, vertices, graph.named
    vertices.unpersist()


def _round(routes: MessageRoutes, state: DataFrame, vertices: DataFrame) -> DataFrame:
    """(id, out_edges, got): sum of the received shares, 0 for a vertex that receives none.

    The vertices join the messages as rows without a share, so one shuffle does
    both the sum and the lookup of out_edges.
    """
    share = F.col("rank") * F.col("weight") / F.col("out_edges")
    sent = routes.send(state).select(
        F.col("receiver").alias("id"), F.lit(0).cast("bigint").alias("out_edges"),
        share.alias("got"),
    )
    silent = vertices.select("id", "out_edges", F.lit(0.0).alias("got"))
    return sent.union(silent).groupBy("id").agg(
        F.max("out_edges").alias("out_edges"), F.sum("got").alias("got")
    )


def pagerank(
    edges: DataFrame | EdgeLayout,
    reset: float = 0.15,
    max_iter: int = 10,
    tol: float | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(id, pagerank) on the multigraph; the ranks add up to the number of vertices.

    All vertices start at 1 and parallel edges count. With `tol` the rounds stop
    once no rank moves by more than `tol`; max_iter remains the upper bound.
    A stored layout is read as it is: no edge is shuffled.
    """
    _check(reset, max_iter)
    with _routes_and_vertices(edges, rows_per_slice) as (routes, vertices, named):
        state = vertices.withColumn("rank", F.lit(1.0))
        for step in range(1, max_iter + 1):
            before = state
            state = _round(routes, state, vertices).select(
                "id",
                "out_edges",
                (F.lit(reset) + F.lit(1 - reset) * F.col("got")).alias("rank"),
            )
            if tol is not None or step % ROUNDS_PER_CHECKPOINT == 0 or step == max_iter:
                state = cut_lineage(state)
            if tol is not None:
                old = before.select("id", F.col("rank").alias("old"))
                moved = state.join(old, "id").agg(
                    F.max(F.abs(F.col("rank") - F.col("old")))
                )
                if (moved.first()[0] or 0.0) <= tol:
                    break
    scale = state.agg(F.count(F.lit(1)) / F.sum("rank")).scalar()
    return named(state.select("id", (F.col("rank") * scale).alias("pagerank")))


def pagerank_push(
    edges: DataFrame | EdgeLayout,
    reset: float = 0.15,
    tol: float = 0.001,
    max_iter: int = 200,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(id, pagerank) as `pagerank` after endless rounds; only vertices with something left to tell send.

    What a vertex has received and not yet sent on is its residual. In each round
    those with more than `tol` add it to their rank and send its share along their
    edges; the others stay silent and keep it, however many rounds go on elsewhere.
    When nobody has more than `tol`, all the mass still to come is at most
    n * tol * (1 - reset) / reset, and so is the summed error of the ranks before
    they are scaled to add up to the number of vertices. The same holds after
    scaling with a factor of two. Fails when max_iter rounds do not reach that.
    """
    _check(reset, max_iter)
    if not tol > 0:
        raise ValueError(f"the tolerance must be positive, got {tol}")
    loud = F.col("residual") > tol / 4
    with _routes_and_vertices(edges, rows_per_slice) as (routes, vertices, named):
        state = vertices.withColumns({"rank": F.lit(0.0), "residual": F.lit(float(reset))})
        for _ in range(max_iter):
            senders = state.filter(loud & (F.col("out_edges") > 0)).select("id", "out_edges", "residual")
            share = (1 - reset) * F.col("residual") * F.col("weight") / F.col("out_edges")
            sent = routes.send(senders).select(
                F.col("receiver").alias("id"), F.lit(0).cast("bigint").alias("out_edges"),
                F.lit(0.0).alias("rank"), share.alias("residual"))
            kept = state.select(
                "id", "out_edges", F.when(loud, F.col("rank") + F.col("residual")).otherwise(F.col("rank")).alias("rank"),
                F.when(loud, 0.0).otherwise(F.col("residual")).alias("residual"))
            state = cut_lineage(kept.union(sent).groupBy("id").agg(
                F.max("out_edges").alias("out_edges"), F.max("rank").alias("rank"), F.sum("residual").alias("residual")))
            if state.filter(F.col("residual") > tol).isEmpty():
                break
        else:
            raise RuntimeError(f"no convergence within {max_iter} iterations")
    ranks = state.select("id", (F.col("rank") + F.col("residual")).alias("rank"))
    scale = ranks.agg(F.count(F.lit(1)) / F.sum("rank")).scalar()
    return named(ranks.select("id", (F.col("rank") * scale).alias("pagerank")))


def pagerank_normalized(
    edges: DataFrame,
    alpha: float = 0.85,
    max_iter: int = 20,
    tol: float = 1e-6,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(id, pagerank) on the simple graph; ranks add up to 1.

    The rank of vertices without out-edges is spread evenly. Stops when the
    summed change is below n * tol and fails when max_iter does not reach that.
    """
    _check(alpha, max_iter)
    pairs = simple_edges(edges).withColumn("weight", F.lit(1).cast("bigint")).persist()
    links, vertices = _layout(pairs)
    vertices = vertices.persist()
    n = vertices.count()
    state = vertices.withColumn("rank", F.lit(1.0 / max(n, 1)))
    done = n == 0
    with MessageRoutes(links, rows_per_slice) as routes:
        for _ in range(max_iter):
            if done:
                break
            old = state.select("id", F.col("rank").alias("old"))
            step = cut_lineage(_round(routes, state, vertices).join(old, "id"))
            # What was not received is the rank of the vertices without out-edges.
            received = step.agg(F.sum("got")).first()[0]
            even = (alpha * (1.0 - received) + 1.0 - alpha) / n
            step = step.withColumn("rank", F.lit(alpha) * F.col("got") + F.lit(even))
            change = step.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
            state = step.select("id", "out_edges", "rank")
            done = change < n * tol
    vertices.unpersist()
    pairs.unpersist()
    if not done:
        raise RuntimeError(f"no convergence within {max_iter} iterations")
    return state.select("id", F.col("rank").alias("pagerank"))


def top_pagerank(ranks: DataFrame, k: int = 50) -> DataFrame:
    return ranks.orderBy(F.desc("pagerank"), "id").limit(check_limit(k))


def rank_with_snapshot(ranks: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Ranks with the latest views and category; videos without snapshot are dropped."""
    latest = latest_snapshot(snapshots).select(
        F.col("video_id").alias("id"), "views", "category"
    )
    return ranks.join(latest, "id").select(
        F.col("id").alias("video_id"), "pagerank", "views", "category"
    )


def influence_report(
    ranks: DataFrame, snapshots: DataFrame, edges: DataFrame, k: int = 10
) -> DataFrame:
    """Top k ranked videos with latest views, category and edge counts."""
    top = rank_with_snapshot(ranks, snapshots).orderBy(F.desc("pagerank"), "video_id")
    top = top.limit(check_limit(k))
    degrees = degree_table(edges).withColumnRenamed("id", "video_id")
    return top.join(degrees, "video_id", "left")


def pagerank_by_category(ranks: DataFrame, videos: DataFrame) -> DataFrame:
    return (
        enrich_metadata(ranks, videos)
        .groupBy("category")
        .agg(F.avg("pagerank").alias("avg_pagerank"), F.count(F.lit(1)).alias("num_videos"))
        .orderBy(F.desc("avg_pagerank"), "category")
    )


def pagerank_percentile(
    ranks: DataFrame, digits: int = 6, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Share of the other vertices with a lower rank, compared at `digits` digits."""
    scores = ranks.withColumn("score", F.round("pagerank", digits))
    below = cumulative_counts(scores, "score")
    total = ranks.agg(F.count(F.lit(1))).scalar()
    share = F.when(total > 1, F.col("below") / F.greatest(total - 1, F.lit(1))).otherwise(0.0)
    return sliced_join(
        scores,
        below.select("score", "below"),
        "score",
        by=["id"],
        counts=below.select("score", F.col("num_rows").alias("n")),
        rows_per_slice=rows_per_slice,
    ).select("id", "pagerank", share.alias("percentile"))


def influence_correlation(ranks: DataFrame, snapshots: DataFrame, edges: DataFrame) -> DataFrame:
    """Correlation and trend line of rank against views and against total degree."""
    rows = rank_with_snapshot(ranks, snapshots).join(
        degree_table(edges).select(F.col("id").alias("video_id"), "total_degree"), "video_id"
    )
    rows = rows.withColumns(
        {name: F.col(name).cast("double") for name in ("views", "total_degree")}
    )
    return rows.agg(
        F.corr("pagerank", "views").alias("corr_views"),
        F.regr_slope("pagerank", "views").alias("slope_views"),
        F.regr_intercept("pagerank", "views").alias("intercept_views"),
        F.corr("pagerank", "total_degree").alias("corr_degree"),
        F.regr_slope("pagerank", "total_degree").alias("slope_degree"),
        F.regr_intercept("pagerank", "total_degree").alias("intercept_degree"),
    )


def pagerank_quartiles(ranks: DataFrame, videos: DataFrame, digits: int = 6) -> DataFrame:
    """Minimum, quartiles and maximum of the rank per category, exact at `digits` digits."""
    rows = ranks.join(videos.select("id", "category"), "id", "left").select(
        F.coalesce("category", F.lit(UNKNOWN)).alias("category"),
        F.round("pagerank", digits).alias("pagerank"),
    )
    return group_quantiles(
        rows, "category", "pagerank", {"min_rank": 0.0, "q1": 0.25, "median_rank": 0.5,
                                       "q3": 0.75, "max_rank": 1.0}
    )
