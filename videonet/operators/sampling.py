"""Samples that stay the same when a task runs again.

Rows are chosen by a hash of their key and a seed, not by a random generator
that depends on the order of the rows. Rows with equal keys share their fate.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from videonet.operators.degree import degree_table, out_degree, vertex_set
from videonet.operators.graph import incident_edges, induced_edges, simple_edges
from videonet.operators.search import check_limit
from videonet.session import cut_lineage

EDGE_KEY = ["src", "dst", "crawl_id"]


def sample_hash(key: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def sample_fraction(df: DataFrame, fraction: float, key: list[str], seed: int) -> DataFrame:
    """Each key is kept with the given probability."""
    if fraction >= 1:
        return df
    bound = F.lit(f"{int(fraction * 16**12):012x}")
    return df.filter(F.substring(sample_hash(key, seed), 1, 12) < bound)


def sample_up_to(df: DataFrame, size: int, key: list[str], seed: int) -> DataFrame:
    """About `size` rows: a fraction size / total, or the whole frame if it is smaller."""
    # Decimals: the product of a 48-bit position and a row count exceeds 64 bits.
    total = df.agg(F.count(F.lit(1)).cast("decimal(20,0)")).scalar()
    position = F.conv(F.substring(sample_hash(key, seed), 1, 12), 16, 10).cast("decimal(15,0)")
    return df.filter(position * total < F.lit(Decimal(size * 16**12)))


def sample_limit(df: DataFrame, n: int, key: list[str], seed: int = 0) -> DataFrame:
    """n rows in hash order."""
    return df.orderBy(sample_hash(key, seed), *key).limit(n)


def sample_n(df: DataFrame, n: int, key: list[str], seed: int) -> DataFrame:
    """Exactly n random rows, or all if there are fewer."""
    return sample_limit(df, n, key, seed)


def hub_subgraph(edges: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Edges among n videos around the n / 2 largest senders.

    Takes up to 5 n random edges that touch a hub; where no edge has a sender,
    2 n random edges. Of their ends the hubs are kept first, then those with most
    of these edges. Returns no rows when there are no edges; see `hub_videos`.
    """
    check_limit(n)
    hubs = out_degree(edges).filter(F.col("id").isNotNull())
    hubs = hubs.orderBy(F.desc("outDegree"), "id").limit(max(n // 2, 1)).select("id")
    # Few rows, read several times: stored once.
    hubs = cut_lineage(hubs)
    if hubs.isEmpty():
        near = sample_n(edges, 2 * n, EDGE_KEY, seed)
    else:
        near = sample_n(incident_edges(edges, hubs), 5 * n, EDGE_KEY, seed)
    near = cut_lineage(near)
    ends = near.select(F.explode(F.array("src", "dst")).alias("id")).filter(F.col("id").isNotNull())
    members = (
        ends.groupBy("id").agg(F.count(F.lit(1)).alias("links"))
        .join(hubs.withColumn("hub", F.lit(1)), "id", "left")
        .orderBy(F.coalesce("hub", F.lit(0)).desc(), F.desc("links"), "id")
        .limit(n)
    )
    return induced_edges(near, members.select("id"))


def hub_videos(edges: DataFrame, videos: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """(id): the ends of the hub subgraph; where it has no edge, random videos, shown as isolated vertices."""
    ends = cut_lineage(vertex_set(hub_subgraph(edges, n, seed)).filter(F.col("id").isNotNull()))
    return fallback_videos(videos, n, seed).select("id") if ends.isEmpty() else ends


def fallback_videos(videos: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Random videos."""
    return sample_n(videos, n, ["id"], seed)


def top_connected_subgraph(edges: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Distinct edges among the n highest-degree vertices of 3 n random edges."""
    check_limit(n)
    sample = cut_lineage(sample_n(edges, 3 * n, EDGE_KEY, seed))
    distinct = simple_edges(sample)
    members = degree_table(distinct).orderBy(F.desc("total_degree"), "id").limit(n)
    return induced_edges(distinct, members.select("id"))
