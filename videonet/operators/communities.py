"""Label propagation and reports on the communities it finds."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from videonet.functions.labels import community_size_class
from videonet.operators.graph import MessageRoutes, enrich_metadata, message_partitions
from videonet.operators.keys import hashed, stored_pairs
from videonet.operators.ranks import in_order
from videonet.operators.skew import ROWS_PER_SLICE, SLICE, copy_to_slices, hot_keys, spread_rows
from videonet.session import cut_lineage, write_through

ROUNDS_PER_CHECKPOINT = 5

# Votes that one task of a round handles: the rounds cache much, which leaves little memory for a task's tables of counts.
VOTES_PER_PARTITION = 500_000


def _keyed_vertices(vertices: DataFrame, partitions: int, key: Callable[[Column, int], Column]) -> tuple[DataFrame, int]:
    """(key, id, place) of all vertices, cached in partitions of their keys, and the seed under which no two share one."""
    for seed in count():
        # The key is made again behind the shuffle, which so moves ids and places only.
        made = key(F.col("id"), seed)
        keyed = _filled(vertices.repartition(partitions, made).select(made.alias("key"), "id", "place"))
        if keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return keyed, seed
        keyed.unpersist()


def _filled(df: DataFrame) -> DataFrame:
    """The frame, cached and filled: adaptive execution knows the partitioning of a cached frame only then."""
    df.persist().count()
    return df


def label_propagation(
    edges: DataFrame, max_iter: int = 5, rows_per_slice: int = ROWS_PER_SLICE,
    key: Callable[[Column, int], Column] = hashed,
) -> DataFrame:
    """(id, label) after synchronous rounds of taking the most frequent neighbour label.

    Edges count in both directions, each parallel edge votes, a self-loop votes
    twice. Ties take the smallest label.

    Vertices travel as 64-bit keys, labels as places in the order of ids, which decide ties as
    the ids do. Edges, vertices and labels lie in the same partitions of keys, so a round
    shuffles its votes only, unless hubs are cut into slices. A leaf, which has one other
    vertex as its only neighbour, votes for what that vertex had two rounds before. So leaves
    send in the first round alone; later that vertex gives their votes itself. From the third
    round on, a vertex takes back its vote of two rounds before and gives the new one only where
    these differ: synchronous rounds soon swing between two states, so few votes are sent.
    """
    pairs = stored_pairs(edges)
    vertices = pairs.select(F.expr("stack(2, src, dst) AS (id)")).distinct()
    places = in_order(vertices, "id", "place")
    partitions = message_partitions(edges.sparkSession, 2 * pairs.count(), VOTES_PER_PARTITION)
    keyed, seed = _keyed_vertices(places, partitions, key)
    links = pairs.select(*[key(F.col(end), seed).alias(end) for end in ("src", "dst")])
    votes = links.select(F.expr("stack(2, src, dst, dst, src) AS (sender, receiver)"))
    with MessageRoutes(votes, rows_per_slice, weight="votes", per_partition=VOTES_PER_PARTITION) as routes:
        # Else each round that is planned before the edges are cached would lay them out again.
        routes.edges.count()

        def votes_of(senders: DataFrame) -> DataFrame:
            """(id, votes) of the receivers with the columns of the senders."""
            # The two numbers without a pattern side by side are what shuffle files compress best.
            columns = [c for c in senders.columns if c != "id"]
            return routes.send(senders).withColumnRenamed("receiver", "id").select("id", *columns, "votes")

        def received(sent: DataFrame) -> DataFrame:
            # Votes go both ways, so without hubs no vertex receives very many: one shuffle serves both
            # groupings and leaves the labels where the edges of their vertices are.
            return sent if routes.has_hubs else sent.repartition(partitions, "id")

        alone = (F.count(F.lit(1)) == 1) & (F.max("sender") != F.max("receiver"))
        leaves = routes.edges.groupBy(F.col("sender").alias("key")).agg(alone.alias("leaf"))
        # `before` and `older` are the labels of the last round but one and but two, `held` the votes of the
        # leaves at the vertex.
        state = _filled(keyed.join(leaves, "key").select(
            F.col("key").alias("id"), F.col("place").alias("label"), F.col("place").alias("before"),
            F.col("place").alias("older"), F.lit(0).cast("bigint").alias("held"), "leaf"))
        # By round: (id, label, votes) of the senders that are no leaves, cached for the next round but one.
        heard_in: dict[int, DataFrame] = {}
        for step in range(1, max_iter + 1):
            last, again = state, step + 2 <= max_iter
            if step == 1:
                sent = received(votes_of(last.select("id", "label", "leaf")))
                of_leaves = F.when(F.col("leaf"), F.col("votes")).otherwise(0)
                counts = sent.groupBy("id", "label").agg(F.sum("votes").alias("votes"), F.sum(of_leaves).alias("held"))
                if again:
                    heard_in[step] = counts = _filled(counts)
                best = F.min(F.struct(-F.col("votes"), F.col("label").alias("label"))).alias("best")
                found = counts.groupBy("id").agg(best, F.sum("held").alias("held"))
                state = last.select("id", F.col("label").alias("before"), F.col("before").alias("older"), "leaf").join(
                    found, "id")
            else:
                senders = last.filter(~F.col("leaf"))
                if step == 2:
                    counts = received(votes_of(senders.select("id", "label")))
                else:
                    moved = votes_of(senders.select("id", "label", "older")).filter("label != older")
                    # Stored, as these are few. Else the plan would hold all rounds before twice, in each round again.
                    moved = write_through(moved, "moved-votes", "zstd")
                    counts = received(moved).select("id", F.expr("stack(2, label, votes, older, -votes) AS (label, votes)"))
                    known = heard_in[step - 2]
                    if step == 3:
                        known = known.select("id", "label", (F.col("votes") - F.col("held")).alias("votes"))
                    counts = known.union(counts)
                counts = counts.groupBy("id", "label").agg(F.sum("votes").alias("votes")).filter("votes != 0")
                if again and step % ROUNDS_PER_CHECKPOINT == 0:
                    counts = cut_lineage(counts)
                if again or step > 2:
                    # Within the join below, Spark would shuffle both parts of a union again.
                    heard_in[step] = counts = _filled(counts)
                heard = last.join(counts.withColumnRenamed("label", "heard"), "id", "left")
                all_votes = F.col("votes") + F.when(F.col("heard") == F.col("before"), F.col("held")).otherwise(0)
                choice = F.struct((-all_votes).alias("votes"), F.col("heard").alias("label"))
                best = F.min(F.when(F.col("heard").isNotNull(), choice)).alias("best")
                kept = [F.first(c).alias(c) for c in ("label", "before", "held", "leaf")]
                of_leaves = F.struct((-F.col("held")).alias("votes"), F.col("before").alias("label"))
                state = heard.groupBy("id").agg(best, *kept).select(
                    "id", F.col("label").alias("before"), F.col("before").alias("older"), "leaf", "held",
                    F.least("best", F.when(F.col("held") > 0, of_leaves)).alias("best"))
            state = state.select("id", F.col("best.label").alias("label"), "before", "older", "held", "leaf")
            if step % ROUNDS_PER_CHECKPOINT == 0 and step < max_iter:
                state = cut_lineage(state)
            state = _filled(state)
            last.unpersist()
            for past in [n for n in heard_in if n == step - 2 or n + 2 > max_iter]:
                heard_in.pop(past).unpersist()
        own = keyed.select(F.col("key").alias("id"), F.col("id").alias("own"))
        found = state.join(own, "id").select(F.col("own").alias("id"), "label")
        found = write_through(found, "labels", "zstd")
        state.unpersist()
    keyed.unpersist()
    hot = hot_keys(found, "label", rows_per_slice)
    names = copy_to_slices(places.select(F.col("place").alias("label"), F.col("id").alias("name")), hot, "label")
    return spread_rows(found, hot, "label", ["id"]).join(names, ["label", SLICE]).select(
        "id", F.col("name").alias("label"))


def community_sizes(labels: DataFrame) -> DataFrame:
    return (
        labels.groupBy("label")
        .agg(F.count(F.lit(1)).alias("num_videos"))
        .orderBy(F.desc("num_videos"), "label")
    )


def community_size_classes(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy(community_size_class(F.col("num_videos")).alias("size_class")).agg(
        F.count(F.lit(1)).alias("num_communities")
    )


def community_summary(sizes: DataFrame) -> DataFrame:
    """Number, largest, mean and median size.

    The median keeps one counter per distinct size. Sizes add up to the number
    of vertices, so there are at most sqrt(2 * vertices) different ones.
    """
    return sizes.agg(
        F.count(F.lit(1)).alias("num_communities"),
        F.max("num_videos").alias("largest"),
        F.avg("num_videos").alias("avg_size"),
        F.median("num_videos").alias("median_size"),
    )


def _videos_of(members: DataFrame, videos: DataFrame) -> DataFrame:
    """The videos among the stored members; where these are few, Spark drops the others before it shuffles any."""
    return videos.join(members.select("id"), "id", "left_semi")


def community_categories(labels: DataFrame, videos: DataFrame, top: int = 5) -> DataFrame:
    """Videos per category in the `top` largest communities."""
    largest = community_sizes(labels).limit(top).select("label")
    # At most `top` rows.
    members = write_through(labels.join(F.broadcast(largest), "label", "left_semi"), "members", "zstd")
    return (
        enrich_metadata(members, _videos_of(members, videos))
        .groupBy("label", "category")
        .agg(F.count(F.lit(1)).alias("num_videos"))
        .orderBy("label", F.desc("num_videos"), "category")
    )


def community_members(
    labels: DataFrame, videos: DataFrame, top: int = 5, limit: int = 100
) -> DataFrame:
    """First members of the `top` largest communities with category and uploader."""
    largest = community_sizes(labels).limit(top).select("label")
    members = labels.join(F.broadcast(largest), "label", "left_semi")
    members = write_through(members.orderBy("label", "id").limit(limit), "members")
    return enrich_metadata(members, _videos_of(members, videos))
