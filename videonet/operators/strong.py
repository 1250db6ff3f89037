"""Strongly connected components by trimming, contraction of chains, and searches in what is left.

A vertex without links in or out is a component of its own and goes. A vertex with
one link in can only be on a cycle through the vertex at its other end, so it is
merged into that one, which takes over its links out; likewise with one link out.
What reaches what among the other vertices does not change. Merging halves chains and
rings again and again, so rounds do not follow the diameter there. The core that is
left has two links in and out at every vertex; searches colour it, each vertex by the
smallest id that reaches it, and all that the owner of a colour reaches backwards
within its colour is a component. Links between colours are dropped, and the rest
starts over.

At the end merged vertices are taken apart in reverse order: one that was merged
into the vertex before it belongs to the component of that vertex if some link out
of it leads there, and is alone otherwise; every way into it leads through the vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from videonet.operators.degree import vertex_set
from videonet.operators.graph import MessageRoutes, simple_edges
from videonet.operators.skew import ROWS_PER_SLICE, sliced_join
from videonet.session import cut_lineage, write_through

# A round of merging must take away this share of the vertices, or the searches begin.
WORTH_MERGING = 0.05


def _stored(links: DataFrame) -> DataFrame:
    """Links as a table: Spark knows its size then, where estimates of a checkpoint grow with the square in each round."""
    return write_through(links, "links")


def _ends(links: DataFrame) -> DataFrame:
    """(id, n_in, n_out, before, after): number of links of each vertex, and one neighbour on each side."""
    rows = links.select(F.expr(
        "stack(2, src, 0L, 1L, cast(null AS string), dst, dst, 1L, 0L, src, cast(null AS string))"
        " AS (id, i, o, before, after)"))
    return rows.groupBy("id").agg(
        F.sum("i").alias("n_in"), F.sum("o").alias("n_out"),
        F.min("before").alias("before"), F.min("after").alias("after"),
    )


def _without(links: DataFrame, gone: DataFrame) -> DataFrame:
    """Links whose ends are both not among the ids."""
    rows = links
    for end in ("src", "dst"):
        rows = rows.join(gone.select(F.col("id").alias(end)), end, "left_anti")
    return rows.select("src", "dst")


def _chosen(ends: DataFrame, step: int, forwards: bool) -> DataFrame:
    """(id, into): vertices with one link in (or out) and the vertex at its other end.

    A vertex is merged only if a coin of this step falls on heads for it and on tails
    for the other one, so nothing is merged into what is merged itself.
    """
    count, other = ("n_in", "before") if forwards else ("n_out", "after")
    coin = [F.pmod(F.xxhash64(F.lit(step), name), F.lit(2)) for name in ("id", other)]
    return ends.filter((F.col(count) == 1) & (coin[0] == 1) & (coin[1] == 0)).select(
        "id", F.col(other).alias("into"))


def _merge(links: DataFrame, step: int, forwards: bool, rows_per_slice: int) -> tuple[DataFrame, DataFrame] | None:
    """Links after a round of merging, and (id, into, onward) to undo it; None if nothing was worth merging."""
    ends = write_through(_ends(links), "link-ends")
    total, chosen = ends.count(), write_through(_chosen(ends, step, forwards), "chosen")
    merged = chosen.count()
    if merged <= WORTH_MERGING * total:
        return None
    count, end, far = ("n_in", "src", "dst") if forwards else ("n_out", "dst", "src")
    # The vertex of a link's end, or the one that it is merged into.
    outs = sliced_join(
        links, chosen.withColumnRenamed("id", end), end, [far],
        ends.select(F.col("id").alias(end), (F.col("n_in") + F.col("n_out") - F.col(count)).alias("n")),
        "left", rows_per_slice,
    )
    outs = write_through(outs.select("src", "dst", "into"), "merged-links")
    undo = outs.filter("into IS NOT NULL").select(F.col(end).alias("id"), "into", F.col(far).alias("onward"))
    moved = outs.select(F.coalesce("into", end).alias(end), far)
    # A merged vertex keeps no link: its one link from the vertex is gone, and a link back to it is no link any more.
    gone = chosen.select(F.col("id").alias(far))
    left = moved.join(gone, far, "left_anti").filter("src <> dst").select("src", "dst").distinct()
    return _stored(left), undo


def _smallest_sent(links: DataFrame, state: DataFrame, rows_per_slice: int) -> DataFrame:
    """State (id, value) after each value went along the links as long as a receiver's is larger or null."""
    state = cut_lineage(state.withColumn("fresh", F.col("value").isNotNull()))
    routes = links.select(F.col("src").alias("sender"), F.col("dst").alias("receiver"))
    with MessageRoutes(routes, rows_per_slice) as messages:
        while not (fresh := state.filter("fresh").select("id", "value")).isEmpty():
            sent = messages.send(fresh).select(
                F.col("receiver").alias("id"), F.lit(None).cast("string").alias("value"), F.col("value").alias("got"))
            own = state.select("id", "value", F.lit(None).cast("string").alias("got"))
            best = own.union(sent).groupBy("id").agg(F.max("value").alias("value"), F.min("got").alias("got"))
            state = cut_lineage(best.select(
                "id", F.least("value", "got").alias("value"),
                F.expr("got IS NOT NULL AND (value IS NULL OR got < value)").alias("fresh")))
    return state.select("id", "value")


def _found_by_search(links: DataFrame, rows_per_slice: int) -> tuple[DataFrame, DataFrame]:
    """(id, component) of the vertices whose component holds the owner of their colour, and the links of all others."""
    vertices = vertex_set(links)
    colours = _smallest_sent(links, vertices.withColumn("value", F.col("id")), rows_per_slice)
    within = links
    for end in ("src", "dst"):
        colour = colours.select(F.col("id").alias(end), F.col("value").alias(f"{end}_colour"))
        within = sliced_join(within, colour, end, ["dst" if end == "src" else "src"], rows_per_slice=rows_per_slice)
    within = _stored(within.filter("src_colour = dst_colour").select("src", "dst"))
    owners = colours.select("id", F.when(F.col("id") == F.col("value"), F.col("id")).alias("value"))
    back = within.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    found = _smallest_sent(back, owners, rows_per_slice).filter("value IS NOT NULL")
    return found.withColumnRenamed("value", "component"), _stored(_without(within, found))


def _taken_apart(undo: DataFrame, labels: DataFrame, rows_per_slice: int) -> DataFrame:
    """(id, component) of the merged vertices that belong to the component of the one they were merged into."""
    rows = undo
    for name in ("into", "onward"):
        label = labels.select(F.col("id").alias(name), F.col("component").alias(f"{name}_label"))
        rows = sliced_join(
            rows, label, name, ["id", "into", "onward"], how="left", rows_per_slice=rows_per_slice
        ).withColumn(f"{name}_label", F.coalesce(f"{name}_label", name))
    rows = rows.filter("into_label = onward_label")
    # All rows of a vertex hold the one that it was merged into, so its label too.
    return rows.groupBy("id").agg(F.min("into_label").alias("component"))


def strong_components(edges: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(id, component): the smallest vertex id of the strongly connected component, for every end of an edge.

    Edges with a missing end are left out; self-loops and parallel edges change nothing.
    """
    pairs = _stored(simple_edges(edges))
    links = _stored(pairs.filter("src <> dst"))
    labels = links.select(F.col("src").alias("id"), F.col("src").alias("component")).limit(0)
    undone: list[DataFrame] = []
    step = 0
    while not links.isEmpty():
        ends = write_through(_ends(links), "link-ends")
        loose = ends.filter("n_in = 0 OR n_out = 0")
        trimmed = loose.count()
        progress = trimmed > WORTH_MERGING * ends.count()
        if trimmed:
            links = _stored(_without(links, loose))
        for forwards in (True, False):
            step += 1
            merged = _merge(links, step, forwards, rows_per_slice)
            if merged is not None:
                links, undo = merged
                undone.append(undo)
                progress = True
        if not progress:
            found, links = _found_by_search(links, rows_per_slice)
            labels = write_through(labels.union(found), "labels")
    for undo in reversed(undone):
        labels = write_through(labels.union(_taken_apart(undo, labels, rows_per_slice)), "labels")
    rows = write_through(vertex_set(pairs).join(labels, "id", "left").select(
        "id", F.coalesce("component", "id").alias("label")), "labels")
    sizes = rows.groupBy("label").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("n")).persist()
    named = cut_lineage(sliced_join(
        rows, sizes.select("label", "component"), "label", ["id"], sizes.select("label", "n"),
        rows_per_slice=rows_per_slice).select("id", "component"))
    sizes.unpersist()
    return named
