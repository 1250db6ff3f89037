"""Subgraph patterns: pairs, chains, common recommendations and motifs.

A hub in the middle of a pattern makes the number of matches grow with the
square of its degree. The listings therefore return the first matches in a
total order and build only those; totals are computed from degrees. Both are
exact and neither forms the pairs of a hub.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from videonet.operators.degree import degree_table
from videonet.operators.graph import edges_of_category, simple_edges, weighted_edges
from videonet.operators.ranks import numbered, running_sum
from videonet.operators.search import by_category, check_limit
from videonet.operators.skew import (
    SLICE,
    copy_to_slices,
    hot_slices,
    sliced_join,
    spread_rows,
)
from videonet.session import cut_lineage, write_through
from videonet.sources.layout import EdgeLayout

# Rows of a hot target that one task pairs with all rows of that target.
PAIR_ROWS_PER_SLICE = 10_000
# Sources that a listing of pairs compares with all others in its first round.
SOURCES_AT_FIRST = 256
# Numbers of matches grow with the square of a degree and do not fit 64 bits.
COUNT = "decimal(38,0)"


def wide(name: str) -> Column:
    """A 64-bit number whose products are exact."""
    return F.col(name).cast("decimal(19,0)")


def related_pairs(
    edges: DataFrame,
    videos: DataFrame | None = None,
    category: str | None = None,
    max_results: int = 50,
) -> DataFrame:
    """(a)->(b), `a` in the category."""
    rows = edges if videos is None else edges_of_category(edges, videos, category)
    return (
        rows.select(F.col("src").alias("source_video"), F.col("dst").alias("related_video"))
        .orderBy("source_video", "related_video")
        .limit(check_limit(max_results))
    )


def motif_edge(
    edges: DataFrame | EdgeLayout, vertices: DataFrame, category: str | None = None
) -> DataFrame:
    """(a)-[e]->(b) as structs; both ends must be vertices, `a` in the category.

    From a stored layout the edges are joined with `a` bucket by bucket; only the
    matches, not all edges, are shuffled to find `b`.
    """
    columns = [c for c in vertices.columns if c != "id"]
    starts = by_category(vertices, category).select(
        F.col("id").alias("src"), F.struct("id", *columns).alias("a")
    )
    ends = vertices.select(F.col("id").alias("dst"), F.struct("id", *columns).alias("b"))
    if isinstance(edges, EdgeLayout):
        rows = edges.by("src").join(copy_to_slices(starts, edges.hot("src"), "src"), ["src", SLICE])
        rows = rows.select("src", "dst", F.struct("crawl_id", "src", "dst").alias("e"), "a")
        # Of the matches into a popular `b` no more exist than the layout counted edges into it.
        hot = edges.hot("dst")
        rows = spread_rows(rows, hot, "dst", ["src"])
        return rows.join(copy_to_slices(ends, hot, "dst"), ["dst", SLICE]).select("a", "e", "b")
    edge = F.struct(*edges.columns).alias("e")
    rows = sliced_join(edges.select("src", "dst", edge), starts, "src", by=["dst"])
    return sliced_join(rows, ends, "dst", by=["src"]).select("a", "e", "b")


def path_matches(
    edges: DataFrame,
    hops: int,
    max_results: int,
    allowed: dict[int, DataFrame] | None = None,
) -> DataFrame:
    """First paths v0 -> v1 -> ... in lexicographic order, parallel edges repeated.

    `allowed` restricts the vertex at a position to a frame of ids. For each
    vertex the number of ways to finish the path is counted backwards, up to
    max_results. Going forward, a partial path takes only as many next edges as
    the paths before it leave room for, so at most max_results rows exist.
    Parallel edges travel as one row with a number of copies. Edges, counts and
    partial paths are stored, so each hop reads them instead of making them anew.
    """
    limit = check_limit(max_results)
    if hops < 1:
        raise ValueError("a path needs at least one edge")
    allowed = allowed or {}
    base = write_through(weighted_edges(edges), "path-edges")
    # Sizes before any restriction: an upper bound that all hops share.
    counts = base.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))

    def only(rows: DataFrame, column: str, position: int) -> DataFrame:
        if position not in allowed:
            return rows
        ids = allowed[position].select(F.col("id").alias(column))
        return rows.join(ids, column, "left_semi")

    def up_to_limit(count):
        return F.least(count, F.lit(limit).cast("bigint"))

    steps: list[DataFrame] = []
    ways: DataFrame | None = None
    for hop in reversed(range(hops)):
        step = only(base, "dst", hop + 1)
        if hop == 0:
            step = only(step, "src", 0)
        if ways is None:
            step = step.withColumn("ways", F.lit(1).cast("bigint"))
        else:
            step = sliced_join(step, ways, "dst", by=["src"], counts=counts)
        steps.insert(0, step)
        if hop > 0:
            total = up_to_limit(F.sum(up_to_limit(F.col("weight") * F.col("ways"))))
            ways = write_through(
                step.groupBy(F.col("src").alias("dst")).agg(total.alias("ways")), "path-ways"
            )

    paths = (
        steps[0]
        .select(
            F.col("src").alias("v0"),
            F.col("dst").alias("v1"),
            up_to_limit(F.col("weight")).alias("copies"),
            "ways",
        )
        .orderBy("v0", "v1")
        .limit(limit)
    )
    for hop in range(1, hops):
        names = [f"v{i}" for i in range(hop + 1)]
        taken = running_sum(
            paths.withColumn("found", F.col("copies") * F.col("ways")), [], names, "found", "taken"
        )
        paths = write_through(
            taken.withColumn("room", F.lit(limit) - F.col("taken"))
            .filter(F.col("room") > 0)
            .drop("taken", "found"),
            "paths",
        )
        last = names[-1]
        ends = paths.select(F.col(last).alias("src")).distinct()
        nexts = (
            numbered(steps[hop].join(ends, "src", "left_semi"), ["src"], ["dst"], "place")
            .filter(F.col("place") <= limit)
            .select(F.col("src").alias(last), F.col("dst").alias(f"v{hop + 1}"), "weight",
                    "ways", "place")
        )
        names.append(f"v{hop + 1}")
        paths = (
            paths.drop("ways")
            .join(nexts, last)
            .filter(F.col("place") <= F.col("room"))
            .withColumn("copies", up_to_limit(F.col("copies") * F.col("weight")))
            .select(*names, "copies", "ways")
            .orderBy(*names)
            .limit(limit)
        )
    names = [f"v{i}" for i in range(hops + 1)]
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return paths.select(*names, copy.alias("copy")).orderBy(*names).limit(limit).select(*names)


def chains(
    edges: DataFrame,
    videos: DataFrame | None = None,
    category: str | None = None,
    length: int = 2,
    max_results: int = 30,
) -> DataFrame:
    """(a)->(b)->(c)... of `length` edges, `a` in the category. Length 1 lists pairs.

    The columns are video_a ... video_z, video_aa, video_ab and so on.
    """
    if length == 1:
        return related_pairs(edges, videos, category, max_results)
    allowed = {}
    if videos is not None and category:
        allowed[0] = by_category(videos, category).select("id")
    paths = path_matches(edges, length, max_results, allowed)
    return paths.toDF(*[f"video_{letters(i)}" for i in range(length + 1)])


def letters(place: int) -> str:
    """a ... z, aa, ab ... for the places 0, 1, ..."""
    head, tail = divmod(place, 26)
    return (letters(head - 1) if head else "") + chr(ord("a") + tail)


def meeting_rows(
    left: DataFrame, right: DataFrame, key: str, by: list[str], rows_per_slice: int = PAIR_ROWS_PER_SLICE
) -> DataFrame:
    """left JOIN right USING (key) where both have many rows of a key: hot keys of the left are cut into slices.

    The result has as many rows as there are matches; for a hub that is the square of its degree.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = hot_slices(counts, key, rows_per_slice=rows_per_slice)
    rows = spread_rows(left, hot, key, by).join(copy_to_slices(right, hot, key), [key, SLICE])
    return rows.drop(SLICE)


def chain_join(edges: DataFrame, videos: DataFrame, category: str) -> DataFrame:
    """All chains (a)->(b)->(c) with `a` in the category, as rows, parallel edges repeated."""
    firsts = edges_of_category(edges, videos, category).select(
        F.col("src").alias("video_a"), F.col("dst").alias("video_b")
    )
    seconds = edges.select(F.col("src").alias("video_b"), F.col("dst").alias("video_c"))
    return meeting_rows(firsts, seconds, "video_b", ["video_a"]).select("video_a", "video_b", "video_c")


def common_target_join(edges: DataFrame, videos: DataFrame, category: str) -> DataFrame:
    """All triples (a)->(c)<-(b), a < b, with the target in the category, as rows, parallel edges repeated."""
    targets = by_category(videos, category).select(F.col("id").alias("dst"))
    rows = edges.join(targets, "dst", "left_semi").select("src", F.col("dst").alias("common_target"))
    pairs = meeting_rows(
        rows.withColumnRenamed("src", "video_a"), rows.withColumnRenamed("src", "video_b"),
        "common_target", ["video_a"],
    )
    return pairs.filter("video_a < video_b").select("video_a", "video_b", "common_target")


def chain_counts_by_bridge(edges: DataFrame) -> DataFrame:
    """Chains (a)->(b)->(c) per middle video: in-degree times out-degree."""
    return (
        degree_table(edges)
        .filter((F.col("inDegree") > 0) & (F.col("outDegree") > 0))
        .select("id", (wide("inDegree") * wide("outDegree")).cast(COUNT).alias("num_chains"))
    )


def chain_counts_by_start(edges: DataFrame) -> DataFrame:
    """Chains (a)->(b)->(c) per first video."""
    weighted = weighted_edges(edges)
    out = weighted.groupBy(F.col("src").alias("dst")).agg(F.sum("weight").alias("ways"))
    steps = sliced_join(weighted, out, "dst", by=["src"])
    return steps.groupBy(F.col("src").alias("id")).agg(
        F.sum((wide("weight") * wide("ways")).cast("decimal(28,0)")).cast(COUNT).alias("num_chains")
    )


def common_counts_by_target(edges: DataFrame) -> DataFrame:
    """Triples (a)->(c)<-(b) with a < b per target c, from sums of the edge weights."""
    total = F.sum("weight").cast("decimal(19,0)")
    squares = F.sum((wide("weight") * wide("weight")).cast("decimal(28,0)"))
    half = F.lit(Decimal("0.5"))
    return (
        weighted_edges(edges)
        .groupBy(F.col("dst").alias("id"))
        .agg(((total * total - squares) * half).cast(COUNT).alias("num_triples"))
        .filter(F.col("num_triples") > 0)
    )


def common_recommendations(
    edges: DataFrame,
    videos: DataFrame | None = None,
    category: str | None = None,
    max_results: int = 30,
    min_common: int = 1,
) -> DataFrame:
    """(a)->(c)<-(b) with a < b, the target c in the category; first by (c, a, b).

    Sources of a target are numbered. Source i of n begins (n - i) pairs, so the
    position of every pair is known and only the wanted ones are built. With
    `min_common` the pair must share so many distinct targets; then these pairs
    are found first, and their common targets are looked up.
    """
    limit = check_limit(max_results)
    if min_common > 1:
        return _common_of_pairs(edges, videos, category, limit, min_common)
    rows = weighted_edges(edges)
    if videos is not None and category:
        targets = by_category(videos, category).select(F.col("id").alias("dst"))
        rows = rows.join(targets, "dst", "left_semi")
    sizes = rows.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    first = sizes.orderBy("dst").limit(limit)
    n = F.col("n")
    # n (n - 1) / 2 pairs, or the limit where that is certainly less.
    pairs = F.when(n > limit, F.lit(limit)).otherwise(F.least(F.expr("n * (n - 1) div 2"), F.lit(limit)))
    first = running_sum(first.withColumn("pairs", pairs.cast("bigint")), [], ["dst"], "pairs", "start")
    first = write_through(first.filter(F.col("start") < limit).drop("pairs"), "first-targets")

    sources = numbered(rows.join(first.select("dst"), "dst", "left_semi"), ["dst"], ["src"], "i")
    sources = write_through(sources.filter(F.col("i") <= limit + 1), "first-sources")
    i = F.col("i")
    room = F.lit(limit) - F.col("start") - F.expr("(i - 1) * n - i * (i - 1) div 2")
    left = (
        sources.join(first, "dst")
        .withColumn("room", room)
        .filter((F.col("room") > 0) & (i < n))
        .select(
            "dst",
            F.col("src").alias("video_a"),
            F.col("weight").alias("weight_a"),
            F.explode(F.sequence(i + 1, F.least(n, i + F.col("room")))).alias("j"),
        )
    )
    right = sources.select(
        "dst", F.col("i").alias("j"), F.col("src").alias("video_b"), F.col("weight").alias("weight_b")
    )
    copies = F.least(F.col("weight_a") * F.col("weight_b"), F.lit(limit).cast("bigint"))
    return (
        left.join(right, ["dst", "j"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .select("video_a", "video_b", F.col("dst").alias("common_target"))
        .orderBy("common_target", "video_a", "video_b")
        .limit(limit)
    )


def _common_of_pairs(
    edges: DataFrame, videos: DataFrame | None, category: str | None, limit: int, min_common: int
) -> DataFrame:
    """The first triples of all pairs that share `min_common` distinct targets."""
    pairs = write_through(
        common_pairs(edges, min_common, videos, category, max_results=None).select("video_a", "video_b"), "pairs")
    rows = weighted_edges(edges)
    if videos is not None and category:
        targets = by_category(videos, category).select(F.col("id").alias("dst"))
        rows = rows.join(targets, "dst", "left_semi")
    of_a = rows.select(F.col("src").alias("video_a"), "dst", F.col("weight").alias("weight_a"))
    of_b = rows.select(F.col("src").alias("video_b"), "dst", F.col("weight").alias("weight_b"))
    triples = sliced_join(pairs, of_a, "video_a", by=["video_b"]).join(of_b, ["video_b", "dst"])
    copies = F.least(F.col("weight_a") * F.col("weight_b"), F.lit(limit).cast("bigint"))
    first = triples.select("video_a", "video_b", F.col("dst").alias("common_target"), copies.alias("copies")).orderBy(
        "common_target", "video_a", "video_b").limit(limit)
    return (
        first.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).drop("copies", "copy")
        .orderBy("common_target", "video_a", "video_b").limit(limit)
    )


def common_pairs(
    edges: DataFrame,
    min_common: int = 2,
    videos: DataFrame | None = None,
    category: str | None = None,
    max_results: int | None = 1000,
    rows_per_slice: int = PAIR_ROWS_PER_SLICE,
) -> DataFrame:
    """Pairs (a, b), a < b, that share at least `min_common` distinct targets; first by (a, b), None for all pairs.

    Sources are taken in order, a few at first and twice as many each time, and
    compared with others until there are enough pairs. Each source's
    `min_common` - 1 most popular targets are set aside: a pair that shares
    enough meets at one of the rest, and lookups complete its count. So a hub
    forms pairs only for sources that have `min_common` - 1 targets as popular.
    """
    limit = None if max_results is None else check_limit(max_results)
    if min_common < 1:
        raise ValueError(f"pairs share at least one target, got {min_common}")
    links = simple_edges(edges)
    if videos is not None and category:
        targets = by_category(videos, category).select(F.col("id").alias("dst"))
        links = links.join(targets, "dst", "left_semi")
    shared = links.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    links = write_through(links.join(shared, "dst").select("src", "dst", "n"), "shared-links")
    sources = write_through(numbered(links.select("src").distinct(), [], ["src"], "place"), "sources")
    total, done = sources.count(), 0
    batch = SOURCES_AT_FIRST if limit else max(1, total)
    popular = Window.partitionBy("src").orderBy(F.desc("n"), "dst")
    found: DataFrame | None = None
    while found is None or (limit and done < total and found.count() < limit):
        some = sources.filter(F.col("place").between(done + 1, done + batch)).select("src")
        own = links.join(some, "src", "left_semi")
        rest = own
        if min_common > 1:
            aside = own.withColumn("rank", F.row_number().over(popular)).filter(F.col("rank") < min_common)
            rest = own.join(aside.select("src", "dst"), ["src", "dst"], "left_anti")
        left = rest.select(F.col("src").alias("video_a"), "dst")
        right = links.select(F.col("src").alias("video_b"), "dst")
        met = (
            meeting_rows(left, right, "dst", ["video_a"], rows_per_slice)
            .filter("video_a < video_b").select("video_a", "video_b").distinct()
        )
        met = write_through(met, "met-pairs")
        targets = own.select(F.col("src").alias("video_a"), "dst")
        pairs = (
            meeting_rows(met, targets, "video_a", ["video_b"], rows_per_slice)
            .join(right, ["video_b", "dst"])
            .groupBy("video_a", "video_b")
            .agg(F.count(F.lit(1)).alias("num_common"))
            .filter(F.col("num_common") >= min_common)
        )
        if limit:
            pairs = pairs.orderBy("video_a", "video_b").limit(limit)
        pairs = write_through(pairs, "pairs")
        found = pairs if found is None else found.union(pairs)
        done, batch = done + batch, 2 * batch
    found = found.orderBy("video_a", "video_b")
    return found.limit(limit) if limit else found


def top_counts(counts: DataFrame, column: str, k: int = 10) -> DataFrame:
    return counts.orderBy(F.desc(column), "id").limit(check_limit(k))


def mutual_edges(edges: DataFrame) -> DataFrame:
    """(a)->(b) and (b)->(a), a < b."""
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    return (
        edges.filter(F.col("src") != F.col("dst"))
        .groupBy(low.alias("video_a"), high.alias("video_b"))
        .agg(F.bool_or(F.col("src") < F.col("dst")).alias("there"),
             F.bool_or(F.col("src") > F.col("dst")).alias("back"))
        .filter("there AND back")
        .select("video_a", "video_b")
    )


def motif(
    edges: DataFrame,
    vertices: DataFrame,
    where: dict[int, object] | None = None,
    hops: int = 1,
    max_results: int = 100,
) -> DataFrame:
    """Paths whose vertices are in `vertices`, with a condition per position.

    `where` maps a position to a column condition on the vertex table (category,
    views, date). Returns the ids v0, v1, ... in lexicographic order.
    """
    where = where or {}
    allowed = {}
    for position in range(hops + 1):
        rows = vertices.filter(where[position]) if position in where else vertices
        allowed[position] = rows.select("id")
    return path_matches(edges, hops, max_results, allowed)


def motif_links(
    edges: DataFrame,
    links: list[tuple[str, str]],
    vertices: DataFrame | None = None,
    where: dict[str, Column] | None = None,
    edge_where: dict[int, Column] | None = None,
    max_results: int = 100,
) -> DataFrame:
    """Matches of several links between named vertices, e.g. [("a", "b"), ("c", "b"), ("b", "a")].

    `where` maps a name to a condition on the vertex table, `edge_where` the place
    of a link to a condition on its edge. Each link but the first shares a name
    with earlier ones. Returns the ids by name, in order, parallel edges repeated.
    """
    limit = check_limit(max_results)
    where, edge_where = where or {}, edge_where or {}
    rows: DataFrame | None = None
    for place, (source, target) in enumerate(links):
        step = edges.filter(edge_where[place]) if place in edge_where else edges
        if source == target:
            step = step.filter("src = dst").select(F.col("src").alias(source))
        else:
            step = step.select(F.col("src").alias(source), F.col("dst").alias(target))
        known = set() if rows is None else set(rows.columns)
        for name in dict.fromkeys((source, target)):
            if vertices is not None and name not in known:
                ids = vertices.filter(where[name]) if name in where else vertices
                step = step.join(ids.select(F.col("id").alias(name)), name, "left_semi")
        both = [name for name in dict.fromkeys((source, target)) if name in known]
        if rows is None:
            rows = step
        elif not both:
            raise ValueError(f"link {place} shares no vertex with the links before it")
        elif len(both) == 1 and source != target:
            rows = meeting_rows(rows, step, both[0], [c for c in rows.columns if c != both[0]])
        else:
            rows = rows.join(step, both)
    names = list(dict.fromkeys(name for link in links for name in link))
    return rows.select(*names).orderBy(*names).limit(limit)


def typed_edges(edges: DataFrame, videos: DataFrame) -> DataFrame:
    """user -> video (uploaded) and video -> video (related) as one edge list."""
    uploads = videos.filter(F.col("uploader").isNotNull()).select(
        F.concat(F.lit("user:"), "uploader").alias("src"),
        F.concat(F.lit("video:"), "id").alias("dst"),
    )
    related = edges.select(
        F.concat(F.lit("video:"), "src").alias("src"),
        F.concat(F.lit("video:"), "dst").alias("dst"),
    )
    return uploads.union(related)


def user_video_patterns(
    edges: DataFrame, videos: DataFrame, max_results: int = 100
) -> DataFrame:
    """user -> uploaded video -> related video."""
    links = typed_edges(edges, videos)
    users = videos.select(F.concat(F.lit("user:"), "uploader").alias("id")).distinct()
    return path_matches(links, 2, max_results, {0: users}).toDF("user", "video", "related_video")


def uploader_links(edges: DataFrame, videos: DataFrame) -> DataFrame:
    """Number of edges from the videos of one uploader to those of another."""
    by_src = videos.select(F.col("id").alias("src"), F.col("uploader").alias("src_uploader"))
    by_dst = videos.select(F.col("id").alias("dst"), F.col("uploader").alias("dst_uploader"))
    # Parallel edges meet first, so both lookups see one row per pair.
    rows = sliced_join(weighted_edges(edges), by_src, "src", by=["dst"])
    rows = sliced_join(rows, by_dst, "dst", by=["src"])
    return rows.groupBy("src_uploader", "dst_uploader").agg(F.sum("weight").alias("num_edges"))


def pattern_stats(edges: DataFrame, videos: DataFrame) -> DataFrame:
    """Matches per pattern and category over the whole graph.

    Pairs and chains count for the category of their first video, common
    recommendations for the category of their target.
    """
    weighted = weighted_edges(edges)
    pairs = weighted.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("n"))
    counts = (
        pairs.withColumn("pattern", F.lit("pair"))
        .unionByName(
            chain_counts_by_start(edges).withColumnRenamed("num_chains", "n")
            .withColumn("pattern", F.lit("chain"))
        )
        .unionByName(
            common_counts_by_target(edges).withColumnRenamed("num_triples", "n")
            .withColumn("pattern", F.lit("common"))
        )
    )
    return (
        counts.join(videos.select("id", "category"), "id", "left")
        .groupBy("pattern", F.coalesce("category", F.lit("Unknown")).alias("category"))
        .agg(F.sum("n").alias("num_matches"))
    )
