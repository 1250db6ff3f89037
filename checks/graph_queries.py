"""Joins on the network, patterns, influence, communities, centrality, structure, samples."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import Data, query
from checks.source_queries import stored
from checks.table_queries import rounded
from videonet.operators import (
    categories,
    centrality,
    communities,
    degree,
    graph,
    influence,
    patterns,
    sampling,
    strong,
    structure,
)
from videonet.plans import jobs
from videonet.session import scratch_path
from videonet.sources.layout import EdgeLayout

UNITED = """
SELECT DISTINCT src AS id FROM edges UNION SELECT dst FROM edges"""

# ---------------------------------------------------------------- joins and sets


def whole(df: DataFrame, column: str) -> DataFrame:
    """A wide number of matches as a 64-bit one, which is enough for the test tables."""
    return df.withColumn(column, F.col(column).cast("bigint"))


@query("vertex_set", UNITED)
def vertex_set(d):
    return degree.vertex_set(d.edges)


@query("build_graph", f"""
SELECT id, category, uploader FROM videos WHERE id IN ({UNITED})""")
def build_graph(d):
    return graph.build_graph(d.edges, d.videos).vertices.select("id", "category", "uploader")


@query("vertices_in_edges", f"SELECT count(*) AS n FROM videos WHERE id IN ({UNITED})")
def vertices_in_edges(d):
    return graph.vertices_in_edges(d.videos, d.edges).agg(F.count(F.lit(1)).alias("n"))


@query("edges_of_category", """
SELECT crawl_id, src, dst FROM edges JOIN videos ON src = id WHERE category = 'small'""")
def edges_of_category(d):
    return graph.edges_of_category(d.edges, d.videos, "small").select("crawl_id", "src", "dst")


@query("chain_join", """
SELECT e.dst AS video_b, count(*) AS num_chains, min(e.src) AS first_a, max(f.dst) AS last_c
FROM edges e JOIN edges f ON e.dst = f.src JOIN videos ON e.src = id
WHERE category = 'promo' GROUP BY e.dst""")
def chain_join(d):
    return patterns.chain_join(d.edges, d.videos, "promo").groupBy("video_b").agg(
        F.count(F.lit(1)).alias("num_chains"), F.min("video_a").alias("first_a"),
        F.max("video_c").alias("last_c"),
    )


@query("common_target_join", """
SELECT e.dst AS common_target, count(*) AS num_triples, min(e.src) AS first_a, max(f.src) AS last_b
FROM edges e JOIN edges f ON e.dst = f.dst AND e.src < f.src JOIN videos ON e.dst = id
WHERE category = 'promo' GROUP BY e.dst""")
def common_target_join(d):
    return patterns.common_target_join(d.edges, d.videos, "promo").groupBy("common_target").agg(
        F.count(F.lit(1)).alias("num_triples"), F.min("video_a").alias("first_a"),
        F.max("video_b").alias("last_b"),
    )


@query("chain_counts", """
SELECT e.dst AS id, count(*) AS num_chains FROM edges e JOIN edges f ON e.dst = f.src
GROUP BY e.dst""")
def chain_counts(d):
    return whole(patterns.chain_counts_by_bridge(d.edges), "num_chains")


@query("common_target_counts", """
SELECT e.dst AS id, count(*) AS num_triples FROM edges e JOIN edges f
  ON e.dst = f.dst AND e.src < f.src GROUP BY e.dst""")
def common_target_counts(d):
    return whole(patterns.common_counts_by_target(d.edges), "num_triples")


MOTIF_EDGE = """
SELECT a.id AS a_id, a.uploader AS a_uploader, e.crawl_id, e.src, e.dst, b.id AS b_id,
       b.category AS b_category
FROM edges e JOIN videos a ON e.src = a.id JOIN videos b ON e.dst = b.id
WHERE a.category = 'promo'"""


def edge_layout(d: Data) -> EdgeLayout:
    return EdgeLayout.store(d.edges, scratch_path(d.spark, "edge-layout"))


def promo_links(d: Data, edges) -> DataFrame:
    found = patterns.motif_edge(edges, d.videos, "Promo")
    return found.select(
        F.col("a.id").alias("a_id"), F.col("a.uploader").alias("a_uploader"), "e.crawl_id",
        "e.src", "e.dst", F.col("b.id").alias("b_id"), F.col("b.category").alias("b_category"),
    )


@query("motif_edge", MOTIF_EDGE)
def motif_edge(d):
    return promo_links(d, d.edges)


@query("motif_edge_stored", MOTIF_EDGE)
def motif_edge_stored(d):
    return promo_links(d, edge_layout(d))


@query("enrich_metadata", """
SELECT d.id, total_degree, coalesce(category, 'Unknown') AS category,
       coalesce(uploader, 'Unknown') AS uploader, round(coalesce(rate, 0), 6) AS rating,
       coalesce(views, 0) AS views, coalesce(ratings, 0) AS ratings_count
FROM (SELECT id, total_degree FROM degrees
      UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_suppkey FROM supplier) d
LEFT JOIN videos v ON d.id = v.id
LEFT JOIN (SELECT video_id, rate, views, ratings FROM latest) ON d.id = video_id""")
def enrich_metadata(d):
    degrees = degree.degree_table(d.edges).select("id", "total_degree")
    # Suppliers are no videos, so they have no metadata.
    others = d.table("supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_suppkey").cast("bigint").alias("total_degree"),
    )
    return rounded(graph.enrich_metadata(degrees.union(others), d.videos, d.snapshots), "rating")


TOP = "SELECT id FROM degrees ORDER BY total_degree DESC, id LIMIT {k}"


def top_ids(d: Data, k: int) -> DataFrame:
    return degree.top_by_degree(degree.degree_table(d.edges), k).select("id")


@query("induced_edges", f"""
SELECT crawl_id, src, dst FROM edges WHERE src IN ({TOP.format(k=200)})
  AND dst IN ({TOP.format(k=200)})""")
def induced_edges(d):
    return graph.induced_edges(d.edges, top_ids(d, 200))


@query("incident_edges", f"""
SELECT crawl_id, src, dst FROM edges WHERE src IN ({TOP.format(k=50)})
  OR dst IN ({TOP.format(k=50)})""")
def incident_edges(d):
    return graph.incident_edges(d.edges, top_ids(d, 50))


# ---------------------------------------------------------------- patterns


@query("related_pairs", """
SELECT src AS source_video, dst AS related_video FROM edges JOIN videos ON src = id
WHERE category = 'promo' ORDER BY src, dst LIMIT 50""")
def related_pairs(d):
    return patterns.related_pairs(d.edges, d.videos, "promo")


@query("chains", """
SELECT e.src AS video_a, e.dst AS video_b, f.dst AS video_c
FROM edges e JOIN edges f ON e.dst = f.src JOIN videos ON e.src = id
WHERE category = 'promo' ORDER BY 1, 2, 3 LIMIT 5000""")
def chains(d):
    return patterns.chains(d.edges, d.videos, "promo", max_results=5000)


@query("long_chains", """
SELECT e.src AS video_a, e.dst AS video_b, f.dst AS video_c, g.dst AS video_d
FROM offer_edges e JOIN offer_edges f ON e.dst = f.src JOIN offer_edges g ON f.dst = g.src
ORDER BY 1, 2, 3, 4 LIMIT 500""")
def long_chains(d):
    return patterns.chains(d.offer_edges, length=3, max_results=500)


@query("common_recommendations", """
SELECT e.src AS video_a, f.src AS video_b, e.dst AS common_target
FROM edges e JOIN edges f ON e.dst = f.dst AND e.src < f.src JOIN videos ON e.dst = id
WHERE category = 'promo' ORDER BY 3, 1, 2 LIMIT 5000""")
def common_recommendations(d):
    return patterns.common_recommendations(d.edges, d.videos, "promo", max_results=5000)


@query("common_of_pairs", """
SELECT e.src AS video_a, f.src AS video_b, e.dst AS common_target
FROM edges e JOIN edges f ON e.dst = f.dst AND e.src < f.src JOIN videos ON e.dst = id
JOIN (SELECT e.src AS a, f.src AS b FROM simple e JOIN simple f ON e.dst = f.dst AND e.src < f.src
      JOIN videos ON e.dst = id WHERE category = 'promo' GROUP BY 1, 2 HAVING count(*) >= 2) ON a = e.src AND b = f.src
WHERE category = 'promo' ORDER BY 3, 1, 2 LIMIT 5000""")
def common_of_pairs(d):
    return patterns.common_recommendations(d.edges, d.videos, "promo", max_results=5000, min_common=2)


@query("common_pairs", """
SELECT e.src AS video_a, f.src AS video_b, count(*) AS num_common
FROM simple e JOIN simple f ON e.dst = f.dst AND e.src < f.src
GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY 1, 2 LIMIT 5000""")
def common_pairs(d):
    return patterns.common_pairs(d.edges, 2, max_results=5000)


@query("top_sources", """
SELECT src AS id, count(*) AS n FROM edges GROUP BY src ORDER BY n DESC, id LIMIT 10""")
def top_sources(d):
    counts = degree.out_degree(d.edges).withColumnRenamed("outDegree", "n")
    return patterns.top_counts(counts, "n")


@query("top_bridges", """
SELECT e.dst AS id, count(*) AS num_chains FROM edges e JOIN edges f ON e.dst = f.src
GROUP BY e.dst ORDER BY num_chains DESC, id LIMIT 10""")
def top_bridges(d):
    top = patterns.top_counts(patterns.chain_counts_by_bridge(d.edges), "num_chains")
    return whole(top, "num_chains")


@query("top_targets", """
SELECT e.dst AS id, count(*) AS num_triples FROM edges e JOIN edges f
  ON e.dst = f.dst AND e.src < f.src GROUP BY e.dst ORDER BY num_triples DESC, id LIMIT 10""")
def top_targets(d):
    top = patterns.top_counts(patterns.common_counts_by_target(d.edges), "num_triples")
    return whole(top, "num_triples")


@query("motif", """
SELECT e.src AS v0, e.dst AS v1, f.dst AS v2 FROM edges e JOIN edges f ON e.dst = f.src
  JOIN videos a ON e.src = a.id JOIN videos b ON e.dst = b.id JOIN videos c ON f.dst = c.id
WHERE a.category = 'promo' AND b.length_sec > 600 AND c.age_days < 500
ORDER BY 1, 2, 3 LIMIT 400""")
def motif(d):
    where = {
        0: F.col("category") == "promo",
        1: F.col("length_sec") > 600,
        2: F.col("age_days") < 500,
    }
    return patterns.motif(d.edges, d.videos, where, hops=2, max_results=400)


@query("motif_links", """
SELECT e.src AS a, e.dst AS b, g.src AS c FROM edges e JOIN edges f ON f.src = e.dst AND f.dst = e.src
  JOIN edges g ON g.dst = e.dst JOIN videos v ON e.src = v.id
WHERE e.crawl_id < '1996' AND v.length_sec > 300 ORDER BY 1, 2, 3 LIMIT 2000""")
def motif_links(d):
    return patterns.motif_links(
        d.edges, [("a", "b"), ("b", "a"), ("c", "b")], d.videos,
        {"a": F.col("length_sec") > 300}, {0: F.col("crawl_id") < "1996"}, 2000,
    )


@query("mutual_edges", """
SELECT e.src AS video_a, e.dst AS video_b FROM simple e JOIN simple f
  ON e.src = f.dst AND e.dst = f.src WHERE e.src < e.dst""")
def mutual_edges(d):
    return patterns.mutual_edges(d.edges)


@query("user_video_patterns", """
SELECT 'user:' || uploader AS "user", 'video:' || src AS video, 'video:' || dst AS related_video
FROM edges JOIN videos ON src = id ORDER BY 1, 2, 3 LIMIT 500""")
def user_video_patterns(d):
    return patterns.user_video_patterns(d.edges, d.videos, 500)


@query("uploader_links", """
SELECT a.uploader AS src_uploader, b.uploader AS dst_uploader, count(*) AS num_edges
FROM edges JOIN videos a ON src = a.id JOIN videos b ON dst = b.id GROUP BY 1, 2""")
def uploader_links(d):
    return patterns.uploader_links(d.edges, d.videos)


@query("pattern_stats", """
SELECT pattern, category, count(*) AS num_matches FROM (
  SELECT 'pair' AS pattern, src AS id FROM edges
  UNION ALL SELECT 'chain', e.src FROM edges e JOIN edges f ON e.dst = f.src
  UNION ALL SELECT 'common', e.dst FROM edges e JOIN edges f ON e.dst = f.dst AND e.src < f.src
) JOIN videos USING (id) GROUP BY 1, 2""")
def pattern_stats(d):
    return whole(patterns.pattern_stats(d.edges, d.videos), "num_matches")


# ---------------------------------------------------------------- influence


def pagerank_steps(rounds: int, reset: float = 0.15) -> str:
    """r0 ... r<rounds>: unscaled ranks after each round, as chained expressions."""
    parts = [
        'outs AS MATERIALIZED (SELECT id, "outDegree" AS o FROM degrees)',
        "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) AS r FROM outs)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"""r{i} AS MATERIALIZED (SELECT outs.id, {reset} + (1 - {reset}) * coalesce(got, 0) AS r
  FROM outs LEFT JOIN (SELECT dst, sum(r * weight / o) AS got FROM weighted
    JOIN r{i - 1} p ON p.id = src JOIN outs u ON u.id = src GROUP BY dst) ON dst = outs.id)"""
        )
    return ",\n".join(parts)


def scaled(name: str) -> str:
    return f"(SELECT id, r * (count(*) OVER () / sum(r) OVER ()) AS pagerank FROM {name})"


PAGERANK = f"WITH {pagerank_steps(10)},\nranks AS MATERIALIZED {scaled('r10')}\n"


@query("pagerank", PAGERANK + "SELECT id, round(pagerank, 6) AS pagerank FROM ranks")
def pagerank(d):
    return rounded(influence.pagerank(d.edges), "pagerank")


@query("pagerank_stored", PAGERANK + "SELECT id, round(pagerank, 6) AS pagerank FROM ranks")
def pagerank_stored(d):
    return rounded(influence.pagerank(edge_layout(d)), "pagerank")


TOL_ROUNDS = 15
TOL_PICK = "\nUNION ALL\n".join(
    f"SELECT {i} AS step, max(abs(a.r - b.r)) AS moved FROM r{i} a JOIN r{i - 1} b USING (id)"
    for i in range(1, TOL_ROUNDS + 1)
)
TOL_ALL = "\nUNION ALL\n".join(f"SELECT {i} AS step, id, r FROM r{i}" for i in range(1, TOL_ROUNDS + 1))


@query("pagerank_tol", f"""
WITH {pagerank_steps(TOL_ROUNDS)},
moves AS ({TOL_PICK}),
chosen AS (SELECT coalesce(min(CASE WHEN moved <= 0.01 THEN step END), {TOL_ROUNDS}) AS step
           FROM moves),
final AS (SELECT id, r FROM ({TOL_ALL}) JOIN chosen USING (step))
SELECT id, round(pagerank, 6) AS pagerank FROM {scaled('final')}""")
def pagerank_tol(d):
    ranks = influence.pagerank(d.edges, max_iter=TOL_ROUNDS, tol=0.01)
    return rounded(ranks, "pagerank")


PUSH_ROUNDS, PUSH_TOL = 30, 0.01


def push_steps(rounds: int, tol: float, reset: float = 0.15) -> str:
    """s0 ... s<rounds>: rank and residual after each round; once no residual is above tol nothing changes."""
    parts = [
        'outs AS MATERIALIZED (SELECT id, "outDegree" AS o FROM degrees)',
        f"s0 AS MATERIALIZED (SELECT id, CAST(0 AS DOUBLE) AS r, CAST({reset} AS DOUBLE) AS d FROM outs)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"""s{i} AS MATERIALIZED (SELECT p.id, r + CASE WHEN loud THEN d ELSE 0 END AS r,
    CASE WHEN loud THEN 0 ELSE d END + coalesce(got, 0) AS d
  FROM (SELECT *, d > {tol / 4} AND (SELECT max(d) FROM s{i - 1}) > {tol} AS loud FROM s{i - 1}) p
  LEFT JOIN (SELECT dst, sum((1 - {reset}) * q.d * weight / o) AS got FROM weighted
    JOIN s{i - 1} q ON q.id = src JOIN outs u ON u.id = src
    WHERE q.d > {tol / 4} AND (SELECT max(d) FROM s{i - 1}) > {tol} GROUP BY dst) ON dst = p.id)"""
        )
    return ",\n".join(parts)


@query("pagerank_push", f"""
WITH {push_steps(PUSH_ROUNDS, PUSH_TOL)}
SELECT id, round((r + d) * (count(*) OVER () / sum(r + d) OVER ()), 6) AS pagerank FROM s{PUSH_ROUNDS}""")
def pagerank_push(d):
    ranks = influence.pagerank_push(d.edges, tol=PUSH_TOL, max_iter=PUSH_ROUNDS)
    return rounded(ranks, "pagerank")


def normalized_steps(rounds: int, alpha: float = 0.85) -> str:
    parts = [
        f"""vs AS MATERIALIZED (SELECT id, CAST(sum(o) AS DOUBLE) AS o, count(*) OVER () AS n FROM
  (SELECT src AS id, 1 AS o FROM simple UNION ALL SELECT dst, 0 FROM simple) GROUP BY id)""",
        "x0 AS MATERIALIZED (SELECT id, 1.0 / n AS r FROM vs)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"""x{i} AS MATERIALIZED (SELECT vs.id, {alpha} * coalesce(got, 0)
    + ({alpha} * (SELECT coalesce(sum(r), 0) FROM x{i - 1} JOIN vs USING (id) WHERE o = 0)
       + 1 - {alpha}) / n AS r
  FROM vs LEFT JOIN (SELECT dst, sum(r / o) AS got FROM simple
    JOIN x{i - 1} p ON p.id = src JOIN vs u ON u.id = src GROUP BY dst) ON dst = vs.id)"""
        )
    return ",\n".join(parts)


NORM_ROUNDS = 20
NORM_PICK = "\nUNION ALL\n".join(
    f"SELECT {i} AS step, sum(abs(a.r - b.r)) AS moved, count(*) AS n"
    f" FROM x{i} a JOIN x{i - 1} b USING (id)"
    for i in range(1, NORM_ROUNDS + 1)
)
NORM_ALL = "\nUNION ALL\n".join(f"SELECT {i} AS step, id, r FROM x{i}" for i in range(1, NORM_ROUNDS + 1))


@query("pagerank_normalized", f"""
WITH {normalized_steps(NORM_ROUNDS)},
moves AS ({NORM_PICK}),
chosen AS (SELECT min(CASE WHEN moved < n * 1e-6 THEN step END) AS step FROM moves)
SELECT id, round(r, 9) AS pagerank FROM ({NORM_ALL}) JOIN chosen USING (step)""")
def pagerank_normalized(d):
    return rounded(influence.pagerank_normalized(d.edges), "pagerank", digits=9)


@query("top_pagerank", PAGERANK + """
SELECT id, round(pagerank, 6) AS pagerank FROM ranks ORDER BY 2 DESC, id LIMIT 50""")
def top_pagerank(d):
    return influence.top_pagerank(rounded(influence.pagerank(d.edges), "pagerank"))


@query("rank_with_snapshot", PAGERANK + """
SELECT video_id, round(pagerank, 6) AS pagerank, views, category
FROM ranks JOIN latest ON id = video_id""")
def rank_with_snapshot(d):
    rows = influence.rank_with_snapshot(influence.pagerank(d.edges), d.snapshots)
    return rounded(rows, "pagerank")


@query("pagerank_by_category", PAGERANK + """
SELECT coalesce(category, 'Unknown') AS category, round(avg(pagerank), 6) AS avg_pagerank,
       count(*) AS num_videos FROM ranks LEFT JOIN videos USING (id) GROUP BY 1""")
def pagerank_by_category(d):
    rows = influence.pagerank_by_category(influence.pagerank(d.edges), d.videos)
    return rounded(rows, "avg_pagerank")


@query("pagerank_percentile", PAGERANK + """
SELECT id, round(percent_rank() OVER (ORDER BY round(pagerank, 6)), 6) AS percentile FROM ranks""")
def pagerank_percentile(d):
    rows = influence.pagerank_percentile(influence.pagerank(d.edges))
    return rounded(rows.select("id", "percentile"), "percentile")


@query("influence_report", PAGERANK + """
SELECT video_id, round(pagerank, 6) AS pagerank, views, category, "outDegree", "inDegree",
       total_degree FROM ranks JOIN latest ON id = video_id JOIN degrees USING (id)
ORDER BY ranks.pagerank DESC, video_id LIMIT 10""")
def influence_report(d):
    report = influence.influence_report(influence.pagerank(d.edges), d.snapshots, d.edges)
    return rounded(report, "pagerank")


@query("influence_correlation", PAGERANK + """
SELECT round(corr(pagerank, views), 6) AS corr_views,
       round(regr_slope(pagerank, views) * 1e6, 6) AS slope_views,
       round(regr_intercept(pagerank, views), 6) AS intercept_views,
       round(corr(pagerank, total_degree), 6) AS corr_degree,
       round(regr_slope(pagerank, total_degree), 6) AS slope_degree,
       round(regr_intercept(pagerank, total_degree), 6) AS intercept_degree
FROM ranks JOIN latest ON id = video_id JOIN degrees USING (id)""")
def influence_correlation(d):
    row = influence.influence_correlation(influence.pagerank(d.edges), d.snapshots, d.edges)
    row = row.withColumn("slope_views", F.col("slope_views") * 1e6)
    return rounded(row, *row.columns)


@query("pagerank_quartiles", PAGERANK + """
SELECT category, count(*) AS num_rows, round(min(p), 6) AS min_rank,
       round(quantile_cont(p, 0.25), 6) AS q1, round(quantile_cont(p, 0.5), 6) AS median_rank,
       round(quantile_cont(p, 0.75), 6) AS q3, round(max(p), 6) AS max_rank
FROM (SELECT coalesce(category, 'Unknown') AS category, round(pagerank, 6) AS p
      FROM ranks LEFT JOIN videos USING (id)) GROUP BY category""")
def pagerank_quartiles(d):
    rows = influence.pagerank_quartiles(influence.pagerank(d.edges), d.videos)
    return rounded(rows, "min_rank", "q1", "median_rank", "q3", "max_rank")


@query("pagerank_histogram", PAGERANK.rstrip() + """,
bounds AS (SELECT min(p) AS low, max(p) AS high FROM (SELECT round(pagerank, 6) AS p FROM ranks)),
binned AS (SELECT CAST(least(30, floor((round(pagerank, 6) - low) / ((high - low) / 30)) + 1)
                       AS BIGINT) AS bin FROM ranks, bounds)
SELECT bin, count(*) AS num_rows FROM binned GROUP BY bin""")
def pagerank_histogram(d):
    ranks = rounded(influence.pagerank(d.edges), "pagerank")
    return categories.histogram(ranks, "pagerank", 30).select("bin", "num_rows")


# ---------------------------------------------------------------- communities


def label_steps(edges: str, rounds: int = 5) -> str:
    parts = [
        f"""votes AS MATERIALIZED (SELECT sender, receiver, sum(n) AS n FROM
  (SELECT src AS sender, dst AS receiver, count(*) AS n FROM {edges} GROUP BY 1, 2
   UNION ALL SELECT dst, src, count(*) FROM {edges} GROUP BY 1, 2) GROUP BY 1, 2)""",
        "l0 AS MATERIALIZED (SELECT DISTINCT sender AS id, sender AS label FROM votes)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"""l{i} AS MATERIALIZED (SELECT id, label FROM (
  SELECT receiver AS id, label, row_number() OVER (PARTITION BY receiver ORDER BY n DESC, label) AS rn
  FROM (SELECT receiver, label, sum(n) AS n FROM votes JOIN l{i - 1} ON id = sender GROUP BY 1, 2))
  WHERE rn = 1)"""
        )
    return ",\n".join(parts)


OFFER_LABELS = f"WITH {label_steps('offer_edges')},\nlabels AS MATERIALIZED (SELECT * FROM l5),\n"
OFFER_SIZES = (
    OFFER_LABELS
    + "sizes AS MATERIALIZED (SELECT label, count(*) AS num_videos FROM labels GROUP BY label)\n"
)


@query("label_propagation", f"WITH {label_steps('edges')}\nSELECT id, label FROM l5")
def label_propagation(d):
    return communities.label_propagation(d.edges)


@query("community_sizes", OFFER_SIZES + "SELECT label, num_videos FROM sizes")
def community_sizes(d):
    return communities.community_sizes(communities.label_propagation(d.offer_edges))


@query("community_size_classes", OFFER_SIZES + """
SELECT CASE WHEN num_videos <= 10 THEN 'Tiny (1-10)' WHEN num_videos <= 50 THEN 'Small (11-50)'
            WHEN num_videos <= 100 THEN 'Medium (51-100)'
            WHEN num_videos <= 500 THEN 'Large (101-500)' ELSE 'Huge (500+)' END AS size_class,
       count(*) AS num_communities FROM sizes GROUP BY 1""")
def community_size_classes(d):
    sizes = communities.community_sizes(communities.label_propagation(d.offer_edges))
    return communities.community_size_classes(sizes)


@query("community_summary", OFFER_SIZES + """
SELECT count(*) AS num_communities, max(num_videos) AS largest, round(avg(num_videos), 6) AS avg_size,
       CAST(median(num_videos) AS DOUBLE) AS median_size FROM sizes""")
def community_summary(d):
    sizes = communities.community_sizes(communities.label_propagation(d.offer_edges))
    return rounded(communities.community_summary(sizes), "avg_size")


OFFER_VIDEOS = """
SELECT DISTINCT CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS id,
       lower(p_type) AS category, p_brand AS uploader FROM lineitem JOIN part ON l_partkey = p_partkey"""


def offer_videos(d: Data) -> DataFrame:
    text = OFFER_VIDEOS.replace("FROM lineitem JOIN part", "FROM {lineitem} JOIN {part}")
    return d.spark.sql(text, lineitem=d.table("lineitem"), part=d.table("part"))


@query("community_categories", OFFER_SIZES.rstrip() + f""",
tops AS (SELECT label FROM sizes ORDER BY num_videos DESC, label LIMIT 5),
offers AS ({OFFER_VIDEOS})
SELECT label, coalesce(category, 'Unknown') AS category, count(*) AS num_videos
FROM labels JOIN tops USING (label) LEFT JOIN offers USING (id) GROUP BY 1, 2""")
def community_categories(d):
    labels = communities.label_propagation(d.offer_edges)
    return communities.community_categories(labels, offer_videos(d))


@query("community_members", OFFER_SIZES.rstrip() + f""",
tops AS (SELECT label FROM sizes ORDER BY num_videos DESC, label LIMIT 5),
offers AS ({OFFER_VIDEOS})
SELECT label, id, category, uploader FROM
  (SELECT label, id FROM labels JOIN tops USING (label) ORDER BY label, id LIMIT 100)
JOIN offers USING (id)""")
def community_members(d):
    labels = communities.label_propagation(d.offer_edges)
    return communities.community_members(labels, offer_videos(d))


# ---------------------------------------------------------------- centrality

DEPTH = 40


def search_steps(links: str) -> str:
    """Breadth-first search from all vertices of `sub`, one expression per level."""
    parts = [
        "f0 AS MATERIALIZED (SELECT id AS root, id, CAST(1 AS DOUBLE) AS sigma, 0 AS dist FROM nodes)"
    ]
    for i in range(1, DEPTH + 1):
        seen = " UNION ALL ".join(f"SELECT root, id FROM f{j}" for j in range(i))
        parts.append(
            f"""f{i} AS MATERIALIZED (SELECT root, dst AS id, sum(sigma) AS sigma, {i} AS dist
  FROM f{i - 1} JOIN {links} ON src = id
  WHERE (root, dst) NOT IN ({seen}) GROUP BY root, dst)"""
        )
    union = " UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(DEPTH + 1))
    parts.append(f"paths AS MATERIALIZED ({union})")
    return ",\n".join(parts)


def delta_steps(links: str) -> str:
    """Dependencies from the deepest level back to the pivots."""
    parts = [f"d{DEPTH} AS MATERIALIZED (SELECT root, id, sigma, CAST(0 AS DOUBLE) AS delta FROM f{DEPTH})"]
    for i in reversed(range(DEPTH)):
        parts.append(
            f"""d{i} AS MATERIALIZED (SELECT v.root, v.id, v.sigma, v.sigma * coalesce(got, 0) AS delta
  FROM f{i} v LEFT JOIN (SELECT root, src AS id, sum((1 + delta) / sigma) AS got
    FROM d{i + 1} JOIN {links} ON dst = id GROUP BY root, src) g
  ON v.root = g.root AND v.id = g.id)"""
        )
    union = " UNION ALL ".join(f"SELECT root, id, delta FROM d{i}" for i in range(DEPTH + 1))
    parts.append(f"deltas AS MATERIALIZED ({union})")
    return ",\n".join(parts)


CENTRALITY = f"""WITH tops AS MATERIALIZED ({TOP.format(k=100)}),
sub AS MATERIALIZED (SELECT src, dst FROM simple WHERE src IN (SELECT id FROM tops)
                     AND dst IN (SELECT id FROM tops)),
nodes AS MATERIALIZED (SELECT src AS id FROM sub UNION SELECT dst FROM sub),
total AS (SELECT count(*) AS n FROM nodes),
{search_steps('sub')},
{delta_steps('sub')},
between_scores AS MATERIALIZED (
  SELECT id, sum(CASE WHEN id <> root THEN delta ELSE 0 END) / ((any_value(n) - 1) * (any_value(n) - 2))
    AS betweenness FROM deltas, total GROUP BY id),
close_scores AS MATERIALIZED (
  SELECT id, CASE WHEN sum(dist) > 0 THEN (count(*) - 1) / CAST(sum(dist) AS DOUBLE) * (count(*) - 1)
                  / (any_value(n) - 1) ELSE 0 END AS closeness FROM paths, total GROUP BY id),
sub_degrees AS MATERIALIZED (
  SELECT id, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree
  FROM (SELECT src AS id, 1 AS o, 0 AS i FROM sub UNION ALL SELECT dst, 0, 1 FROM sub) GROUP BY id)
"""


@query("top_degree_centrality", CENTRALITY.split("total AS")[0].rstrip().rstrip(",") + """
SELECT id, CAST(sum(o) AS BIGINT) AS "outDegree", CAST(sum(i) AS BIGINT) AS "inDegree",
       count(*) AS total_degree
FROM (SELECT src AS id, 1 AS o, 0 AS i FROM sub UNION ALL SELECT dst, 0, 1 FROM sub) GROUP BY id""")
def top_degree_centrality(d):
    return centrality.degree_centrality(d.edges)


@query("top_degree_nodes", 'SELECT * FROM degrees ORDER BY total_degree DESC, id LIMIT 100')
def top_degree_nodes(d):
    return degree.top_by_degree(degree.degree_table(d.edges), 100)


@query("betweenness", CENTRALITY + "SELECT id, round(betweenness, 9) AS betweenness FROM between_scores")
def betweenness(d):
    scores = centrality.betweenness(centrality.top_degree_subgraph(d.edges), num_pivots=100)
    return rounded(scores, "betweenness", digits=9)


@query("closeness", CENTRALITY + "SELECT id, round(closeness, 9) AS closeness FROM close_scores")
def closeness(d):
    scores = centrality.closeness(centrality.top_degree_subgraph(d.edges), num_pivots=100)
    return rounded(scores, "closeness", digits=9)


@query("closeness_sketched", CENTRALITY + "SELECT id, round(closeness, 9) AS closeness FROM close_scores")
def closeness_sketched(d):
    scores = centrality.closeness_sketched(centrality.top_degree_subgraph(d.edges))
    return rounded(scores, "closeness", digits=9)


@query("centrality_table", CENTRALITY + """
SELECT id AS video_id, in_degree, out_degree, in_degree + out_degree AS total_degree,
       round(betweenness, 9) AS betweenness, round(closeness, 9) AS closeness, category, uploader
FROM sub_degrees JOIN between_scores USING (id) JOIN close_scores USING (id) JOIN videos USING (id)""")
def centrality_table(d):
    table = centrality.centrality_table(d.edges, d.videos)
    return rounded(table, "betweenness", "closeness", digits=9)


@query("top_by_metric", CENTRALITY + """
SELECT id AS video_id, in_degree + out_degree AS total_degree, round(closeness, 9) AS closeness
FROM sub_degrees JOIN close_scores USING (id) ORDER BY total_degree DESC, video_id LIMIT 20""")
def top_by_metric(d):
    table = centrality.centrality_table(d.edges, d.videos)
    top = centrality.top_by_metric(table, "total_degree", 20)
    return rounded(top.select("video_id", "total_degree", "closeness"), "closeness", digits=9)


# ---------------------------------------------------------------- structure


@query("graph_summary", """
SELECT n AS num_nodes, m AS num_edges, round(m / (CAST(n AS DOUBLE) * (n - 1)), 9) AS density,
       round(2.0 * m / n, 6) AS avg_degree, round(1.0 * m / n, 6) AS avg_in_degree,
       round(1.0 * m / n, 6) AS avg_out_degree
FROM (SELECT count(*) AS m FROM simple),
     (SELECT count(*) AS n FROM (SELECT src FROM simple UNION SELECT dst FROM simple))""")
def graph_summary(d):
    row = rounded(structure.graph_summary(d.edges), "density", digits=9)
    return rounded(row, "avg_degree", "avg_in_degree", "avg_out_degree")


COMPONENTS = """WITH links AS MATERIALIZED (
  SELECT src AS a, dst AS b FROM offer_edges UNION SELECT dst, src FROM offer_edges),
walk(id, other) AS (SELECT a, a FROM links UNION SELECT walk.id, b FROM walk JOIN links ON other = a),
components AS MATERIALIZED (SELECT id, min(other) AS component FROM walk GROUP BY id)
"""


def offer_components(d: Data) -> DataFrame:
    return structure.weak_components(d.offer_edges)


@query("weak_components", COMPONENTS + "SELECT id, component FROM components")
def weak_components(d):
    return offer_components(d)


@query("component_count", COMPONENTS + """
SELECT count(DISTINCT component) AS num_components FROM components""")
def component_count(d):
    return structure.component_count(offer_components(d))


@query("is_strongly_connected", """
WITH fwd(id) AS (SELECT min(src) FROM simple UNION SELECT dst FROM fwd JOIN simple ON src = id),
back(id) AS (SELECT min(src) FROM simple UNION SELECT src FROM back JOIN simple ON dst = id),
total AS (SELECT count(*) AS n FROM (SELECT src FROM simple UNION SELECT dst FROM simple))
SELECT n AS num_nodes, (SELECT count(*) FROM fwd) = n AND (SELECT count(*) FROM back) = n
  AS strongly_connected FROM total""")
def is_strongly_connected(d):
    answer = structure.strongly_connected(d.edges)
    nodes = degree.vertex_set(d.edges).agg(F.count(F.lit(1)).alias("num_nodes"))
    return nodes.withColumn("strongly_connected", F.lit(answer))


@query("strong_components", """
WITH links AS MATERIALIZED (SELECT DISTINCT src AS a, dst AS b FROM offer_edges),
walk(id, other) AS (
  SELECT id, id FROM (SELECT a AS id FROM links UNION SELECT b FROM links)
  UNION SELECT walk.id, b FROM walk JOIN links ON other = a)
SELECT there.id, min(there.other) AS component
FROM walk there JOIN walk back ON there.id = back.other AND there.other = back.id GROUP BY there.id""")
def strong_components(d):
    return strong.strong_components(d.offer_edges)


@query("reciprocity", """
SELECT m AS num_edges, k AS num_mutual, round(CAST(k AS DOUBLE) / m, 9) AS reciprocity
FROM (SELECT count(*) AS m FROM simple),
     (SELECT count(*) AS k FROM simple e JOIN simple f ON e.src = f.dst AND e.dst = f.src
      WHERE e.src <> e.dst)""")
def reciprocity(d):
    return rounded(structure.reciprocity(d.edges), "reciprocity", digits=9)


@query("top_nodes", """
SELECT id, count(*) AS degree FROM (SELECT src AS id FROM simple UNION ALL SELECT dst FROM simple)
GROUP BY id ORDER BY degree DESC, id LIMIT 5""")
def top_nodes(d):
    return structure.top_nodes(d.edges)


@query("node_attributes", PAGERANK + """
SELECT id, category, uploader, round(rate, 6) AS rating, views, ratings AS ratings_count,
  in_degree, out_degree, in_degree + out_degree AS degree, round(pagerank, 6) AS pagerank,
  greatest(10, least(30, 3 * (in_degree + out_degree))) AS size
FROM (SELECT id, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree FROM
        (SELECT src AS id, 1 AS o, 0 AS i FROM simple UNION ALL SELECT dst, 0, 1 FROM simple)
      GROUP BY id)
JOIN ranks USING (id) JOIN videos USING (id) JOIN
  (SELECT video_id, rate, views, ratings FROM latest) ON video_id = id""")
def node_attributes(d):
    table = structure.node_attributes(
        d.edges, d.videos, d.snapshots, influence.pagerank(d.edges)
    )
    return rounded(table, "rating", "pagerank")


# ---------------------------------------------------------------- samples

EDGE_HASH = "md5('{seed}|' || src || '|' || dst || '|' || crawl_id)"


@query("sample_fraction", f"""
SELECT crawl_id, src, dst FROM edges
WHERE substring({EDGE_HASH.format(seed=7)}, 1, 12) < '{int(0.25 * 16**12):012x}'""")
def sample_fraction(d):
    return sampling.sample_fraction(d.edges, 0.25, sampling.EDGE_KEY, 7)


@query("sample_up_to", f"""
SELECT crawl_id, src, dst FROM edges
WHERE CAST('0x' || substring({EDGE_HASH.format(seed=3)}, 1, 12) AS HUGEINT)
      * (SELECT count(*) FROM edges) < 5000 * CAST({16**12} AS HUGEINT)""")
def sample_up_to(d):
    return sampling.sample_up_to(d.edges, 5000, sampling.EDGE_KEY, 3)


@query("sample_limit", f"""
SELECT crawl_id, src, dst FROM edges ORDER BY {EDGE_HASH.format(seed=0)}, src, dst, crawl_id LIMIT 1000""")
def sample_limit(d):
    return sampling.sample_limit(d.edges, 1000, sampling.EDGE_KEY)


@query("sample_n", """
SELECT id, category FROM videos ORDER BY md5('5|' || id), id LIMIT 200""")
def sample_n(d):
    return sampling.sample_n(d.videos, 200, ["id"], 5).select("id", "category")


@query("hub_subgraph", """
WITH hubs AS (SELECT src AS id FROM edges GROUP BY src ORDER BY count(*) DESC, src LIMIT 50),
near AS MATERIALIZED (
  SELECT crawl_id, src, dst FROM edges WHERE src IN (SELECT id FROM hubs) OR dst IN (SELECT id FROM hubs)
  ORDER BY md5('0|' || src || '|' || dst || '|' || crawl_id), src, dst, crawl_id LIMIT 500),
members AS MATERIALIZED (
  SELECT id FROM (SELECT src AS id FROM near UNION ALL SELECT dst FROM near) GROUP BY id
  ORDER BY id IN (SELECT id FROM hubs) DESC, count(*) DESC, id LIMIT 100)
SELECT crawl_id, src, dst FROM near WHERE src IN (SELECT id FROM members)
  AND dst IN (SELECT id FROM members)""")
def hub_subgraph(d):
    return sampling.hub_subgraph(d.edges, 100)


@query("top_connected_subgraph", f"""
WITH sampled AS MATERIALIZED (SELECT DISTINCT src, dst FROM (
  SELECT src, dst FROM edges ORDER BY {EDGE_HASH.format(seed=2)}, src, dst, crawl_id LIMIT 900)),
members AS MATERIALIZED (
  SELECT id FROM (SELECT src AS id FROM sampled UNION ALL SELECT dst FROM sampled)
  GROUP BY id ORDER BY count(*) DESC, id LIMIT 300)
SELECT src, dst FROM sampled WHERE src IN (SELECT id FROM members)
  AND dst IN (SELECT id FROM members)""")
def top_connected_subgraph(d):
    return sampling.top_connected_subgraph(d.edges, 300, 2)


# ---------------------------------------------------------------- whole analyses


def stacked(results: dict[str, DataFrame], keys: dict[str, tuple[str, str]]) -> DataFrame:
    """One (part, name, n) frame from a label and a count column per result."""
    parts = [
        results[part].select(
            F.lit(part).alias("part"), F.col(name).cast("string").alias("name"), F.col(n).alias("n")
        )
        for part, (name, n) in keys.items()
    ]
    return reduce(DataFrame.union, parts)


DEGREE_PARTS = """
SELECT 'summary' AS part, CAST(max(total_degree) AS STRING) AS name, count(*) AS n FROM degrees
UNION ALL SELECT 'top_videos', id, total_degree FROM
  (SELECT id, total_degree FROM degrees ORDER BY total_degree DESC, id LIMIT 10)
UNION ALL SELECT 'distribution', CAST(total_degree AS STRING), n FROM
  (SELECT total_degree, count(*) AS n FROM degrees GROUP BY 1 ORDER BY 1 LIMIT 50)"""
DEGREE_KEYS = {
    "summary": ("max_total_degree", "num_vertices"),
    "top_videos": ("id", "total_degree"),
    "distribution": ("total_degree", "num_vertices"),
}
CATEGORY_PARTS = """
SELECT 'category_counts' AS part, category AS name, count(*) AS n FROM videos GROUP BY category
UNION ALL SELECT 'length_distribution', CASE WHEN length_sec <= 120 THEN '0-2m'
  WHEN length_sec <= 300 THEN '2-5m' WHEN length_sec <= 600 THEN '5-10m'
  WHEN length_sec <= 1200 THEN '10-20m' ELSE '>20m' END, count(*) FROM videos GROUP BY 2
UNION ALL SELECT 'view_distribution', CASE WHEN views <= 1000 THEN '0-1K'
  WHEN views <= 10000 THEN '1K-10K' WHEN views <= 100000 THEN '10K-100K'
  WHEN views <= 1000000 THEN '100K-1M' WHEN views <= 10000000 THEN '1M-10M' ELSE '>10M' END,
  count(*) FROM video_snapshots GROUP BY 2"""
CATEGORY_KEYS = {
    "category_counts": ("category", "num_videos"),
    "length_distribution": ("length_bucket", "num_videos"),
    "view_distribution": ("view_bucket", "num_videos"),
}


@query("degree_analysis", DEGREE_PARTS)
def degree_analysis(d):
    return stacked(jobs.degree_analysis(d.edges), DEGREE_KEYS)


@query("category_analysis", CATEGORY_PARTS)
def category_analysis(d):
    return stacked(jobs.category_analysis(d.videos, d.snapshots), CATEGORY_KEYS)


@query("degree_job", DEGREE_PARTS + "\nUNION ALL\n" + CATEGORY_PARTS + """
UNION ALL SELECT 'saved', id, total_degree FROM degrees""")
def degree_job(d):
    tables = stored(d)
    results = jobs.degree_job(tables)
    results["saved"] = tables.load_table("degree_statistics")
    return stacked(results, {**DEGREE_KEYS, **CATEGORY_KEYS, "saved": ("id", "total_degree")})


@query("notebook_flow", PAGERANK + """
SELECT 'top_categories' AS part, category AS name, count(*) AS n FROM videos GROUP BY category
UNION ALL SELECT * FROM (SELECT 'most_viewed', video_id, views FROM video_snapshots
  ORDER BY views DESC, video_id, crawl_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'highest_rated', video_id, views FROM video_snapshots
  ORDER BY rate DESC, video_id, crawl_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'by_duration', video_id, views FROM video_snapshots
  WHERE category = 'promo' AND length_sec BETWEEN 200 AND 500
  ORDER BY views DESC, video_id, crawl_id LIMIT 10)
UNION ALL SELECT 'motif', src, count(*) FROM edges JOIN videos ON src = id
  WHERE category = 'promo' GROUP BY src
UNION ALL SELECT * FROM (SELECT 'influence', video_id, views FROM ranks JOIN latest ON id = video_id
  ORDER BY pagerank DESC, video_id LIMIT 10)""")
def notebook_flow(d):
    results = jobs.notebook_flow(stored(d), "Promo")
    results["motif"] = results["motif"].groupBy(F.col("a.id").alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return stacked(
        results,
        {
            "top_categories": ("category", "video_count"),
            "most_viewed": ("video_id", "views"),
            "highest_rated": ("video_id", "views"),
            "by_duration": ("video_id", "views"),
            "motif": ("id", "n"),
            "influence": ("video_id", "views"),
        },
    )
