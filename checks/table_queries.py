"""Projections, filters, aggregations, windows, top-k and paging."""

from datetime import date

from pyspark.sql import functions as F

from checks.registry import query
from checks.source_queries import LENGTH_CASE, VIEW_CASE
from videonet.functions import labels
from videonet.operators import categories, degree, metrics, search
from videonet.session import scratch_path

RATED = """views, round(rate, 6) AS rating, ratings AS num_ratings"""


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("by_category", "SELECT * FROM videos WHERE category = 'promo'")
def by_category(d):
    return search.by_category(d.videos, " Promo ")


@query("between", """
SELECT video_id, crawl_id, length_sec FROM video_snapshots WHERE length_sec BETWEEN 200 AND 500""")
def between(d):
    return search.between(d.snapshots, "length_sec", 200, 500).select(
        "video_id", "crawl_id", "length_sec"
    )


@query("min_threshold", "SELECT video_id, crawl_id, ratings FROM video_snapshots WHERE ratings >= 50")
def min_threshold(d):
    rows = search.min_threshold(d.snapshots, "ratings", 50)
    return rows.select("video_id", "crawl_id", "ratings")


@query("in_subquery", """
SELECT crawl_id, src, dst FROM edges WHERE src IN (SELECT id FROM videos WHERE category = 'promo')""")
def in_subquery(d):
    return search.in_ids(d.edges, search.by_category(d.videos, "promo"), "src").select(
        "crawl_id", "src", "dst"
    )


@query("in_list", """
SELECT id, category, uploader FROM videos WHERE id IN
  (SELECT id FROM degrees ORDER BY total_degree DESC, id LIMIT 50)""")
def in_list(d):
    top = degree.top_by_degree(degree.degree_table(d.edges), 50)
    return search.in_ids(d.videos, top, "id").select("id", "category", "uploader")


@query("exists_filter", """
SELECT video_id, crawl_id, views FROM video_snapshots WHERE rate IS NOT NULL AND views > 0""")
def exists_filter(d):
    rows = search.exists_filter(search.exists_filter(d.snapshots, "rate"), "views", positive=True)
    return rows.select("video_id", "crawl_id", "views")


@query("null_to_zero", """
SELECT id, coalesce(views, 0) AS views, coalesce(round(rate, 6), 0) AS rating,
       coalesce(ratings, 0) AS num_ratings, coalesce(s.length_sec, 0) AS duration_sec
FROM (SELECT id FROM videos UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR) FROM supplier) v
LEFT JOIN video_snapshots s ON v.id = s.video_id""")
def null_to_zero(d):
    metrics = d.snapshots.select(
        F.col("video_id").alias("id"), "views", "rate", "ratings", "length_sec"
    )
    # Suppliers are no videos, so they have no snapshot.
    others = d.table("supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"))
    joined = d.videos.select("id").union(others).join(metrics, "id", "left")
    return rounded(labels.result_columns(joined), "rating")


@query("duration_formatted", """
SELECT id, (length_sec // 60) || ':' || lpad(CAST(length_sec % 60 AS STRING), 2, '0') AS duration
FROM videos""")
def duration_formatted(d):
    return d.videos.select(
        "id", labels.duration_formatted(F.col("length_sec")).alias("duration")
    )


@query("video_urls", """
SELECT id, 'https://videos.example/watch?v=' || id AS url, 'https://v.example/' || id AS short_url
FROM videos""")
def video_urls(d):
    return labels.video_urls(
        d.videos.select("id"), "https://videos.example/watch?v=", "https://v.example/", "id"
    )


@query("display_trim", """
SELECT substring(p_name || ' by ' || p_brand, 1, 30) AS uploader,
       round(p_retailprice / 7, 6) AS pagerank FROM part""")
def display_trim(d):
    rows = d.table("part").select(
        F.concat("p_name", F.lit(" by "), "p_brand").alias("uploader"),
        (F.col("p_retailprice") / 7).alias("pagerank"),
    )
    return labels.display_trim(rows)


@query("multi_criteria", """
SELECT s.video_id, s.crawl_id, s.views, coalesce(n, 0) AS related_count
FROM video_snapshots s LEFT JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) ON src = video_id
WHERE category IN ('promo', 'small') AND length_sec BETWEEN 200 AND 1000
  AND views BETWEEN 100 AND 1000000 AND rate BETWEEN 1 AND 4.5 AND comments BETWEEN 2 AND 10
  AND coalesce(n, 0) BETWEEN 5 AND 30
  AND DATE '2005-02-15' + CAST(age_days AS INTEGER) BETWEEN DATE '2005-06-01' AND DATE '2007-06-30'
""")
def multi_criteria(d):
    criteria = search.Criteria(
        categories=("promo", "Small"),
        duration=(200, 1000),
        views=(100, 1_000_000),
        rating=(1.0, 4.5),
        comments=(2, 10),
        related_count=(5, 30),
        uploaded=(date(2005, 6, 1), date(2007, 6, 30)),
    )
    rows = search.multi_criteria(d.snapshots, criteria, degree.out_degree(d.edges))
    return rows.select("video_id", "crawl_id", "views", "related_count")


@query("presets", """
SELECT CASE WHEN length_sec < 300 THEN 'Short' WHEN length_sec <= 1200 THEN 'Medium'
            ELSE 'Long' END AS duration_preset,
       CASE WHEN views > 1000000 THEN 'Viral' WHEN views >= 100000 THEN 'Popular'
            ELSE 'Growing' END AS views_preset, count(*) AS n
FROM video_snapshots GROUP BY 1, 2""")
def presets(d):
    return search.with_presets(d.snapshots).groupBy("duration_preset", "views_preset").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("out_degree", 'SELECT src AS id, count(*) AS "outDegree" FROM edges GROUP BY src')
def out_degree(d):
    return degree.out_degree(d.edges)


@query("in_degree", 'SELECT dst AS id, count(*) AS "inDegree" FROM edges GROUP BY dst')
def in_degree(d):
    return degree.in_degree(d.edges)


@query("degree_table", 'SELECT id, "outDegree", "inDegree", total_degree FROM degrees')
def degree_table(d):
    return degree.degree_table(d.edges)


@query("degree_outer", """
SELECT coalesce(o.id, i.id) AS id, coalesce(o.n, 0) AS "outDegree", coalesce(i.n, 0) AS "inDegree",
       coalesce(o.n, 0) + coalesce(i.n, 0) AS total_degree
FROM (SELECT src AS id, count(*) AS n FROM offer_edges GROUP BY src) o
FULL JOIN (SELECT dst AS id, count(*) AS n FROM offer_edges GROUP BY dst) i ON o.id = i.id""")
def degree_outer(d):
    return degree.degree_table(d.offer_edges)


@query("degree_summary", """
SELECT count(*) AS num_vertices, round(avg(total_degree), 6) AS avg_total_degree,
       round(stddev_samp(total_degree), 6) AS std_total_degree,
       min(total_degree) AS min_total_degree, max(total_degree) AS max_total_degree,
       round(avg("outDegree"), 6) AS avg_out_degree, max("outDegree") AS max_out_degree,
       round(avg("inDegree"), 6) AS avg_in_degree, max("inDegree") AS max_in_degree
FROM degrees""")
def degree_summary(d):
    return rounded(
        degree.degree_summary(degree.degree_table(d.edges)),
        "avg_total_degree", "std_total_degree", "avg_out_degree", "avg_in_degree",
    )


@query("degree_histogram", """
SELECT total_degree, count(*) AS num_vertices FROM degrees GROUP BY total_degree
ORDER BY total_degree LIMIT 20""")
def degree_histogram(d):
    return degree.degree_histogram(degree.degree_table(d.edges))


@query("describe_degrees", """
SELECT 'inDegree' AS degree, count(*) AS num_vertices, round(avg("inDegree"), 6) AS mean,
       round(stddev_samp("inDegree"), 6) AS stddev, min("inDegree") AS min_value,
       max("inDegree") AS max_value FROM degrees
UNION ALL
SELECT 'outDegree', count(*), round(avg("outDegree"), 6), round(stddev_samp("outDegree"), 6),
       min("outDegree"), max("outDegree") FROM degrees""")
def describe_degrees(d):
    return rounded(degree.describe_degrees(degree.degree_table(d.edges)), "mean", "stddev")


@query("category_counts", "SELECT category, count(*) AS num_videos FROM videos GROUP BY category")
def category_counts(d):
    return categories.category_counts(d.videos)


@query("category_share", """
SELECT category, num_videos, round(num_videos * 100.0 / sum(num_videos) OVER (), 6) AS pct_of_shown,
       round(num_videos * 100.0 / (SELECT count(*) FROM videos), 6) AS pct_of_all
FROM (SELECT coalesce(category, 'Unknown') AS category, count(*) AS num_videos FROM videos
      GROUP BY 1 ORDER BY num_videos DESC, category LIMIT 4)""")
def category_share(d):
    return rounded(categories.category_share(d.videos, 4), "pct_of_shown", "pct_of_all")


@query("length_buckets", f"""
SELECT {LENGTH_CASE} AS length_bucket, count(*) AS num_videos FROM videos GROUP BY 1""")
def length_buckets(d):
    return categories.length_buckets(d.videos)


@query("view_buckets", f"""
SELECT {VIEW_CASE} AS view_bucket, count(*) AS num_videos FROM video_snapshots GROUP BY 1""")
def view_buckets(d):
    return categories.view_buckets(d.snapshots)


@query("rating_buckets", """
SELECT CASE WHEN rate >= 0 AND rate < 6 THEN CAST(CAST(floor(rate) AS BIGINT) AS STRING) || '-'
            || CAST(CAST(floor(rate) AS BIGINT) + 1 AS STRING) ELSE 'Other' END AS rating_bucket,
       count(*) AS num_snapshots FROM video_snapshots WHERE rate IS NOT NULL GROUP BY 1""")
def rating_buckets(d):
    return categories.rating_buckets(d.snapshots)


@query("view_summary", """
SELECT round(avg(views), 4) AS avg_views, max(views) AS max_views, min(views) AS min_views,
       CAST(sum(views) AS BIGINT) AS total_views FROM video_snapshots WHERE views > 0""")
def view_summary(d):
    return rounded(categories.view_summary(d.snapshots), "avg_views", digits=4)


@query("top_uploaders", """
SELECT uploader, count(*) AS num_videos FROM videos GROUP BY uploader
ORDER BY num_videos DESC, uploader LIMIT 10""")
def top_uploaders(d):
    return categories.top_uploaders(d.videos)


@query("avg_total_degree", "SELECT round(avg(total_degree), 6) AS avg_total_degree FROM degrees")
def avg_total_degree(d):
    return rounded(degree.avg_total_degree(degree.degree_table(d.edges)), "avg_total_degree")


@query("distinct_categories", "SELECT DISTINCT category FROM videos WHERE category <> ''")
def distinct_categories(d):
    return categories.distinct_categories(d.videos)


@query("result_category_mix", """
SELECT category, count(*) AS num_rows FROM (
  SELECT * FROM video_snapshots WHERE views BETWEEN 1000 AND 100000
  ORDER BY views DESC, video_id, crawl_id LIMIT 500) GROUP BY category""")
def result_category_mix(d):
    return categories.result_category_mix(
        search.by_views(d.snapshots, 1000, 100000, max_results=500)
    )


@query("histogram", """
WITH bounds AS (SELECT CAST(min(length_sec) AS DOUBLE) AS low, CAST(max(length_sec) AS DOUBLE) AS high
                FROM video_snapshots),
binned AS (SELECT CAST(least(20, floor((length_sec - low) / ((high - low) / 20)) + 1) AS BIGINT) AS bin,
                  low, (high - low) / 20 AS width FROM video_snapshots, bounds)
SELECT bin, round(any_value(low) + (bin - 1) * any_value(width), 6) AS bin_start,
       round(any_value(low) + bin * any_value(width), 6) AS bin_end, count(*) AS num_rows
FROM binned GROUP BY bin""")
def histogram(d):
    return rounded(categories.histogram(d.snapshots, "length_sec", 20), "bin_start", "bin_end")


@query("run_metrics", """
SELECT 'by_views' AS query_type, count(*) AS rows_processed, 500 AS rows_returned,
       round(500 * 100.0 / count(*), 6) AS selectivity, '{"max_results": 500}' AS params
FROM video_snapshots""")
def run_metrics(d):
    path = scratch_path(d.spark, "measured")
    row = metrics.run_measured(
        "by_views",
        d.snapshots,
        lambda s: search.by_views(s, 0, 10**12, max_results=500),
        lambda result: result.write.parquet(path),
        {"max_results": 500},
    )
    return rounded(row, "selectivity").select(
        "query_type", "rows_processed", "rows_returned", "selectivity", "params"
    )


@query("run_history", """
SELECT event_type AS query_type, count(*) AS num_runs, round(avg(value), 6) AS avg_time,
       min(value) AS best_time, max(value) AS worst_time FROM events GROUP BY event_type""")
def run_history(d):
    log = d.table("events").select(
        F.col("event_type").alias("query_type"), F.col("value").alias("execution_time")
    )
    return rounded(metrics.run_history(log), "avg_time")


@query("row_count", "SELECT count(*) AS num_rows FROM video_snapshots")
def row_count(d):
    return metrics.row_count(d.snapshots)


@query("overview_metrics", """
SELECT (SELECT count(*) FROM videos) AS total_videos, (SELECT count(*) FROM edges) AS total_edges,
  (SELECT count(DISTINCT category) FROM videos) AS unique_categories,
  (SELECT CAST(DATE '2005-02-15' + CAST(min(age_days) AS INTEGER) AS DATE) FROM videos) AS first_upload,
  (SELECT CAST(DATE '2005-02-15' + CAST(max(age_days) AS INTEGER) AS DATE) FROM videos) AS last_upload,
  c.category AS top_category, c.n AS top_category_videos, m.video_id AS most_viewed_video,
  m.views AS most_views, (SELECT round(avg(total_degree), 6) FROM degrees) AS avg_degree,
  (SELECT max(crawl_id) FROM video_snapshots) AS latest_crawl
FROM (SELECT category, count(*) AS n FROM videos GROUP BY category ORDER BY n DESC, category LIMIT 1) c,
     (SELECT video_id, views FROM video_snapshots ORDER BY views DESC, video_id DESC LIMIT 1) m""")
def overview_metrics(d):
    crawls = d.snapshots.select(F.col("crawl_id").alias("id")).distinct()
    return rounded(
        categories.overview_metrics(
            d.dated_videos, d.snapshots, d.edges, crawls, degree.degree_table(d.edges)
        ),
        "avg_degree",
    )


@query("latest_snapshot", """
SELECT video_id, crawl_id, age_days, category, length_sec, views, round(rate, 6) AS rate, ratings,
       comments FROM latest""")
def latest_snapshot(d):
    return rounded(search.latest_snapshot(d.snapshots), "rate")


@query("rank_output", """
SELECT video_id, crawl_id, views, row_number() OVER (ORDER BY views DESC, video_id, crawl_id) AS rank
FROM video_snapshots ORDER BY rank LIMIT 25""")
def rank_output(d):
    rows = d.snapshots.select("video_id", "crawl_id", "views")
    return search.rank_output(rows, [F.desc("views"), "video_id", "crawl_id"], 25)


@query("crawl_deltas", """
SELECT video_id, crawl_id, lag(crawl_id) OVER w AS previous_crawl_id, views,
       views - lag(views) OVER w AS views_delta, ratings - lag(ratings) OVER w AS ratings_delta,
       comments - lag(comments) OVER w AS comments_delta,
       round(rate - lag(rate) OVER w, 6) AS rate_delta
FROM video_snapshots WINDOW w AS (PARTITION BY video_id ORDER BY crawl_id)""")
def crawl_deltas(d):
    return rounded(search.crawl_deltas(d.snapshots), "rate_delta")


@query("top_categories", """
SELECT category, count(*) AS video_count FROM videos GROUP BY category
ORDER BY video_count DESC, category LIMIT 3""")
def top_categories(d):
    return search.top_categories(d.videos, 3)


@query("most_viewed", f"""
SELECT video_id, crawl_id, category, {RATED} FROM video_snapshots
ORDER BY views DESC, video_id, crawl_id LIMIT 5000""")
def most_viewed(d):
    return rounded(search.most_viewed(d.snapshots, 5000), "rating")


@query("most_viewed_latest", f"""
SELECT video_id, crawl_id, category, {RATED} FROM latest
ORDER BY views DESC, video_id, crawl_id LIMIT 10""")
def most_viewed_latest(d):
    return rounded(search.most_viewed(d.snapshots, latest_only=True), "rating")


@query("highest_rated", f"""
SELECT video_id, crawl_id, category, {RATED} FROM video_snapshots WHERE ratings >= 30
ORDER BY rate DESC, video_id, crawl_id LIMIT 20""")
def highest_rated(d):
    return rounded(search.highest_rated(d.snapshots, 20, 30), "rating")


@query("top_by_degree", """
SELECT 'total' AS kind, * FROM (SELECT * FROM degrees ORDER BY total_degree DESC, id LIMIT 10)
UNION ALL SELECT 'in', * FROM (SELECT * FROM degrees ORDER BY "inDegree" DESC, id LIMIT 10)
UNION ALL SELECT 'out', * FROM (SELECT * FROM degrees ORDER BY "outDegree" DESC, id LIMIT 10)""")
def top_by_degree(d):
    degrees = degree.degree_table(d.edges)
    total, into, out = (
        degree.top_by_degree(degrees, 10, kind).withColumn("kind", F.lit(kind))
        for kind in ("total", "in", "out")
    )
    return total.union(into).union(out)


DURATION = """length_sec AS duration_sec, views, round(rate, 6) AS rating, category,
  (length_sec // 60) || ':' || lpad(CAST(length_sec % 60 AS STRING), 2, '0') AS duration_formatted"""


@query("by_duration", f"""
SELECT video_id, crawl_id, {DURATION} FROM video_snapshots
WHERE category = 'promo' AND length_sec BETWEEN 200 AND 500 ORDER BY video_id, crawl_id LIMIT 100""")
def by_duration(d):
    return rounded(search.by_duration(d.snapshots, "Promo", 200, 500), "rating")


@query("by_views", f"""
SELECT video_id, crawl_id, {RATED}, category, length_sec AS duration_sec FROM video_snapshots
WHERE views BETWEEN 1000 AND 500000 AND category = 'small'
ORDER BY views DESC, video_id, crawl_id LIMIT 100""")
def by_views(d):
    return rounded(search.by_views(d.snapshots, 1000, 500000, "small"), "rating")


@query("range_by_views_order", f"""
SELECT video_id, crawl_id, {DURATION} FROM video_snapshots
WHERE category = 'promo' AND length_sec BETWEEN 200 AND 500
ORDER BY views DESC, video_id, crawl_id LIMIT 10""")
def range_by_views_order(d):
    rows = search.by_duration(d.snapshots, "promo", 200, 500, 10, order_by_views=True)
    return rounded(rows, "rating")


@query("paginate", """
SELECT video_id, crawl_id, views FROM video_snapshots ORDER BY views DESC, video_id, crawl_id
LIMIT 50 OFFSET 100""")
def paginate(d):
    rows = d.snapshots.select("video_id", "crawl_id", "views")
    return search.paginate(rows, [F.desc("views"), "video_id", "crawl_id"], 3)


@query("page_after", """
SELECT video_id, crawl_id, views FROM video_snapshots
WHERE views < 250000 OR (views = 250000 AND (video_id, crawl_id) > ('v', '1998'))
ORDER BY views DESC, video_id, crawl_id LIMIT 50""")
def page_after(d):
    rows = d.snapshots.select("video_id", "crawl_id", "views")
    order = {"views": True, "video_id": False, "crawl_id": False}
    last = {"views": 250000, "video_id": "v", "crawl_id": "1998"}
    return search.page_after(rows, order, last)
