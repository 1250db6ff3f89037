"""Sources, sinks and ingest."""

import math
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import Data, query
from videonet.functions import cleaning
from videonet.operators import categories, degree, ingest
from videonet.plans.jobs import ingest_crawls
from videonet.session import cut_lineage, drop_shuffles, scratch_path
from videonet.sources import catalog, crawl_files, sinks
from videonet.sources.views import raw_lines_at, raw_places
from videonet.streaming.incremental import parts_of, stream_ingest

# Raw lines that one task writes.
LINES_PER_RANGE = 400_000
# Raw lines are written in about so many goes, of so many lines at least.
WRITES = 4
LINES_PER_WRITE = 2_000_000
LINE = ["crawl_id", "file_name", "block_start", "line_no"]


def stored(d: Data) -> catalog.Catalog:
    """The derived tables written below the shared scratch folder."""
    tables = catalog.Catalog(d.spark, scratch_path(d.spark, "tables"))
    sinks.write_entities(d.edges, tables.path("edges"))
    sinks.write_entities(d.snapshots, tables.path("video_snapshots"))
    seen = d.snapshots.groupBy(F.col("video_id").alias("id")).agg(
        F.array_sort(F.collect_set("crawl_id")).alias("seen_in_crawls")
    )
    videos = d.dated_videos.drop("age_days").join(seen, "id", "left")
    videos.write.parquet(tables.path("videos"))
    return tables


def raw_files(d: Data, codec: str | None = None) -> str:
    """The raw lines as crawl directories with a log file each, below the scratch folder.

    Rows are dealt out and sorted before the text of their lines is made, some crawls at a time where they are many.
    `codec` is the compression of the files.
    """
    path = scratch_path(d.spark, "raw")
    order = ["crawl_id", "file_name", "block_start", "line_no"]
    counts = cut_lineage(d.lines.groupBy("crawl_id").agg(F.count(F.lit(1)).alias("n")))
    # One number per crawl.
    found = {row.crawl_id: row.n for row in counts.collect()}
    rows = raw_places(d.spark, d.sf_dir)
    most = max(LINES_PER_WRITE, math.ceil(sum(found.values()) / WRITES))
    for crawls in parts_of({crawl or "": n for crawl, n in found.items()}, most):
        places = rows.filter(F.coalesce("crawl_id", F.lit("")).isin(crawls))
        # Ranges keep the order over file names and split a crawl over several files, as many as there are lines for.
        ranges = max(8, math.ceil(sum(found.get(c or None, 0) for c in crawls) / LINES_PER_RANGE))
        places = places.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        raw_lines_at(places).write.mode("append").partitionBy("crawl_id").text(path, compression=codec)
        drop_shuffles(d.spark)
    logs = counts.select(
        "crawl_id",
        F.concat_ws(
            "\n",
            F.concat(F.lit("Start: day "), "crawl_id"),
            F.concat(F.lit("Total "), F.col("n").cast("string"), F.lit(" 7")),
            F.lit("Finish: later"),
        ).alias("value"),
    )
    (
        logs.write.mode("append").option("mapreduce.output.basename", "log")
        .partitionBy("crawl_id").text(path)
    )
    return path


@query("load_table", "SELECT crawl_id, src, dst FROM edges")
def load_table(d):
    return stored(d).load_table("edges")


@query("load_all", """
SELECT 'edges' AS table_name, count(*) AS num_rows FROM edges
UNION ALL SELECT 'video_snapshots', count(*) FROM video_snapshots
UNION ALL SELECT 'videos', count(*) FROM videos""")
def load_all(d):
    tables = stored(d).load_all()
    parts = [
        table.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.union, parts)


@query("load_graph", """
SELECT id, category, uploader, length_sec, coalesce(out_edges, 0) AS out_edges FROM videos
LEFT JOIN (SELECT src, count(*) AS out_edges FROM edges GROUP BY src) ON src = id""")
def load_graph(d):
    vertices, edges = catalog.load_graph(d.videos, d.edges)
    counts = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_edges"))
    return vertices.join(counts, "id", "left").na.fill(0, ["out_edges"])


@query("read_raw_crawl", """
SELECT 'crawl_id=' || crawl_id AS crawl_id, value FROM raw_lines""")
def read_raw_crawl(d):
    return crawl_files.read_raw_crawl(d.spark, raw_files(d)).select("crawl_id", "value")


# One log per customer: a line per order, in order-key order.
LOG_LINES = """
SELECT CAST(o_custkey AS STRING) AS path,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS line_no,
       CASE o_orderstatus
         WHEN 'O' THEN ' Start: ' || o_orderpriority || ' '
         WHEN 'F' THEN 'FINISH: ' || CAST(o_orderkey AS STRING)
         ELSE 'Total ' || CAST(o_orderkey AS STRING)
              || CASE WHEN o_orderpriority = '1-URGENT' THEN ' x'
                      ELSE ' ' || CAST(o_custkey AS STRING) END END AS value
FROM orders"""

LOG_SQL = f"""
WITH log_lines AS ({LOG_LINES}),
texts AS (SELECT path, line_no, value, lower(trim(value)) AS text FROM log_lines),
parsed AS (
  SELECT path,
    left(string_agg(value || chr(10), '' ORDER BY line_no), 1000) AS raw_log,
    max_by(trim(replace(text, 'start:', '')), line_no) FILTER (text LIKE '%start:%')
      AS start_time,
    max_by(trim(replace(text, 'finish:', '')), line_no) FILTER (text LIKE '%finish:%')
      AS finish_time,
    max_by(TRY_CAST(string_split(text, ' ')[2] AS BIGINT), line_no)
      FILTER (text LIKE 'total%') AS total_videos,
    max_by(TRY_CAST(string_split(text, ' ')[3] AS BIGINT), line_no)
      FILTER (text LIKE 'total%' AND TRY_CAST(string_split(text, ' ')[3] AS BIGINT) IS NOT NULL)
      AS total_time
  FROM texts GROUP BY path)
"""


def order_logs(d: Data) -> DataFrame:
    lines = d.spark.sql(LOG_LINES.replace("FROM orders", "FROM {orders}"), orders=d.table("orders"))
    lines = lines.withColumn("block_start", F.lit(0).cast("bigint"))
    logs = lines.select(
        "path", F.col("path").alias("crawl_id"), F.lit("log.txt").alias("log_file")
    ).distinct()
    return crawl_files.parse_log_lines(lines, logs)


@query("parse_log_lines", LOG_SQL + """
SELECT path AS crawl_id, 'log.txt' AS log_file, raw_log, start_time, finish_time,
       total_videos, total_time FROM parsed""")
def parse_log_lines(d):
    return order_logs(d).drop("parsed_at", "error")


@query("read_crawl_log", """
SELECT 'crawl_id=' || crawl_id AS crawl_id, 'day ' || crawl_id AS start_time, 'later' AS finish_time,
       count(*) AS total_videos, CAST(7 AS BIGINT) AS total_time,
       'Start: day ' || crawl_id || chr(10) || 'Total ' || count(*) || ' 7' || chr(10)
         || 'Finish: later' || chr(10) AS raw_log
FROM raw_lines GROUP BY crawl_id""")
def read_crawl_log(d):
    logs = crawl_files.read_crawl_log(d.spark, raw_files(d))
    return logs.drop("parsed_at", "error", "log_file")


@query("crawl_registry", LOG_SQL + """
SELECT path AS id, 'Crawl processing from ' || coalesce(start_time, 'unknown') || ' to '
       || coalesce(finish_time, 'unknown') AS notes, total_videos, total_time AS duration_sec
FROM parsed""")
def crawl_registry(d):
    return ingest.crawl_registry(order_logs(d)).select(
        "id", "notes", "total_videos", "duration_sec"
    )


@query("write_entities", """
SELECT video_id, crawl_id, age_days, category, length_sec, views, round(rate, 6) AS rate,
       ratings, comments FROM video_snapshots""")
def write_entities(d):
    path = scratch_path(d.spark, "entities")
    sinks.write_entities(d.snapshots, path)
    tables = catalog.Catalog(d.spark, path)
    return tables.load_table("video_snapshots", path).withColumn("rate", F.round("rate", 6))


@query("save_degree_stats", 'SELECT id, "outDegree", "inDegree", total_degree FROM degrees')
def save_degree_stats(d):
    path = scratch_path(d.spark, "degrees")
    sinks.save_degree_stats(degree.degree_table(d.edges), path)
    return catalog.Catalog(d.spark, path).load_table("degree_statistics", path)


LENGTH_CASE = """CASE WHEN length_sec <= 120 THEN '0-2m' WHEN length_sec <= 300 THEN '2-5m'
  WHEN length_sec <= 600 THEN '5-10m' WHEN length_sec <= 1200 THEN '10-20m' ELSE '>20m' END"""
VIEW_CASE = """CASE WHEN views <= 1000 THEN '0-1K' WHEN views <= 10000 THEN '1K-10K'
  WHEN views <= 100000 THEN '10K-100K' WHEN views <= 1000000 THEN '100K-1M'
  WHEN views <= 10000000 THEN '1M-10M' ELSE '>10M' END"""


@query("save_categorized", f"""
SELECT 'category' AS kind, category AS name, count(*) AS num_videos FROM videos GROUP BY category
UNION ALL
SELECT 'length', {LENGTH_CASE}, count(*) FROM videos GROUP BY 2""")
def save_categorized(d):
    prefix = scratch_path(d.spark, "categorized")
    written = sinks.save_categorized(
        {
            "category": categories.category_counts(d.videos),
            "length": categories.length_buckets(d.videos),
            "views": categories.view_buckets(d.videos),
            "none": categories.category_counts(d.videos).filter(F.lit(False)),
        },
        prefix,
    )
    parts = [
        d.spark.read.parquet(path).toDF("name", "num_videos").select(
            F.lit(path.removeprefix(f"{prefix}_")).alias("kind"), "name", "num_videos"
        )
        for path in written
    ]
    return reduce(DataFrame.union, parts)


@query("archive_result", """
SELECT kind, name, n, 10 AS k, '03-09-2024' AS created_date, '08:05:01' AS created_time,
       '03-09-2024_08-05-01' AS run_ts FROM (
  SELECT 'degree' AS kind, id AS name, total_degree AS n FROM degrees
  UNION ALL SELECT 'category', category, count(*) FROM videos GROUP BY category)""")
def archive_result(d):
    path = scratch_path(d.spark, "archive")
    now = datetime(2024, 3, 9, 8, 5, 1)
    degrees = degree.degree_table(d.edges)
    sinks.archive_result(
        degrees.select(F.col("id").alias("name"), F.col("total_degree").alias("n")),
        path, "degree", {"k": 10}, now,
    )
    sinks.archive_result(
        categories.category_counts(d.videos).toDF("name", "n"), path, "category", {"k": 10}, now
    )
    return d.spark.read.parquet(path)


@query("export_result", """
SELECT 'csv' AS file_format, id, total_degree FROM degrees
UNION ALL SELECT 'json', id, total_degree FROM degrees""")
def export_result(d):
    degrees = degree.degree_table(d.edges).select("id", "total_degree")
    parts = []
    for kind in ("csv", "json"):
        path = scratch_path(d.spark, kind)
        sinks.export_result(degrees, path, kind)
        reader = d.spark.read.schema("id string, total_degree bigint").option("header", True)
        parts.append(reader.format(kind).load(path).withColumn("file_format", F.lit(kind)))
    return parts[0].unionByName(parts[1])


PROFILE = """
SELECT 'videos' AS table_name, true AS table_exists, count(*) AS num_rows,
       'id,uploader,category,length_sec,age_days' AS column_names FROM videos
UNION ALL SELECT 'edges', true, count(*), 'crawl_id,src,dst' FROM edges
UNION ALL SELECT 'crawls', false, 0, ''"""


@query("dataset_profile", PROFILE)
def dataset_profile(d):
    return catalog.dataset_profile(
        d.spark, {"videos": d.videos, "edges": d.edges, "crawls": None}
    )


@query("list_tables", """
SELECT 'edges' AS table_name, count(*) AS num_rows FROM edges
UNION ALL SELECT 'videos', count(*) FROM videos""")
def list_tables(d):
    created = catalog.create_views({"videos": d.videos, "edges": d.edges})
    names = [name for name in catalog.list_tables(d.spark) if name in created]
    parts = [
        d.spark.table(name).agg(F.count(F.lit(1)).alias("num_rows")).withColumn(
            "table_name", F.lit(name)
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)


@query("temp_view", """
SELECT v.category, count(*) AS num_edges FROM edges e JOIN videos v ON e.src = v.id
GROUP BY v.category""")
def temp_view(d):
    catalog.create_views({"videos": d.videos, "edges": d.edges})
    return d.spark.sql(
        "SELECT v.category, count(*) AS num_edges FROM edges e JOIN videos v ON e.src = v.id"
        " GROUP BY v.category"
    )


@query("split_lines", """
SELECT crawl_id, file_name, block_start, line_no, CAST(len(f) AS BIGINT) AS num_fields,
       f[1] AS first_field, f[len(f)] AS last_field FROM fielded""")
def split_lines(d):
    return ingest.split_lines(d.lines).select(
        *LINE,
        F.size("fields").cast("bigint").alias("num_fields"),
        F.element_at("fields", 1).alias("first_field"),
        F.element_at("fields", -1).alias("last_field"),
    )


@query("classify_malformed", """
SELECT crawl_id, reason, count(*) AS num_lines FROM classified WHERE reason IS NOT NULL
GROUP BY crawl_id, reason""")
def classify_malformed(d):
    return ingest.reject_counts(ingest.rejected_lines(d.lines))


@query("valid_video_id", """
SELECT crawl_id, regexp_full_match(trim(f[1]), '[A-Za-z0-9_-]{11}') AS is_valid,
       count(*) AS num_lines FROM fielded GROUP BY 1, 2""")
def valid_video_id(d):
    first = cleaning.strip(F.element_at("fields", 1))
    return ingest.split_lines(d.lines).groupBy(
        "crawl_id", cleaning.is_video_id(first).alias("is_valid")
    ).agg(F.count(F.lit(1)).alias("num_lines"))


@query("dedupe_in_crawl", """
SELECT crawl_id, video_id, uploader, age_days, category, length_sec, views, rate, ratings,
       comments, array_to_string(related_ids, ',') AS related, copies FROM deduped""")
def dedupe_in_crawl(d):
    records = ingest.dedupe_in_crawl(ingest.typed_records(d.lines))
    return records.withColumn("related", F.array_join("related_ids", ",")).drop("related_ids")


@query("safe_cast", """
SELECT crawl_id, file_name, block_start, line_no, coalesce(TRY_CAST(f[3] AS BIGINT), 0) AS age,
       coalesce(TRY_CAST(f[6] AS BIGINT), 0) AS views,
       coalesce(TRY_CAST(f[7] AS DOUBLE), 0) AS rate FROM fielded""")
def safe_cast(d):
    lines = ingest.split_lines(d.lines)
    return lines.select(
        *LINE,
        cleaning.to_long(F.get("fields", 2)).alias("age"),
        cleaning.to_long(F.get("fields", 5)).alias("views"),
        cleaning.to_double(F.get("fields", 6)).alias("rate"),
    )


def record_query(name, columns):
    """A query over some columns of the typed records."""
    sql = f"SELECT {', '.join(LINE)}, {', '.join(columns)} FROM records"

    @query(name, sql)
    def run(d):
        return ingest.typed_records(d.lines).select(*LINE, *columns)


record_query("clamp_metrics", ["views", "rate", "ratings", "comments"])
record_query("normalize_category", ["category"])
record_query("default_uploader", ["uploader"])


@query("age_to_date", """
SELECT video_id, CAST(DATE '2005-02-15' + CAST(age_days AS INTEGER) AS DATE) AS date_uploaded,
       count(*) AS num_lines FROM records GROUP BY 1, 2""")
def age_to_date(d):
    day = cleaning.age_to_date(F.col("age_days")).alias("date_uploaded")
    records = ingest.typed_records(d.lines)
    return records.groupBy("video_id", day).agg(F.count(F.lit(1)).alias("num_lines"))


@query("clean_related", """
SELECT crawl_id, file_name, block_start, line_no, CAST(len(related_ids) AS BIGINT) AS num_related,
       array_to_string(related_ids, ',') AS related FROM records""")
def clean_related(d):
    return ingest.typed_records(d.lines).select(
        *LINE,
        F.size("related_ids").cast("bigint").alias("num_related"),
        F.array_join("related_ids", ",").alias("related"),
    )


@query("explode_edges", """
SELECT crawl_id, video_id AS src, unnest(related_ids) AS dst FROM deduped""")
def explode_edges(d):
    return ingest.explode_edges(ingest.dedupe_in_crawl(ingest.typed_records(d.lines)))


@query("project_entities", """
SELECT d.video_id, d.crawl_id, d.age_days, d.category, d.length_sec, d.views, d.rate, d.ratings,
       d.comments, v.uploader, v.date_uploaded
FROM deduped d JOIN new_videos v ON d.video_id = v.id AND d.crawl_id = v.crawl_id""")
def project_entities(d):
    records = ingest.dedupe_in_crawl(ingest.typed_records(d.lines))
    videos = ingest.project_videos(records).select(
        F.col("id").alias("video_id"),
        F.element_at("seen_in_crawls", 1).alias("crawl_id"),
        "uploader",
        "date_uploaded",
    )
    return ingest.project_snapshots(records).join(videos, ["video_id", "crawl_id"])


UPSERTED = """
SELECT id, max_by(uploader, crawl_id) AS uploader, max_by(category, crawl_id) AS category,
       max_by(length_sec, crawl_id) AS length_sec, max_by(date_uploaded, crawl_id) AS date_uploaded,
       string_agg(crawl_id, ',' ORDER BY crawl_id) AS seen_in_crawls
FROM new_videos GROUP BY id"""


@query("upsert_videos", UPSERTED)
def upsert_videos(d):
    videos = ingest.project_videos(ingest.dedupe_in_crawl(ingest.typed_records(d.lines)))
    early = F.element_at("seen_in_crawls", 1) <= "1997"
    first = ingest.upsert_videos(None, videos.filter(early))
    merged = ingest.upsert_videos(first, videos.filter(~early))
    return merged.withColumn("seen_in_crawls", F.array_join("seen_in_crawls", ","))


@query("skip_processed", """
SELECT crawl_id FROM raw_lines GROUP BY crawl_id
HAVING crawl_id NOT IN (SELECT CAST(year(o_orderdate) AS STRING) FROM orders
                        WHERE o_orderstatus = 'P' AND year(o_orderdate) < 1998)""")
def skip_processed(d):
    orders = d.table("orders").filter("o_orderstatus = 'P' AND year(o_orderdate) < 1998")
    registered = orders.select(F.year("o_orderdate").cast("string").alias("id")).distinct()
    return ingest.skip_processed(d.lines.select("crawl_id").distinct(), registered)


STATS = """
SELECT crawl_id, CAST(sum(n) AS BIGINT) AS total_lines,
       CAST(sum(CASE WHEN good THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
       CAST(sum(CASE WHEN good THEN 0 ELSE n END) AS BIGINT) AS malformed,
       CAST(sum(CASE WHEN good THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicates,
       count(DISTINCT all_crawls) AS crawls_processed,
       round(sum(CASE WHEN good THEN 1 ELSE 0 END) * 100.0 / sum(n), 6) AS retention_pct
FROM (SELECT {crawl} AS crawl_id, crawl_id AS all_crawls, reason IS NULL AS good,
             CASE WHEN reason IS NULL THEN trim(f[1]) END AS video_id, count(*) AS n
      FROM classified GROUP BY 1, 2, 3, 4) GROUP BY 1"""


@query("ingest_stats", STATS.format(crawl="crawl_id") + " UNION ALL "
       + STATS.format(crawl="CAST(NULL AS STRING)"))
def ingest_stats(d):
    records = ingest.dedupe_in_crawl(ingest.typed_records(d.lines))
    stats = ingest.ingest_stats(records, ingest.rejected_lines(d.lines))
    return stats.withColumn("retention_pct", F.round("retention_pct", 6))


@query("anti_processed", """
SELECT crawl_id, count(*) AS num_lines FROM raw_lines
WHERE crawl_id NOT IN (SELECT DISTINCT CAST(year(o_orderdate) AS STRING) FROM orders
                       WHERE o_orderstatus = 'P' AND year(o_orderdate) < 1998)
GROUP BY crawl_id""")
def anti_processed(d):
    orders = d.table("orders").filter("o_orderstatus = 'P' AND year(o_orderdate) < 1998")
    registered = orders.select(F.year("o_orderdate").cast("string").alias("id")).distinct()
    return ingest.skip_processed(d.lines, registered).groupBy("crawl_id").agg(
        F.count(F.lit(1)).alias("num_lines")
    )


@query("add_to_set", """
SELECT video_id, string_agg(crawl_id, ',' ORDER BY crawl_id) AS crawls FROM
  (SELECT DISTINCT video_id, crawl_id FROM (
     SELECT video_id, crawl_id FROM video_snapshots
     UNION ALL SELECT src, crawl_id FROM edges WHERE src IN (SELECT video_id FROM video_snapshots)))
GROUP BY video_id""")
def add_to_set(d):
    known = d.snapshots.groupBy("video_id").agg(F.collect_set("crawl_id").alias("known"))
    linked = d.edges.groupBy(F.col("src").alias("video_id")).agg(
        F.collect_set("crawl_id").alias("linked")
    )
    united = ingest.unite_crawls(F.col("known"), F.coalesce("linked", F.array().cast("array<string>")))
    return known.join(linked, "video_id", "left").select(
        "video_id", F.array_join(united, ",").alias("crawls")
    )


INGESTED = """
SELECT 'video' AS kind, id AS a, category AS b, seen AS c, 0 AS n FROM
  (SELECT id, max_by(category, crawl_id) AS category,
          string_agg('crawl_id=' || crawl_id, ',' ORDER BY crawl_id) AS seen
   FROM new_videos GROUP BY id)
UNION ALL SELECT 'snapshot', video_id, 'crawl_id=' || crawl_id, '', views FROM deduped
UNION ALL SELECT 'edge', src, 'crawl_id=' || crawl_id, dst, 0 FROM
  (SELECT crawl_id, video_id AS src, unnest(related_ids) AS dst FROM deduped)
UNION ALL SELECT 'crawl', 'crawl_id=' || crawl_id,
  'Crawl processing from day ' || crawl_id || ' to later', '', count(*) FROM raw_lines
  GROUP BY crawl_id"""


def ingested(d: Data, base: str) -> DataFrame:
    tables = catalog.Catalog(d.spark, base)
    zero = F.lit(0).cast("bigint")
    parts = [
        tables.load_table("videos").select(
            F.lit("video"), "id", "category", F.array_join("seen_in_crawls", ","), zero
        ),
        tables.load_table("video_snapshots").select(
            F.lit("snapshot"), "video_id", "crawl_id", F.lit(""), "views"
        ),
        tables.load_table("edges").select(F.lit("edge"), "src", "crawl_id", "dst", zero),
        tables.load_table("crawls").select(
            F.lit("crawl"), "id", "notes", F.lit(""), "total_videos"
        ),
    ]
    return reduce(DataFrame.union, parts).toDF("kind", "a", "b", "c", "n")


@query("ingest", INGESTED)
def run_ingest(d):
    raw, base = raw_files(d), scratch_path(d.spark, "ingested")
    ingest_crawls(d.spark, raw, base)
    return ingested(d, base)


@query("stream_ingest", INGESTED)
def run_stream_ingest(d):
    raw, base = raw_files(d), scratch_path(d.spark, "streamed")
    stream_ingest(d.spark, raw, base, scratch_path(d.spark, "stream")).awaitTermination()
    return ingested(d, base)


@query("stream_dedupe", """
SELECT video_id, 'crawl_id=' || crawl_id AS crawl_id, views, rate, ratings FROM deduped""")
def run_stream_dedupe(d):
    # A second run over the same directory must not add a record.
    raw, base = raw_files(d, "gzip"), scratch_path(d.spark, "streamed")
    for _ in range(2):
        checkpoint = scratch_path(d.spark, "stream")
        stream_ingest(d.spark, raw, base, checkpoint, crawl_files.TEXT_OR_GZIP).awaitTermination()
    snapshots = catalog.Catalog(d.spark, base).load_table("video_snapshots")
    return snapshots.select("video_id", "crawl_id", "views", "rate", "ratings")
