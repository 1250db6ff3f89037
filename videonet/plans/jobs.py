"""Whole jobs over stored tables: analyses, batch statistics and ingest."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.operators import categories, degree, ingest, sampling, search
from videonet.operators.graph import build_graph
from videonet.operators.influence import influence_report, pagerank
from videonet.operators.metrics import run_measured
from videonet.operators.patterns import motif_edge
from videonet.session import (
    build_session, cut_lineage, delete_folder, drop_shuffles, scratch_path, scratch_paths, write_through,
)
from videonet.sources import crawl_files, sinks
from videonet.sources.catalog import VIDEO_BUCKET_COUNT, Catalog

HISTOGRAM_BINS = 50
SHOWN_CATEGORIES = 15


def degree_results(degrees: DataFrame, k: int = 10, kind: str = "total") -> dict[str, DataFrame]:
    """Summary, top videos and histogram of a degree table."""
    return {
        "summary": degree.degree_summary(degrees),
        "top_videos": degree.top_by_degree(degrees, k, kind),
        "distribution": degree.degree_histogram(degrees, HISTOGRAM_BINS),
    }


def degree_analysis(
    edges: DataFrame, sample_size: int | None = None, seed: int = 0, k: int = 10
) -> dict[str, DataFrame]:
    """Degree results of all edges, or of about `sample_size` of them.

    The degree table is written to the checkpoint folder once and shared by the
    results, so nothing is left cached.
    """
    if sample_size is not None:
        edges = sampling.sample_up_to(edges, sample_size, sampling.EDGE_KEY, seed)
    degrees = cut_lineage(degree.degree_table(edges))
    return {"degrees": degrees, **degree_results(degrees, k)}


def category_analysis(
    videos: DataFrame, snapshots: DataFrame, sample_size: int | None = None, seed: int = 0
) -> dict[str, DataFrame]:
    """Category counts, length buckets and view buckets."""
    if sample_size is not None:
        videos = sampling.sample_up_to(videos, sample_size, ["id"], seed)
        snapshots = sampling.sample_up_to(snapshots, sample_size, ["video_id", "crawl_id"], seed)
    results = {
        "category_counts": categories.category_counts(videos),
        "length_distribution": categories.length_buckets(videos),
        "view_distribution": categories.view_buckets(snapshots),
    }
    return {name: result for name, result in results.items() if result is not None}


def degree_job(catalog: Catalog, save: bool = True) -> dict[str, DataFrame]:
    """Degree and category statistics of the stored tables, written unless told otherwise.

    What is written is measured while it is written: the run log gains a row per table.
    """
    edges = catalog.load_table("edges")
    videos, snapshots = catalog.load_table("videos"), catalog.load_table("video_snapshots")
    by_category = category_analysis(videos, snapshots)
    if not save:
        return {**degree_analysis(edges), **by_category}
    path = catalog.path("degree_statistics")
    runs = [run_measured("degree_statistics", edges, degree.degree_table,
                         lambda rows: sinks.save_degree_stats(rows, path))]
    sources = {"category_counts": videos, "length_distribution": videos, "view_distribution": snapshots}
    makers = {"category_counts": categories.category_counts, "length_distribution": categories.length_buckets,
              "view_distribution": categories.view_buckets}
    for name in by_category:
        runs.append(run_measured(
            name, sources[name], makers[name],
            lambda rows, to=f"{catalog.path('categorized_statistics')}_{name}": (
                rows.write.mode("overwrite").parquet(to)),
        ))
    sinks.append_runs(runs, catalog.path("run_log"))
    degrees = catalog.spark.read.parquet(path)
    return {"degrees": degrees, **degree_results(degrees), **by_category}


def store_records(
    catalog: Catalog, records: DataFrame, rejects: DataFrame, logs: DataFrame, force: bool = False,
    video_buckets: int = VIDEO_BUCKET_COUNT,
) -> int:
    """Write deduplicated records and register their crawls, which makes them visible; returns the number of the run."""
    def whole(known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        if known is None:
            return records, rejects
        return write_through(records.join(known, ["crawl_id", "video_id"], "left_anti"), "new-records"), rejects

    return store_parts(catalog, [(None, whole)], logs, force, video_buckets)


def store_parts(
    catalog: Catalog, parts: list[tuple[list[str] | None, Callable[[DataFrame | None], tuple[DataFrame, DataFrame]]]],
    logs: DataFrame, force: bool = False, video_buckets: int = VIDEO_BUCKET_COUNT,
) -> int:
    """Write deduplicated records, some crawls at a time, and register all crawls; returns the number of the run.

    A part is the ids of its crawls (None for all) and a function that makes their
    records and rejects. It gets the stored (crawl_id, video_id) of its crawls, or
    None, and leaves those out. What was shuffled and stored for a part goes once it is written.

    Everything is written into partitions of this run, which no reader sees before
    the registry names them; the registry is written last, as a new version. So a
    run that fails anywhere, new, repeated or forced, leaves readers with what they
    had. A registered crawl keeps its runs and gains this one, with its new records
    only. The rejects are all rejected lines of the crawls. With `force` the new
    registry names nothing but this run.

    Of `videos` the buckets are merged and written that hold ids of this run.
    """
    run = catalog.new_run()
    registered = _load(catalog, "crawls")
    if registered is None:
        catalog.write_version("crawls", catalog.empty("crawls"))
    if force:
        registered = None
    registry = cut_lineage(_registry(ingest.crawl_registry(logs), registered, run))
    again = set()
    if registered is not None:  # One id per crawl directory.
        again = {row.id for row in registered.join(registry.select("id"), "id", "left_semi").select("id").collect()}
    spark, videos = catalog.spark, scratch_path(catalog.spark, "new-videos")
    try:
        for crawls, make in parts:
            mine = sorted(again if crawls is None else again.intersection(crawls))
            known = None
            if mine:
                stored = catalog.load_table("video_snapshots").filter(F.col("crawl_id").isin(mine))
                known = stored.select("crawl_id", "video_id")
            with scratch_paths() as made:
                try:
                    records, rejects = make(known)
                    for name, rows in (
                        ("rejected_lines", rejects), ("edges", ingest.explode_edges(records)),
                        ("video_snapshots", ingest.project_snapshots(records)),
                    ):
                        sinks.write_entities(rows.withColumn("run", F.lit(run).cast("bigint")), catalog.path(name))
                    new = ingest.project_videos(records).withColumn("crawl", F.element_at("seen_in_crawls", 1))
                    new = new.drop("seen_in_crawls")
                    new.write.mode("append").parquet(videos)
                finally:
                    for folder in made:
                        delete_folder(spark, folder)
            drop_shuffles(spark)
        new = spark.read.schema(new.schema).parquet(videos)
        version = _store_videos(catalog, new, registry, run, None if force else catalog.video_buckets(), video_buckets)
    finally:
        delete_folder(spark, videos)
    drop_shuffles(spark)

    rows = registry.withColumn("videos_version", F.lit(version).cast("bigint"))
    if registered is not None:
        rows = registered.join(rows.select("id"), "id", "left_anti").unionByName(rows)
    catalog.write_version("crawls", rows)
    return run


def _registry(rows: DataFrame, registered: DataFrame | None, run: int) -> DataFrame:
    """Registry rows of a run's crawls with their numbers and runs; one row per crawl directory."""
    none = F.expr("cast(array() AS array<bigint>)")
    if registered is None:
        old = rows.select("id", F.lit(None).cast("bigint").alias("number"), none.alias("runs"))
        last = F.lit(-1)
    else:
        old = rows.select("id").join(registered.select("id", "number", "runs"), "id", "left")
        last = F.coalesce(registered.agg(F.max("number")).scalar(), F.lit(-1))
    # Numbers go on from the last one, in the order of ids; the rows are as few as the directories.
    new = old.filter("number IS NULL").select("id").coalesce(1).sortWithinPartitions("id").select(
        "id", F.monotonically_increasing_id().alias("place"))
    runs = F.array_append(F.coalesce("runs", none), F.lit(run).cast("bigint"))
    return (
        rows.join(old.withColumnRenamed("number", "old"), "id").join(new, "id", "left")
        .withColumn("number", F.coalesce("old", F.col("place") + last + 1).cast("bigint"))
        .withColumn("runs", runs)
        .withColumn("rejects_run", F.lit(run).cast("bigint"))
        .drop("old", "place")
    )


def _store_videos(
    catalog: Catalog, videos: DataFrame, registry: DataFrame, run: int, current: DataFrame | None, buckets: int
) -> int:
    """Merge the videos of a run into the buckets of their ids; returns the version of the new list of buckets."""
    if current is not None:
        buckets = current.agg(F.max("bucket")).first()[0] + 1
    numbers = registry.select(F.col("id").alias("crawl"), "number")
    # One row per crawl directory; shuffled by crawl, the videos of a large one would fill a task.
    new = videos.join(F.broadcast(numbers), "crawl").withColumn("bucket", ingest.bucket_of(F.col("id"), buckets))
    this_run = F.lit(run).cast("bigint").alias("run")
    if current is None:
        old, named = None, catalog.spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), this_run)
    else:
        touched = cut_lineage(new.select("bucket").distinct())
        old = catalog.video_parts(current.join(touched, "bucket", "left_semi"))
        named = current.join(touched, "bucket", "left_anti").unionByName(touched.select("bucket", this_run))
    merged = ingest.merge_videos(old, new).withColumn("run", this_run)
    sinks.write_buckets(merged, catalog.path("video_parts"))
    return catalog.write_version("videos", named.coalesce(1))


def _load(catalog: Catalog, name: str) -> DataFrame | None:
    try:
        return catalog.load_table(name)
    except AnalysisException:
        return None


def ingest_crawls(
    spark: SparkSession, raw_dir: str, base: str, force: bool = False, video_buckets: int = VIDEO_BUCKET_COUNT
) -> DataFrame | None:
    """Ingest the crawl directories that are not registered; returns their line counts.

    With `force` all tables are replaced by what the directories hold now. None
    when there is nothing to do.
    """
    catalog = Catalog(spark, base)
    crawls = crawl_files.list_files(spark, raw_dir).select("crawl_id").distinct()
    if not force:
        crawls = ingest.skip_processed(crawls, _load(catalog, "crawls"))
    # One name per directory to read; the driver lists the files in them anyway.
    crawl_ids = sorted(row.crawl_id for row in crawls.collect())
    if not crawl_ids:
        return None
    lines = crawl_files.read_raw_crawl(spark, raw_dir, crawl_ids)
    classified = ingest.classified_once(lines)
    records = write_through(ingest.first_records(classified), "records")
    logs = cut_lineage(crawl_files.read_crawl_log(spark, raw_dir, crawl_ids))
    run = store_records(catalog, records, ingest.rejects_of(classified), logs, force, video_buckets)
    if force:
        catalog.drop_unused()
    return ingest.ingest_stats(records, catalog.rows_of_run("rejected_lines", run))


def notebook_flow(catalog: Catalog, category: str, k: int = 10) -> dict[str, DataFrame]:
    """Load, aggregate, top-k, range, motif and influence in one go."""
    videos, edges = catalog.load_table("videos"), catalog.load_table("edges")
    snapshots = catalog.load_table("video_snapshots")
    graph = build_graph(edges, videos)
    degrees = degree.degree_table(edges)
    ranks = pagerank(edges)
    return {
        "degrees": degree.describe_degrees(degrees),
        "top_categories": search.top_categories(videos, k),
        "most_viewed": search.most_viewed(snapshots, k),
        "highest_rated": search.highest_rated(snapshots, k, min_ratings=None),
        "by_duration": search.by_duration(snapshots, category, 200, 500, k, order_by_views=True),
        "motif": motif_edge(edges, videos.join(graph.vertices.select("id"), "id", "left_semi"),
                            category),
        "influence": influence_report(ranks, snapshots, edges, k),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Batch jobs over the stored tables")
    parser.add_argument("--base", required=True, help="folder of the tables")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("ingest", help="ingest new crawl directories")
    load.add_argument("--raw", required=True, help="folder of the crawl directories")
    load.add_argument("--force-reprocess", action="store_true", help="replace all tables")
    stats = commands.add_parser("degrees", help="degree and category statistics")
    stats.add_argument("--no-save", action="store_true", help="show only")
    flow = commands.add_parser("flow", help="the example analyses")
    flow.add_argument("--category", required=True)
    args = parser.parse_args(argv)

    spark = build_session(f"videonet-{args.command}")
    catalog = Catalog(spark, args.base)
    if args.command == "ingest":
        counts = ingest_crawls(spark, args.raw, args.base, args.force_reprocess)
        results = {} if counts is None else {"ingest": counts}
    elif args.command == "degrees":
        results = degree_job(catalog, save=not args.no_save)
    else:
        results = notebook_flow(catalog, args.category)
    for name, result in results.items():
        print(name)
        result.show(10, truncate=False)


if __name__ == "__main__":
    main()
