"""Category, bucket and overview statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from videonet.functions import labels


def counted(df: DataFrame, *keys, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def category_counts(videos: DataFrame, limit: int | None = None) -> DataFrame:
    """Videos per category, most first; a null category is its own group."""
    counts = counted(videos, "category", name="num_videos").orderBy(
        F.desc("num_videos"), F.col("category").asc_nulls_first()
    )
    return counts if limit is None else counts.limit(limit)


def category_share(videos: DataFrame, top: int = 10) -> DataFrame:
    """Largest categories with their share of the shown rows and of all videos."""
    named = videos.select(F.coalesce("category", F.lit("Unknown")).alias("category"))
    counts = counted(named, "category", name="num_videos")
    total = videos.agg(F.count(F.lit(1))).scalar()
    shown = counts.orderBy(F.desc("num_videos"), "category").limit(top)
    # The window runs over at most `top` rows.
    shown_total = F.sum("num_videos").over(Window.partitionBy())
    return shown.select(
        "category",
        "num_videos",
        (F.col("num_videos") * 100.0 / shown_total).alias("pct_of_shown"),
        (F.col("num_videos") * 100.0 / total).alias("pct_of_all"),
    )


def length_buckets(videos: DataFrame) -> DataFrame | None:
    if "length_sec" not in videos.columns:
        return None
    bucket = labels.length_bucket(F.col("length_sec")).alias("length_bucket")
    return counted(videos, bucket, name="num_videos").orderBy("length_bucket")


def view_buckets(snapshots: DataFrame) -> DataFrame | None:
    column = next((c for c in ("view_count", "views") if c in snapshots.columns), None)
    if column is None:
        return None
    bucket = labels.view_bucket(F.col(column)).alias("view_bucket")
    return counted(snapshots, bucket, name="num_videos").orderBy("view_bucket")


def rating_buckets(snapshots: DataFrame) -> DataFrame:
    bucket = labels.rating_bucket(F.col("rate")).alias("rating_bucket")
    rated = snapshots.filter(F.col("rate").isNotNull())
    return counted(rated, bucket, name="num_snapshots").orderBy("rating_bucket")


def view_summary(snapshots: DataFrame) -> DataFrame:
    return snapshots.filter(F.col("views") > 0).agg(
        F.avg("views").alias("avg_views"),
        F.max("views").alias("max_views"),
        F.min("views").alias("min_views"),
        F.sum("views").alias("total_views"),
    )


def top_uploaders(videos: DataFrame, k: int = 10) -> DataFrame:
    named = videos.filter(F.col("uploader").isNotNull())
    return (
        counted(named, "uploader", name="num_videos")
        .orderBy(F.desc("num_videos"), "uploader")
        .limit(k)
    )


def distinct_categories(videos: DataFrame) -> DataFrame:
    return (
        videos.filter(F.col("category").isNotNull() & (F.col("category") != ""))
        .select("category")
        .distinct()
        .orderBy("category")
    )


def result_category_mix(result: DataFrame) -> DataFrame:
    return counted(result, "category", name="num_rows").orderBy(F.desc("num_rows"), "category")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins from the minimum to the maximum; the last bin is closed."""
    values = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    low = values.agg(F.min("x")).scalar()
    high = values.agg(F.max("x")).scalar()
    placed = values.select("x", low.alias("low"), high.alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    position = F.when(F.col("high") == F.col("low"), F.lit(1)).otherwise(
        F.least(F.lit(bins), F.floor((F.col("x") - F.col("low")) / F.nullif(width, F.lit(0.0))) + 1)
    )
    return (
        placed.withColumn("bin", position.cast("bigint"))
        .groupBy("bin")
        .agg(
            (F.first("low") + (F.col("bin") - 1) * F.first(width)).alias("bin_start"),
            (F.first("low") + F.col("bin") * F.first(width)).alias("bin_end"),
            F.count(F.lit(1)).alias("num_rows"),
        )
    )


def overview_metrics(
    videos: DataFrame, snapshots: DataFrame, edges: DataFrame, crawls: DataFrame, degrees: DataFrame
) -> DataFrame:
    """One row of totals. Every value is a scalar subquery."""
    most_viewed = snapshots.agg(
        F.max(F.struct("views", "video_id", "crawl_id")).alias("top")
    )
    return videos.sparkSession.range(1).select(
        videos.agg(F.count(F.lit(1))).scalar().alias("total_videos"),
        edges.agg(F.count(F.lit(1))).scalar().alias("total_edges"),
        videos.agg(F.countDistinct("category")).scalar().alias("unique_categories"),
        videos.agg(F.min("date_uploaded")).scalar().alias("first_upload"),
        videos.agg(F.max("date_uploaded")).scalar().alias("last_upload"),
        category_counts(videos, 1).select("category").scalar().alias("top_category"),
        category_counts(videos, 1).select("num_videos").scalar().alias("top_category_videos"),
        most_viewed.select("top.video_id").scalar().alias("most_viewed_video"),
        most_viewed.select("top.views").scalar().alias("most_views"),
        degrees.agg(F.avg("total_degree")).scalar().alias("avg_degree"),
        crawls.agg(F.max("id")).scalar().alias("latest_crawl"),
    )
