"""Label and display columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds (inclusive) and their labels.
LENGTH_BUCKETS = [(120, "0-2m"), (300, "2-5m"), (600, "5-10m"), (1200, "10-20m")]
LENGTH_REST = ">20m"
VIEW_BUCKETS = [
    (1_000, "0-1K"),
    (10_000, "1K-10K"),
    (100_000, "10K-100K"),
    (1_000_000, "100K-1M"),
    (10_000_000, "1M-10M"),
]
VIEW_REST = ">10M"
COMMUNITY_SIZES = [
    (10, "Tiny (1-10)"),
    (50, "Small (11-50)"),
    (100, "Medium (51-100)"),
    (500, "Large (101-500)"),
]
COMMUNITY_REST = "Huge (500+)"


def bucket_label(value: Column, bounds: list[tuple[int, str]], rest: str) -> Column:
    """Label of the first bound that is not exceeded; null values get `rest`."""
    label = None
    for bound, name in bounds:
        test = value <= bound
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    return label.otherwise(F.lit(rest))


def length_bucket(length_sec: Column) -> Column:
    return bucket_label(length_sec, LENGTH_BUCKETS, LENGTH_REST)


def view_bucket(views: Column) -> Column:
    return bucket_label(views, VIEW_BUCKETS, VIEW_REST)


def community_size_class(size: Column) -> Column:
    return bucket_label(size, COMMUNITY_SIZES, COMMUNITY_REST)


def rating_bucket(rate: Column) -> Column:
    """`x-(x+1)` for 0 <= rate < 6, otherwise Other."""
    low = F.floor(rate)
    return F.when(
        (rate >= 0) & (rate < 6),
        F.concat(low.cast("string"), F.lit("-"), (low + 1).cast("string")),
    ).otherwise(F.lit("Other"))


def duration_preset(length_sec: Column) -> Column:
    return (
        F.when(length_sec < 300, F.lit("Short"))
        .when(length_sec <= 1200, F.lit("Medium"))
        .when(length_sec > 1200, F.lit("Long"))
    )


def views_preset(views: Column) -> Column:
    return (
        F.when(views > 1_000_000, F.lit("Viral"))
        .when(views >= 100_000, F.lit("Popular"))
        .when(views < 100_000, F.lit("Growing"))
    )


def duration_formatted(seconds: Column) -> Column:
    """m:ss, minutes not padded."""
    whole = F.coalesce(seconds, F.lit(0))
    return F.format_string("%d:%02d", F.floor(whole / 60).cast("bigint"), whole % 60)


def result_columns(df: DataFrame) -> DataFrame:
    """Result names of the metric columns, nulls shown as zero."""
    renames = {
        "views": ("views", "bigint"),
        "rate": ("rating", "double"),
        "ratings": ("num_ratings", "bigint"),
        "length_sec": ("duration_sec", "bigint"),
    }
    columns = []
    for name in df.columns:
        if name in renames:
            target, kind = renames[name]
            columns.append(F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind)).alias(target))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def video_urls(
    df: DataFrame, watch_prefix: str, short_prefix: str, id_column: str = "video_id"
) -> DataFrame:
    """Add `url` and `short_url`; a frame without the id column is returned as it is."""
    if id_column not in df.columns:
        return df
    return df.withColumn("url", F.concat(F.lit(watch_prefix), F.col(id_column))).withColumn(
        "short_url", F.concat(F.lit(short_prefix), F.col(id_column))
    )


def display_trim(df: DataFrame, uploader: str = "uploader", score: str = "pagerank") -> DataFrame:
    """Uploader cut to 30 characters, score rounded to 6 digits."""
    return df.withColumn(uploader, F.substring(uploader, 1, 30)).withColumn(
        score, F.round(score, 6)
    )
