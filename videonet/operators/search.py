"""Filters, top-k and range queries, latest snapshots, paging.

Every limited result has a total order, so equal inputs give equal rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from videonet.functions import cleaning, labels
from videonet.operators.ranks import numbered

ALL_CATEGORIES = "All Categories"


def check_limit(k: int) -> int:
    if k < 1:
        raise ValueError(f"result limit must be at least 1, got {k}")
    return k


def check_range(low, high) -> None:
    if low < 0 or low >= high:
        raise ValueError(f"range needs 0 <= min < max, got {low} and {high}")


def by_category(df: DataFrame, category: str | None) -> DataFrame:
    """None and the all-categories entry keep every row."""
    if not category or category == ALL_CATEGORIES:
        return df
    return df.filter(F.col("category") == cleaning.normalize_category(F.lit(category)))


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def min_threshold(df: DataFrame, column: str, least) -> DataFrame:
    return df.filter(F.col(column) >= least)


def exists_filter(df: DataFrame, column: str, positive: bool = False) -> DataFrame:
    if column not in df.columns:
        return df.filter(F.lit(False))
    return df.filter(F.col(column) > 0 if positive else F.col(column).isNotNull())


def in_ids(df: DataFrame, ids: DataFrame, column: str, id_column: str = "id") -> DataFrame:
    """Rows whose key is in a frame of ids; never a collected list."""
    keys = ids.select(F.col(id_column).alias(column))
    return df.join(keys, column, "left_semi")


@dataclass(frozen=True)
class Criteria:
    """Any combination of conditions; a missing one is not tested. Ranges are inclusive."""

    categories: tuple[str, ...] | None = None
    duration: tuple[int, int] | None = None
    views: tuple[int, int] | None = None
    rating: tuple[float, float] | None = None
    comments: tuple[int, int] | None = None
    related_count: tuple[int, int] | None = None
    uploaded: tuple[date, date] | None = None

    def predicate(self) -> Column:
        ranges = {
            "length_sec": self.duration,
            "views": self.views,
            "rate": self.rating,
            "comments": self.comments,
            "related_count": self.related_count,
            "date_uploaded": self.uploaded,
        }
        tests = [F.col(name).between(*span) for name, span in ranges.items() if span]
        if self.categories:
            names = [cleaning.normalize_category(F.lit(name)) for name in self.categories]
            tests.append(reduce(lambda a, b: a | b, [F.col("category") == n for n in names]))
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def multi_criteria(
    snapshots: DataFrame, criteria: Criteria, out_degrees: DataFrame | None = None
) -> DataFrame:
    """Snapshots that meet all criteria. `out_degrees` (id, outDegree) gives related_count."""
    rows = snapshots
    if "date_uploaded" not in rows.columns:
        rows = rows.withColumn("date_uploaded", cleaning.age_to_date(F.col("age_days")))
    if out_degrees is not None:
        related = out_degrees.select(
            F.col("id").alias("video_id"), F.col("outDegree").alias("related_count")
        )
        rows = rows.join(related, "video_id", "left").withColumn(
            "related_count", F.coalesce("related_count", F.lit(0))
        )
    elif criteria.related_count:
        raise ValueError("related_count needs out_degrees")
    return rows.filter(criteria.predicate())


def with_presets(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumn(
        "duration_preset", labels.duration_preset(F.col("length_sec"))
    ).withColumn("views_preset", labels.views_preset(F.col("views")))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot per video: largest age, then largest crawl id.

    A grouped maximum instead of a window: rows of one video meet in a partial
    aggregate first, so a video with very many rows never fills one task.
    """
    rest = [c for c in snapshots.columns if c not in ("video_id", "age_days", "crawl_id")]
    newest = F.max(F.struct("age_days", "crawl_id", *rest)).alias("newest")
    return snapshots.groupBy("video_id").agg(newest).select(
        "video_id", *[F.col(f"newest.{c}").alias(c) for c in ["age_days", "crawl_id", *rest]]
    )


def rank_output(df: DataFrame, order: list, k: int) -> DataFrame:
    """Top k rows with a 1-based rank, numbered range by range."""
    top = df.orderBy(*order).limit(check_limit(k))
    return numbered(top, [], order, "rank")


def crawl_deltas(snapshots: DataFrame) -> DataFrame:
    """Change of the metrics since the video's previous crawl.

    Snapshots are unique per (video, crawl), so a window holds at most one row
    per crawl.
    """
    window = Window.partitionBy("video_id").orderBy("crawl_id")
    changes = [
        (F.col(name) - F.lag(name).over(window)).alias(f"{name}_delta")
        for name in ("views", "ratings", "comments", "rate")
    ]
    return snapshots.select(
        "video_id",
        "crawl_id",
        F.lag("crawl_id").over(window).alias("previous_crawl_id"),
        "views",
        *changes,
    )


def top_categories(videos: DataFrame, k: int = 10) -> DataFrame:
    return (
        videos.groupBy("category")
        .agg(F.count(F.lit(1)).alias("video_count"))
        .orderBy(F.desc("video_count"), "category")
        .limit(check_limit(k))
    )


def most_viewed(snapshots: DataFrame, k: int = 10, latest_only: bool = False) -> DataFrame:
    rows = latest_snapshot(snapshots) if latest_only else snapshots
    top = (
        rows.select("video_id", "crawl_id", "views", "category", "rate", "ratings")
        .orderBy(F.desc("views"), "video_id", "crawl_id")
        .limit(check_limit(k))
    )
    return labels.result_columns(top)


def highest_rated(
    snapshots: DataFrame, k: int = 10, min_ratings: int | None = 100, latest_only: bool = False
) -> DataFrame:
    rows = latest_snapshot(snapshots) if latest_only else snapshots
    if min_ratings is not None:
        rows = min_threshold(rows, "ratings", min_ratings)
    top = (
        rows.select("video_id", "crawl_id", "rate", "ratings", "views", "category")
        .orderBy(F.desc("rate"), "video_id", "crawl_id")
        .limit(check_limit(k))
    )
    return labels.result_columns(top)


def by_duration(
    snapshots: DataFrame,
    category: str | None,
    min_duration: int,
    max_duration: int,
    max_results: int = 100,
    order_by_views: bool = False,
) -> DataFrame:
    check_range(min_duration, max_duration)
    order = ["video_id", "crawl_id"]
    if order_by_views:
        order = [F.desc("views"), *order]
    rows = (
        between(by_category(snapshots, category), "length_sec", min_duration, max_duration)
        .select(
            "video_id", "crawl_id", "length_sec", "views", "rate", "category",
            # Made before the limit: two projections above it would turn top-k into a full sort.
            labels.duration_formatted(F.col("length_sec")).alias("duration_formatted"),
        )
        .orderBy(*order)
        .limit(check_limit(max_results))
    )
    return labels.result_columns(rows)


def by_views(
    snapshots: DataFrame,
    min_views: int,
    max_views: int,
    category: str | None = None,
    max_results: int = 100,
) -> DataFrame:
    check_range(min_views, max_views)
    rows = (
        by_category(between(snapshots, "views", min_views, max_views), category)
        .select("video_id", "crawl_id", "views", "rate", "ratings", "category", "length_sec")
        .orderBy(F.desc("views"), "video_id", "crawl_id")
        .limit(check_limit(max_results))
    )
    return labels.result_columns(rows)


def paginate(df: DataFrame, order: list, page: int, size: int = 50) -> DataFrame:
    """Page `page` (from 1) of a sorted frame. Use `page_after` for deep pages."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def page_after(df: DataFrame, order: dict[str, bool], last: dict, size: int = 50) -> DataFrame:
    """The page behind the row `last`; `order` maps column to descending or not.

    The position is a filter, so a deep page costs no more than the first one.
    """
    behind = F.lit(False)
    equal = F.lit(True)
    for name, descending in order.items():
        value = F.lit(last[name])
        further = F.col(name) < value if descending else F.col(name) > value
        behind = behind | (equal & further)
        equal = equal & (F.col(name) == value)
    keys = [F.desc(name) if descending else F.asc(name) for name, descending in order.items()]
    return df.filter(behind).orderBy(*keys).limit(size)
