"""Raw crawl lines to videos, snapshots and edges.

Lines are (crawl_id, file_name, block_start, line_no, value); the middle three
give the order in which the files would be read one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from videonet.functions import cleaning
from videonet.session import write_through

LINE_ORDER = ["file_name", "block_start", "line_no"]
CRAWL_UNKNOWN = "unknown"


def split_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines and add the fields.

    The one-row inline makes Spark split each line once; as a plain column the
    split would be repeated in every later expression that reads a field.
    """
    once = F.array(F.struct(cleaning.split_line(F.col("value")).alias("fields")))
    return lines.filter(cleaning.strip(F.col("value")) != "").select("*", F.inline(once))


def classify_malformed(lines: DataFrame) -> DataFrame:
    """Split lines with `reason`, null for good records."""
    return split_lines(lines).withColumn("reason", cleaning.malformed_reason(F.col("fields")))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Malformed lines with the first rule they break."""
    return rejects_of(classify_malformed(lines))


def rejects_of(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).select(
        "crawl_id", *LINE_ORDER, "value", "reason"
    )


def typed_records(lines: DataFrame) -> DataFrame:
    """Good lines as typed records, duplicates included."""
    return records_of(classify_malformed(lines))


def records_of(classified: DataFrame, *more: str) -> DataFrame:
    """The good lines as typed records, with the columns `more` as they are."""
    field = F.col("fields").getItem
    good = classified.filter(F.col("reason").isNull())
    return good.select(
        "crawl_id",
        *LINE_ORDER,
        cleaning.strip(field(0)).alias("video_id"),
        cleaning.default_uploader(field(1)).alias("uploader"),
        cleaning.to_long(field(2)).alias("age_days"),
        cleaning.normalize_category(field(3)).alias("category"),
        cleaning.to_long(field(4)).alias("length_sec"),
        cleaning.at_least_zero(cleaning.to_long(field(5))).alias("views"),
        cleaning.clamp_rate(cleaning.to_double(field(6))).alias("rate"),
        cleaning.at_least_zero(cleaning.to_long(field(7))).alias("ratings"),
        cleaning.at_least_zero(cleaning.to_long(field(8))).alias("comments"),
        cleaning.clean_related(F.col("fields")).alias("related_ids"),
        *more,
    )


def classified_once(lines: DataFrame) -> DataFrame:
    """Classified lines stored once, for records and rejects; a good line keeps its fields only."""
    bad = F.col("reason").isNotNull()
    rows = classify_malformed(lines).withColumns({
        "value": F.when(bad, F.col("value")),
        "fields": F.when(~bad, F.col("fields")),
    })
    return write_through(rows, "classified")


def dedupe_in_crawl(records: DataFrame) -> DataFrame:
    """First record per (crawl, video), with the number of its copies.

    A grouped minimum, so copies of one video meet map-side and never fill a task.
    """
    payload = [c for c in records.columns if c not in ("crawl_id", "video_id", *LINE_ORDER)]
    first = F.min(F.struct(*LINE_ORDER, *payload)).alias("first")
    return (
        records.groupBy("crawl_id", "video_id")
        .agg(first, F.count(F.lit(1)).alias("copies"))
        .select(
            "crawl_id", "video_id", *[F.col(f"first.{c}").alias(c) for c in payload], "copies"
        )
    )


def first_records(classified: DataFrame) -> DataFrame:
    """The dedupe_in_crawl of the typed records of classified lines; only lines that stay are made into records."""
    video = cleaning.strip(F.col("fields").getItem(0)).alias("video_id")
    lines = classified.filter(F.col("reason").isNull()).groupBy("crawl_id", video).agg(
        F.min(F.struct(*LINE_ORDER, "fields")).alias("first"), F.count(F.lit(1)).alias("copies"))
    kept = lines.select(
        "crawl_id", *[F.col(f"first.{c}").alias(c) for c in (*LINE_ORDER, "fields")],
        F.lit(None).cast("string").alias("reason"), "copies")
    return records_of(kept, "copies").drop(*LINE_ORDER)


def first_records_of_lines(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The first_records of unclassified lines, without those of `known` (crawl_id, video_id).

    A good line travels as its text, which is shorter than its fields; what is left is split again.
    """
    video = cleaning.strip(F.col("fields").getItem(0)).alias("video_id")
    first = classify_malformed(lines).filter(F.col("reason").isNull()).groupBy("crawl_id", video).agg(
        F.min(F.struct(*LINE_ORDER, "value")).alias("first"), F.count(F.lit(1)).alias("copies"))
    if known is not None:
        first = first.join(known, ["crawl_id", "video_id"], "left_anti")
    kept = first.select(
        "crawl_id", *[F.col(f"first.{c}").alias(c) for c in (*LINE_ORDER, "value")],
        F.lit(None).cast("string").alias("reason"), "copies")
    return records_of(split_lines(kept), "copies").drop(*LINE_ORDER)


def project_videos(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("video_id").alias("id"),
        "uploader",
        "category",
        "length_sec",
        cleaning.age_to_date(F.col("age_days")).alias("date_uploaded"),
        F.array("crawl_id").alias("seen_in_crawls"),
    )


def project_snapshots(records: DataFrame) -> DataFrame:
    return records.select(
        "video_id", "crawl_id", "age_days", "category", "length_sec",
        "views", "rate", "ratings", "comments",
    )


def explode_edges(records: DataFrame) -> DataFrame:
    """One edge per related id; duplicates and self-loops are kept."""
    return records.select(
        "crawl_id", F.col("video_id").alias("src"), F.explode("related_ids").alias("dst")
    )


def upsert_videos(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Latest static fields per id, crawl ids united.

    `new` has one row per (id, crawl) with a one-element seen_in_crawls; later
    crawl ids win, and any new row wins over an existing one.
    """
    fields = ["uploader", "category", "length_sec", "date_uploaded"]
    rows = new.withColumn("crawl", F.element_at("seen_in_crawls", -1)).withColumn(
        "is_new", F.lit(1)
    )
    if existing is not None:
        old = existing.withColumn("crawl", F.lit("")).withColumn("is_new", F.lit(0))
        rows = old.unionByName(rows)
    return (
        rows.groupBy("id")
        .agg(
            F.max(F.struct("is_new", "crawl", *fields)).alias("last"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen_in_crawls")))).alias(
                "seen_in_crawls"
            ),
        )
        .select("id", *[F.col(f"last.{c}").alias(c) for c in fields], "seen_in_crawls")
    )


def bucket_of(video_id: Column, buckets: int) -> Column:
    """The bucket of a video in a table that is divided by a hash of ids."""
    return F.pmod(F.xxhash64(video_id), F.lit(buckets)).cast("int")


def merge_videos(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """The same as upsert_videos for stored videos, by bucket, with the crawls of a video as a bitmap.

    `existing` has (id, fields, seen, bucket), `new` one row per id and crawl: (id, fields, crawl, number, bucket).
    All rows of a bucket meet in one partition, which is written as it is. A video has one row
    for 64 crawls there, of any number of new ones.
    """
    fields = ["uploader", "category", "length_sec", "date_uploaded"]
    rows = new.select(
        "bucket", "id", F.struct(F.lit(1).alias("is_new"), "crawl", *fields).alias("last"),
        F.floor(F.col("number") / 64).cast("int").alias("word"),
        F.expr("shiftleft(1L, cast(number % 64 AS int))").alias("bits"),
    )
    if existing is not None:
        old = F.struct(F.lit(0).alias("is_new"), F.lit("").alias("crawl"), *fields).alias("last")
        rows = rows.unionByName(existing.select("bucket", "id", old, F.explode("seen").alias("word", "bits")))
    words = rows.repartition("bucket").groupBy("bucket", "id", "word").agg(
        F.max("last").alias("last"), F.bit_or("bits").alias("bits"))
    return (
        words.groupBy("bucket", "id")
        .agg(F.max("last").alias("last"), F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("seen"))
        .select("id", *[F.col(f"last.{c}").alias(c) for c in fields], "seen", "bucket")
    )


def unite_crawls(existing, added):
    """Set union of two crawl id arrays."""
    return F.array_sort(F.array_union(existing, added))


def skip_processed(crawls: DataFrame, registered: DataFrame | None) -> DataFrame:
    """Crawls (crawl_id) that are not registered yet."""
    if registered is None:
        return crawls
    known = registered.select(F.col("id").alias("crawl_id"))
    return crawls.join(known, "crawl_id", "left_anti")


def ingest_stats(records: DataFrame, rejects: DataFrame) -> DataFrame:
    """Line counts per crawl and, with a null crawl_id, for all crawls.

    `records` are deduplicated and carry their number of copies.
    """
    good = records.groupBy("crawl_id").agg(
        F.count(F.lit(1)).alias("valid_records"), F.sum("copies").alias("good_lines")
    )
    bad = rejects.groupBy("crawl_id").agg(F.count(F.lit(1)).alias("malformed"))
    counts = good.join(bad, "crawl_id", "full").na.fill(
        0, ["valid_records", "good_lines", "malformed"]
    )
    total = F.sum(F.col("good_lines") + F.col("malformed"))
    return counts.rollup("crawl_id").agg(
        total.alias("total_lines"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("malformed").alias("malformed"),
        F.sum(F.col("good_lines") - F.col("valid_records")).alias("duplicates"),
        F.count("crawl_id").alias("crawls_processed"),
        F.try_divide(F.sum("valid_records") * 100.0, total).alias("retention_pct"),
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("crawl_id", "reason").agg(F.count(F.lit(1)).alias("num_lines"))


def crawl_registry(logs: DataFrame) -> DataFrame:
    """Registry rows from parsed logs; missing times read `unknown`."""
    info = [
        "crawl_id", "parsed_at", "log_file", "raw_log", "start_time", "finish_time",
        "total_videos", "total_time", "error",
    ]

    def shown(name):
        return F.coalesce(F.col(name), F.lit(CRAWL_UNKNOWN))

    return logs.select(
        F.col("crawl_id").alias("id"),
        F.current_timestamp().alias("date"),
        F.format_string(
            "Crawl processing from %s to %s", shown("start_time"), shown("finish_time")
        ).alias("notes"),
        F.current_timestamp().alias("processed_at"),
        F.struct(*info).alias("log_info"),
        "total_videos",
        F.col("total_time").alias("duration_sec"),
    )
