"""Crawl directories: <raw_dir>/<crawl_id>/*.txt, data files and one log file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.functions.cleaning import is_integer, strip, to_long

# Names of the files of a crawl: text, or text of which some may be compressed.
TEXT_FILES = "*.txt"
TEXT_OR_GZIP = "*.{txt,txt.gz}"
# Fixed values.
SKIPPED_FILES = ["log.txt", "readme.txt"]
RAW_LOG_CHARS = 1000
LINE_COLUMNS = {
    "crawl_id": "string", "file_name": "string", "block_start": "bigint", "line_no": "bigint", "value": "string",
}


def _crawl_of(path: Column) -> Column:
    """The name of a file's directory; only one that holds an escape is decoded, as this runs for every line."""
    name = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(name.contains("%") | name.contains("+"), F.url_decode(name)).otherwise(name)


def _plain_name(name: Column) -> Column:
    """The file name without the ending of a compressed file."""
    return F.when(name.endswith(".gz"), F.left(name, F.length(name) - 3)).otherwise(name)


def list_files(spark: SparkSession, raw_dir: str, names: str = TEXT_FILES) -> DataFrame:
    """(crawl_id, path, file_name, size, location); reads no content."""
    return _listed(spark.read.format("binaryFile").option("pathGlobFilter", names).load(f"{raw_dir}/*"))


def stream_files(spark: SparkSession, raw_dir: str, names: str = TEXT_FILES) -> DataFrame:
    """The same as a stream of the files that appear."""
    # The only schema that files of this format have; a stream does not find it by itself.
    files = spark.readStream.schema("path string, modificationTime timestamp, length bigint, content binary")
    return _listed(files.format("binaryFile").option("pathGlobFilter", names).load(f"{raw_dir}/*"))


def _listed(files: DataFrame) -> DataFrame:
    return files.select(
        _crawl_of(F.col("_metadata.file_path")).alias("crawl_id"),
        F.col("_metadata.file_path").alias("path"),
        _plain_name(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_size").alias("size"),
        F.col("path").alias("location"),
    )


def choose_logs(files: DataFrame) -> DataFrame:
    """(crawl_id, path, log_file): a name with "log" in it, else the smallest file."""
    unnamed = ~F.lower("file_name").contains("log")
    rank = F.struct(
        unnamed.alias("unnamed"),
        F.when(unnamed, F.col("size")).otherwise(F.lit(0)).alias("size"),
        "file_name",
        "path",
    )
    return files.groupBy("crawl_id").agg(F.min(rank).alias("log")).select(
        "crawl_id",
        F.col("log.path").alias("path"),
        F.url_decode("log.file_name").alias("log_file"),
    )


def valid_text(value: Column) -> Column:
    """The text without bytes that are not UTF-8; replacement characters that it holds itself stay.

    They are written as a private mark while the invalid bytes are turned into
    replacement characters and removed.
    """
    own, mark = F.lit("\ufffd"), F.lit("\U0010fffd\U0010fffc")
    cleaned = F.replace(F.make_valid_utf8(F.replace(value, own, mark)), own, F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(F.replace(cleaned, mark, own))


def with_line_order(text: DataFrame) -> DataFrame:
    """Add crawl_id, file name and line position to rows of a text source."""
    return text.select(
        _crawl_of(F.col("_metadata.file_path")).alias("crawl_id"),
        F.col("_metadata.file_path").alias("path"),
        _plain_name(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        valid_text(F.col("value")).alias("value"),
    )


def only_data_files(lines: DataFrame, logs: DataFrame) -> DataFrame:
    """Drop log and readme files; a numbered file is data even if it was taken for the log.

    `lines` are lines or files.
    """
    name = F.lower(F.url_decode("file_name"))
    numbered = F.regexp_replace(name, r"\.[^.]*$", "").rlike(r"^\p{Nd}+$")
    # One row per crawl directory.
    chosen = logs.select("crawl_id", F.lower("log_file").alias("log_name"))
    return (
        lines.filter(~name.isin(SKIPPED_FILES))
        .join(chosen, "crawl_id", "left")
        .filter(numbered | F.col("log_name").isNull() | (name != F.col("log_name")))
        .drop("log_name", "path")
    )


def read_files(spark: SparkSession, locations: list[str]) -> DataFrame:
    """Lines of the listed files with their order."""
    if not locations:
        return spark.range(0).select(
            *[F.lit(None).cast(kind).alias(name) for name, kind in LINE_COLUMNS.items()])
    # The names are those of files, not patterns.
    text = spark.read.option("__globPaths__", "false").text(locations)
    return with_line_order(text).withColumn("line_no", F.monotonically_increasing_id()).select(*LINE_COLUMNS)


def read_raw_crawl(
    spark: SparkSession, raw_dir: str, crawl_ids: list[str] | None = None
) -> DataFrame:
    """Lines of all data files with their order."""
    paths = [f"{raw_dir}/{c}" for c in crawl_ids] if crawl_ids is not None else f"{raw_dir}/*"
    text = spark.read.option("pathGlobFilter", "*.txt").text(paths)
    lines = with_line_order(text).withColumn("line_no", F.monotonically_increasing_id())
    logs = choose_logs(list_files(spark, raw_dir))
    return only_data_files(lines, logs).select(
        "crawl_id", "file_name", "block_start", "line_no", "value"
    )


def read_crawl_log(
    spark: SparkSession, raw_dir: str, crawl_ids: list[str] | None = None, names: str = TEXT_FILES
) -> DataFrame:
    """One row per crawl with the times and totals of its log; the last match of a kind wins."""
    logs = choose_logs(list_files(spark, raw_dir, names))
    if crawl_ids is not None:
        logs = logs.filter(F.col("crawl_id").isin(crawl_ids))
    # Only the chosen files are opened: one path per crawl directory.
    paths = [row.path for row in logs.select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no crawl files under {raw_dir}")
    lines = with_line_order(spark.read.text(paths)).withColumn(
        "line_no", F.monotonically_increasing_id()
    )
    return parse_log_lines(lines, logs)


def parse_log_lines(lines: DataFrame, logs: DataFrame) -> DataFrame:
    """Parsed log per (crawl_id, path, log_file) from its lines (path, block_start, line_no, value)."""
    text = F.lower(strip(F.col("value")))
    words = F.split(F.col("text"), r"(?U)\s+")
    is_start = F.col("text").contains("start:")
    is_finish = ~is_start & F.col("text").contains("finish:")
    is_total = (
        ~is_start & ~is_finish & F.col("text").contains("total") & (F.size(words) >= 3)
    )
    first, second = F.get(words, F.lit(1)), F.get(words, F.lit(2))
    has_videos = is_total & is_integer(first)
    has_time = has_videos & is_integer(second)
    place = F.struct("block_start", "line_no")

    def last(value: Column, test: Column) -> Column:
        return F.max_by(value, F.when(test, place))

    def rest(label: str) -> Column:
        return strip(F.replace(F.col("text"), F.lit(label), F.lit("")))

    rows = lines.withColumn("text", text)
    parsed = rows.groupBy("path").agg(
        last(rest("start:"), is_start).alias("start_time"),
        last(rest("finish:"), is_finish).alias("finish_time"),
        last(to_long(first), has_videos).alias("total_videos"),
        last(to_long(second), has_time).alias("total_time"),
    )
    # Every line has a line break, so 1000 lines hold the first 1000 characters.
    head = rows.filter(F.col("block_start") == 0)
    begin = head.groupBy("path").agg(F.min("line_no").alias("begin"))
    pieces = F.array_sort(
        F.collect_list(
            F.struct("line_no", F.concat(F.substring("value", 1, RAW_LOG_CHARS), F.lit("\n")).alias("t"))
        )
    )
    raw = (
        head.join(begin, "path")
        .filter(F.col("line_no") - F.col("begin") < RAW_LOG_CHARS)
        .groupBy("path")
        .agg(F.array_join(F.transform(pieces, lambda p: p["t"]), "").alias("raw_log"))
    )
    return (
        logs.join(parsed, "path", "left")
        .join(raw, "path", "left")
        .select(
            "crawl_id",
            F.current_timestamp().alias("parsed_at"),
            "log_file",
            F.substring("raw_log", 1, RAW_LOG_CHARS).alias("raw_log"),
            "start_time",
            "finish_time",
            "total_videos",
            "total_time",
            F.lit(None).cast("string").alias("error"),
        )
    )
