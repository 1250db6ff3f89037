"""Incremental ingest of crawl directories with a file-source stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from videonet.operators import ingest
from videonet.plans.jobs import store_parts
from videonet.session import cut_lineage, write_through
from videonet.sources import crawl_files
from videonet.sources.catalog import Catalog

#: A batch is stored in parts of whole crawls. A part has up to this share of the bytes of the batch's files, or
#: PART_BYTES if that is more; a larger crawl is a part by itself.
PARTS = 8
PART_BYTES = 64 << 20


def stream_ingest(
    spark: SparkSession, raw_dir: str, base: str, checkpoint: str, names: str = crawl_files.TEXT_FILES
) -> StreamingQuery:
    """Ingest the files that appeared since the last run, then stop.

    The stream's checkpoint is the set of files already read. Files that arrive
    later for a known crawl add their new videos; the first record of a video
    in a crawl stays. The stream is one of files, so that lines are read part by part.
    """
    def load(batch: DataFrame, _: int) -> None:
        store_batch(batch, raw_dir, base, names)

    return (
        crawl_files.stream_files(spark, raw_dir, names).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def store_batch(batch: DataFrame, raw_dir: str, base: str, names: str = crawl_files.TEXT_FILES) -> None:
    """Clean the lines of one batch of files and merge them into the tables; repeating it changes nothing."""
    spark = batch.sparkSession
    catalog = Catalog(spark, base)
    files = cut_lineage(batch.filter("size > 0"))
    # One id per crawl directory in the batch.
    crawl_ids = sorted(row.crawl_id for row in files.select("crawl_id").distinct().collect())
    if not crawl_ids:
        return
    logs = cut_lineage(crawl_files.read_crawl_log(spark, raw_dir, crawl_ids, names))
    data = cut_lineage(crawl_files.only_data_files(files, logs.select("crawl_id", "log_file")))
    # The driver holds the names of all files anyway, as the stream lists them.
    by_crawl = {crawl: [] for crawl in crawl_ids}
    for row in data.collect():
        by_crawl[row.crawl_id].append((row.location, row.size))

    def loader(crawls: list[str]):
        def load(known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
            lines = crawl_files.read_files(spark, sorted(path for c in crawls for path, _ in by_crawl[c]))
            records = write_through(ingest.first_records_of_lines(lines, known), "records")
            return records, with_other_rejects(catalog, ingest.rejected_lines(lines), crawls, data)

        return load

    sizes = {crawl: sum(size for _, size in found) for crawl, found in by_crawl.items()}
    parts = parts_of(sizes, max(PART_BYTES, sum(sizes.values()) // PARTS))
    store_parts(catalog, [(crawls, loader(crawls)) for crawls in parts], logs)


def parts_of(sizes: dict[str, int], most: int) -> list[list[str]]:
    """The keys in lists whose sizes add up to `most` or less; a larger one stands alone."""
    parts: list[list[str]] = []
    room = -1
    for key in sorted(sizes):
        if not parts or sizes[key] > room:
            parts.append([])
            room = most
        parts[-1].append(key)
        room -= sizes[key]
    return parts


def with_other_rejects(catalog: Catalog, rejects: DataFrame, crawls: list[str], files: DataFrame) -> DataFrame:
    """The rejects of the files that were read and, of the same crawls, those of all other files."""
    try:
        old = catalog.load_table("rejected_lines")
    except AnalysisException:
        return rejects
    read = files.select("crawl_id", "file_name").distinct()
    others = old.filter(F.col("crawl_id").isin(crawls)).join(read, ["crawl_id", "file_name"], "left_anti")
    return others.unionByName(rejects)
