"""Fixed schemas of the stored tables."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


VIDEOS = _struct(
    id=StringType(),
    uploader=StringType(),
    category=StringType(),
    length_sec=LongType(),
    date_uploaded=DateType(),
    seen_in_crawls=ArrayType(StringType()),
)

VIDEO_SNAPSHOTS = _struct(
    video_id=StringType(),
    crawl_id=StringType(),
    age_days=LongType(),
    category=StringType(),
    length_sec=LongType(),
    views=LongType(),
    rate=DoubleType(),
    ratings=LongType(),
    comments=LongType(),
)

EDGES = _struct(crawl_id=StringType(), src=StringType(), dst=StringType())

LOG_INFO = _struct(
    crawl_id=StringType(),
    parsed_at=TimestampType(),
    log_file=StringType(),
    raw_log=StringType(),
    start_time=StringType(),
    finish_time=StringType(),
    total_videos=LongType(),
    total_time=LongType(),
    error=StringType(),
)

CRAWLS = _struct(
    id=StringType(),
    date=TimestampType(),
    notes=StringType(),
    processed_at=TimestampType(),
    log_info=LOG_INFO,
    total_videos=LongType(),
    duration_sec=LongType(),
)

DEGREE_STATISTICS = _struct(
    id=StringType(), outDegree=LongType(), inDegree=LongType(), total_degree=LongType()
)

REJECTED_LINES = _struct(
    crawl_id=StringType(),
    file_name=StringType(),
    block_start=LongType(),
    line_no=LongType(),
    value=StringType(),
    reason=StringType(),
)

# The registry also numbers the crawls, and names the runs of ingest whose rows count: those that wrote a crawl's
# snapshots and edges, the one that wrote its rejected lines, and the version of the list of buckets of `videos`.
STORED_CRAWLS = StructType([
    *CRAWLS.fields,
    StructField("number", LongType()),
    StructField("runs", ArrayType(LongType())),
    StructField("rejects_run", LongType()),
    StructField("videos_version", LongType()),
])

# Videos as stored: `seen` is a bitmap over the numbers of crawls, 64 of them in each entry.
VIDEO_PARTS = _struct(
    id=StringType(),
    uploader=StringType(),
    category=StringType(),
    length_sec=LongType(),
    date_uploaded=DateType(),
    seen=MapType(IntegerType(), LongType()),
    bucket=IntegerType(),
    run=LongType(),
)
# The run that wrote the rows of a bucket.
VIDEO_BUCKETS = _struct(bucket=IntegerType(), run=LongType())

# The four tables of the data model.
TABLES = {
    "videos": VIDEOS,
    "video_snapshots": VIDEO_SNAPSHOTS,
    "edges": EDGES,
    "crawls": CRAWLS,
}

STORED = {
    **TABLES,
    "crawls": STORED_CRAWLS,
    "degree_statistics": DEGREE_STATISTICS,
    "rejected_lines": REJECTED_LINES,
}
