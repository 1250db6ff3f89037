"""Registry of checked queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.functions.cleaning import age_to_date
from videonet.sources.views import VIEWS, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Data:
    """The derived tables of one test directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def videos(self) -> DataFrame:
        return view(self.spark, self.sf_dir, "videos")

    @cached_property
    def dated_videos(self) -> DataFrame:
        return self.videos.withColumn("date_uploaded", age_to_date(F.col("age_days")))

    @cached_property
    def edges(self) -> DataFrame:
        return view(self.spark, self.sf_dir, "edges")

    @cached_property
    def offer_edges(self) -> DataFrame:
        return view(self.spark, self.sf_dir, "offer_edges")

    @cached_property
    def snapshots(self) -> DataFrame:
        return view(self.spark, self.sf_dir, "video_snapshots")

    @cached_property
    def lines(self) -> DataFrame:
        return view(self.spark, self.sf_dir, "raw_lines")


# Common table expressions that the statements may use by name.
SHARED = {
    **VIEWS,
    "degrees": """
SELECT id, CAST(sum(o) AS BIGINT) AS "outDegree", CAST(sum(i) AS BIGINT) AS "inDegree",
       CAST(sum(o + i) AS BIGINT) AS total_degree
FROM (SELECT src AS id, 1 AS o, 0 AS i FROM edges
      UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY id""",
    "simple": "SELECT DISTINCT src, dst FROM edges",
    "weighted": "SELECT src, dst, count(*) AS weight FROM edges GROUP BY src, dst",
    "latest": """
SELECT video_id, crawl_id, age_days, category, length_sec, views, rate, ratings, comments
FROM (SELECT *, row_number() OVER (PARTITION BY video_id
                                   ORDER BY age_days DESC, crawl_id DESC) AS rn
      FROM video_snapshots) WHERE rn = 1""",
    "stripped": """
SELECT crawl_id, file_name, block_start, line_no, trim(value, ' ' || chr(9)) AS t
FROM raw_lines WHERE trim(value, ' ' || chr(9)) <> ''""",
    "fielded": """
SELECT crawl_id, file_name, block_start, line_no, string_split(t, chr(9)) AS f FROM stripped""",
    "classified": """
SELECT *, CASE
  WHEN len(f) < 9 THEN 'insufficient_fields'
  WHEN NOT regexp_full_match(trim(f[1]), '[A-Za-z0-9_-]{11}') THEN 'invalid_video_id'
  WHEN coalesce(TRY_CAST(f[3] AS BIGINT), 0) NOT BETWEEN 0 AND 10000 THEN 'invalid_age'
  WHEN coalesce(TRY_CAST(f[5] AS BIGINT), 0) <= 0 THEN 'invalid_length' END AS reason
FROM fielded""",
    "records": """
SELECT crawl_id, file_name, block_start, line_no, trim(f[1]) AS video_id,
  CASE WHEN f[2] = '' THEN 'unknown' ELSE trim(f[2]) END AS uploader,
  coalesce(TRY_CAST(f[3] AS BIGINT), 0) AS age_days,
  CASE WHEN f[4] = '' THEN 'unknown'
       ELSE replace(replace(lower(trim(f[4])), '&', 'and'), ' ', '_') END AS category,
  coalesce(TRY_CAST(f[5] AS BIGINT), 0) AS length_sec,
  greatest(0, coalesce(TRY_CAST(f[6] AS BIGINT), 0)) AS views,
  greatest(CAST(0 AS DOUBLE), least(CAST(5 AS DOUBLE),
           coalesce(TRY_CAST(f[7] AS DOUBLE), CAST(0 AS DOUBLE)))) AS rate,
  greatest(0, coalesce(TRY_CAST(f[8] AS BIGINT), 0)) AS ratings,
  greatest(0, coalesce(TRY_CAST(f[9] AS BIGINT), 0)) AS comments,
  list_filter(list_transform(f[10:], lambda x: trim(x)),
              lambda x: regexp_full_match(x, '[A-Za-z0-9_-]{11}'))[1:50] AS related_ids
FROM classified WHERE reason IS NULL""",
    "deduped": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY crawl_id, video_id
                               ORDER BY file_name, block_start, line_no) AS rn,
         count(*) OVER (PARTITION BY crawl_id, video_id) AS copies
  FROM records) WHERE rn = 1""",
    "new_videos": """
SELECT video_id AS id, crawl_id, uploader, category, length_sec,
       CAST(DATE '2005-02-15' + CAST(age_days AS INTEGER) AS DATE) AS date_uploaded FROM deduped""",
}


def with_shared(sql: str) -> str:
    """Put the named expressions that a statement uses in front of it."""
    order: list[str] = []

    def need(text: str, skip: str = "") -> None:
        for name, body in SHARED.items():
            if name != skip and name not in order and re.search(rf"\b{name}\b", text):
                need(body, name)
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql
    shared = ",\n".join(f"{name} AS ({SHARED[name]})" for name in order)
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    if own:
        return f"WITH RECURSIVE {shared},\n{sql[own.end():]}"
    return f"WITH RECURSIVE {shared}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register a function of the test data under a name."""

    def register(function: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(Data(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_shared(sql)
        return function

    return register
