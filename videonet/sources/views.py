"""Video-network tables derived from the retail test tables.

The statements are plain SQL that other engines accept unchanged, so the
checks can use the same text as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIDEOS_SQL = """
SELECT 'v' || lpad(CAST(p_partkey AS STRING), 10, '0') AS id,
       p_brand AS uploader, lower(p_type) AS category,
       CAST(p_size * 30 AS BIGINT) AS length_sec,
       CAST(p_partkey % 1000 AS BIGINT) AS age_days
FROM part"""

EDGES_SQL = """
SELECT CAST(year(a.l_shipdate) AS STRING) AS crawl_id,
       'v' || lpad(CAST(a.l_partkey AS STRING), 10, '0') AS src,
       'v' || lpad(CAST(b.l_partkey AS STRING), 10, '0') AS dst
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1"""

# The same links between (part, supplier) offers: a sparse graph with many components.
OFFER_EDGES_SQL = """
SELECT CAST(year(a.l_shipdate) AS STRING) AS crawl_id,
       CAST(a.l_partkey AS STRING) || '-' || CAST(a.l_suppkey AS STRING) AS src,
       CAST(b.l_partkey AS STRING) || '-' || CAST(b.l_suppkey AS STRING) AS dst
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1"""

# The rows of OFFER_EDGES_SQL by one shuffle of the lines, where the join takes one for each side. The lines of an order
# are dealt by runs of 64 numbers, so no task has to take all lines of a very long one; the first line of a run is
# shown to the run before it as well.
OFFER_EDGES_BY_RUNS_SQL = """
SELECT CAST(year(l_shipdate) AS STRING) AS crawl_id,
       CAST(a.l_partkey AS STRING) || '-' || CAST(a.l_suppkey AS STRING) AS src,
       CAST(b.l_partkey AS STRING) || '-' || CAST(b.l_suppkey AS STRING) AS dst
FROM (SELECT l_shipdate, l_linenumber, run, a, collect_list(a) OVER (
        PARTITION BY l_orderkey, run ORDER BY l_linenumber RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS nexts
      FROM (SELECT l_orderkey, l_linenumber, l_shipdate, struct(l_partkey, l_suppkey) AS a,
                   explode(CASE WHEN pmod(l_linenumber, 64) = 0 THEN array(l_linenumber, l_linenumber - 64)
                                ELSE array(l_linenumber - pmod(l_linenumber, 64)) END) AS run
            FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL))
     LATERAL VIEW explode(nexts) AS b
WHERE run = l_linenumber - pmod(l_linenumber, 64)"""

SNAPSHOTS_SQL = """
SELECT 'v' || lpad(CAST(l_partkey AS STRING), 10, '0') AS video_id,
       CAST(year(l_shipdate) AS STRING) AS crawl_id,
       CAST(l_partkey % 1000 AS BIGINT) AS age_days,
       lower(p_type) AS category, CAST(p_size * 30 AS BIGINT) AS length_sec,
       CAST(floor(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
                  / power(10, l_partkey % 6)) AS BIGINT) AS views,
       CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE)
         / count(*) / CAST(2 AS DOUBLE) AS rate,
       CAST(sum(l_linenumber) AS BIGINT) AS ratings, count(*) AS comments
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey, year(l_shipdate), p_type, p_size"""

# One raw crawl line per lineitem row. The five ordering columns are unique.
RAW_LINES_SQL = """
SELECT CAST(year(l_shipdate) AS STRING) AS crawl_id,
       CAST(l_linenumber AS STRING) || '.txt' AS file_name,
       l_orderkey AS block_start,
       CAST(l_partkey * 100000000000 + l_suppkey * 100000000
            + CAST(round(l_extendedprice) AS BIGINT) AS BIGINT) AS line_no,
       CASE WHEN l_quantity = 7 THEN '  ' ELSE '' END
       || CASE WHEN l_quantity = 13 THEN 'x' ELSE 'v' END
       || lpad(CAST(l_partkey AS STRING), CASE WHEN l_quantity = 17 THEN 9 ELSE 10 END, '0')
       || chr(9) || CASE WHEN l_quantity = 19 THEN '' ELSE ' ' || p_brand || ' ' END
       || chr(9) || CASE WHEN l_quantity = 23 THEN '-1' WHEN l_quantity = 29 THEN 'abc'
                         ELSE CAST(l_partkey % 1000 AS STRING) END
       || chr(9) || p_type || CASE WHEN l_quantity = 31 THEN ' & More' ELSE '' END
       || chr(9) || CASE WHEN l_quantity = 37 THEN '0' ELSE CAST(p_size * 30 AS STRING) END
       || chr(9) || CASE WHEN l_quantity = 41 THEN '-5' ELSE CAST(l_orderkey AS STRING) END
       || chr(9) || CASE WHEN l_quantity = 43 THEN '7.5'
                         ELSE CAST(l_linenumber AS STRING) || '.5' END
       || chr(9) || CAST(l_suppkey AS STRING)
       || chr(9) || CASE WHEN l_quantity = 47 THEN '' ELSE CAST(l_linenumber AS STRING) END
       || CASE WHEN l_quantity = 47 THEN '' ELSE
            chr(9) || 'r' || lpad(CAST(l_suppkey AS STRING), 10, '0')
            || chr(9) || 'bad id'
            || chr(9) || ' s' || lpad(CAST(l_orderkey AS STRING), 10, '0') || ' ' END AS value
FROM lineitem JOIN part ON l_partkey = p_partkey"""

VIEWS = {
    "videos": VIDEOS_SQL,
    "edges": EDGES_SQL,
    "offer_edges": OFFER_EDGES_SQL,
    "video_snapshots": SNAPSHOTS_SQL,
    "raw_lines": RAW_LINES_SQL,
}


# What Spark runs where another statement gives the same rows with less work.
SPARK_VIEWS = VIEWS | {"offer_edges": OFFER_EDGES_BY_RUNS_SQL}


RAW_ROWS = "FROM lineitem JOIN part ON l_partkey = p_partkey"
# The columns that the text of a raw line is made of.
RAW_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
    "p_brand", "p_type", "p_size",
]


def raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines by place, with what their text is made of instead of the text, which is longer."""
    lineitem, part = (spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in ("lineitem", "part"))
    joined = RAW_ROWS.replace("lineitem", "{lineitem}").replace("part ON", "{part} ON")
    text = RAW_LINES_SQL.replace(RAW_ROWS, f", {', '.join(RAW_COLUMNS)} {joined}")
    return spark.sql(text, lineitem=lineitem, part=part).drop("value")


def raw_lines_at(places: DataFrame) -> DataFrame:
    """(crawl_id, value) of raw_places, in their order."""
    text = RAW_LINES_SQL.replace(RAW_ROWS, ", crawl_id AS crawl FROM {places}")
    return places.sparkSession.sql(text, places=places).select(F.col("crawl").alias("crawl_id"), "value")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table over the parquet files of a test directory."""
    text = re.sub(r"\b(FROM|JOIN) (lineitem|part)\b", r"\1 {\2}", SPARK_VIEWS[name])
    tables = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in ("lineitem", "part")
        if f"{{{table}}}" in text
    }
    return spark.sql(text, **tables)
