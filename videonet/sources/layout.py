"""Edges stored in buckets of their ends, so that joins and loops read a layout instead of shuffling all edges."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.operators.skew import ROWS_PER_SLICE, SLICE, spread_rows

#: Bytes of both ids and the crawl that one bucket should hold, before compression.
BUCKET_BYTES = 512 * 1024 * 1024
ENDS = {"src": "dst", "dst": "src"}


class EdgeLayout:
    """Two copies of the edges of one folder: in buckets by `src` and in buckets by `dst`.

    Within a copy an id with more edges than a slice holds is cut into slices by
    the other end; buckets are hashed from id and slice, so no bucket holds all
    edges of a hub, and parallel edges share a bucket. Without such ids the buckets
    are hashed from the id alone, which is what a join asks for then. The list of such ids and the
    vertices with their degrees are stored next to the copies. Edges without both
    ends are not stored: no join or message can use them.

    A layout is written once and then only read. Its size is written last, so one
    whose write was broken off cannot be opened.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = spark.read.schema("buckets int").parquet(f"{self.path}/size").first().buckets

    @classmethod
    def store(
        cls, edges: DataFrame, path: str, buckets: int | None = None, rows_per_slice: int = ROWS_PER_SLICE
    ) -> EdgeLayout:
        """Write the layout of (crawl_id, src, dst); fails where the folder holds one already.

        The number of buckets follows the bytes of the edges unless it is given.
        """
        spark, path = edges.sparkSession, path.rstrip("/")
        rows = edges.select("crawl_id", "src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL")
        ends = rows.select(F.expr("stack(2, src, 1L, 0L, dst, 0L, 1L) AS (id, outDegree, inDegree)"))
        degrees = ends.groupBy("id").agg(F.sum("outDegree").alias("outDegree"), F.sum("inDegree").alias("inDegree"))
        degrees.write.parquet(f"{path}/vertices")
        degrees = spark.read.parquet(f"{path}/vertices")
        if buckets is None:
            length = F.coalesce(F.octet_length("id"), F.lit(0)) + 8
            held = degrees.agg(F.sum((F.col("outDegree") + F.col("inDegree")) * length)).first()[0] or 0
            buckets = max(spark.sparkContext.defaultParallelism, math.ceil(held / BUCKET_BYTES))
        for end, count in (("src", "outDegree"), ("dst", "inDegree")):
            hot = degrees.filter(F.col(count) > rows_per_slice).select(
                F.col("id").alias(end), F.ceil(F.col(count) / rows_per_slice).cast("int").alias("_slices"))
            hot.write.parquet(f"{path}/hot_{end}")
            hot = cls._hot(spark, path, end)
            keys = cls._keys(end, hot)
            (
                # The same hash as that of the buckets, so each task writes one file.
                spread_rows(rows, hot, end, [ENDS[end]])
                .select("crawl_id", "src", "dst", SLICE).repartition(buckets, *keys)
                .write.bucketBy(buckets, *keys).sortBy(*keys, ENDS[end])
                .option("path", f"{path}/by_{end}").saveAsTable(cls._name(path, end))
            )
        spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(f"{path}/size")
        return cls(spark, path)

    @staticmethod
    def _name(path: str, end: str) -> str:
        return f"edges_by_{end}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"

    def by(self, end: str) -> DataFrame:
        """(crawl_id, src, dst, _slice), hash-partitioned by the end and its slice as stored."""
        name, keys = self._name(self.path, end), ", ".join(self._keys(end, self.hot(end)))
        # The session's list of tables may not know a layout that another session wrote.
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (crawl_id STRING, src STRING, dst STRING, {SLICE} INT) "
            f"USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}, {ENDS[end]}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/by_{end}'"
        )
        return self.spark.table(name)

    def hot(self, end: str) -> DataFrame | None:
        """(end, _slices) of the ids that are cut into slices; None if there is none."""
        return self._hot(self.spark, self.path, end)

    @staticmethod
    def _hot(spark: SparkSession, path: str, end: str) -> DataFrame | None:
        found = spark.read.schema(f"{end} string, _slices int").parquet(f"{path}/hot_{end}")
        return None if found.isEmpty() else found

    @staticmethod
    def _keys(end: str, hot: DataFrame | None) -> list[str]:
        return [end] if hot is None else [end, SLICE]

    def vertices(self) -> DataFrame:
        """(id, outDegree, inDegree) of all ends; parallel edges count."""
        return self.spark.read.schema("id string, outDegree bigint, inDegree bigint").parquet(f"{self.path}/vertices")

    def forget(self) -> None:
        """Take the copies off the session's list of tables; the files stay."""
        for end in ENDS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(self.path, end)}")
