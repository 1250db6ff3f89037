"""Stored tables below one base path, and views over them."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from videonet.schemas import STORED, TABLES, VIDEO_BUCKETS, VIDEO_PARTS

#: Tables that an ingest makes visible by registering crawls.
REGISTERED = ("crawls", "videos", "video_snapshots", "edges", "rejected_lines")
#: Buckets by which a new table of videos is divided. A run reads and writes the buckets of its ids only, so there
#: should be many more of them than a small crawl touches, and few enough for files of some hundred megabytes.
VIDEO_BUCKET_COUNT = 64


class Catalog:
    """Reads and writes the tables as files of one format."""

    def __init__(self, spark: SparkSession, base: str, file_format: str = "parquet"):
        self.spark = spark
        self.base = base
        self.file_format = file_format

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def exists(self, name: str) -> bool:
        try:
            self.load_table(name)
            return True
        except AnalysisException:
            return False

    def load_table(self, name: str, path: str | None = None) -> DataFrame:
        """Lazy frame with the fixed schema; runs no job over the data of known tables.

        The newest complete version of `crawls` counts. Where there is one, it names
        what is visible in the other tables: per crawl the runs that wrote its
        rows, and the version of the list of runs that wrote the buckets of `videos`.
        Nothing that it names is ever written again.
        """
        if path is not None or name not in REGISTERED:
            return self._read(name, path or self.path(name))
        version = self._newest("crawls")
        if version is None:
            return self._read(name, self.path(name))
        crawls = self._read("crawls", f"{self.path('crawls')}/version={version}")
        if name == "crawls":
            return crawls
        if name == "videos":
            return self._videos(crawls)
        runs = F.array("rejects_run") if name == "rejected_lines" else F.col("runs")
        current = crawls.select(F.col("id").alias("crawl_id"), F.explode(runs).alias("run"))
        schema = StructType([*STORED[name].fields, StructField("run", LongType())])
        try:
            rows = self.spark.read.format(self.file_format).schema(schema).load(self.path(name))
        except AnalysisException:  # a first run that was broken off before it wrote the table
            return self.empty(name)
        return self._named(rows, current, ["crawl_id", "run"]).select(*STORED[name].names)

    @staticmethod
    def _named(rows: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
        """The rows of the partitions that are named; the comparison makes Spark prune the others before it reads."""
        return rows.join(current.filter(F.col("run") >= 0), keys, "left_semi")

    def video_buckets(self) -> DataFrame | None:
        """(bucket, run): the run whose rows of each bucket of `videos` count; None before the first ingest."""
        version = self.videos_version()
        if not version:
            return None
        path = f"{self.path('videos')}/version={version}"
        return self.spark.read.schema(VIDEO_BUCKETS).parquet(path)

    def video_parts(self, buckets: DataFrame) -> DataFrame:
        """The videos of the listed buckets, as stored."""
        rows = self.spark.read.schema(VIDEO_PARTS).parquet(self.path("video_parts"))
        return self._named(rows, buckets, ["bucket", "run"])

    def _videos(self, crawls: DataFrame) -> DataFrame:
        buckets = self.video_buckets()
        if buckets is None:
            return self.empty("videos")
        names = crawls.agg(F.map_from_entries(F.collect_list(F.struct("number", "id")))).scalar()
        rows = self.video_parts(buckets).withColumn("names", names)

        def seen(number, _):
            bits = F.try_element_at(F.col("seen"), F.floor(number / 64).cast("int"))
            return F.getbit(F.coalesce(bits, F.lit(0).cast("bigint")), (number % 64).cast("int")) == 1

        crawl_ids = F.array_sort(F.map_values(F.map_filter("names", seen)))
        return rows.withColumn("seen_in_crawls", crawl_ids).select(*STORED["videos"].names)

    def empty(self, name: str) -> DataFrame:
        """A known table without rows, made without Python workers."""
        fields = self.spark.createDataFrame([], STORED[name]).schema.fields
        return self.spark.range(0).select(
            *[F.lit(None).cast(field.dataType).alias(field.name) for field in fields]
        )

    def _read(self, name: str, path: str) -> DataFrame:
        reader = self.spark.read.format(self.file_format)
        if name in STORED:
            reader = reader.schema(STORED[name])
        return reader.load(path)

    def _versions(self, name: str, marker: str) -> list[int]:
        """Versions of a table that have a file or folder of the marker's name; lists names only."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/version=*{marker}")
        files = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [str(status.getPath()) for status in files.globStatus(pattern) or []]
        return sorted(int(path.split("/version=")[-1].split("/")[0]) for path in found)

    def _newest(self, name: str) -> int | None:
        """The newest complete version; one whose write was broken off is never read."""
        versions = self._versions(name, "/_SUCCESS")
        return versions[-1] if versions else None

    def write_version(self, name: str, rows: DataFrame) -> int:
        """Write the next version of a table and drop all but the two newest complete ones before it."""
        version = max(self._versions(name, ""), default=0) + 1
        complete = self._versions(name, "/_SUCCESS")
        rows.write.mode("overwrite").parquet(f"{self.path(name)}/version={version}")
        jvm = self.spark.sparkContext._jvm
        for old in complete[:-2]:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/version={old}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return version

    def new_run(self) -> int:
        """A number for a run of ingest that no other run has, whether it ends or not."""
        run = max(self._versions("runs", ""), default=0) + 1
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path('runs')}/version={run}")
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
        return run

    def rows_of_run(self, name: str, run: int) -> DataFrame:
        """What one run wrote into a table, whether it counts or not."""
        schema = StructType([*STORED[name].fields, StructField("run", LongType())])
        rows = self.spark.read.format(self.file_format).schema(schema).load(self.path(name))
        return rows.filter(F.col("run") == run).drop("run")

    def drop_unused(self) -> int:
        """Delete partitions that none of the kept versions names and that no later run is writing; returns their number.

        Partitions are listed and compared by name; no file is opened but those of the registry.
        """
        kept = [self._read("crawls", f"{self.path('crawls')}/version={v}") for v in self._versions("crawls", "/_SUCCESS")]
        if not kept:
            return 0
        crawls = reduce(DataFrame.unionByName, kept)
        newest = kept[-1].agg(F.max(F.greatest(F.array_max("runs"), "rejects_run"))).first()[0] or 0
        named = {"edges": F.col("runs"), "video_snapshots": F.col("runs"), "rejected_lines": F.array("rejects_run")}
        used = {
            name: {(row.key, row.run) for row in crawls.select(
                F.col("id").alias("key"), F.explode(runs).alias("run")).distinct().collect()}
            for name, runs in named.items()
        }
        used["video_parts"] = set()
        for version in self._versions("videos", "/_SUCCESS"):
            rows = self.spark.read.schema(VIDEO_BUCKETS).parquet(f"{self.path('videos')}/version={version}").collect()
            used["video_parts"] |= {(str(row.bucket), row.run) for row in rows}
        jvm = self.spark.sparkContext._jvm
        dropped = 0
        for name, keys in used.items():
            pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/*=*/run=*")
            files = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for status in files.globStatus(pattern) or []:
                path = status.getPath()
                key = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
                    path.getParent().getName().split("=", 1)[1])
                run = int(path.getName().split("=")[1])
                if run <= newest and (key, run) not in keys:
                    dropped += files.delete(path, True)
        return dropped

    def videos_version(self) -> int:
        """Number of the current version of the list of buckets of `videos`, 0 before the first ingest."""
        version = self._newest("crawls")
        if version is None:
            return 0
        crawls = self._read("crawls", f"{self.path('crawls')}/version={version}")
        return crawls.agg(F.max("videos_version")).first()[0] or 0

    def load_all(self, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
        """All tables that exist; those named in `keep` are cached for reuse."""
        tables = {}
        for name in TABLES:
            if self.exists(name):
                table = self.load_table(name)
                tables[name] = table.persist() if name in keep else table
        return tables

    def create_views(self) -> list[str]:
        return create_views(self.load_all())

    def profile(self) -> DataFrame:
        return dataset_profile(
            self.spark,
            {name: self.load_table(name) if self.exists(name) else None for name in TABLES},
        )


def load_graph(videos: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (id and the known columns that are present) and edges (src, dst)."""
    columns = [F.col("_id" if "_id" in videos.columns else "id").alias("id")]
    columns += [F.col(c) for c in ("category", "uploader", "length_sec") if c in videos.columns]
    for name in ("view_count", "views"):
        if name in videos.columns:
            columns.append(F.col(name).alias("view_count"))
            break
    return videos.select(*columns), edges.select("src", "dst")


def create_views(tables: dict[str, DataFrame]) -> list[str]:
    """Register every table as a temporary view for SQL."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return sorted(tables)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables())


def dataset_profile(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Per table: does it exist, number of rows, column names."""
    parts = []
    for name, table in tables.items():
        if table is None:
            row = spark.range(1).select(F.lit(0).cast("bigint").alias("num_rows"))
        else:
            row = table.agg(F.count(F.lit(1)).alias("num_rows"))
        columns = ",".join(table.columns) if table is not None else ""
        parts.append(
            row.select(
                F.lit(name).alias("table_name"),
                F.lit(table is not None).alias("table_exists"),
                "num_rows",
                F.lit(columns).alias("column_names"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
