"""Session defaults and the folder shared by all executors."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.checkpoint.compress": "true",
    # Loops leave one checkpoint per few rounds; drop those no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "videonet", conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """This session's folder below the shared one named in spark.checkpoint.dir; deleted when its JVM ends.

    Where that is unset, the shared folder is one below the warehouse, which executors share as well.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_scratch")
    root = sc.getCheckpointDir()
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    return root


#: Scratch paths given out since a block of `scratch_paths` began.
_GIVEN: ContextVar[list[str] | None] = ContextVar("given", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this session's shared folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    if (given := _GIVEN.get()) is not None:
        given.append(path)
    return path


@contextmanager
def scratch_paths() -> Iterator[list[str]]:
    """The list of scratch paths that are given out within the block, for a caller that deletes them."""
    given: list[str] = []
    token = _GIVEN.set(given)
    try:
        yield given
    finally:
        _GIVEN.reset(token)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of queries that have ended.

    It does so once the driver collects their handles, which may be long after the disk is full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and shortens the plan."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def write_through(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """A frame stored as a table in the shared folder, for several reads of some columns each.

    `codec` is the compression of its files, the session's where it is not given.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
