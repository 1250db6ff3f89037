"""Writers for tables, results, archives and exports."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed formats of the archive stamps.
ARCHIVE_DATE = "%m-%d-%Y"
ARCHIVE_TIME = "%H:%M:%S"
ARCHIVE_RUN = "%m-%d-%Y_%H-%M-%S"


def write_entities(df: DataFrame, path: str, replace_all: bool = False) -> None:
    """Write a table partitioned by crawl, and by run where rows carry one; only the partitions in `df` are replaced.

    The rebalance hint lets adaptive execution split a very large crawl over
    several files and join small ones, by size.
    """
    keys = ["crawl_id", "run"] if "run" in df.columns else ["crawl_id"]
    (
        df.hint("rebalance", F.col("crawl_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_buckets(df: DataFrame, path: str) -> None:
    """Add rows that carry their bucket and run, and are dealt by bucket, to a table partitioned by both."""
    df.write.mode("append").partitionBy("bucket", "run").parquet(path)


def save_degree_stats(degrees: DataFrame, path: str) -> None:
    degrees.write.mode("overwrite").parquet(path)


def save_categorized(results: dict[str, DataFrame | None], prefix: str) -> list[str]:
    """Write each non-empty result to <prefix>_<key>; returns the written paths."""
    written = []
    for key, result in results.items():
        if result is None or result.isEmpty():
            continue
        path = f"{prefix}_{key}"
        result.write.mode("overwrite").parquet(path)
        written.append(path)
    return written


def archive_columns(
    df: DataFrame, kind: str, params: dict[str, object], now: datetime
) -> DataFrame:
    """Result with date, time and the query parameters."""
    stamps = {
        "created_date": F.lit(now.strftime(ARCHIVE_DATE)),
        "created_time": F.lit(now.strftime(ARCHIVE_TIME)),
        "kind": F.lit(kind),
        "run_ts": F.lit(now.strftime(ARCHIVE_RUN)),
    }
    return df.withColumns({**{k: F.lit(v) for k, v in params.items()}, **stamps})


def archive_result(
    df: DataFrame, path: str, kind: str, params: dict[str, object], now: datetime | None = None
) -> None:
    """Append a result to the archive, one directory per kind and run."""
    rows = archive_columns(df, kind, params, now or datetime.now())
    # Results of one kind share columns; kinds are kept in separate directories.
    rows.write.mode("append").partitionBy("kind", "run_ts").parquet(path)


def append_runs(runs: list[DataFrame], path: str) -> None:
    """Append the rows of measured runs to the stored run log."""
    reduce(DataFrame.unionByName, runs).coalesce(1).write.mode("append").parquet(path)


def export_result(df: DataFrame, path: str, file_format: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).csv(path)
    elif file_format == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown export format {file_format}")
