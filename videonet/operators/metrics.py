"""Run log: rows in, rows out and time of a query, without an extra scan."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = (
    "query_type string, execution_time double, rows_processed bigint, rows_returned bigint, "
    "throughput double, selectivity double, params string, finished_at timestamp"
)


def run_measured(
    query_type: str,
    source: DataFrame,
    query: Callable[[DataFrame], DataFrame],
    save: Callable[[DataFrame], None],
    params: dict[str, object] | None = None,
) -> DataFrame:
    """Run query(source), hand the result to `save`, return one run-log row.

    Both row counts are observed while the one job runs.
    """
    read, returned = Observation(), Observation()
    result = query(source.observe(read, F.count(F.lit(1)).alias("rows")))
    result = result.observe(returned, F.count(F.lit(1)).alias("rows"))
    start = time.monotonic()
    save(result)
    seconds = time.monotonic() - start
    rows_in, rows_out = read.get["rows"], returned.get["rows"]
    row = (
        query_type,
        seconds,
        rows_in,
        rows_out,
        rows_in / seconds if seconds > 0 else None,
        100.0 * rows_out / rows_in if rows_in else None,
        json.dumps(params or {}, sort_keys=True, default=str),
        datetime.now(timezone.utc),
    )
    return source.sparkSession.createDataFrame([row], RUN_LOG_SCHEMA)


def run_history(log: DataFrame) -> DataFrame:
    """Average, best and worst time per query type."""
    return log.groupBy("query_type").agg(
        F.count(F.lit(1)).alias("num_runs"),
        F.avg("execution_time").alias("avg_time"),
        F.min("execution_time").alias("best_time"),
        F.max("execution_time").alias("worst_time"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_rows"))
