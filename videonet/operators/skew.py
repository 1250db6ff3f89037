"""Joins of a large table with a table that is unique per key, safe for hot keys.

Every hot key is cut into slices: each row of the large side goes to one slice,
and the matching row of the other side is copied to all slices of its key. The
list of hot keys is stored as a table, so Spark knows its size: it broadcasts a
short list and joins a long one by a shuffle that adaptive execution can split.
Where the list is empty there is one slice, and neither side is joined with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from videonet.session import write_through

ROWS_PER_SLICE = 1_000_000
NULL_SLICES = 1024
SLICE = "_slice"


def hot_slices(
    counts: DataFrame, key: str, n: str = "n", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame | None:
    """(key, _slices) for all keys of a (key, n) table with more rows than a slice holds; None if there is none."""
    hot = counts.filter(F.col(key).isNotNull() & (F.col(n) > rows_per_slice)).select(
        key, F.ceil(F.col(n) / rows_per_slice).cast("int").alias("_slices")
    )
    stored = write_through(hot, "hot-keys")
    return None if stored.isEmpty() else stored


# Parts of the keys that are counted first; a part with fewer rows than a slice has no hot key.
KEY_PARTS = 16_384
PART = "_part"


def hot_keys(fact: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame | None:
    """The hot_slices of the rows themselves, without a shuffle of all keys where nothing is hot.

    Rows are counted by a part of the hash of their key, of which there are few; keys
    are counted in the parts only that hold more rows than a slice.
    """
    parts = fact.filter(F.col(key).isNotNull()).select(
        key, F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int").alias(PART))
    # At most KEY_PARTS numbers.
    sizes = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    full = [row[PART] for row in sizes.filter(F.col("n") > rows_per_slice).select(PART).collect()]
    if not full:
        return None
    counts = parts.filter(F.col(PART).isin(full)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return hot_slices(counts, key, rows_per_slice=rows_per_slice)


def spread_rows(fact: DataFrame, hot: DataFrame | None, key: str, by: list[str]) -> DataFrame:
    """Give each row of a hot key one of its slices, chosen by the columns `by`."""
    spread = F.xxhash64(*by)
    rows = fact.withColumn("_slices", F.lit(None).cast("int")) if hot is None else fact.join(hot, key, "left")
    return (
        rows.withColumn(
            SLICE,
            F.when(F.col(key).isNull(), F.pmod(spread, F.lit(NULL_SLICES)))
            .when(F.col("_slices").isNull(), F.lit(0))
            .otherwise(F.pmod(spread, F.col("_slices")))
            .cast("int"),
        )
        .drop("_slices")
    )


def copy_to_slices(dim: DataFrame, hot: DataFrame | None, key: str) -> DataFrame:
    """Copy the rows of a hot key to each of its slices."""
    if hot is None:
        return dim.withColumn(SLICE, F.lit(0))
    last: Column = F.coalesce(F.col("_slices"), F.lit(1)) - 1
    return (
        dim.join(hot, key, "left")
        .withColumn(SLICE, F.explode(F.sequence(F.lit(0), last)))
        .drop("_slices")
    )


def sliced_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    by: list[str],
    counts: DataFrame | None = None,
    how: str = "inner",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """fact JOIN dim USING (key), with the rows of hot keys spread over several tasks.

    `counts` (key, n) may be given when the number of fact rows per key is known.
    """
    if counts is None:
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = hot_slices(counts, key, rows_per_slice=rows_per_slice)
    left = spread_rows(fact, hot, key, by)
    right = copy_to_slices(dim, hot, key)
    return left.join(right, [key, SLICE], how).drop(SLICE)
