"""Exact ranks and quantiles without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from videonet.session import cut_lineage, write_through

# monotonically_increasing_id: the number of the partition stands above these bits, that of the row within them.
ROW_BITS = 33


def running_sum(df: DataFrame, by: list[str], order: list, value: str, name: str) -> DataFrame:
    """The rows with the sum of `value` over the earlier rows of their group (keys without nulls).

    Rows are range-partitioned and summed per range; only range totals, one row
    per range and group, are accumulated over a whole group.
    """
    ranges = cut_lineage(
        df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    )
    totals = ranges.groupBy(*by, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = (F.col("_start") + F.col("_inside")).alias(name)
    return (
        ranges.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, [*by, "_range"])
        .select(*[c for c in df.columns if c != "_one"], earlier)
    )


def numbered(df: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    """The rows with their 1-based place in their group."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(one, by, order, "_one", name).withColumn(name, F.col(name) + 1)


def in_order(df: DataFrame, order: str, name: str) -> DataFrame:
    """The rows, stored, with a number each that grows with the column `order`, which has no value twice.

    Rows are sorted once, by one shuffle. Numbers are those of range and row within it, so they
    leave gaps; a range takes as many of them as the longest one needs.
    """
    stored = write_through(df.orderBy(order).withColumn(name, F.monotonically_increasing_id()), "in-order", "zstd")
    row = F.col(name).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    bits = (stored.agg(F.max(row)).first()[0] or 0).bit_length()
    return stored.withColumn(name, F.shiftleft(F.shiftright(name, ROW_BITS), bits).bitwiseOR(row))


def cumulative_counts(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """(by, value, num_rows, below): rows of the group that have a smaller value.

    Equal values collapse first; the distinct ones are range-partitioned, summed
    per range, and only the range totals (one row per range and group) are
    accumulated over a whole group.
    """
    keys = [by] if by else []
    distinct = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("num_rows"))
    ranges = cut_lineage(
        distinct.repartitionByRange(*keys, value).withColumn("range", F.spark_partition_id())
    )
    totals = ranges.groupBy(*keys, "range").agg(F.sum("num_rows").alias("range_rows"))
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = totals.select(
        *keys, "range", F.coalesce(F.sum("range_rows").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy(*keys, "range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        ranges.withColumn("inside", F.coalesce(F.sum("num_rows").over(inside), F.lit(0)))
        .join(starts, [*keys, "range"])
        .select(*keys, value, "num_rows", (F.col("start") + F.col("inside")).alias("below"))
    )


def group_quantiles(
    df: DataFrame, by: str, value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Exact quantiles per group, linear between neighbouring rows."""
    placed = cumulative_counts(df, value, by)
    totals = placed.groupBy(by).agg(F.sum("num_rows").alias("total"))
    placed = placed.join(totals, by)

    def value_at(position):
        hit = (F.col("below") <= position) & (position < F.col("below") + F.col("num_rows"))
        return F.max(F.when(hit, F.col(value)))

    columns = [F.max("total").alias("num_rows")]
    for name, q in quantiles.items():
        exact = F.lit(q) * (F.col("total") - 1)
        low, high = value_at(F.floor(exact)), value_at(F.ceil(exact))
        part = F.max(exact - F.floor(exact))
        columns.append((low + (high - low) * part).alias(name))
    return placed.groupBy(by).agg(*columns)
