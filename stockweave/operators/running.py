"""Running totals over a whole frame without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import materialize

CHUNK = "_chunk"


def running_total(
    df: DataFrame,
    value: Column,
    order_by: Sequence[Column],
    out: str,
    total_out: str | None = None,
) -> DataFrame:
    """Add the inclusive running sum of ``value`` in ``order_by`` order.

    ``order_by`` must be a total order. Rows are range-partitioned on it, so
    each chunk is a contiguous stretch and ties are split by the last column.
    The chunked frame is written once: chunk numbers must not change between
    the pass that sums the chunks and the pass that adds the offsets. The
    offsets have one row per chunk, so broadcasting them is bounded by the
    number of shuffle partitions, not by the data.
    """
    chunked = (
        df.withColumn("_value", value)
        .repartitionByRange(*order_by)
        .withColumn(CHUNK, F.spark_partition_id())
    )
    stored = materialize(chunked)
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(CHUNK).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sums = stored.groupBy(CHUNK).agg(F.sum("_value").alias("_sum"))
    offsets = sums.select(
        CHUNK,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(everything).alias("_total"),
    )
    inside = Window.partitionBy(CHUNK).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = stored.withColumn("_inside", F.sum("_value").over(inside)).join(
        F.broadcast(offsets), CHUNK
    )
    result = summed.withColumn(out, F.col("_before") + F.col("_inside"))
    if total_out:
        result = result.withColumnRenamed("_total", total_out)
    return result.drop(CHUNK, "_value", "_inside", "_before", "_total")


def ordinal(
    df: DataFrame, order_by: Sequence[Column], out: str, count_out: str | None = None
) -> DataFrame:
    """Add the zero-based position of each row in ``order_by`` order."""
    numbered = running_total(df, F.lit(1).cast("bigint"), order_by, out, count_out)
    return numbered.withColumn(out, F.col(out) - 1)
