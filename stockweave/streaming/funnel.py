"""Daily event counts per type over a stream, late events included however late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockweave.sources.publish import Lakehouse

LAYER = "streams"
TABLE = "daily_counts"
# Days and types have one row each, so months make few and small partitions.
MONTH = "traffic_month"
KEY = "count_key"


def daily_counts(events: DataFrame) -> DataFrame:
    """(traffic_date, traffic_source, sessions) per day; state per day and type.

    There is no watermark: the state has one row per day and type, bounded by the
    calendar, and a watermark would drop late events from an exact count. Events
    without a time count under a NULL day.
    """
    day = F.col("ts").cast("timestamp").cast("date").alias("traffic_date")
    return events.groupBy(day, F.col("event_type").alias("traffic_source")).agg(
        F.count("*").alias("sessions")
    )


def funnel_stream(counts: DataFrame, lake: Lakehouse, checkpoint: str) -> StreamingQuery:
    """Keep the newest count per day and type in a published table keyed by both.

    A micro-batch brings whole new counts for the days it changed and rewrites
    their months only; a replayed batch brings the same counts again.
    """
    keyed = counts.withColumn(
        KEY, F.to_json(F.struct("traffic_date", "traffic_source"))
    ).withColumn(MONTH, F.trunc("traffic_date", "MM"))

    def save(batch: DataFrame, batch_id: int) -> None:
        own = Lakehouse(batch.sparkSession, lake.root, lake.branch, lake.environment)
        own.upsert_partitions(batch, LAYER, TABLE, KEY, MONTH)

    return (
        keyed.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_counts(lake: Lakehouse) -> DataFrame | None:
    """The counts as the last finished micro-batch left them; None before any."""
    table = lake.read(LAYER, TABLE)
    return None if table is None else table.drop(KEY, MONTH)
