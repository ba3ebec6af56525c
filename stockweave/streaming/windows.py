"""Windowed event counts with bounded state, and the late rows beside them.

An aggregation with a watermark drops late rows without a trace. Here a first
stream keeps the watermark itself: a micro-batch is late where its window ends at
or before the newest time of the batches before it, less the delay. Late rows are
counted in a side table, all others pass. The second stream counts windows of what
passed, in append mode: it forgets a window once the watermark passes its end, so
its state is the windows of the delay. Its watermark is never ahead of the first
one, so it drops nothing; counts of a closed window plus its late rows are the
counts of a batch job over everything that arrived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockweave.session import path_exists

WINDOW = "1 day"
DELAY = "1 day"
_PASSED = "ts timestamp, event_type string"
_COUNTS = "traffic_date date, traffic_source string, n bigint"


def _window_end(ts: Column, window: str) -> Column:
    return F.window(ts, window).getField("end")


def split_stream(
    events: DataFrame, root: str, checkpoint: str, window: str = WINDOW, delay: str = DELAY
) -> StreamingQuery:
    """Write late rows as counts and the others as they are, one folder per micro-batch.

    Rows without a time belong to no window and count as late under a NULL day. A
    replayed batch finds the newest time of the batches before it, and what it
    has written whole is not written again, so nothing counts twice.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"batch={batch_id}"
        if path_exists(spark, f"{root}/passed/{name}/_SUCCESS"):
            return
        newest = None
        if batch_id:
            marks = spark.read.parquet(f"{root}/marks").where(F.col("batch") < batch_id)
            newest = marks.agg(F.max("newest")).first()[0]
        rows = batch.select(F.col("ts").cast("timestamp").alias("ts"), "event_type").persist()
        late = F.col("ts").isNull()
        if newest is not None:
            limit = F.lit(newest) - F.expr(f"interval {delay}")
            late = late | (_window_end(F.col("ts"), window) <= limit)
        counts = rows.where(late).groupBy(
            F.col("ts").cast("date").alias("traffic_date"), F.col("event_type").alias("traffic_source")
        )
        counts.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/late/{name}")
        seen = rows.agg(F.max("ts").alias("newest"))
        seen.write.mode("overwrite").parquet(f"{root}/marks/{name}")
        # last, as it is what a replay looks for
        rows.where(~late).write.mode("overwrite").parquet(f"{root}/passed/{name}")
        rows.unpersist()

    return (
        events.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def count_stream(
    spark: SparkSession, root: str, checkpoint: str, window: str = WINDOW, delay: str = DELAY
) -> StreamingQuery:
    """Counts per window and type of what passed, each written once, when its window closes.

    Runs after ``split_stream`` has come to rest, so a batch of it holds whole
    batches of the first stream.
    """
    passed = spark.readStream.schema(_PASSED).parquet(f"{root}/passed")
    counts = (
        passed.withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"), F.col("event_type").alias("traffic_source"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast("date").alias("traffic_date"), "traffic_source", "n")
    )
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/closed")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_counts(spark: SparkSession, root: str) -> DataFrame:
    """(traffic_date, traffic_source, sessions, late_sessions) of all closed windows."""
    closed = spark.read.schema(_COUNTS).parquet(f"{root}/closed")
    late = spark.read.schema(_COUNTS).parquet(f"{root}/late")
    late = late.select(*closed.columns, F.col("n").alias("late"))
    both = closed.withColumn("late", F.lit(0).cast("bigint")).unionByName(late)
    return both.groupBy("traffic_date", "traffic_source").agg(
        F.sum("n").alias("sessions"), F.sum("late").alias("late_sessions")
    )
