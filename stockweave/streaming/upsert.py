"""Keyed upsert of a change stream into a published, partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockweave.sources.publish import Lakehouse


def last_per_key(changes: DataFrame, key: str, order: str) -> DataFrame:
    """Reduce a batch to the newest change per key before it is merged.

    Of changes of equal order the one of greatest hash counts, so a replayed
    batch gives the same rows.
    """
    rest = [c for c in changes.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(order, F.xxhash64(*rest))).alias("_row")
    return changes.groupBy(key).agg(newest).select(key, "_row.*")


def upsert_stream(
    changes: DataFrame,
    lake: Lakehouse,
    layer: str,
    table: str,
    key: str,
    partition_column: str,
    checkpoint: str,
    order: str | None = None,
) -> StreamingQuery:
    """Upsert a change stream into a partitioned table, touched partitions only.

    Work per micro-batch follows the partitions it touches. Upserts repeat
    safely, so a batch replayed after a failure changes nothing, and a restart
    without new files finds the table as it is. With an ``order`` column, which
    the table keeps, changes may come in any order and a key several times in a
    batch: in the end every key has its newest change. Without one a repeated key
    stops the stream, and later batches overwrite earlier ones.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        own = Lakehouse(batch.sparkSession, lake.root, lake.branch, lake.environment)
        batch = last_per_key(batch, key, order) if order else batch
        own.upsert_partitions(batch, layer, table, key, partition_column, order, order is not None)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
