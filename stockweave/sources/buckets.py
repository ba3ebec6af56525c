"""Tables bucketed by their join key, so that joins on it need no exchange.

Facts about orders all meet on ``order_id``. Stored in the same number of buckets by
it, they are joined bucket by bucket: a table is shuffled once, when it is written,
and never again by the queries that join it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def store_bucketed(
    df: DataFrame, database: str, table: str, key: str, folder: str, buckets: int = BUCKETS
) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets sorted by ``key`` and read it.

    One task writes a bucket, as one file. Rows without a key share a bucket; a left
    join keeps them there. All tables that are to meet need the same ``buckets``.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", f"{folder.rstrip('/')}/{table}")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(f"{database}.{table}")
    )
    return read_bucketed(spark, database, table)


def read_bucketed(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")
