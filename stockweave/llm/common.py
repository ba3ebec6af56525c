"""What the operators share: reading tables, bounded Arrow batches, ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the contracts, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"

# Bytes of one Arrow batch sent to Python, so that long texts cannot pile up.
BATCH_BYTES = 8 * 1024 * 1024


def ready(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes, unless the session already chose a bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named columns: alias -> source column, whatever else the frame has."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Non-empty batches with the Python values of their last column."""
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(batch.num_columns - 1).to_pylist()
