"""Keyed changes as pure functions (target, source) -> new target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.session import materialize

EPOCH = "1900-01-01"
# What a fact keeps of the source rows it was built from.
DIGEST = "source_digest"


def checked_batch(source: DataFrame, key: str) -> DataFrame:
    """A change batch written once and tested on the copy, as MERGE would test it.

    Raises if a key is NULL or repeats: a NULL key matches nothing, so a rerun
    would add its row again.
    """
    stored = materialize(source)
    counted = stored.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    wrong = counted.where(F.col(key).isNull() | (F.col("n") > 1)).limit(1).collect()
    if wrong and wrong[0][key] is None:
        raise ValueError(f"source row without {key}")
    if wrong:
        raise ValueError(f"more than one source row for {key} = {wrong[0][key]}")
    return stored


def merged(target: DataFrame, batch: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """``upsert`` with a batch that is checked already; ``keys`` are its keys, if they are stored."""
    keys = batch if keys is None else keys
    return target.join(keys.select(key), key, "left_anti").unionByName(batch)


def moves(target: DataFrame, batch: DataFrame, key: str, column: str) -> DataFrame:
    """``batch`` with ``_held``, whether the target has a row of its key, and that row's ``_from``.

    ``_from`` is the old value of ``column``. Of the target only keys and the column move.
    """
    old = target.select(key, F.lit(True).alias("_held"), F.col(column).alias("_from"))
    return batch.join(old, key, "left").withColumn("_held", F.coalesce("_held", F.lit(False)))


def newer_moves(target: DataFrame, batch: DataFrame, key: str, column: str, order: str) -> DataFrame:
    """``moves`` of the rows of ``batch`` that are not older than the target's row of their key.

    A NULL order is older than any other; of equal ones the batch's row counts.
    """
    old = target.select(
        key, F.lit(True).alias("_held"), F.col(column).alias("_from"), F.col(order).alias("_at")
    )
    newer = F.coalesce(F.col(order) >= F.col("_at"), F.col("_at").isNull())
    joined = batch.join(old, key, "left").where(newer).drop("_at")
    return joined.withColumn("_held", F.coalesce("_held", F.lit(False)))


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Matched rows take the source's columns, unmatched source rows are added.

    The source is planned once; its NULL and repeated keys are refused. Target
    rows without a key match nothing and are kept.
    """
    return merged(target, checked_batch(source, key), key)


def high_water_mark(target: DataFrame, column: str) -> Column:
    """``max(column)`` of the target as a scalar subquery, early date when empty."""
    newest = target.agg(F.coalesce(F.max(column), F.lit(EPOCH).cast("date")).alias("mark"))
    return newest.scalar()


def since_mark(
    source: DataFrame, target: DataFrame, column: str, lookback_days: int = 0
) -> DataFrame:
    """Source rows at or after the target's high-water mark.

    With the default of zero days late changes to older rows are not seen;
    a look-back widens the window by that many days.
    """
    mark = high_water_mark(target, column)
    return source.where(F.col(column) >= F.date_sub(mark, lookback_days))


def _row_text(df: DataFrame) -> Column:
    """A row as text in which NULL and empty, and every column, stay apart."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def source_digests(main: DataFrame, key: str, *details: DataFrame) -> DataFrame:
    """(key, source_digest): a digest of the row of ``main`` and of its rows in each detail.

    The rows of a detail are added up as hashes per key, so their order plays no
    part and repeated rows count; a hot key is one row per task before the shuffle.
    """
    parts = [F.md5(_row_text(main))]
    found = main.select(key, parts[0].alias("_d0"))
    for i, detail in enumerate(details, 1):
        hashed = F.xxhash64(_row_text(detail)).cast("decimal(38,0)")
        sums = detail.groupBy(key).agg(F.sum(hashed).cast("string").alias(f"_d{i}"))
        found = found.join(sums, key, "left")
    columns = [F.coalesce(f"_d{i}", F.lit("")) for i in range(len(details) + 1)]
    return found.select(key, F.md5(F.concat_ws("|", *columns)).alias(DIGEST))


def changed_keys(digests: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys that the target lacks or holds with another digest, however old they are."""
    held = target.select(key, F.col(DIGEST).alias("_held"))
    known = digests.join(held, key, "left")
    return known.where(~F.col(DIGEST).eqNullSafe(F.col("_held"))).select(key)


def scd2_empty(source: DataFrame) -> DataFrame:
    """An empty history with the columns ``scd2_apply`` keeps."""
    return source.where(F.lit(False)).select(
        "*",
        F.lit(None).cast("string").alias("scd_id"),
        F.lit(None).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def _scd_id(key: str, run_ts: str | Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(run_ts)))


def scd2_open(source: DataFrame, key: str, run_ts: str | Column) -> DataFrame:
    """The history a first snapshot starts: every row open, keys as they are."""
    now = F.lit(run_ts).cast("timestamp_ntz")
    return source.select(
        "*",
        _scd_id(key, run_ts).alias("scd_id"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        now.alias("updated_at"),
    )


def scd2_apply(
    history: DataFrame, source: DataFrame, key: str, check: Sequence[str], run_ts: str | Column
) -> DataFrame:
    """Fold one snapshot of ``source`` into a type-2 history.

    A key whose checked columns differ (NULL-safe) from its open row gets that
    row closed at ``run_ts`` and a new open row; an unseen key gets an open
    row; a key gone from the source keeps its open row. NULL and repeated source
    keys are refused. One join of the open rows with the source decides
    everything; closed rows never shuffle. The history is read twice, so keep it
    stored between runs.
    """
    now = F.lit(run_ts).cast("timestamp_ntz")
    columns = [c for c in source.columns]
    closed = history.where(F.col("valid_to").isNotNull())
    open_rows = history.where(F.col("valid_to").isNull())
    old = F.struct(*[F.col(c) for c in history.columns]).alias("_old")
    new = F.struct(*[F.col(c) for c in columns]).alias("_new")
    both = open_rows.select(key, old).join(
        checked_batch(source, key).select(key, new), key, "full"
    )
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = has_old & has_new & ~same

    opened = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in columns],
        _scd_id(key, run_ts).alias("scd_id"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        now.alias("updated_at"),
    )
    ended = F.struct(
        *[F.col(f"_old.{c}").alias(c) for c in columns],
        F.col("_old.scd_id").alias("scd_id"),
        F.col("_old.valid_from").alias("valid_from"),
        F.when(changed, now).otherwise(F.col("_old.valid_to")).alias("valid_to"),
        F.when(changed, now).otherwise(F.col("_old.updated_at")).alias("updated_at"),
    )
    rows = F.array_compact(
        F.array(F.when(has_old, ended), F.when(has_new & (~has_old | changed), opened))
    )
    return closed.unionByName(both.select(F.explode(rows).alias("_row")).select("_row.*"))
