"""Joins that keep their shape when one key holds a large share of the rows.

Join strategy is left to Spark: a side is broadcast only when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold``, otherwise both sides
are shuffled and adaptive execution splits skewed partitions of the side that
may be split. Two cases are out of its reach and handled here: NULL keys of a
left join, and a hot key on the right of a left join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import materialize

# A key holding more than this share of the rows is hot; so at most 200 are.
HOT_SHARE = 1 / 200
# Copies of the left rows of a hot key, each meeting its part of the right rows.
HOT_SALTS = 64
# Shuffle targets over which left rows without a key are spread.
NULL_SPREAD = 4096


def left_join_spread(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where many left keys are NULL.

    A NULL key matches nothing, but all of them would hash to one partition.
    A second equi-key, which for NULL keys is a bucket no right row carries,
    spreads them; the first equi-key keeps the meaning exact. The bucket is one
    more projected column, so it is always there: Spark picks the join by sizes
    it measures at run time, and a broadcast join is none the worse for it.
    """
    others = [F.col(c) for c in left.columns if c != key]
    bucket = F.concat(
        F.lit("null-"), F.pmod(F.xxhash64(*others), F.lit(NULL_SPREAD)).cast("string")
    )
    spread_left = left.withColumn("_spread", F.coalesce(F.col(key).cast("string"), bucket))
    spread_right = right.withColumn("_spread", F.col(key).cast("string"))
    return spread_left.join(spread_right, [key, "_spread"], "left").drop("_spread")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, fraction: float = 0.01) -> list:
    """Keys that hold more than ``share`` of a sample of the rows.

    The sample only steers where rows are sent, never which rows are kept. The
    answer has at most ``1 / share`` entries, however large the input.
    """
    sample = df.select(key).where(F.col(key).isNotNull())
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=7)
    counts = sample.groupBy(key).count()
    total = counts.agg(F.sum("count")).scalar()
    return [row[0] for row in counts.where(F.col("count") > total * share).select(key).collect()]


def left_join_many(
    left: DataFrame, right: DataFrame, key: str, **sampling
) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where ``right`` may repeat a key.

    A left join cannot split its right side, so a hot right key would end in
    one task. Hot keys found in ``right`` surely match, so for them the join
    is an inner one and can be salted: right rows scatter over the salts and
    the left rows are copied to each. All other keys take the plain left join.
    """
    hot = hot_keys(right, key, **sampling)
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    # Row numbers spread even exact copies. A retried task could number its rows
    # anew, so the salted rows are written down before they are joined.
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(HOT_SALTS))
    scattered = materialize(right.where(is_hot).withColumn("_salt", place))
    copied = left.where(is_hot).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(HOT_SALTS - 1).cast("bigint")))
    )
    matched = copied.join(scattered, [key, "_salt"], "inner").drop("_salt")
    rest = left.where(~is_hot).join(right.where(~is_hot), key, "left")
    return rest.unionByName(matched.select(*rest.columns))


def as_of_join(
    probes: DataFrame,
    features: DataFrame,
    entity: str,
    probe_ts: str,
    feature_ts: str,
    created_ts: str,
    values: Sequence[str],
    ttl_days: int,
    slices: int = 1,
) -> DataFrame:
    """Newest feature row of the probe's entity with ``t - ttl <= ts <= t``.

    Equal event times go to the newest created row; without one the values are
    NULL. Time is cut into buckets of ``ttl / slices``, so a feature can serve
    its own bucket and the next ``slices`` only: it is copied to those, and the
    scan runs per (entity, bucket). However many rows an entity has, one window
    holds one row per distinct time of one bucket and its look-back.
    """
    width = F.lit(-(-ttl_days * 86400 // slices))

    def bucket(ts: str) -> Column:
        return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / width).cast("bigint")

    payload = F.struct(F.col(feature_ts).alias("_ts"), *[F.col(v) for v in values])
    newest = features.groupBy(entity, feature_ts).agg(
        F.max_by(payload, F.col(created_ts)).alias("_row")
    )
    offered = newest.select(
        F.col(entity).alias("_entity"),
        F.col(feature_ts).alias("_at"),
        F.lit(0).alias("_kind"),
        "_row",
        F.explode(
            F.sequence(bucket(feature_ts), bucket(feature_ts) + F.lit(slices).cast("bigint"))
        ).alias("_bucket"),
    )
    asked = (
        probes.select(F.col(entity).alias("_entity"), F.col(probe_ts).alias("_at"))
        .distinct()
        .select(
            "_entity",
            "_at",
            F.lit(1).alias("_kind"),
            F.lit(None).cast(newest.schema["_row"].dataType).alias("_row"),
            bucket("_at").alias("_bucket"),
        )
    )
    # At equal times features come before probes, so "at t" counts as known at t.
    order = Window.partitionBy("_entity", "_bucket").orderBy("_at", "_kind")
    seen = F.last("_row", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    fresh = F.col("_seen._ts") >= F.col("_at") - F.expr(f"INTERVAL {ttl_days} DAYS")
    answers = (
        offered.unionByName(asked)
        .withColumn("_seen", seen)
        .where(F.col("_kind") == 1)
        .select(
            F.col("_entity").alias(entity),
            F.col("_at").alias(probe_ts),
            F.when(fresh, F.col("_seen._ts")).alias(feature_ts),
            *[F.when(fresh, F.col(f"_seen.{v}")).alias(v) for v in values],
        )
    )
    return probes.join(answers, [entity, probe_ts], "left")


def latest_per_entity(
    features: DataFrame, entity: str, feature_ts: str, created_ts: str
) -> DataFrame:
    """The newest row per entity, ties to the newest created; combines map-side."""
    rest = [c for c in features.columns if c != entity]
    newest = F.max_by(F.struct(*rest), F.struct(feature_ts, created_ts)).alias("_row")
    return features.groupBy(entity).agg(newest).select(entity, "_row.*")


def literal_date(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")
