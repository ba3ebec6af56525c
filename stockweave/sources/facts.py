"""Order facts kept as month-partitioned tables and advanced in place.

By the high-water mark of the order date, or by digests of the source rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from stockweave.functions.exprs import month_of
from stockweave.operators.changes import changed_keys, since_mark, source_digests
from stockweave.sources.publish import Lakehouse
from stockweave.session import materialize

MONTH = "order_month"
KEY = "order_id"
LAYER = "fact"


def create_fact(lake: Lakehouse, name: str, fact: DataFrame) -> DataFrame:
    """First load, one partition per order month."""
    return lake.publish(
        fact.withColumn(MONTH, month_of("order_date")), LAYER, name, partition_by=(MONTH,)
    )


def _with_digest(fact: DataFrame, digests: DataFrame) -> DataFrame:
    return fact.join(digests, KEY).withColumn(MONTH, month_of("order_date"))


def create_tracked_fact(
    lake: Lakehouse, name: str, build: Callable[..., DataFrame], orders: DataFrame, *others: DataFrame
) -> DataFrame:
    """First load of a fact that keeps a digest of its source rows."""
    digests = source_digests(orders, KEY, *others)
    fact = _with_digest(build(orders, *others), digests)
    return lake.publish(fact, LAYER, name, partition_by=(MONTH,))


def advance_tracked_fact(
    lake: Lakehouse, name: str, build: Callable[..., DataFrame], orders: DataFrame, *others: DataFrame
) -> list:
    """Rebuild the orders whose source rows changed, late changes to old orders included.

    A high-water mark sees none of those. Here the digests of all source rows are
    joined with the ones the fact keeps: a scan of the sources, while only changed
    orders are built and only their months written. Orders gone from the source
    stay. Returns the months rewritten.
    """
    digests = materialize(source_digests(orders, KEY, *others))
    changed = materialize(changed_keys(digests, lake.read(LAYER, name), KEY))
    of_changed = [df.join(changed, KEY, "left_semi") for df in (orders, *others)]
    fresh = _with_digest(build(*of_changed), digests)
    return lake.upsert_partitions(fresh, LAYER, name, KEY, MONTH)


def advance_fact(
    lake: Lakehouse,
    name: str,
    build: Callable[..., DataFrame],
    orders: DataFrame,
    *others: DataFrame,
    lookback_days: int = 0,
) -> list:
    """Rebuild the orders from the high-water mark on and merge their months.

    Returns the months rewritten. All other months are neither read, but for
    their keys, nor written.
    """
    target = lake.read(LAYER, name)
    recent = since_mark(orders, target, "order_date", lookback_days)
    fresh = build(recent, *others).withColumn(MONTH, month_of("order_date"))
    return lake.upsert_partitions(fresh, LAYER, name, "order_id", MONTH)
