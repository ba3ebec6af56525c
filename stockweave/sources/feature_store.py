"""Demand features stored by month and advanced month by month.

Beside the features lies the state: the last sale days of every product at the end of
the months a run covered, one partition per run. A run reads the sales of its own
months and one partition of the state, and writes the months it covers; what lies
before them is neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.operators.joins import literal_date
from stockweave.plans.features import demand_days, last_days, with_history
from stockweave.session import materialize
from stockweave.sources.publish import Lakehouse

LAYER = "features"
FEATURES = "demand_features"
STATE = "demand_history"
EVENT_MONTH = "event_month"
STATE_MONTH = "state_month"
CREATED = "2001-08-01 00:00:00"


def _within(orders: DataFrame, since: str | None, until: str) -> DataFrame:
    """Orders of the months from ``since`` up to ``until``; a ``month`` partition prunes the scan."""
    for column in [c for c in ("month", "order_date") if c in orders.columns]:
        orders = orders.where(F.col(column) < literal_date(until))
        if since is not None:
            orders = orders.where(F.col(column) >= literal_date(since))
    return orders


def _month_before(day: str):
    return F.add_months(literal_date(day), -1)


def _looked_up(inventory: DataFrame, since: str | None, until: str) -> DataFrame:
    """The stock of the months before those: a sale looks up the month before its own."""
    inventory = inventory.where(F.col("snapshot_date") < _month_before(until))
    return inventory if since is None else inventory.where(F.col("snapshot_date") >= _month_before(since))


def _days(
    since: str | None,
    until: str,
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    traffic: DataFrame,
    inventory: DataFrame,
) -> DataFrame:
    stock = _looked_up(inventory, since, until)
    return materialize(demand_days(items, _within(orders, since, until), products, traffic, stock))


def _save(lake: Lakehouse, days: DataFrame, carried: DataFrame | None, until: str, created: str) -> None:
    features = with_history(days, created, carried).withColumn(EVENT_MONTH, F.trunc("event_timestamp", "MM"))
    seen = days.select("product_id", "order_date", "quantity")
    seen = seen if carried is None else seen.unionByName(carried)
    state = last_days(seen).withColumn(STATE_MONTH, _month_before(until))
    for rows, table, column in ((features, FEATURES, EVENT_MONTH), (state, STATE, STATE_MONTH)):
        if carried is None:
            lake.publish(rows, LAYER, table, partition_by=(column,))
        else:
            lake.replace_partitions(rows, LAYER, table, column)


def create_demand_features(
    lake: Lakehouse, until: str, items: DataFrame, orders: DataFrame, *others: DataFrame, created: str = CREATED
) -> None:
    """First load: all months before the first of a month ``until``."""
    days = _days(None, until, items, orders, *others)
    _save(lake, days, None, until, created)


def carried_days(lake: Lakehouse, since: str) -> DataFrame:
    """The state at the end of the month before ``since``: one partition is read."""
    state = lake.read(LAYER, STATE).where(F.col(STATE_MONTH) == _month_before(since))
    return state.drop(STATE_MONTH)


def advance_demand_features(
    lake: Lakehouse,
    since: str,
    until: str,
    items: DataFrame,
    orders: DataFrame,
    *others: DataFrame,
    created: str = CREATED,
) -> None:
    """Add or replace the months from ``since`` up to ``until``, both the first of a month.

    The run before must have ended at ``since``; a rerun of the last months finds
    the state it started from and writes the same months again.
    """
    carried = carried_days(lake, since)
    if carried.isEmpty():
        raise ValueError(f"no run ended at {since}")
    days = _days(since, until, items, orders, *others)
    _save(lake, days, materialize(carried), until, created)


def read_demand_features(lake: Lakehouse) -> DataFrame | None:
    table = lake.read(LAYER, FEATURES)
    return None if table is None else table.drop(EVENT_MONTH)
