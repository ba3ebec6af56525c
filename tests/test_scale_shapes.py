"""Operators with a special path for hot keys give the plain operator's rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stockweave import session
from stockweave.catalog import QUERIES
from stockweave.operators import joins
from stockweave.operators.running import ordinal, running_total
from stockweave.plans import risk
from stockweave.plans.features import delivered_items, demand_days, demand_features
from stockweave.sources import feature_store
from stockweave.sources.feature_store import (
    advance_demand_features,
    create_demand_features,
    read_demand_features,
)
from stockweave.sources.publish import Lakehouse


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_running_total_with_ties(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([0, 5, 5, 9])) for i in range(500)]
    df = spark.createDataFrame(data, "id bigint, v bigint").repartition(5)
    out = running_total(df, F.col("v"), [F.col("v").desc(), F.col("id")], "run", "total")
    expected, acc = [], 0
    for i, v in sorted(data, key=lambda r: (-r[1], r[0])):
        acc += v
        expected.append((i, v, acc))
    got = sorted(((r["id"], r["v"], r["run"]) for r in out.collect()), key=lambda r: (-r[1], r[0]))
    assert got == expected
    assert {r["total"] for r in out.collect()} == {acc}
    places = ordinal(df, [F.col("id")], "n").collect()
    assert all(r["n"] == r["id"] for r in places)


def test_hot_right_key(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(joins, "HOT_SALTS", 8)
    left = spark.createDataFrame([(k, f"l{k}") for k in range(40)] + [(None, "n")], "k int, l string")
    copies = [(3, "same")] * 300 + [(k, f"r{k}") for k in range(0, 40, 2)]
    right = spark.createDataFrame(copies, "k int, r string")
    assert joins.hot_keys(right, "k", share=0.2, fraction=1.0) == [3]
    got = joins.left_join_many(left, right, "k", share=0.2, fraction=1.0)
    assert rows(got) == rows(left.join(right, "k", "left"))


def test_null_keys_are_spread(spark, no_broadcast):
    left = spark.createDataFrame(
        [(None if i % 3 else f"p{i % 7}", i) for i in range(300)], "k string, v int"
    )
    right = spark.createDataFrame([(f"p{i}", i) for i in range(5)] + [(None, 9)], "k string, w int")
    joined = joins.left_join_spread(left, right, "k")
    assert rows(joined) == rows(left.join(right, "k", "left"))
    keys = [
        r[0] for r in left.where("k is null").select(F.pmod(F.xxhash64("v"), F.lit(4096))).collect()
    ]
    assert len(set(keys)) > 100


def test_markov_counts_repeated_snapshots(spark):
    rng = random.Random(3)
    data = [
        (rng.randrange(4), dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(30)), rng.randrange(2), 1.0)
        for _ in range(400)
    ]
    df = spark.createDataFrame(
        data, "product_id bigint, snapshot_date date, stockout_flag int, fill_rate double"
    )
    expected = {"hh": 0, "hr": 0, "rh": 0, "rr": 0}
    ordered = sorted((p, d, "r" if s else "h") for p, d, s, _ in data)
    for a, b in zip(ordered, ordered[1:]):
        if a[0] == b[0]:
            expected[a[2] + b[2]] += 1
    got = risk.transition_counts(df).first().asDict()
    assert {k: got[k] for k in expected} == expected


@pytest.mark.parametrize("slices", [1, 4])
def test_as_of_join_brute_force(spark, slices):
    rng = random.Random(5)
    start = dt.datetime(2000, 1, 1)

    def moment():
        return start + dt.timedelta(hours=rng.randrange(0, 24 * 60, 6))

    features = [
        (rng.randrange(3), moment(), start + dt.timedelta(seconds=i), float(i)) for i in range(120)
    ]
    probes = [(i, rng.randrange(4), moment()) for i in range(200)]
    f = spark.createDataFrame(
        features, "e bigint, ts timestamp_ntz, made timestamp_ntz, v double"
    )
    p = spark.createDataFrame(probes, "id bigint, e bigint, at timestamp_ntz")
    ttl = 10
    got = {
        r["id"]: (r["ts"], r["v"])
        for r in joins.as_of_join(p, f, "e", "at", "ts", "made", ["v"], ttl, slices).collect()
    }
    assert len(got) == len(probes)
    for i, e, at in probes:
        valid = [
            (ts, made, v)
            for fe, ts, made, v in features
            if fe == e and at - dt.timedelta(days=ttl) <= ts <= at
        ]
        best = max(valid, default=None)
        assert got[i] == ((best[0], best[2]) if best else (None, None))


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython")


@pytest.mark.parametrize(
    "name",
    [
        "fct_sales_orders",
        "fct_order_fulfillment",
        "fct_logistics_delivery_performance",
        "rpt_daily_category_sales_performance",
        "rpt_daily_executive_kpi",
        "demand_features",
        "inventory_markov",
        "demand_scenarios",
        "scenario_bom_explosion",
        "production_schedule",
    ],
)
def test_plans_have_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = QUERIES["stg_shipments"](spark, sf_dir).where("order_id > 10").select("order_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
    assert "GreaterThan(o_orderkey,10)" in plan


def test_bucketed_facts_join_without_an_exchange(spark, sf_dir, no_broadcast):
    plan = QUERIES["fct_order_fulfillment_bucketed"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan


def test_a_run_reads_its_own_partitions(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), environment="t_pruned")
    days = [(k % 3, dt.date(2000, 1, 1) + dt.timedelta(9 * k), 1 + k % 5) for k in range(90)]
    orders = spark.createDataFrame(
        [(k, d, "delivered", d.replace(day=1)) for k, (_, d, _) in enumerate(days)],
        "order_id long, order_date date, order_status string, month date",
    )
    items = spark.createDataFrame(
        [(k, p, q, 2.0, 0.0, None) for k, (p, _, q) in enumerate(days)],
        "order_id long, product_id long, quantity int, unit_price double, discount_amount double, promo_id string",
    )
    others = [
        spark.createDataFrame([(0, 3.0, 1.0)], "product_id long, price double, cogs double"),
        spark.createDataFrame([], "traffic_date date, page_views int"),
        spark.createDataFrame([], "product_id long, snapshot_date date, stockout_flag int"),
    ]
    orders = lake.publish(orders, "landing", "orders", partition_by=("month",))
    whole = demand_features(items, orders, *others)
    create_demand_features(lake, "2000-06-01", items, orders, *others)
    ends = ["2000-06-01", "2001-01-01", "2002-01-01", "2003-01-01"]
    for since, until in zip(ends, ends[1:]):
        advance_demand_features(lake, since, until, items, orders, *others)
    assert rows(read_demand_features(lake)) == rows(whole)
    # the last run again, and one that does not fit to any before it
    advance_demand_features(lake, *ends[-2:], items, orders, *others)
    assert rows(read_demand_features(lake)) == rows(whole)
    with pytest.raises(ValueError):
        advance_demand_features(lake, "2001-05-01", "2001-06-01", items, orders, *others)

    def pruned(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("PartitionFilters: [")[1].split("]")[0]

    assert "state_month" in pruned(feature_store.carried_days(lake, "2001-01-01"))
    assert "month" in pruned(feature_store._within(orders, "2001-01-01", "2001-02-01"))
    # another branch replaces partitions in its own folder
    dev = lake.create_branch("dev")
    dev.replace_partitions(dev.read("features", "demand_history").limit(1), "features", "demand_history", "state_month")
    assert lake.read("features", "demand_history").count() > dev.read("features", "demand_history").count()


def test_advanced_runs_shuffle_neither_items_nor_other_months(spark, sf_dir, no_broadcast, monkeypatch):
    plans, months = [], []

    def spied(items, orders, products, traffic, inventory):
        sold = delivered_items(items, orders, "quantity")
        plans.append(sold._jdf.queryExecution().executedPlan().toString())
        months.append({d.strftime("%Y-%m") for (d,) in inventory.select("snapshot_date").distinct().collect()})
        return demand_days(items, orders, products, traffic, inventory)

    monkeypatch.setattr(feature_store, "demand_days", spied)
    QUERIES["demand_features_advanced"](spark, sf_dir)
    # only the orders of a run go to the items' buckets, and no month of the stock is read twice
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 1, 1]
    assert all(months) and len(set.union(*months)) == sum(map(len, months))


def test_stock_that_is_there_is_not_added_up(spark, sf_dir):
    """Months with stock drop out where orders meet items, before the stock is grouped."""
    optimized = QUERIES["demand_features"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins_on_order = [x for x in optimized.splitlines() if "Join Inner" in x and "l_orderkey" in x]
    assert any("% 9" in x for x in joins_on_order), joins_on_order


def test_sale_days_do_not_move_for_their_flags(spark, sf_dir, no_broadcast):
    plan = QUERIES["demand_features"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    by_month = [x for x in plan.splitlines() if "Exchange hashpartitioning(product_id" in x and "add_months" in x or "hashpartitioning" in x and "_month#" in x]
    assert len(by_month) <= 1, by_month  # the flags' own grouping only
