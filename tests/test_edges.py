"""One small frame per rule that a rewrite could silently change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockweave.operators import changes, quality
from stockweave.operators.joins import literal_date
from stockweave.plans import features, forecast, marts, planning, risk, segmentation, staging

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_missing_rating_is_a_detractor(spark):
    reviews = spark.createDataFrame(
        [("a", 1, None), ("b", 1, 3), ("c", 2, 4)], "review_id string, order_id bigint, rating int"
    )
    reviews = reviews.selectExpr(
        "*",
        "1L as product_id",
        "1L as customer_id",
        "date'2000-01-09' as review_date",
        "'' as review_title",
    )
    orders = spark.sql("select 1L as order_id, date'2000-01-01' as order_date, 'x' as order_source")
    out = marts.fct_customer_reviews(reviews, orders)
    assert rows(out.select("review_id", "csat_sentiment_category", "days_to_review")) == [
        ("a", "Negative_Detractor", 8),
        ("b", "Neutral", 8),
        ("c", "Positive", None),
    ]


def test_zero_price_has_no_margin_pct(spark):
    df = spark.sql(
        "select 1L as product_id, 'n' as product_name, 'c' as category, 's' as segment, "
        "'1' as size, 'r' as color, 0D as price, 2D as cogs"
    )
    row = marts.dim_products(df).first()
    assert row["gross_margin"] == -2.0 and row["gross_margin_pct"] is None


def inventory(spark, **values):
    base = {
        "snapshot_date": "date'2000-01-31'",
        "product_id": "1L",
        "stock_on_hand": "10",
        "units_received": "0",
        "units_sold": "25",
        "stockout_days": "0",
        "days_of_supply": "30D",
        "fill_rate": "1D",
        "stockout_flag": "0",
        "overstock_flag": "0",
        "reorder_flag": "0",
        "sell_through_rate": "0.5D",
        "product_name": "cast(null as string)",
        "category": "cast(null as string)",
        "segment": "cast(null as string)",
        "year": "2000",
        "month": "1",
    } | values
    return spark.sql("select " + ", ".join(f"{v} as {k}" for k, v in base.items()))


@pytest.fixture
def products(spark):
    return spark.sql(
        "select 1L as product_id, 'n' as product_name, 'c' as category, 's' as segment, "
        "10D as price, 4D as cogs"
    )


def test_lost_revenue(spark, products):
    def lost(days):
        df = marts.fct_monthly_inventory_kpi(inventory(spark, stockout_days=str(days)), products)
        return df.first()["estimated_lost_revenue_due_to_stockout"]

    assert lost(0) == 0.0
    assert lost(30) is None
    assert lost(5) == 50.0


@pytest.mark.parametrize(
    "values, status, qty",
    [
        # 25 * 1.5 - 10 = 27.5, rounded half up.
        ({"reorder_flag": "1"}, "REORDER_IMMEDIATELY", 28),
        ({"stockout_flag": "1", "stock_on_hand": "99"}, "CRITICAL_STOCKOUT_RISK", 0),
        ({"stockout_flag": "1", "stock_on_hand": "cast(null as int)"}, "CRITICAL_STOCKOUT_RISK", None),
        ({"days_of_supply": "9.5D"}, "CRITICAL_STOCKOUT_RISK", 0),
        ({"days_of_supply": "20D"}, "REORDER_IMMEDIATELY", 0),
        ({"overstock_flag": "1"}, "EXCESS_OVERSTOCK", 0),
        ({}, "HEALTHY_BUFFER", 0),
    ],
)
def test_replenishment(spark, products, values, status, qty):
    row = marts.fct_supplier_replenishment_alert(inventory(spark, **values), products).first()
    assert row["supply_chain_action_status"] == status
    assert row["recommended_reorder_qty"] == qty


def test_discount_rules(spark):
    items = spark.createDataFrame(
        [
            (1, "P", 1.0),
            (2, "F", 1.0),
            (3, "unknown", 7.0),
            (4, None, None),
        ],
        "order_id bigint, promo_id string, discount_amount double",
    ).selectExpr("*", "1L as product_id", "2 as quantity", "50D as unit_price", "'' as promo_id_2")
    promos = spark.createDataFrame(
        [("P", "percentage", 10.0), ("F", "fixed", 5.0)],
        "promo_id string, promo_type string, discount_value double",
    )
    out = marts.int_order_items_discounted(items, promos)
    assert rows(out.select("order_id", "calculated_discount_amount", "net_line_total")) == [
        (1, 10.0, 90.0),
        (2, 10.0, 90.0),
        (3, 7.0, 93.0),
        (4, 0.0, 100.0),
    ]


def test_staging_rules(spark):
    raw = spark.createDataFrame(
        [("1", " 2 ", " ", "x "), (None, "2", "a", "b")],
        "order_id string, product_id string, promo_id string, promo_id_2 string",
    ).selectExpr("*", "'3' as quantity", "'1.5' as unit_price", "null as discount_amount")
    assert rows(staging.stage(raw, "order_items")) == [(1, 2, 3, 1.5, None, None, "x")]


# --- segmentation ------------------------------------------------------------


def sales(spark, lines):
    """(product, month, quantity, price) as delivered items and their orders."""
    items = spark.createDataFrame(
        [(i, p, q, float(price)) for i, (p, _, q, price) in enumerate(lines)],
        "order_id bigint, product_id bigint, quantity int, unit_price double",
    ).selectExpr("*", "cast(null as double) as discount_amount")
    orders = spark.createDataFrame(
        [(i, D(2000, m, 5), "delivered") for i, (_, m, _, _) in enumerate(lines)],
        "order_id bigint, order_date date, order_status string",
    )
    names = spark.sql("select 1L as product_id, 'n' as product_name, 'c' as category")
    return items, orders, names


def test_abc_boundaries_ties_and_single_month(spark):
    lines = [(1, 1, 10, 7.0), (1, 2, 10, 0.9)]  # 79 of 100 -> A
    lines += [(2, 1, 1, 15.0)]  # reaches 94 -> B, crosses 80
    lines += [(3, 1, 1, 3.0), (4, 1, 1, 3.0)]  # equal revenue: lower id first
    items, orders, names = sales(spark, lines)
    out = segmentation.abc_xyz(segmentation.monthly_sales(items, orders), names)
    got = rows(out.select("product_id", "abc_class", "xyz_class", "cv"))
    assert got == [(1, "A", "X", 0.0), (2, "B", "Z", 2.0), (3, "C", "Z", 2.0), (4, "C", "Z", 2.0)]
    cumulated = rows(out.select("product_id", "cum_rev_pct"))
    assert cumulated == [(1, 79.0), (2, 94.0), (3, 97.0), (4, 100.0)]


# --- risk ----------------------------------------------------------------------


def snapshots(spark, data):
    return spark.createDataFrame(
        data, "product_id bigint, snapshot_date date, stockout_flag int, fill_rate double"
    )


def matrix(df):
    return {(r["from_state"], r["to_state"]): r["p"] for r in df.collect()}


def test_markov_without_history(spark):
    assert matrix(risk.inventory_markov(snapshots(spark, []))) == risk.THEORETICAL


def test_markov_only_healthy(spark):
    data = [(1, D(2000, 1, 1), 0, 1.0), (1, D(2000, 2, 1), 0, 0.95)]
    got = matrix(risk.inventory_markov(snapshots(spark, data)))
    assert got == {
        (risk.HEALTHY, risk.HEALTHY): 1.0,
        (risk.HEALTHY, risk.AT_RISK): 0.0,
        (risk.AT_RISK, risk.HEALTHY): 0.0,
        (risk.AT_RISK, risk.AT_RISK): 1.0,
    }


def test_missing_fill_rate_is_at_risk(spark):
    data = [(1, D(2000, 1, 1), 0, None), (1, D(2000, 2, 1), 0, 1.0)]
    got = matrix(risk.inventory_markov(snapshots(spark, data)))
    assert got[(risk.AT_RISK, risk.HEALTHY)] == 1.0


def test_risk_defaults(spark):
    skus = spark.sql("select 1L as product_id, 'none' as supplier_id")
    empty_inventory = risk.inventory_markov(snapshots(spark, [])).where("false")
    suppliers = risk.supplier_markov(
        spark.sql("select ' S1 ' as supplier_id, cast(null as double) as reliability_score")
    )
    assert matrix(suppliers)[("OnTime", "OnTime")] == 0.9
    row = risk.risk_lookup(skus, empty_inventory, suppliers).first()
    assert (row["p_inv_risk"], row["p_sup_delay"]) == (0.15, 0.10)


def outlook(spark):
    return spark.sql(
        "select 5L as product_id, 10D as P10, 20D as P50, 40D as P90, "
        "0.1D as p_sup_delay, 0.25D as p_inv_risk"
    )


def test_scenarios(spark):
    got = risk.demand_scenarios(outlook(spark)).collect()
    assert [r["scenario_id"] for r in got] == [f"SCN_5_{i}" for i in range(1, 13)]
    assert [(r["supplier_state"], r["inv_state"]) for r in got[:4]] == [
        ("OnTime", "Healthy"),
        ("Delayed", "Healthy"),
        ("OnTime", "AtRisk"),
        ("Delayed", "AtRisk"),
    ]
    assert sum(r["probability"] for r in got) == pytest.approx(1.0)
    check = quality.mass_check(risk.demand_scenarios(outlook(spark)), "product_id").first()
    assert check["is_valid"] == 1


def test_expected_needs_equal_the_sum_over_scenarios(spark):
    bom = spark.createDataFrame(
        [(5, "RM1", 2.0), (5, "RM2", 1.0)], "product_id bigint, rm_id string, quantity_required double"
    )
    materials = spark.createDataFrame([("RM1", 3.0)], "rm_id string, current_stock double")
    long = planning.scenario_bom_explosion(outlook(spark), bom).collect()
    got = {
        r["rm_id"]: r
        for r in planning.expected_requirements(outlook(spark), bom, materials, 0.1).collect()
    }
    for rm, stock in (("RM1", 3.0), ("RM2", 800.0)):
        part = [r for r in long if r["rm_id"] == rm]
        gross = sum(r["probability"] * r["gross_req"] for r in part)
        late = sum(r["probability"] for r in part if r["supplier_state"] == "Delayed")
        assert got[rm]["expected_net_req"] == pytest.approx(max(0.0, gross * 1.1 - stock), abs=1e-5)
        assert got[rm]["p_delay"] == pytest.approx(late)
        assert got[rm]["n_scenarios"] == len(part) == 12


# --- procurement -----------------------------------------------------------------


QUOTES = (
    "scenario_id string, scenario_name string, supplier_id string, rm_id string, "
    "unit_price double, lead_time_days int, min_qty double, discount_pct double"
)


def test_cheapest_quote(spark):
    needs = spark.createDataFrame(
        [("A", 100.0), ("B", 10.0), ("C", 0.0), ("D", 10.0)], "rm_id string, net_req double"
    )
    quotes = spark.createDataFrame(
        [
            ("q1", "spot", "S1", "A", 2.0, 3, 0.0, 0.0),
            ("q2", "bulk", "S2", "A", 2.0, 3, 0.0, 0.0),  # tie: the earlier quote wins
            ("q3", "slow", "S3", "A", 1.0, 9, 0.0, 0.0),  # too slow
            ("q4", "bulk", "S4", "D", 1.0, 3, 50.0, 5.0),  # discount demands the minimum: 50
            ("q5", "spot", "S5", "D", 4.0, 3, 50.0, 0.0),  # no discount: the need suffices: 40
        ],
        QUOTES,
    )
    got = rows(
        planning.procurement_cheapest(needs, quotes, 7).select(
            "rm_id", "scenario_id", "order_qty", "total_cost", "lead_time_days"
        )
    )
    assert got == [
        ("A", "q1", 100.0, 200.0, 3),
        ("B", "DEFAULT", 10.0, 50.0, 3),
        ("D", "q5", 10.0, 40.0, 3),
    ]


def test_expected_cost_choice(spark):
    needs = spark.createDataFrame(
        [("A", 100.0, 0.2, 12), ("B", 100.0, 0.1, 12), ("C", 100.0, 0.2, 12), ("D", 0.0, 0.2, 12)],
        "rm_id string, expected_net_req double, p_delay double, n_scenarios bigint",
    )
    quotes = spark.createDataFrame(
        [
            ("q1", "slow", "S1", "A", 1.0, 5, 0.0, 0.0),  # 100 + 100 * 2.5 * 0.2 = 150
            ("q2", "fast", "S2", "A", 1.4, 4, 0.0, 0.0),  # 140
            ("q3", "bulk", "S3", "B", 1.0, 9, 200.0, 10.0),  # 200 * 0.9 * 0.95 = 171
        ],
        QUOTES,
    )
    plan = planning.procurement_expected_cost(needs, quotes)
    got = rows(plan.select("rm_id", "selected_supplier", "order_qty", "expected_total_cost", "risk_penalty_cost"))
    assert got == [("A", "S2", 100.0, 140.0, 0.0), ("B", "S3", 200.0, 180.0, -9.0)]
    assert rows(planning.procurement_budget(plan)) == [(2, 311.0, 9.0)]


def test_net_requirements(spark):
    demand = spark.createDataFrame([(1, 100.0), (9, 5.0)], "product_id bigint, qty double")
    bom = spark.createDataFrame(
        [(1, " RM1", 10.0), (1, "RM2", 1.0)],
        "product_id bigint, rm_id string, quantity_required double",
    )
    materials = spark.createDataFrame([("RM1",), ("RM1",)], "rm_id string")
    assert rows(planning.net_requirements(demand, bom, materials, 0.1)) == [
        ("RM1", 1000.0, 800.0, 100.0, 300.0),
        ("RM2", 100.0, 0.0, 10.0, 110.0),
    ]


# --- schedule ----------------------------------------------------------------------


# Demand 25, 10 and 4.5 at 10 a batch on lines A to C, shifts S1 and S2, by locked lines.
SCHEDULES = {
    (): [
        (7, "A", "S1", 10.0),
        (7, "B", "S2", 10.0),
        (7, "C", "S1", 5.0),
        (3, "A", "S2", 10.0),
        (1, "B", "S1", 4.5),
    ],
    ("B",): [
        (7, "A", "S1", 10.0),
        (7, "C", "S1", 10.0),
        (7, "A", "S2", 5.0),
        (3, "C", "S2", 10.0),
        (1, "A", "S1", 4.5),
    ],
    ("A", "C"): [
        (7, "B", "S2", 10.0),
        (7, "B", "S1", 10.0),
        (7, "B", "S2", 5.0),
        (3, "B", "S1", 10.0),
        (1, "B", "S2", 4.5),
    ],
}


@pytest.mark.parametrize("locked", sorted(SCHEDULES))
def test_schedule(spark, monkeypatch, locked):
    monkeypatch.setattr(planning, "BATCH_BLOCK", 2)
    df = spark.createDataFrame(
        [(7, 25.0, 0), (3, 10.0, 1), (1, 4.5, 2)], "product_id bigint, qty double, seq bigint"
    )
    lockouts = spark.createDataFrame(
        [(x, D(2024, 1, 5)) for x in locked] + [("C", D(2024, 1, 6))],
        "line_name string, lockout_date date",
    )
    out = planning.production_schedule(
        df, lockouts, "2024-01-05", ["A", "B", "C"], ["S1", "S2"], 10.0
    )
    got = rows(out.select("batch_no", "product_id", "assigned_line", "shift_name", "scheduled_qty"))
    assert [r[1:] for r in got] == SCHEDULES[locked]
    assert [r[0] for r in got] == list(range(got[0][0], got[0][0] + len(got)))


def test_all_lines_locked(spark):
    df = spark.createDataFrame([(1, 25.0, 0)], "product_id bigint, qty double, seq bigint")
    lockouts = spark.createDataFrame(
        [("A", D(2024, 1, 5))], "line_name string, lockout_date date"
    )
    out = planning.production_schedule(df, lockouts, "2024-01-05", ["A"], ["S1"], 10.0).collect()
    assert len(out) == 1 and out[0]["assigned_line"] is None and out[0]["scheduled_qty"] == 25.0
    with pytest.raises(ValueError):
        planning.production_schedule(df, lockouts, "2024-01-05", ["A"], ["S1"], 0.0)


# --- changes -----------------------------------------------------------------------


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = changes.upsert(target, source, "k")
    assert rows(once, "k") == [(None, "n"), (1, "a"), (2, "B"), (3, "C")]
    assert rows(changes.upsert(once, source, "k"), "k") == rows(once, "k")


def test_upsert_rejects_repeated_source_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="more than one source row"):
        changes.upsert(target, source, "k").collect()


def test_null_source_keys_are_refused(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(None, "x"), (2, "y")], "k int, v string")
    with pytest.raises(ValueError, match="without k"):
        changes.upsert(target, source, "k")
    with pytest.raises(ValueError, match="without k"):
        changes.scd2_apply(changes.scd2_empty(source), source, "k", ["v"], "2000-01-01 00:00:00")


def test_high_water_mark_ignores_late_old_rows(spark):
    target = spark.createDataFrame([(1, D(2000, 1, 1)), (2, D(2000, 1, 5))], "k int, d date")
    source = spark.createDataFrame(
        [(1, D(2000, 1, 1)), (2, D(2000, 1, 5)), (3, D(2000, 1, 6))], "k int, d date"
    )
    assert [r[0] for r in rows(changes.since_mark(source, target, "d"))] == [2, 3]
    assert [r[0] for r in rows(changes.since_mark(source, target, "d", 10))] == [1, 2, 3]
    assert changes.since_mark(source, target.where("false"), "d").count() == 3


def test_scd2(spark):
    def load(history, data, ts):
        source = spark.createDataFrame(data, "k int, price double, note string")
        return changes.scd2_apply(history, source, "k", ["price"], ts)

    empty = changes.scd2_empty(spark.createDataFrame([], "k int, price double, note string"))
    h1 = load(empty, [(1, 1.0, "x"), (2, None, "x"), (3, 3.0, "x")], "2000-01-01 00:00:00")
    h2 = load(h1, [(1, 1.0, "unchecked"), (2, 2.0, "x"), (4, 4.0, "x")], "2000-02-01 00:00:00")
    h3 = load(h2, [(1, 1.0, "x"), (2, 2.0, "x"), (4, 4.0, "x")], "2000-03-01 00:00:00")
    got = rows(h2.selectExpr("k", "price", "month(valid_from)", "month(valid_to)"))
    assert got == [
        (1, 1.0, 1, None),
        (2, None, 1, 2),
        (2, 2.0, 2, None),
        (3, 3.0, 1, None),
        (4, 4.0, 2, None),
    ]
    assert rows(h3) == rows(h2)
    assert h3.where("valid_to is null").groupBy("k").count().where("count > 1").count() == 0
    assert h3.select("scd_id").distinct().count() == h3.count()


# --- data tests ---------------------------------------------------------------------


def test_orphans_count_null_keys_and_null_checks(spark):
    main = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    helper = spark.createDataFrame([(1, "x"), (1, None), (3, "y")], "k int, c string")
    assert quality.orphan_count(main, "k", helper).first()[0] == 2
    joined = main.join(helper, "k", "left").where("c is null").count()
    assert quality.orphan_count(main, "k", helper, check_column="c").first()[0] == joined == 4
    filtered = quality.orphan_count(main, "k", helper, where=F.col("k") == 2)
    assert filtered.first()[0] == 1


def test_stale_since(spark):
    as_of = literal_date("2000-06-15")
    old = spark.createDataFrame([(D(2000, 6, 1),)], "d date")
    assert rows(quality.stale_since(old, "d", as_of, lookback_days=10)) == [
        (D(2000, 6, 1), "MAX_UPDATE_TOO_OLD", 14)
    ]
    # Without lookback_days the filter and the cutoff are one date: never fires.
    assert quality.stale_since(old, "d", as_of).count() == 0
    ancient = spark.createDataFrame([(D(1999, 1, 1),)], "d date")
    assert quality.stale_since(ancient, "d", as_of, lookback_days=10).count() == 0


# --- features and forecasts -----------------------------------------------------------


def test_oee_defaults(spark):
    logs = spark.sql(
        "select date'2024-01-01' as DATE, 'E1' as EQUIPMENT_ID, 10D as RUN_TIME, "
        "0D as PRODUCTION_AVAILABLE_TIME"
    )
    row = features.oee_features(logs).first()
    assert (row["avg_oee_last_14d"], row["avg_changeover_duration_min"]) == (75.0, 30.0)
    assert row["scrap_reject_rate_pct"] == 2.0 and row["mtbf_hours"] == 168.0


def test_accuracy(spark):
    df = spark.createDataFrame([(10.0, 8.0), (5.0, 6.0)], "y double, p double")
    row = forecast.accuracy(df, "y", "p").first()
    assert (row["mape_pct"], row["rmse"]) == (20.0, 1.58)


def test_split_is_by_key(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = forecast.train_test(df, "k")
    again = forecast.train_test(df.repartition(7), "k")[1]
    assert train.count() + test.count() == 2000
    assert 300 < test.count() < 500
    assert rows(test) == rows(again)
