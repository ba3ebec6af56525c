"""The registered queries: name -> function (spark, sf_dir) -> DataFrame.

Every query plans from the given tables in ``sf_dir`` through the landing
adapters and the models, over their whole content.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.exprs import exact_sum
from stockweave.operators import changes, quality
from stockweave.operators.joins import literal_date
from stockweave.plans import features, forecast, marts, planning, risk, segmentation, staging
from stockweave.plans.registry import LAYERS, MODELS, Models, run_layer
from stockweave.sources.ingest import LANDING, ingest, ingest_checked
from stockweave.sources.ingest import main as landing_job
from stockweave.session import at_once, materialize, prepare, run_folder, size_shuffles, sized_buckets
from stockweave.sources.landing import GIVEN, given_table, landing_table
from stockweave.sources.buckets import store_bucketed
from stockweave.sources.chain import SNAPSHOT_LAYER, SNAPSHOTS, run_chain
from stockweave.sources.facts import LAYER as FACT_LAYER
from stockweave.sources.facts import MONTH, advance_tracked_fact, create_tracked_fact
from stockweave.sources.feature_store import (
    advance_demand_features,
    create_demand_features,
    read_demand_features,
)
from stockweave.sources.publish import Lakehouse
from stockweave.sources.readers import read_csv
from stockweave.sources.tables import DAILY_LOAD, TABLES
from stockweave.streaming.funnel import LAYER as FUNNEL_LAYER
from stockweave.streaming.funnel import current_counts, daily_counts, funnel_stream
from stockweave.streaming.upsert import upsert_stream
from stockweave.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01"
PLAN_DAY = "2024-01-05"
LOAD_ENDS = ("2024-01-11", "2024-01-21")
# Where the runs that advance the demand features end.
FEATURE_RUNS = ("1998-01-01", "2000-03-01", "2002-01-01")
FIRST_LOAD_UNTIL = "1998-12-31"
RUNS = ("2001-06-01 00:00:00", "2001-07-01 00:00:00", "2001-08-01 00:00:00")
SETTINGS = planning.PlanSettings(
    safety_stock_pct=0.10,
    max_lead_days=7,
    lines=("LINE0", "LINE1", "LINE2", "LINE3", "LINE4", "LINE5"),
    shifts=("S1", "S2", "S3"),
    rate_per_shift=500.0,
)

# The data tests declared on sources and marts.
DATA_TESTS = (
    quality.DataTest("products", "unique", "product_id"),
    quality.DataTest("products", "not_null", "product_id"),
    quality.DataTest("customers", "unique", "customer_id"),
    quality.DataTest("customers", "not_null", "customer_id"),
    quality.DataTest(
        "orders", "monthly_duplicates", "order_id", date_field="order_date", lookback_months=6
    ),
    quality.DataTest("orders", "unique", "order_id"),
    quality.DataTest("orders", "not_null", "order_id"),
    quality.DataTest("order_items", "orphans", "order_id", helper="orders"),
    quality.DataTest("order_items", "not_null", "order_id"),
    quality.DataTest("dim_customers", "unique", "customer_id"),
    quality.DataTest("dim_customers", "not_null", "customer_id"),
    quality.DataTest("dim_products", "unique", "product_id"),
    quality.DataTest("dim_products", "not_null", "product_id"),
    quality.DataTest("fct_sales_orders", "orphans", "customer_id", helper="dim_customers"),
    quality.DataTest(
        "fct_sales_orders",
        "monthly_duplicates",
        "order_id",
        date_field="order_date",
        lookback_months=6,
    ),
    quality.DataTest("fct_sales_orders", "unique", "order_id"),
    quality.DataTest("fct_sales_orders", "not_null", "order_id"),
    quality.DataTest("fct_sales_orders", "not_null", "customer_id"),
    quality.DataTest("fct_sales_orders", "not_null", "order_date"),
    quality.DataTest("fct_order_fulfillment", "unique", "order_id"),
    quality.DataTest("fct_order_fulfillment", "not_null", "order_id"),
)
# Beyond those, tests the given data does not pass, so the report has findings.
EXTRA_TESTS = (
    quality.DataTest("order_items", "unique", "order_id"),
    quality.DataTest("stg_customers", "not_null", "city", severity="error"),
    quality.DataTest("stg_customers", "orphans", "zip", severity="error", helper="stg_geography"),
    quality.DataTest("stg_order_items", "not_null", "promo_id"),
    quality.DataTest("stg_order_items", "orphans", "promo_id", helper="stg_promotions"),
    quality.DataTest(
        "stg_returns",
        "monthly_duplicates",
        "order_id",
        severity="error",
        date_field="return_date",
        lookback_months=6,
    ),
    # A known region outside ASIA for all customers of the other channels, but for two.
    quality.DataTest(
        "stg_customers",
        "orphans",
        "zip",
        helper="stg_geography",
        check_column="region",
        where="acquisition_channel <> 'BUILDING'",
        helper_where="region <> 'ASIA'",
        threshold=2,
    ),
    quality.DataTest("payments", "unique", "order_id"),
    quality.DataTest("shipments", "unique", "order_id"),
    quality.DataTest("stg_orders", "max_update", "order_date", "error", lookback_days=15),
    quality.DataTest("stg_web_traffic", "freshness", "traffic_date", max_age_days=30),
    quality.DataTest("demand_scenarios", "mass", "product_id", "error"),
)

QUERIES: dict[str, Query] = {}


def models_over(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, lambda name: landing_table(spark, sf_dir, name))


def ready(spark: SparkSession, sf_dir: str) -> Models:
    size_shuffles(prepare(spark), [f"{sf_dir}/{name}.parquet" for name in GIVEN])
    return models_over(spark, sf_dir)


def query(fn: Callable[[Models], DataFrame]) -> Callable[[Models], DataFrame]:
    """Register ``fn(models)`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _register_models() -> None:
    for name, declared in MODELS.items():
        if declared.layer == "shared":  # a building block, not a result
            continue

        def run(spark: SparkSession, sf_dir: str, name: str = name) -> DataFrame:
            return ready(spark, sf_dir).ref(name)

        QUERIES[name] = run


_register_models()


# --- manufacturing extracts ------------------------------------------------


@query
def stg_maintenance_orders(m: Models) -> DataFrame:
    raw = m.ref("maintenance_orders").withColumnsRenamed(
        {
            "order_id": "ORDER",
            "start_date": "BASIC_START_DATE",
            "equipment_id": "EQUIPMENT_ID",
            "order_type": "ORDER_TYPE",
            "description": "DESCRIPTION",
        }
    )
    return staging.harmonise_maintenance(raw)


@query
def stg_cross_reference(m: Models) -> DataFrame:
    raw = m.ref("cross_reference").toDF("EQUIPMENT_ID", "OPERA NAME")
    return staging.harmonise_cross_reference(raw)


@query
def size_type_mapping(m: Models) -> DataFrame:
    return staging.size_type_products(m.ref("production_logs"), m.ref("products"), "log_id")


@query
def stg_production_logs(m: Models) -> DataFrame:
    return staging.harmonise_production_logs(m.ref("production_logs"), m.ref("products"), "log_id")


# --- table changes ---------------------------------------------------------


def changed_orders(orders: DataFrame) -> DataFrame:
    """A change batch: open orders ship, returned orders are replaced by new ones."""
    status = F.col("order_status")
    shipped = orders.where(status == "processing").withColumn("order_status", F.lit("shipped"))
    replaced = (
        orders.where(status == "returned")
        .withColumn("order_id", -1 - F.col("order_id"))
        .withColumn("order_status", F.lit("processing"))
    )
    return shipped.unionByName(replaced)


@query
def upsert_orders(m: Models) -> DataFrame:
    orders = m.ref("stg_orders")
    return changes.upsert(orders, changed_orders(orders), "order_id")


def _two_loads(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders as first loaded, and all orders as seen later with a changed device code."""
    first = orders.where(F.col("order_date") <= literal_date(FIRST_LOAD_UNTIL))
    return first, orders.withColumn("device_type", F.upper("device_type")).withColumn(
        "order_status", F.concat("order_status", F.lit("*"))
    )


@query
def incremental_sales_orders(m: Models) -> DataFrame:
    first, later = _two_loads(m.ref("stg_orders"))
    items = m.ref("int_order_items_discounted")
    loaded = materialize(marts.fct_sales_orders(first, items))
    return marts.incremental(loaded, marts.fct_sales_orders, later, items)


@query
def incremental_order_fulfillment(m: Models) -> DataFrame:
    first, later = _two_loads(m.ref("stg_orders"))
    others = [m.ref(f"stg_{t}") for t in ("payments", "shipments", "returns", "reviews")]
    loaded = materialize(marts.fct_order_fulfillment(first, *others))
    return marts.incremental(loaded, marts.fct_order_fulfillment, later, *others)


@query
def incremental_late_orders(m: Models) -> DataFrame:
    """A fact advanced by digests: old orders and items that were edited late are rebuilt.

    Every seventh order gets another status and the items of every eleventh one
    more piece, whatever their date; later orders are new. ``built_in_run`` tells
    which orders the second run has built: those and no others.
    """
    lake = _temporary_lake(m.spark)
    # Digests, tests of keys and both builds meet on the order: in buckets they need no exchange.
    orders, items = [
        store_bucketed(
            m.ref(t), lake.database("landing"), t, "order_id", lake.root, sized_buckets(m.spark)
        )
        for t in ("stg_orders", "int_order_items_discounted")
    ]
    first = orders.where(F.col("order_date") <= literal_date(FIRST_LOAD_UNTIL))
    status = F.when(F.col("order_id") % 7 == 0, F.concat("order_status", F.lit("-late")))
    later = orders.withColumn("order_status", F.coalesce(status, F.col("order_status")))
    more = (F.col("order_id") % 11 == 0).cast("int")
    edited = items.withColumn("quantity", (F.col("quantity") + more).cast(items.schema["quantity"].dataType))

    def build(run: int):
        return lambda *sources: marts.fct_sales_orders(*sources).withColumn("built_in_run", F.lit(run))

    create_tracked_fact(lake, "sales", build(1), first, items.join(first.select("order_id"), "order_id", "left_semi"))
    advance_tracked_fact(lake, "sales", build(2), later, edited)
    m.spark.sql(f"DROP DATABASE {lake.database('landing')} CASCADE")
    return _rows_of(lake, FACT_LAYER, "sales").drop(MONTH, changes.DIGEST)


@query
def fct_order_fulfillment_bucketed(m: Models) -> DataFrame:
    """``fct_order_fulfillment`` from tables bucketed by order: five joins, no exchange."""
    lake = _temporary_lake(m.spark)
    names = ("orders", "payments", "shipments", "returns", "reviews")
    buckets = m.spark.sparkContext.defaultParallelism
    stored = [
        store_bucketed(m.ref(f"stg_{t}"), lake.database("fact"), t, "order_id", lake.root, buckets)
        for t in names
    ]
    fact = marts.fct_order_fulfillment(*stored)
    m.spark.sql(f"DROP DATABASE {lake.database('fact')} CASCADE")
    return fact


@query
def demand_features_advanced(m: Models) -> DataFrame:
    """``demand_features`` built in three runs, each on the state the one before left.

    The orders are stored by month, so a run reads the partitions of its months. The
    items are stored in buckets by order and the months out of stock once, so that a
    run shuffles neither: only the orders of its months go to the buckets.
    """
    lake = _temporary_lake(m.spark)
    orders = m.ref("stg_orders").withColumn("month", F.trunc("order_date", "MM"))
    orders = lake.publish(orders, "landing", "orders", partition_by=("month",))
    sold = m.ref("stg_order_items").select(
        "order_id", "product_id", "quantity", "unit_price", "discount_amount", "promo_id"
    )
    items = store_bucketed(
        sold, lake.database("landing"), "order_items", "order_id", lake.root, sized_buckets(m.spark)
    )
    stock = m.ref("stg_inventory").select("product_id", "snapshot_date", "stockout_flag")
    stock = materialize(stock.where(F.col("stockout_flag") > 0))
    others = [m.ref("stg_products"), m.ref("stg_web_traffic"), stock]
    create_demand_features(lake, FEATURE_RUNS[0], items, orders, *others)
    for since, until in zip(FEATURE_RUNS, FEATURE_RUNS[1:]):
        advance_demand_features(lake, since, until, items, orders, *others)
    rows = read_demand_features(lake)
    for layer in ("landing", "features"):
        m.spark.sql(f"DROP DATABASE {lake.database(layer)} CASCADE")
    return rows


def _three_snapshots(first: DataFrame, second: DataFrame, key: str, check: list[str]) -> DataFrame:
    """First load, changed load, and a rerun of the changed load that must add nothing."""
    history = changes.scd2_apply(changes.scd2_empty(first), first, key, check, RUNS[0])
    history = materialize(changes.scd2_apply(materialize(history), second, key, check, RUNS[1]))
    return changes.scd2_apply(history, second, key, check, RUNS[2])


@query
def scd2_products(m: Models) -> DataFrame:
    products = m.ref("products").drop("supplier_id")
    first = products.where(F.col("segment") != "Brand#25")
    dearer = F.col("category") == "ECONOMY"
    second = products.withColumn(
        "price", F.when(dearer, F.col("price") + 10).otherwise(F.col("price"))
    )
    check = ["product_name", "category", "segment", "price", "cogs"]
    return _three_snapshots(first, second, "product_id", check)


@query
def scd2_customers(m: Models) -> DataFrame:
    customers = m.ref("customers")
    moved = F.coalesce("city", F.when(F.col("gender") == "F", "CityNew"))
    second = customers.withColumn("city", moved).where(
        F.col("acquisition_channel") != "MACHINERY"
    )
    check = ["city", "zip", "age_group", "acquisition_channel"]
    return _three_snapshots(customers, second, "customer_id", check)


# --- data tests --------------------------------------------------------------


@query
def audit_unique(m: Models) -> DataFrame:
    return quality.duplicated_values(m.ref("stg_order_items"), "order_id")


@query
def audit_not_null(m: Models) -> DataFrame:
    return quality.not_null_counts(
        m.ref("stg_order_items"),
        ["order_id", "product_id", "quantity", "discount_amount", "promo_id", "promo_id_2"],
    )


@query
def audit_orphans(m: Models) -> DataFrame:
    """Customers without a region, and items without a known promotion."""
    zips = quality.orphan_count(
        m.ref("stg_customers"), "zip", m.ref("stg_geography"), check_column="region"
    )
    promos = quality.orphan_count(m.ref("stg_order_items"), "promo_id", m.ref("stg_promotions"))
    return zips.select(F.lit("customers.zip").alias("test_name"), "null_count").unionByName(
        promos.select(F.lit("order_items.promo_id").alias("test_name"), "null_count")
    )


@query
def audit_monthly_duplicates(m: Models) -> DataFrame:
    return quality.monthly_duplicates(
        m.ref("stg_returns"), "return_date", "order_id", literal_date(AS_OF), lookback_months=6
    )


@query
def audit_monthly_duplicates_text(m: Models) -> DataFrame:
    text = m.ref("stg_returns").withColumn(
        "return_date", F.concat(F.col("return_date").cast("string"), F.lit(" 08:30:00"))
    )
    return quality.monthly_duplicates(
        text, "return_date", "order_id", literal_date(AS_OF), 6, date_is_string=True
    )


@query
def audit_max_update(m: Models) -> DataFrame:
    return quality.stale_since(
        m.ref("stg_orders"), "order_date", literal_date("2001-09-20"), lookback_days=15
    )


@query
def audit_freshness(m: Models) -> DataFrame:
    return quality.freshness(m.ref("stg_shipments"), "ship_date", literal_date("2001-09-01"), 7, 60)


@query
def audit_results(m: Models) -> DataFrame:
    # Several tests read each fact; as after publishing, they read its columns
    # from the written table.
    for fact in ("fct_sales_orders", "fct_order_fulfillment"):
        m.keep(fact)

    def ref(name: str) -> DataFrame:
        return demand_scenarios(m) if name == "demand_scenarios" else m.ref(name)

    return quality.audit(DATA_TESTS + EXTRA_TESTS, ref, literal_date(AS_OF))


@query
def audit_status_tally(m: Models) -> DataFrame:
    return quality.status_tally(audit_results(m))


@query
def audit_first_findings(m: Models) -> DataFrame:
    return quality.first_per_status(audit_results(m)).select(
        "status", "place", "test_name", "failures"
    )


# --- features ----------------------------------------------------------------


@query
def features_point_in_time(m: Models) -> DataFrame:
    """What was known about a product's demand when an item came back."""
    # Written once: the lookup reads the probes for their times and again for the answer.
    probes = materialize(
        m.ref("stg_returns").select(
            "return_id", "product_id", F.col("return_date").cast("timestamp_ntz").alias("asked_at")
        )
    )
    wanted = ("list_price", "rolling_mean_demand_7d", "rolling_std_demand_7d", "lag_demand_1d")
    return features.DEMAND_VIEW.at(probes, m.ref("demand_features"), "asked_at", wanted)


@query
def oee_point_in_time(m: Models) -> DataFrame:
    """How a line was doing when maintenance was ordered on it."""
    lines = m.ref("cross_reference")
    probes = m.ref("maintenance_orders").join(lines, "equipment_id").select(
        "order_id", "line_name", F.col("start_date").cast("timestamp_ntz").alias("asked_at")
    )
    wanted = ("avg_oee_last_14d", "scrap_reject_rate_pct")
    return features.OEE_VIEW.at(probes, m.ref("oee_features"), "asked_at", wanted, slices=3)


@query
def features_latest(m: Models) -> DataFrame:
    return features.DEMAND_VIEW.latest(m.ref("demand_features"))


@query
def oee_latest(m: Models) -> DataFrame:
    return features.OEE_VIEW.latest(m.ref("oee_features"))


# --- segmentation and risk -----------------------------------------------------


@query
def abc_xyz_histogram(m: Models) -> DataFrame:
    return segmentation.class_histogram(m.ref("abc_xyz"))


@query
def strategic_skus(m: Models) -> DataFrame:
    return segmentation.strategic_skus(m.ref("abc_xyz")).select("product_id", "abc_xyz_matrix")


@query
def top_skus(m: Models) -> DataFrame:
    return segmentation.top_skus(m.ref("abc_xyz"))


@query
def risk_lookup(m: Models) -> DataFrame:
    return risk.risk_lookup(
        m.ref("products").select("product_id", "supplier_id"),
        m.ref("inventory_markov"),
        m.ref("supplier_markov"),
    )


@query
def sku_demand_quantiles(m: Models) -> DataFrame:
    return forecast.sku_quantiles(m.ref("monthly_sales"))


def outlook(m: Models) -> DataFrame:
    """Strategic products with demand quantiles and next-period risks.

    Segments and quantiles read the same monthly sales, so these are written
    once instead of scanning and joining all items twice.
    """
    m.keep("monthly_sales")
    return (
        strategic_skus(m)
        .select("product_id")
        .join(sku_demand_quantiles(m), "product_id")
        .join(risk_lookup(m).select("product_id", "p_sup_delay", "p_inv_risk"), "product_id", "left")
    )


@query
def demand_scenarios(m: Models) -> DataFrame:
    return risk.demand_scenarios(outlook(m))


@query
def scenario_mass_check(m: Models) -> DataFrame:
    return quality.mass_check(demand_scenarios(m), "product_id")


# --- planning ------------------------------------------------------------------


def median_demand(m: Models) -> DataFrame:
    """A month of demand per product, to be planned in product order."""
    return sku_demand_quantiles(m).select(
        "product_id", F.col("P50").alias("qty"), F.col("product_id").alias("seq")
    )


@query
def bom_net_requirements(m: Models) -> DataFrame:
    return planning.net_requirements(
        median_demand(m), m.ref("bom"), m.ref("raw_materials"), SETTINGS.safety_stock_pct
    )


@query
def procurement_cheapest(m: Models) -> DataFrame:
    return planning.procurement_cheapest(
        bom_net_requirements(m), m.ref("procurement_scenarios"), SETTINGS.max_lead_days
    )


@query
def procurement_cheapest_budget(m: Models) -> DataFrame:
    return procurement_cheapest(m).agg(
        F.count("*").alias("n_materials"),
        exact_sum("total_cost").alias("total_budget"),
    )


@query
def scenario_bom_explosion(m: Models) -> DataFrame:
    return planning.scenario_bom_explosion(outlook(m), m.ref("bom"))


@query
def procurement_expected_cost(m: Models) -> DataFrame:
    needs = planning.expected_requirements(
        outlook(m), m.ref("bom"), m.ref("raw_materials"), SETTINGS.safety_stock_pct
    )
    return planning.procurement_expected_cost(needs, m.ref("procurement_scenarios"))


@query
def procurement_budget(m: Models) -> DataFrame:
    return planning.procurement_budget(procurement_expected_cost(m))


@query
def line_lockouts(m: Models) -> DataFrame:
    return planning.line_lockouts(m.ref("maintenance_orders"), m.ref("cross_reference"))


@query
def production_schedule(m: Models) -> DataFrame:
    return planning.production_schedule(
        median_demand(m),
        line_lockouts(m),
        PLAN_DAY,
        SETTINGS.lines,
        SETTINGS.shifts,
        SETTINGS.rate_per_shift,
    )


@query
def full_plan_summary(m: Models) -> DataFrame:
    return planning.full_plan(
        median_demand(m),
        m.ref("bom"),
        m.ref("raw_materials"),
        m.ref("procurement_scenarios"),
        line_lockouts(m),
        PLAN_DAY,
        SETTINGS,
    )["summary"]


# --- forecasts -------------------------------------------------------------------


def _split(m: Models) -> tuple[DataFrame, DataFrame]:
    return forecast.train_test(m.ref("demand_features"), "product_id", "event_timestamp")


@query
def train_test_split(m: Models) -> DataFrame:
    """Rows and demand on either side of the split."""
    bucket = forecast.split_bucket("product_id", "event_timestamp")
    part = F.when(bucket < forecast.TEST_SHARE_OF_TEN, "test").otherwise("train")
    return m.ref("demand_features").groupBy(part.alias("part")).agg(
        F.count("*").alias("n_rows"), F.sum("quantity").alias("total_quantity")
    )


@query
def forecast_accuracy(m: Models) -> DataFrame:
    """Naive forecasts on the held-out fifth: the bar a trained model has to clear."""
    _, test = _split(m)
    return forecast.accuracy(
        forecast.baseline_forecasts(test), "quantity", "prediction", "method"
    )


@query
def best_forecast_run(m: Models) -> DataFrame:
    return forecast.best_run(forecast_accuracy(m), "mape_pct")


@query
def promotion_gate(m: Models) -> DataFrame:
    return forecast.promotion_gate(forecast_accuracy(m))


@query
def latest_model_version(m: Models) -> DataFrame:
    """Per method: versions are sale years, evaluated when their last sale ended."""
    _, test = _split(m)
    scored = forecast.baseline_forecasts(test).withColumn("version", F.year("event_timestamp"))
    ended = F.max("event_timestamp").alias("ended")
    runs = forecast.accuracy(scored, "quantity", "prediction", "method", "version", also=[ended])
    return forecast.latest_version(runs, "method", "version", "ended")


def _stored_split(m: Models) -> tuple[DataFrame, DataFrame]:
    """The split over a written feature table, its hashes too: training passes over it many times."""
    bucket = forecast.split_bucket("product_id", "event_timestamp").cast("int")
    return forecast.by_bucket(materialize(m.ref("demand_features").withColumn("_bucket", bucket)))


@query
def rf_demand_forecast(m: Models) -> DataFrame:
    train, test = _stored_split(m)
    scored = forecast.fit_forest(train).transform(test)
    return scored.select("product_id", "event_timestamp", "quantity", "prediction")


@query
def poisson_lambda(m: Models) -> DataFrame:
    train, test = _stored_split(m)
    scored = forecast.poisson_lambda(forecast.fit_poisson(train), test)
    return scored.select("product_id", "event_timestamp", "quantity", "poisson_lambda")


@query
def quantile_demand_forecast(m: Models) -> DataFrame:
    train, test = _stored_split(m)
    scored = forecast.quantile_forecast(forecast.fit_quantiles(train), test)
    return scored.select("product_id", "event_timestamp", "quantity", "P10", "P50", "P90")


# Figures of the trained models that hold whatever the training finds.


def _checked(scored: DataFrame, values: list[str], wrong: Column) -> DataFrame:
    missing = F.lit(False)
    for v in values:
        missing = missing | F.col(v).isNull() | F.isnan(v)
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(missing).alias("n_missing"),
        F.count_if(wrong).alias("n_wrong"),
    )


@query
def rf_check(m: Models) -> DataFrame:
    """Every held-out row has a forecast of the forest, within the demand it has seen."""
    return _checked(rf_demand_forecast(m), ["prediction"], F.col("prediction") < 0)


@query
def poisson_check(m: Models) -> DataFrame:
    """Every held-out row has a rate of at least the floor."""
    low = F.col("poisson_lambda") < forecast.LAMBDA_FLOOR
    return _checked(poisson_lambda(m), ["poisson_lambda"], low)


@query
def boosted_rate_check(m: Models) -> DataFrame:
    """Every held-out row has a boosted rate of at least the floor."""
    train, test = _stored_split(m)
    scored = forecast.boosted_rate(forecast.fit_log_trees(train), test)
    return _checked(scored, ["boosted_rate"], F.col("boosted_rate") < forecast.LAMBDA_FLOOR)


# How far the share of held-out demand up to a quantile may lie from it, in points.
COVERAGE_POINTS = 3.0


@query
def quantile_check(m: Models) -> DataFrame:
    """Every held-out row has ordered quantiles, none below zero, and the shares are right.

    ``p10_off`` and ``p90_off`` say whether the share of demand up to the quantile
    is further from 10 and 90 % than ``COVERAGE_POINTS``; that takes a few
    thousand rows to tell.
    """
    p10, p50, p90 = F.col("P10"), F.col("P50"), F.col("P90")
    scored = materialize(quantile_demand_forecast(m))
    missing = p10.isNull() | p50.isNull() | p90.isNull() | F.isnan(p50)

    def off(name: str, percent: float) -> Column:
        share = F.count_if(F.col("quantity") <= F.col(name)) * 100.0 / F.count(F.lit(1))
        return (F.abs(share - percent) > COVERAGE_POINTS).cast("int").alias(f"{name.lower()}_off")

    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(missing).alias("n_missing"),
        F.count_if((p10 < 0) | (p10 > p50) | (p50 > p90)).alias("n_wrong"),
        off("P10", 10.0),
        off("P90", 90.0),
    )


@query
def stored_model_check(m: Models) -> DataFrame:
    """Runs of two forests are stored; the best one that may serve is loaded and scores.

    Its forecasts must be those of the forest that was stored. The limit lets
    both serve, so the better one must be the champion.
    """
    root = f"{run_folder(m.spark)}/models-{uuid.uuid4().hex}"
    train, test = _stored_split(m)
    kept = {}
    for version, depth in ((1, 2), (2, 8)):
        fitted = forecast.fit_forest(train, trees=20, depth=depth)
        figures = forecast.accuracy(fitted.transform(test), "quantity", "prediction").first()
        forecast.save_run(m.spark, fitted, root, "demand", version, figures.asDict())
        kept[version] = (figures["mape_pct"], fitted)
    best = min(kept.values(), key=lambda x: x[0])[1]
    served = forecast.champion(m.spark, root, "demand", limit=float("inf"))
    refused = forecast.champion(m.spark, root, "demand", limit=0.0)
    both = best.transform(test).withColumnRenamed("prediction", "_stored").drop("_x")
    wrong = F.col("prediction") != F.col("_stored")
    checked = _checked(served.transform(both), ["prediction"], wrong)
    return checked.withColumn("n_refused", F.lit(int(refused is None)))


# --- loads and stored layers -----------------------------------------------------


@query
def landing_roundtrip(m: Models) -> DataFrame:
    """Orders written as CSV, read back with their declared types and published."""
    lake = _temporary_lake(m.spark)
    spec = TABLES["orders"]
    folder = f"{lake.root}/{spec.name}.csv"
    m.ref("orders").write.csv(
        folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    ingest(lake, spec, lambda s: read_csv(m.spark, folder, s))
    return _rows_of(lake, LANDING, spec.landing_name)


# The file the daily load does not find.
MISSING_FILE = "promotions"


@query
def daily_load(m: Models) -> DataFrame:
    """The landing job over a folder of CSV files, one of them missing.

    One row per table of the load: its rows and the distinct values of its first
    column as landed, NULL for the table whose file is missing.
    """
    lake = _temporary_lake(m.spark)
    folder = f"{lake.root}/csv"
    names = [name for group in DAILY_LOAD.values() for name in group]

    def write(name: str) -> None:
        m.ref(name).write.csv(
            f"{folder}/{name}.csv",
            header=True,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )

    at_once(write, [name for name in names if name != MISSING_FILE])
    landing_job(["--root", lake.root, "--csv-dir", folder, "--environment", lake.environment])
    landed = []
    for name in names:
        spec = TABLES[name]
        table = lake.read(LANDING, spec.landing_name)
        if table is None:
            none = F.lit(None).cast("bigint")
            table = m.spark.range(1).select(none.alias("n_rows"), none.alias("n_values"))
        else:
            first = spec.columns[0]
            table = table.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(first).alias("n_values"))
        landed.append(table.select(F.lit(spec.landing_name).alias("table_name"), "n_rows", "n_values"))
    m.spark.sql(f"DROP DATABASE {lake.database(LANDING)} CASCADE")
    return reduce(DataFrame.unionByName, landed)


CHAIN_LAYERS = LAYERS


@query
def published_chain(m: Models) -> DataFrame:
    """Source tests, snapshots, then all layers written, tested and merged: the rows of each table."""
    lake = _temporary_lake(m.spark)
    names = run_chain(
        lake,
        "run",
        m.ref,
        [t for t in DATA_TESTS if t.table in TABLES],
        [t for t in DATA_TESTS if t.table in MODELS],
        literal_date(AS_OF),
        CHAIN_LAYERS,
    )
    tables = [(SNAPSHOT_LAYER, s.name) for s in SNAPSHOTS] + [(MODELS[name].layer, name) for name in names]
    counts = [
        lake.read(layer, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows"
        )
        for layer, name in tables
    ]
    for layer in (SNAPSHOT_LAYER, *CHAIN_LAYERS):
        m.spark.sql(f"DROP DATABASE {lake.database(layer)} CASCADE")
    return reduce(DataFrame.unionByName, counts)


@query
def landing_rejects(m: Models) -> DataFrame:
    """Orders written as CSV with malformed dates and customers: loaded and rejected lines.

    A rejected line is known by its first value, the order.
    """
    lake = _temporary_lake(m.spark)
    spec = TABLES["orders"]
    folder = f"{lake.root}/{spec.name}.csv"
    order, text = F.col("order_id"), {f.name: F.col(f.name).cast("string") for f in spec.schema}
    text["order_date"] = F.when(order % 50 == 0, F.lit("no date")).otherwise(text["order_date"])
    text["customer_id"] = F.when(order % 70 == 1, F.lit("c-17")).otherwise(text["customer_id"])
    m.ref("orders").select(*[text[f.name].alias(f.name) for f in spec.schema]).write.csv(
        folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    ingest_checked(lake, spec, folder)
    bad = lake.read(LANDING, f"{spec.landing_name}_rejects")
    good = _rows_of(lake, LANDING, spec.landing_name)
    of_line = F.split("line", ",")[0].cast("bigint").alias("order_id")
    none = F.lit(None)
    return good.select("order_id", "order_date", "customer_id", F.lit(0).alias("rejected")).unionByName(
        bad.select(
            of_line,
            none.cast("date").alias("order_date"),
            none.cast(good.schema["customer_id"].dataType).alias("customer_id"),
            F.lit(1).alias("rejected"),
        )
    )


@query
def published_layer(m: Models) -> DataFrame:
    """Customers by layer on a branch, tested before publishing, then merged into main."""
    lake = _temporary_lake(m.spark)
    lake.publish(m.ref("dim_customers").limit(0), "dim", "dim_customers")
    dev = lake.create_branch("dev")
    stored = Models(m.spark, m.ref, lambda name: dev.read(MODELS[name].layer, name))
    key = quality.DataTest("dim_customers", "unique", "customer_id", severity="error")
    # Taken while a table is written; only the unique test needs a pass of its own.
    observed = [
        quality.DataTest("stg_customers", "not_null", "customer_id", severity="error"),
        quality.DataTest("stg_geography", "not_null", "zip", severity="error"),
        quality.DataTest("dim_customers", "range", "customer_tenure_days", least=0),
        quality.DataTest("dim_customers", "freshness", "signup_date", max_age_days=3650),
    ]

    def write(name: str, df: DataFrame) -> None:
        def audit(written: DataFrame) -> DataFrame:
            return quality.audit([key], lambda _: written, literal_date(AS_OF))

        tests = [t for t in observed if t.table == name]
        dev.publish(
            df,
            MODELS[name].layer,
            name,
            audit if name == key.table else None,
            tests=tests,
            as_of=literal_date(AS_OF),
        )

    run_layer(stored, "staging", write, ["stg_customers", "stg_geography"])
    run_layer(stored, "dim", write, ["dim_customers"])
    lake.merge_branch("dev")
    lake.drop_branch("dev")
    m.spark.sql(f"DROP DATABASE {lake.database('staging')} CASCADE")
    return _rows_of(lake, "dim", "dim_customers")


@query
def features_stored_point_in_time(m: Models) -> DataFrame:
    """``features_point_in_time`` from a feature table published by month."""
    lake = _temporary_lake(m.spark)
    by_month = m.ref("demand_features").withColumn("month", F.trunc("event_timestamp", "MM"))
    lake.publish(by_month, "features", "demand_features", partition_by=("month",))
    table = _rows_of(lake, "features", "demand_features").drop("month")
    stored = {"demand_features": table}
    return features_point_in_time(
        Models(m.spark, m.ref, lambda name: stored.get(name))
    )


# --- streams ---------------------------------------------------------------------


def _temporary_lake(spark: SparkSession) -> Lakehouse:
    """A lakehouse of its own for one query, below the run's folder."""
    name = uuid.uuid4().hex
    return Lakehouse(spark, f"{run_folder(spark)}/lake-{name}", environment=f"q{name}")


def _rows_of(lake: Lakehouse, layer: str, table: str) -> DataFrame:
    """The published rows, read from their folders; the catalog entries go."""
    rows = lake.read(layer, table)
    lake.spark.sql(f"DROP DATABASE {lake.database(layer)} CASCADE")
    return rows


@query
def upsert_orders_partitioned(m: Models) -> DataFrame:
    """The change batch of ``upsert_orders`` merged into orders stored by month.

    Orders without a month, and orders that move to another month, are among
    them; the rows must still be those of ``upsert_orders``.
    """
    lake = _temporary_lake(m.spark)
    month = F.when(F.col("order_status") != "cancelled", F.trunc("order_date", "MM"))
    orders = m.ref("stg_orders")
    lake.publish(orders.withColumn("month", month), "landing", "orders", partition_by=("month",))
    batch = changed_orders(orders).withColumn("month", F.add_months(month, 1))
    lake.upsert_partitions(batch, "landing", "orders", "order_id", "month")
    return _rows_of(lake, "landing", "orders").drop("month")


@query
def stream_upsert(m: Models) -> DataFrame:
    """The change batch of ``upsert_orders`` arriving as files, merged as a stream."""
    spark, lake = m.spark, _temporary_lake(m.spark)
    orders = m.ref("stg_orders").withColumn("month", F.trunc("order_date", "MM"))
    lake.publish(orders, "landing", "orders", partition_by=("month",))
    changed_orders(orders).write.parquet(f"{lake.root}/changes")
    arriving = (
        spark.readStream.schema(orders.schema)
        .option("maxFilesPerTrigger", 1000)
        .parquet(f"{lake.root}/changes")
    )
    running = upsert_stream(
        arriving, lake, "landing", "orders", "order_id", "month", f"{lake.root}/checkpoint"
    )
    running.awaitTermination()
    return _rows_of(lake, "landing", "orders").drop("month")


@query
def stream_upsert_ordered(m: Models) -> DataFrame:
    """Changes of orders that arrive out of order over three batches of a stream.

    Every order has three changes, a fifth of them only two. Each batch brings
    one change per order, and which one differs by order, so newer changes come
    before older ones. Each change moves its order by a month.
    """
    spark, lake = m.spark, _temporary_lake(m.spark)
    first = m.ref("stg_orders").withColumn("month", F.trunc("order_date", "MM"))
    first = materialize(first.withColumn("change_no", F.lit(0)))
    lake.publish(first, "landing", "orders", partition_by=("month",))
    for step in range(3):
        number = F.pmod(F.col("order_id") + step, F.lit(3)).cast("int") + 1
        changed = first.withColumn("change_no", number)
        changed = changed.where((F.col("order_id") % 5 != 0) | (number < 3)).withColumns(
            {
                "order_status": F.concat_ws("-", "order_status", "change_no"),
                "month": F.add_months("month", F.col("change_no")),
            }
        )
        changed.write.mode("append").parquet(f"{lake.root}/changes")
        arriving = spark.readStream.schema(first.schema).parquet(f"{lake.root}/changes")
        upsert_stream(
            arriving, lake, "landing", "orders", "order_id", "month",
            f"{lake.root}/checkpoint", "change_no",
        ).awaitTermination()
    return _rows_of(lake, "landing", "orders")


def _register_funnel() -> None:
    def stream_daily_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Events arriving in several micro-batches that overlap in time."""
        ready(spark, sf_dir)
        lake = _temporary_lake(spark)
        events = given_table(spark, sf_dir, "events")
        events.repartition(3, "event_id").write.parquet(f"{lake.root}/events")
        arriving = (
            spark.readStream.schema(events.schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(f"{lake.root}/events")
        )
        running = funnel_stream(daily_counts(arriving), lake, f"{lake.root}/checkpoint")
        running.awaitTermination()
        rows = current_counts(lake)
        spark.sql(f"DROP DATABASE {lake.database(FUNNEL_LAYER)} CASCADE")
        return rows

    QUERIES["stream_daily_funnel"] = stream_daily_funnel

    def stream_windowed_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Closed daily windows of events that arrive in three loads, a tenth of them late.

        The loads are two decades of the month and the rest; every tenth event
        comes with the last load, whatever its time.
        """
        ready(spark, sf_dir)
        lake = _temporary_lake(spark)
        events = given_table(spark, sf_dir, "events")
        load = F.when(F.col("event_id") % 10 == 0, 2)
        for k, end in enumerate(LOAD_ENDS):
            load = load.when(F.col("ts") < F.lit(end).cast("timestamp"), k)
        loads = events.withColumn("_load", load.otherwise(2))
        for k in range(3):
            loads.where(F.col("_load") == k).drop("_load").write.mode("append").parquet(f"{lake.root}/events")
            arriving = spark.readStream.schema(events.schema).parquet(f"{lake.root}/events")
            windows.split_stream(arriving, lake.root, f"{lake.root}/split").awaitTermination()
            windows.count_stream(spark, lake.root, f"{lake.root}/count").awaitTermination()
        return windows.closed_counts(spark, lake.root)

    QUERIES["stream_windowed_funnel"] = stream_windowed_funnel


_register_funnel()
