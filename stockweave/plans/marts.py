"""Intermediate model, dimensions, facts and daily reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.exprs import (
    at_least_zero,
    days_from,
    exact_sum,
    fixed,
    iso_weekday,
    month_of,
    pct,
    round_half_up,
    safe_div,
    unfixed,
)
from stockweave.operators.changes import since_mark, upsert
from stockweave.operators.joins import left_join_spread, literal_date
from stockweave.plans.registry import Sliced, model

# Tenure is counted to this day unless the caller names one.
AS_OF = "2001-08-01"


# --- intermediate ---------------------------------------------------------


@model("intermediate", "stg_order_items", "stg_promotions")
def int_order_items_discounted(items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Items with the discount of their first promotion, else their own discount.

    Most items carry no promotion, hence the join that spreads missing keys.
    """
    offers = promotions.select("promo_id", "promo_type", "discount_value")
    gross = F.col("quantity") * F.col("unit_price")
    discount = (
        F.when(F.col("promo_type") == "percentage", gross * (F.col("discount_value") / 100.0))
        .when(F.col("promo_type") == "fixed", F.col("quantity") * F.col("discount_value"))
        .otherwise(F.coalesce("discount_amount", F.lit(0.0)))
    )
    return (
        left_join_spread(items, offers, "promo_id")
        .withColumn("calculated_discount_amount", discount)
        .select(
            "order_id",
            "product_id",
            "quantity",
            F.col("unit_price").alias("original_unit_price"),
            "promo_id",
            "promo_id_2",
            "calculated_discount_amount",
            (gross - F.col("calculated_discount_amount")).alias("net_line_total"),
        )
    )


# --- dimensions -----------------------------------------------------------


@model("dim", "stg_customers", "stg_geography")
def dim_customers(customers: DataFrame, geography: DataFrame, as_of: str = AS_OF) -> DataFrame:
    geo = geography.select("zip", F.col("city").alias("_geo_city"), "region", "district")
    return left_join_spread(customers, geo, "zip").select(
        "customer_id",
        "zip",
        F.coalesce("city", "_geo_city").alias("city"),
        "region",
        "district",
        "signup_date",
        "gender",
        "age_group",
        "acquisition_channel",
        days_from("signup_date", literal_date(as_of)).alias("customer_tenure_days"),
    )


@model("dim", "stg_orders")
def dim_date(orders: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row per day from ``first`` to ``last``; unset ends come from the orders."""
    span = orders.agg(
        (literal_date(first) if first else F.min("order_date")).alias("a"),
        (literal_date(last) if last else F.max("order_date")).alias("b"),
    )
    days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    d = F.col("date_key")
    weekday = iso_weekday(d)
    return days.select(
        "date_key",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias(
            "year_quarter"
        ),
        F.concat(
            F.year(d).cast("string"), F.lit("-Q"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")
        ).alias("year_iso_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend_flag"),
    )


@model("dim", "stg_geography")
def dim_geography(geography: DataFrame) -> DataFrame:
    return geography.select(
        "zip",
        "city",
        "district",
        "region",
        F.concat("city", F.lit(" - "), "district").alias("city_district_label"),
    )


@model("dim", "stg_products")
def dim_products(products: DataFrame) -> DataFrame:
    margin = F.col("price") - F.col("cogs")
    return products.select(
        "product_id",
        "product_name",
        "category",
        "segment",
        "size",
        "color",
        "price",
        "cogs",
        margin.alias("gross_margin"),
        pct(margin, F.col("price")).alias("gross_margin_pct"),
    )


@model("dim", "stg_promotions")
def dim_promotions(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        "promo_id",
        "promo_name",
        "promo_type",
        "discount_value",
        "start_date",
        "end_date",
        "applicable_category",
        "promo_channel",
        "stackable_flag",
        "min_order_value",
        days_from("start_date", "end_date").alias("promo_duration_days"),
    )


# --- facts ----------------------------------------------------------------


@model("fact", "stg_orders", "int_order_items_discounted")
def fct_sales_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with item totals; items shrink to one row per order before the join."""
    totals = items.groupBy("order_id").agg(
        F.sum("quantity").alias("total_items"),
        exact_sum(F.col("quantity") * F.col("original_unit_price")).alias("gross_order_value"),
        exact_sum("calculated_discount_amount").alias("total_discount"),
        exact_sum("net_line_total").alias("net_order_value"),
    )
    return orders.join(totals, "order_id", "left").select(
        "order_id",
        "order_date",
        "customer_id",
        "zip",
        "order_status",
        "payment_method",
        "device_type",
        "order_source",
        F.coalesce("total_items", F.lit(0)).alias("total_items"),
        F.coalesce("gross_order_value", F.lit(0.0)).alias("gross_order_value"),
        F.coalesce("total_discount", F.lit(0.0)).alias("total_discount"),
        F.coalesce("net_order_value", F.lit(0.0)).alias("net_order_value"),
    )


@model("fact", "stg_orders", "stg_payments", "stg_shipments", "stg_returns", "stg_reviews")
def fct_order_fulfillment(
    orders: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """Order life cycle. All inputs meet on order_id, so one partitioning serves.

    Returns and reviews are reduced first. Payments and shipments are one per
    order by contract; the data tests report repeats, which the join lets show.
    """
    returned = returns.groupBy("order_id").agg(
        F.sum("return_quantity").alias("_qty"), exact_sum("refund_amount").alias("_refund")
    )
    rated = reviews.groupBy("order_id").agg(
        (F.sum("rating").cast("double") / F.count("rating")).alias("customer_rating")
    )
    paid = payments.select(
        "order_id", F.col("payment_method").alias("_method"), "payment_value", "installments"
    )
    joined = orders.join(paid, "order_id", "left").join(shipments, "order_id", "left")
    joined = joined.join(returned, "order_id", "left").join(rated, "order_id", "left")
    return joined.select(
        "order_id",
        "order_date",
        "customer_id",
        "order_status",
        F.col("_method").alias("payment_method"),
        F.coalesce("payment_value", F.lit(0.0)).alias("payment_value"),
        F.coalesce("installments", F.lit(1)).alias("installments"),
        "ship_date",
        "delivery_date",
        F.coalesce("shipping_fee", F.lit(0.0)).alias("shipping_fee"),
        days_from("order_date", "ship_date").alias("processing_days"),
        days_from("ship_date", "delivery_date").alias("shipping_transit_days"),
        days_from("order_date", "delivery_date").alias("total_fulfillment_days"),
        F.coalesce("_qty", F.lit(0)).alias("returned_qty"),
        F.coalesce("_refund", F.lit(0.0)).alias("refund_amount"),
        F.when(F.col("_qty") > 0, 1).otherwise(0).alias("is_returned_flag"),
        "customer_rating",
    )


def incremental(fact: DataFrame, build, orders: DataFrame, *others, lookback_days: int = 0):
    """Advance an order fact: rebuild orders from its high-water mark on, then merge."""
    fresh = build(since_mark(orders, fact, "order_date", lookback_days), *others)
    return upsert(fact, fresh, "order_id")


@model("fact", "stg_returns", "stg_orders", "dim_products")
def fct_return_items(returns: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    cogs = F.col("return_quantity") * F.col("cogs")
    return (
        returns.join(orders.select("order_id", "order_date", "customer_id", "zip"), "order_id", "left")
        .join(products.select("product_id", "cogs"), "product_id", "left")
        .select(
            "return_id",
            "order_id",
            "order_date",
            "return_date",
            "product_id",
            "customer_id",
            "zip",
            "return_reason",
            "return_quantity",
            "refund_amount",
            cogs.alias("returned_inventory_cogs"),
            (F.col("refund_amount") - cogs).alias("net_reverse_logistics_loss"),
            days_from("order_date", "return_date").alias("days_from_order_to_return"),
        )
    )


@model("fact", "stg_reviews", "stg_orders")
def fct_customer_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    mood = (
        F.when(F.col("rating") >= 4, "Positive")
        .when(F.col("rating") == 3, "Neutral")
        .otherwise("Negative_Detractor")
    )
    placed = orders.select("order_id", "order_date", "order_source")
    return reviews.join(placed, "order_id", "left").select(
        "review_id",
        "order_id",
        "order_date",
        "review_date",
        "product_id",
        "customer_id",
        "rating",
        "review_title",
        "order_source",
        days_from("order_date", "review_date").alias("days_to_review"),
        mood.alias("csat_sentiment_category"),
    )


@model("fact", "stg_web_traffic", "stg_orders", "fct_sales_orders")
def fct_daily_marketing_funnel(
    traffic: DataFrame, orders: DataFrame, sales: DataFrame
) -> DataFrame:
    """Traffic per day and source against the site's orders and revenue of that day."""
    # An order is one row, so two counts distinct become two plain counts.
    placed = (
        orders.groupBy("order_date", "customer_id")
        .agg(F.count("order_id").alias("_orders"))
        .groupBy("order_date")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.count("customer_id").alias("buying_customers"),
        )
    )
    earned = sales.groupBy("order_date").agg(exact_sum("net_order_value").alias("daily_net_revenue"))
    n_orders = F.coalesce("total_orders", F.lit(0))
    revenue = F.coalesce("daily_net_revenue", F.lit(0.0))
    return (
        traffic.withColumn("order_date", F.col("traffic_date"))
        .join(placed, "order_date", "left")
        .join(earned, "order_date", "left")
        .select(
            "traffic_date",
            "traffic_source",
            "sessions",
            "unique_visitors",
            "page_views",
            "bounce_rate",
            "avg_session_duration_sec",
            n_orders.alias("total_orders"),
            F.coalesce("buying_customers", F.lit(0)).alias("buying_customers"),
            revenue.alias("daily_net_revenue"),
            pct(n_orders, F.col("sessions")).alias("session_conversion_rate_pct"),
            round_half_up(safe_div(revenue, F.col("unique_visitors")), 2).alias(
                "revenue_per_visitor"
            ),
        )
    )


@model("fact", "fct_order_fulfillment", "dim_customers")
def fct_logistics_delivery_performance(fulfillment: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivery quality per month and place.

    Orders are first reduced per (month, customer), so the customer join moves
    far fewer rows and a customer with a third of all orders is one row a month.
    """
    per_customer = (
        fulfillment.where(F.col("order_status").isin("shipped", "delivered", "returned"))
        .groupBy(month_of("order_date").alias("performance_month"), "customer_id")
        .agg(
            F.count("order_id").alias("n"),
            F.sum("processing_days").alias("proc"),
            F.count("processing_days").alias("proc_n"),
            F.sum("shipping_transit_days").alias("transit"),
            F.count("shipping_transit_days").alias("transit_n"),
            F.sum("total_fulfillment_days").alias("total"),
            F.count("total_fulfillment_days").alias("total_n"),
            F.sum(fixed("shipping_fee")).alias("fee"),
            F.sum("returned_qty").alias("items"),
            F.sum(fixed("refund_amount")).alias("refund"),
            F.sum("is_returned_flag").alias("flags"),
            F.sum(fixed("customer_rating", 8)).alias("stars"),
            F.count("customer_rating").alias("stars_n"),
        )
    )

    def mean(total: str, n: str):
        return round_half_up(safe_div(F.sum(total), F.sum(n)), 2)

    places = customers.select("customer_id", "region", "district", "city")
    return (
        per_customer.join(places, "customer_id", "left")
        .groupBy("performance_month", "region", "district", "city")
        .agg(
            F.sum("n").alias("total_shipments"),
            mean("proc", "proc_n").alias("avg_warehouse_processing_days"),
            mean("transit", "transit_n").alias("avg_carrier_transit_days"),
            mean("total", "total_n").alias("avg_total_fulfillment_days"),
            unfixed(F.sum("fee")).cast("double").alias("total_logistics_revenue"),
            F.sum("items").alias("total_returned_items"),
            unfixed(F.sum("refund")).cast("double").alias("total_reverse_logistics_refunds"),
            pct(F.sum("flags"), F.sum("n")).alias("return_rate_pct"),
            round_half_up(
                safe_div(unfixed(F.sum("stars"), 8), F.sum("stars_n")), 2
            ).alias("regional_csat_rating"),
        )
    )


@model("fact", "stg_inventory", "dim_products")
def fct_monthly_inventory_kpi(inventory: DataFrame, products: DataFrame) -> DataFrame:
    listed = products.select(
        "product_id",
        F.col("product_name").alias("_name"),
        F.col("category").alias("_category"),
        F.col("segment").alias("_segment"),
        "price",
        "cogs",
    )
    sellable_days = F.nullif(F.lit(30.0) - F.col("stockout_days"), F.lit(0.0))
    lost = (F.col("units_sold") / sellable_days) * F.col("stockout_days") * F.col("price")
    return inventory.join(listed, "product_id", "left").select(
        "snapshot_date",
        "year",
        "month",
        "product_id",
        F.coalesce("product_name", "_name").alias("product_name"),
        F.coalesce("category", "_category").alias("category"),
        F.coalesce("segment", "_segment").alias("segment"),
        "price",
        "cogs",
        "stock_on_hand",
        "units_received",
        "units_sold",
        (F.col("stock_on_hand") * F.col("cogs")).alias("inventory_holding_value"),
        (F.col("units_sold") * (F.col("price") - F.col("cogs"))).alias("monthly_realized_profit"),
        "stockout_days",
        "days_of_supply",
        "fill_rate",
        "sell_through_rate",
        "stockout_flag",
        "overstock_flag",
        "reorder_flag",
        F.when(F.col("stockout_days") > 0, round_half_up(lost, 2))
        .otherwise(0.0)
        .alias("estimated_lost_revenue_due_to_stockout"),
    )


@model("fact", "stg_inventory", "dim_products")
def fct_supplier_replenishment_alert(inventory: DataFrame, products: DataFrame) -> DataFrame:
    supply = F.col("days_of_supply")
    out, low, high = (F.col(f"{f}_flag") == 1 for f in ("stockout", "reorder", "overstock"))
    status = (
        F.when(out | (supply < 10), "CRITICAL_STOCKOUT_RISK")
        .when(low | supply.between(10, 20), "REORDER_IMMEDIATELY")
        .when(high, "EXCESS_OVERSTOCK")
        .otherwise("HEALTHY_BUFFER")
    )
    # The cast to integer rounds half up, away from zero.
    wanted = at_least_zero(F.round(F.col("units_sold") * 1.5 - F.col("stock_on_hand")))
    labels = products.select("product_id", "product_name", "category", "segment")
    return (
        inventory.drop("product_name", "category", "segment")
        .join(labels, "product_id", "left")
        .select(
            "snapshot_date",
            "year",
            "month",
            "product_id",
            "product_name",
            "category",
            "segment",
            "stock_on_hand",
            "units_sold",
            "units_received",
            "days_of_supply",
            "fill_rate",
            "stockout_days",
            "stockout_flag",
            "overstock_flag",
            "reorder_flag",
            round_half_up(F.col("units_sold") / 30.0, 2).alias("daily_burn_rate"),
            status.alias("supply_chain_action_status"),
            F.when(low | out, wanted.cast("bigint")).otherwise(0).alias("recommended_reorder_qty"),
        )
    )


# --- daily reports --------------------------------------------------------


_CATEGORY_DAY = ("report_date", "category", "segment")
_CATEGORY_MONEY = (
    "category_gross_revenue",
    "category_total_discount",
    "category_net_revenue",
    "category_gross_profit",
)


def category_sales_sums(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, units and money, as whole numbers, per day, category and segment.

    Products come first and orders last, so items lie by order when they have all of
    their group: orders are counted there, and only sums per group are dealt again. That
    needs both sides dealt by order, however small, hence the hint.
    """
    values = (
        F.col("quantity") * F.col("original_unit_price"),
        F.col("calculated_discount_amount"),
        F.col("net_line_total"),
        F.col("net_line_total") - F.col("quantity") * F.col("cogs"),
    )
    placed = orders.select("order_id", F.col("order_date").alias("report_date")).hint("merge")
    sold = (
        items.join(products.select("product_id", "category", "segment", "cogs"), "product_id")
        .select(
            "order_id",
            "category",
            "segment",
            "quantity",
            *[fixed(value).alias(name) for name, value in zip(_CATEGORY_MONEY, values)],
        )
        .join(placed, "order_id")
    )
    return (
        sold.groupBy(*_CATEGORY_DAY, "order_id")
        .agg(F.sum("quantity").alias("quantity"), *[F.sum(name).alias(name) for name in _CATEGORY_MONEY])
        .groupBy(*_CATEGORY_DAY)
        .agg(
            F.count("order_id").alias("orders_containing_category"),
            F.sum("quantity").alias("total_units_sold"),
            *[F.sum(name).alias(name) for name in _CATEGORY_MONEY],
        )
    )


def _category_sales(sums: DataFrame) -> DataFrame:
    return sums.select(
        *_CATEGORY_DAY,
        "orders_containing_category",
        "total_units_sold",
        *[unfixed(F.col(name)).cast("double").alias(name) for name in _CATEGORY_MONEY],
    ).withColumn(
        "category_profit_margin_pct",
        pct(F.col("category_gross_profit"), F.col("category_net_revenue")),
    )


def _category_sales_of_slices(sums: DataFrame) -> DataFrame:
    """An order lies in one slice, so orders of the slices add up."""
    added = ("orders_containing_category", "total_units_sold", *_CATEGORY_MONEY)
    return _category_sales(sums.groupBy(*_CATEGORY_DAY).agg(*[F.sum(c).alias(c) for c in added]))


@model(
    "daily_reports",
    "int_order_items_discounted",
    "stg_orders",
    "dim_products",
    sliced=Sliced("order_id", category_sales_sums, _category_sales_of_slices),
)
def rpt_daily_category_sales_performance(
    items: DataFrame, orders: DataFrame, products: DataFrame
) -> DataFrame:
    """Sales per day, category and segment."""
    return _category_sales(category_sales_sums(items, orders, products))


@model("daily_reports", "fct_sales_orders", "stg_shipments", "stg_returns")
def rpt_daily_executive_kpi(
    sales: DataFrame, shipments: DataFrame, returns: DataFrame
) -> DataFrame:
    """One row per day on which anything happened.

    Sales, shipments, deliveries and returns are reduced per day, stacked, and
    folded by one group-by, in place of three chained full outer joins.
    """
    # An order is one row of ``sales``: per customer first, then plain counts and sums.
    money = {
        "gross_revenue": "gross_order_value",
        "total_discount_given": "total_discount",
        "net_revenue": "net_order_value",
    }
    sold = (
        sales.groupBy(F.col("order_date").alias("report_date"), "customer_id")
        .agg(
            F.count("order_id").alias("_orders"),
            *[F.sum(fixed(value)).alias(f"_{name}") for name, value in money.items()],
        )
        .groupBy("report_date")
        .agg(
            F.sum("_orders").alias("total_orders_placed"),
            F.count("customer_id").alias("buying_customers"),
            *[unfixed(F.sum(f"_{name}")).cast("double").alias(name) for name in money],
        )
    )
    sold = sold.withColumn(
        "average_order_value",
        round_half_up(safe_div(F.col("net_revenue"), F.col("total_orders_placed")), 2),
    )
    shipped = (
        shipments.where(F.col("ship_date").isNotNull())
        .groupBy(F.col("ship_date").alias("report_date"))
        .agg(
            F.countDistinct("order_id").alias("orders_shipped_today"),
            exact_sum("shipping_fee").alias("shipping_revenue_today"),
        )
    )
    delivered = (
        shipments.where(F.col("delivery_date").isNotNull())
        .groupBy(F.col("delivery_date").alias("report_date"))
        .agg(F.countDistinct("order_id").alias("orders_delivered_today"))
    )
    sent_back = (
        returns.where(F.col("return_date").isNotNull())
        .groupBy(F.col("return_date").alias("report_date"))
        .agg(
            F.countDistinct("return_id").alias("returns_requested_today"),
            F.sum("return_quantity").alias("return_items_today"),
            exact_sum("refund_amount").alias("total_refunds_today"),
        )
    )
    parts = [sold, shipped, delivered, sent_back]
    measures = [c for p in parts for c in p.columns if c != "report_date"]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # Each measure comes from one branch with one row per day, so max() only picks it.
    days = stacked.groupBy("report_date").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast(stacked.schema[c].dataType)).alias(c) for c in measures]
    )
    return days.withColumn(
        "daily_realized_cashflow", F.col("net_revenue") - F.col("total_refunds_today")
    )
