"""ABC-XYZ segmentation of products by revenue share and demand variability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.exprs import (
    fixed,
    month_of,
    round_half_up,
    safe_div,
    sample_std,
    unfixed,
)
from stockweave.operators.running import running_total
from stockweave.plans.features import delivered_items
from stockweave.plans.registry import model

STRATEGIC = ("AX", "AY", "AZ", "BX", "BY")
# Fixed thresholds: cumulative revenue percent, and coefficient of variation.
A_UP_TO, B_UP_TO = 80.0, 95.0
X_BELOW, Y_BELOW = 0.5, 1.0
SINGLE_MONTH_CV = 2.0


@model("shared", "stg_order_items", "stg_orders")
def monthly_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered quantity and net revenue per product and month with sales."""
    net = F.col("quantity") * F.col("unit_price") - F.coalesce("discount_amount", F.lit(0.0))
    return (
        delivered_items(items, orders, "quantity", "unit_price", "discount_amount")
        .groupBy("product_id", month_of("order_date").alias("year_month"))
        .agg(
            F.sum("quantity").alias("qty"),
            unfixed(F.sum(fixed(net))).cast("decimal(38,4)").alias("revenue"),
        )
    )


@model("segmentation", "monthly_sales", "stg_products")
def abc_xyz(monthly: DataFrame, products: DataFrame) -> DataFrame:
    """One row per sold product with its revenue rank class and variability class.

    The cumulative share is a running total over all products, so it is built
    chunk-wise. The product that crosses a threshold belongs to the next class.
    """
    qty = F.col("qty")
    per_sku = (
        monthly.groupBy("product_id")
        .agg(
            F.sum("revenue").cast("decimal(38,4)").alias("_revenue"),
            F.count("*").alias("_months"),
            F.sum(qty).alias("total_qty"),
            F.sum(qty.cast("decimal(38,0)") * qty).cast("decimal(38,0)").alias("_squares"),
        )
        .withColumn("_std", sample_std(F.col("_months"), F.col("total_qty"), F.col("_squares")))
    )
    ranked = running_total(
        per_sku,
        F.col("_revenue"),
        [F.col("_revenue").desc(), F.col("product_id")],
        "_running",
        "_all",
    )
    total, running = F.col("_all").cast("double"), F.col("_running").cast("double")
    mean = safe_div(F.col("total_qty"), F.col("_months"))
    cv = F.coalesce(F.col("_std") / F.nullif(mean, F.lit(0.0)), F.lit(SINGLE_MONTH_CV))
    cum = safe_div(running, total) * 100.0
    abc = F.when(cum <= A_UP_TO, "A").when(cum <= B_UP_TO, "B").otherwise("C")
    xyz = F.when(cv < X_BELOW, "X").when(cv < Y_BELOW, "Y").otherwise("Z")
    names = products.select("product_id", "product_name", "category")
    return ranked.join(names, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        F.col("_revenue").cast("double").alias("total_revenue"),
        round_half_up(mean, 6).alias("monthly_mean_qty"),
        round_half_up(F.col("_std"), 6).alias("monthly_std_qty"),
        "total_qty",
        round_half_up(safe_div(F.col("_revenue"), total) * 100.0, 8).alias("rev_share_pct"),
        round_half_up(cum, 8).alias("cum_rev_pct"),
        abc.alias("abc_class"),
        round_half_up(cv, 6).alias("cv"),
        xyz.alias("xyz_class"),
        F.concat(abc, xyz).alias("abc_xyz_matrix"),
    )


def strategic_skus(segments: DataFrame, classes: Sequence[str] = STRATEGIC) -> DataFrame:
    return segments.where(F.col("abc_xyz_matrix").isin(*classes))


def class_histogram(segments: DataFrame, classes: Sequence[str] = STRATEGIC) -> DataFrame:
    return (
        segments.groupBy("abc_xyz_matrix")
        .agg(F.count("*").alias("n_skus"))
        .withColumn("is_selected", F.col("abc_xyz_matrix").isin(*classes).cast("int"))
    )


def top_skus(segments: DataFrame, n: int = 10, classes: Sequence[str] = STRATEGIC) -> DataFrame:
    """The report of the first ``n`` strategic products by revenue."""
    return (
        strategic_skus(segments, classes)
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
        .select("product_id", "product_name", "abc_xyz_matrix", "total_revenue")
    )
