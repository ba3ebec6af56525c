"""Demand and equipment feature tables and their feature views."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.exprs import (
    exact_sum,
    fixed,
    month_of,
    round_half_up,
    safe_div,
    sample_std,
    unfixed,
)
from stockweave.operators.joins import as_of_join, latest_per_entity
from stockweave.plans.registry import model

# Defaults for items whose product is unknown, and for gaps in equipment logs.
DEFAULT_LIST_PRICE = 100.0
DEFAULT_MARGIN_PCT = 25.0
DEFAULT_OEE_RATIO = 0.75
DEFAULT_OEE = 75.0
DEFAULT_CHANGEOVER_MIN = 30.0
DEFAULT_SCRAP_RATIO = 0.02
DEFAULT_SCRAP = 2.0
MTBF_HOURS = 168.0

TARGET = "quantity"
DEMAND_FEATURES = (
    "unit_price",
    "discount_amount",
    "list_price",
    "gross_margin_pct",
    "day_of_week",
    "month",
    "is_weekend",
    "daily_page_views",
    "rolling_mean_demand_7d",
    "rolling_mean_demand_30d",
    "rolling_std_demand_7d",
    "lag_demand_1d",
    "lag_demand_7d",
    "lag_demand_14d",
    "promo_active_flag",
    "stockout_flag_previous_day",
)
# Sale days a feature looks back on, the day itself included.
HISTORY_DAYS = 30
OEE_FEATURES = (
    "avg_oee_last_14d",
    "avg_changeover_duration_min",
    "scrap_reject_rate_pct",
    "mtbf_hours",
    "planned_maint_blackout_flag",
)


@dataclass(frozen=True)
class FeatureView:
    """A feature table with its entity and how long a value stays valid."""

    name: str
    entity: str
    ttl_days: int
    features: tuple[str, ...]
    event_ts: str = "event_timestamp"
    created_ts: str = "created_timestamp"

    def at(
        self,
        probes: DataFrame,
        table: DataFrame,
        probe_ts: str,
        features: Sequence[str] | None = None,
        slices: int = 1,
    ) -> DataFrame:
        """The values known for each probe at its own time; all features unless named."""
        return as_of_join(
            probes,
            table,
            self.entity,
            probe_ts,
            self.event_ts,
            self.created_ts,
            features or self.features,
            self.ttl_days,
            slices,
        )

    def latest(self, table: DataFrame) -> DataFrame:
        """The newest values per entity, as an online store would hold them."""
        columns = [self.entity, self.event_ts, self.created_ts, *self.features]
        return latest_per_entity(
            table.select(*columns), self.entity, self.event_ts, self.created_ts
        )


DEMAND_VIEW = FeatureView("product_demand_features", "product_id", 90, DEMAND_FEATURES)
OEE_VIEW = FeatureView("production_line_oee_features", "line_name", 30, OEE_FEATURES)


def delivered_items(items: DataFrame, orders: DataFrame, *columns: str) -> DataFrame:
    """Items of delivered orders with their order date; items without product go."""
    done = orders.where(F.col("order_status") == "delivered").select("order_id", "order_date")
    return (
        items.where(F.col("product_id").isNotNull())
        .select("order_id", "product_id", *columns)
        .join(done, "order_id")
    )


@model(
    "features",
    "stg_order_items",
    "stg_orders",
    "stg_products",
    "stg_web_traffic",
    "stg_inventory",
)
def demand_features(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    traffic: DataFrame,
    inventory: DataFrame,
    created: str = "2001-08-01 00:00:00",
) -> DataFrame:
    """Daily demand per product with price, calendar, market and history features.

    Lags and rolling figures count sale days, not calendar days, and include
    the current day. Items shrink to (product, day) before any other table is
    joined, so a window holds at most one row per day however hot the product.
    """
    return with_history(demand_days(items, orders, products, traffic, inventory), created)


def demand_days(
    items: DataFrame, orders: DataFrame, products: DataFrame, traffic: DataFrame, inventory: DataFrame
) -> DataFrame:
    """One row per product and sale day with what that day tells by itself."""
    sold = delivered_items(
        items, orders, "quantity", "unit_price", "discount_amount", "promo_id"
    )
    daily = sold.groupBy("product_id", "order_date").agg(
        F.sum("quantity").alias("quantity"),
        (exact_sum("unit_price", 6) / F.count("unit_price")).alias("unit_price"),
        F.coalesce(exact_sum("discount_amount"), F.lit(0.0)).alias("discount_amount"),
        F.max(F.col("promo_id").isNotNull().cast("int")).alias("promo_active_flag"),
    )
    margin = (F.col("price") - F.col("cogs")) / F.nullif("price", F.lit(0.0)) * 100.0
    listed = products.select(
        "product_id",
        F.col("price").alias("list_price"),
        F.bround(margin.cast("decimal(28,10)"), 2).cast("double").alias("gross_margin_pct"),
    )
    views = traffic.groupBy(F.col("traffic_date").alias("order_date")).agg(
        F.sum("page_views").cast("double").alias("daily_page_views")
    )
    # The stock-out flag of the month before the sale. A month without a row counts as
    # not flagged, so only flagged rows are shuffled. A product has at most the calendar's
    # months; in one row they are joined by product, as all else from here on.
    flagged = inventory.where(F.col("stockout_flag") > 0)
    flags = flagged.groupBy(
        "product_id", F.add_months(month_of("snapshot_date"), 1).alias("_month")
    ).agg(F.max("stockout_flag").alias("_flag"))
    flags = flags.groupBy("product_id").agg(
        F.map_from_entries(F.collect_list(F.struct("_month", "_flag"))).alias("_flags")
    )
    return (
        daily.withColumn("_month", month_of("order_date"))
        .join(listed, "product_id", "left")
        .join(views, "order_date", "left")
        .join(flags, "product_id", "left")
        .withColumn("_flag", F.col("_flags")[F.col("_month")])
        .drop("_flags")
    )


def last_days(days: DataFrame, n: int = HISTORY_DAYS) -> DataFrame:
    """(product_id, order_date, quantity) of the last ``n`` sale days of every product."""
    newest = Window.partitionBy("product_id").orderBy(F.desc("order_date"))
    numbered = days.select("product_id", "order_date", "quantity", F.row_number().over(newest).alias("_n"))
    return numbered.where(F.col("_n") <= n).drop("_n")


def with_history(days: DataFrame, created: str, carried: DataFrame | None = None) -> DataFrame:
    """The features of the sale days ``days``, with lags and rolling figures.

    ``carried`` are the last sale days before them, as ``last_days`` gives them;
    they are looked back on and not returned.
    """
    joined = days.withColumn("_new", F.lit(True))
    if carried is not None:
        joined = joined.unionByName(carried.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    days = Window.partitionBy("product_id").orderBy("order_date")

    def last_rows(n: int):
        return days.rowsBetween(-(n - 1), 0)

    q = F.col("quantity")
    square = q.cast("decimal(18,0)") * q.cast("decimal(18,0)")
    weekday = F.weekday("order_date")
    deviation = sample_std(
        F.count(q).over(last_rows(7)), F.sum(q).over(last_rows(7)), F.sum(square).over(last_rows(7))
    )
    features = joined.select(
        "product_id",
        F.col("order_date").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit(created).cast("timestamp_ntz").alias("created_timestamp"),
        q.alias(TARGET),
        round_half_up(F.col("unit_price"), 4).alias("unit_price"),
        "discount_amount",
        F.coalesce("list_price", F.lit(DEFAULT_LIST_PRICE)).alias("list_price"),
        F.coalesce("gross_margin_pct", F.lit(DEFAULT_MARGIN_PCT)).alias("gross_margin_pct"),
        weekday.alias("day_of_week"),
        F.month("order_date").alias("month"),
        (weekday >= 5).cast("int").alias("is_weekend"),
        F.coalesce("daily_page_views", F.lit(0.0)).alias("daily_page_views"),
        F.avg(q).over(last_rows(7)).alias("rolling_mean_demand_7d"),
        F.avg(q).over(last_rows(30)).alias("rolling_mean_demand_30d"),
        F.coalesce(deviation, F.lit(0.0)).alias("rolling_std_demand_7d"),
        *[
            F.coalesce(F.lag(q, n).over(days), F.lit(0)).alias(f"lag_demand_{n}d")
            for n in (1, 7, 14)
        ],
        "promo_active_flag",
        F.coalesce("_flag", F.lit(0)).alias("stockout_flag_previous_day"),
        "_new",
    )
    return features.where("_new").drop("_new").dropna()


@model("features", "production_logs")
def oee_features(logs: DataFrame, created: str = "2024-02-01 00:00:00") -> DataFrame:
    """Per line and day: 14-day rolling OEE, changeover and scrap figures.

    Columns an extract lacks fall back as documented by the constants above.
    """
    logs = logs.toDF(*[c.lower() for c in logs.columns])
    have = set(logs.columns)
    date_column = next(c for c in ("productiondate_day_loc", "date") if c in have)
    line_column = next(c for c in ("line_name", "equipment_id") if c in have)
    if "oee" in have:
        oee = F.col("oee")
    elif {"run_time", "production_available_time"} <= have:
        ratio = safe_div(F.col("run_time"), F.col("production_available_time"))
        oee = F.coalesce(ratio, F.lit(DEFAULT_OEE_RATIO)) * 100.0
    else:
        oee = F.lit(DEFAULT_OEE)
    if "changeover_duration" in have:
        changeover = F.coalesce("changeover_duration", F.lit(DEFAULT_CHANGEOVER_MIN))
    else:
        changeover = F.lit(DEFAULT_CHANGEOVER_MIN)
    if "scrap_reject_rate" in have:
        scrap = F.col("scrap_reject_rate")
    elif {"reject_production_qty", "good_production_qty"} <= have:
        bad, good = F.col("reject_production_qty"), F.col("good_production_qty")
        scrap = F.coalesce(safe_div(bad, good + bad), F.lit(DEFAULT_SCRAP_RATIO)) * 100.0
    else:
        scrap = F.lit(DEFAULT_SCRAP)

    def mean(value):
        return round_half_up(exact_sum(value, 8) / F.count(value), 8)

    daily = logs.groupBy(
        F.col(line_column).cast("string").alias("line_name"),
        F.col(date_column).cast("date").alias("_day"),
    ).agg(mean(oee).alias("_oee"), mean(changeover).alias("_change"), mean(scrap).alias("_scrap"))
    recent = Window.partitionBy("line_name").orderBy("_day").rowsBetween(-13, 0)

    def rolling(c: str):
        total = unfixed(F.sum(fixed(c, 8)).over(recent), 8).cast("double")
        return round_half_up(total / F.count(c).over(recent), 6)

    return daily.select(
        "line_name",
        F.col("_day").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit(created).cast("timestamp_ntz").alias("created_timestamp"),
        rolling("_oee").alias("avg_oee_last_14d"),
        rolling("_change").alias("avg_changeover_duration_min"),
        rolling("_scrap").alias("scrap_reject_rate_pct"),
        F.lit(MTBF_HOURS).alias("mtbf_hours"),
        F.lit(0).alias("planned_maint_blackout_flag"),
    ).dropna()
