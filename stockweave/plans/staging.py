"""Staging models: declared casts, trimmed text, rows without their key dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.operators.running import ordinal
from stockweave.plans.registry import MODELS, Model

# Per staging table: its columns as "name type", where the pseudo types are
# text (trimmed), code (trimmed, lower case) and blankable (blank becomes NULL).
# A column read under another name is written "name type <source name>".
STAGING: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id bigint", "zip int", "city text", "signup_date date", "gender text",
        "age_group text", "acquisition_channel text",
    ),
    "geography": ("zip int", "city text", "region text", "district text"),
    "inventory": (
        "snapshot_date date", "product_id bigint", "stock_on_hand int", "units_received int",
        "units_sold bigint", "stockout_days int", "days_of_supply double", "fill_rate double",
        "stockout_flag int", "overstock_flag int", "reorder_flag int", "sell_through_rate double",
        "product_name text", "category text", "segment text", "year int", "month int",
    ),
    "order_items": (
        "order_id bigint", "product_id bigint", "quantity int", "unit_price double",
        "discount_amount double", "promo_id blankable", "promo_id_2 blankable",
    ),
    "orders": (
        "order_id bigint", "order_date date", "customer_id bigint", "zip int", "order_status code",
        "payment_method text", "device_type text", "order_source text",
    ),
    "payments": (
        "order_id bigint", "payment_method text", "payment_value double", "installments int",
    ),
    "products": (
        "product_id bigint", "product_name text", "category text", "segment text", "size text",
        "color text", "price double", "cogs double",
    ),
    "promotions": (
        "promo_id text", "promo_name text", "promo_type code", "discount_value double",
        "start_date date", "end_date date", "applicable_category text", "promo_channel text",
        "stackable_flag int", "min_order_value double",
    ),
    "returns": (
        "return_id text", "order_id bigint", "product_id bigint", "return_date date",
        "return_reason text", "return_quantity bigint", "refund_amount double",
    ),
    "reviews": (
        "review_id text", "order_id bigint", "product_id bigint", "customer_id bigint",
        "review_date date", "rating int", "review_title text",
    ),
    "sales": ("sales_date date <date>", "revenue double", "cogs double"),
    "shipments": ("order_id bigint", "ship_date date", "delivery_date date", "shipping_fee double"),
    "web_traffic": (
        "traffic_date date <date>", "sessions bigint", "unique_visitors bigint", "page_views bigint",
        "bounce_rate double", "avg_session_duration_sec double", "traffic_source text",
    ),
}

# Columns that must be present for a row to enter staging.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "geography": ("zip",),
    "inventory": ("product_id",),
    "order_items": ("order_id", "product_id"),
    "orders": ("order_id",),
    "payments": ("order_id",),
    "products": ("product_id",),
    "promotions": ("promo_id",),
    "returns": ("return_id",),
    "reviews": ("review_id",),
    "sales": (),
    "shipments": ("order_id",),
    "web_traffic": ("date",),
}

_TEXT = {"text": "trim({0})", "code": "lower(trim({0}))", "blankable": "nullif(trim({0}), '')"}


def _column(declared: str) -> str:
    name, kind, *source = declared.split()
    raw = f"`{source[0].strip('<>') if source else name}`"
    value = _TEXT[kind].format(raw) if kind in _TEXT else f"cast({raw} as {kind})"
    return f"{value} as {name}"


def stage(df: DataFrame, table: str) -> DataFrame:
    """Apply the staging rules of ``table`` to its landing frame."""
    if REQUIRED[table]:
        df = df.where(" and ".join(f"`{c}` is not null" for c in REQUIRED[table]))
    return df.selectExpr(*[_column(c) for c in STAGING[table]])


def _register() -> None:
    for table in STAGING:
        name = f"stg_{table}"
        MODELS[name] = Model(name, "staging", lambda df, t=table: stage(df, t), (table,))


_register()


def harmonise_maintenance(raw: DataFrame) -> DataFrame:
    """Maintenance extract: rename, trim, missing text becomes empty."""
    names = {
        "ORDER": "order_id",
        "BASIC_START_DATE": "start_date",
        "EQUIPMENT_ID": "equipment_id",
        "ORDER_TYPE": "order_type",
        "DESCRIPTION": "description",
    }
    present = {c.upper(): c for c in raw.columns}
    return raw.select(
        *[
            F.coalesce(F.trim(F.col(present[old]).cast("string")), F.lit("")).alias(new)
            if old in present
            else F.lit("").alias(new)
            for old, new in names.items()
        ]
    )


def harmonise_cross_reference(raw: DataFrame) -> DataFrame:
    """First two columns by position; rows without a second field go."""
    first, second = raw.columns[:2]
    return raw.where(F.col(second).isNotNull()).select(
        F.trim(F.col(first).cast("string")).alias("equipment_id"),
        F.trim(F.col(second).cast("string")).alias("line_name"),
    )


def size_type_products(logs: DataFrame, products: DataFrame, row_order: str) -> DataFrame:
    """Map the n-th size type, by first appearance, to product ``n mod N``.

    Both sides are numbered without a global window, then joined on the number.
    """
    seen = (
        logs.select(F.coalesce(F.trim("size_type"), F.lit("Unknown")).alias("size_type"), row_order)
        .groupBy("size_type")
        .agg(F.min(row_order).alias("first_row"))
    )
    types = ordinal(seen, [F.col("first_row"), F.col("size_type")], "n")
    shelf = ordinal(products.select("product_id"), [F.col("product_id")], "n")
    n_products = products.agg(F.count("product_id")).scalar()
    return types.select("size_type", F.pmod(F.col("n"), n_products).alias("n")).join(
        shelf, "n"
    ).select("size_type", "product_id")


def harmonise_production_logs(raw: DataFrame, products: DataFrame, row_order: str) -> DataFrame:
    """Production extract with the product each size type stands for put first."""
    mapping = size_type_products(raw, products, row_order)
    keyed = raw.withColumn("size_type", F.coalesce(F.trim("size_type"), F.lit("Unknown")))
    return keyed.join(mapping, "size_type", "left").select("product_id", *raw.columns)
