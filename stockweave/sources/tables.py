"""The declared source tables: columns, key and the source group they load from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    """One source table. ``group`` is the operational schema it is loaded from."""

    name: str
    group: str
    ddl: str
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [field.split()[0] for field in self.ddl.split(",")]

    @property
    def stripe_column(self) -> str | None:
        """The first key column that can be cut into stripes: a number or a date."""
        kinds = ("int", "bigint", "date")
        found = [c for c in self.key if self.schema[c].dataType.simpleString() in kinds]
        return found[0] if found else None

    @property
    def landing_name(self) -> str:
        return f"{self.group}_{self.name}"


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        # Loaded daily.
        TableSpec(
            "products",
            "master_data",
            "product_id bigint, product_name string, category string, segment string, size string, "
            "color string, price double, cogs double, supplier_id string",
            ("product_id",),
        ),
        TableSpec(
            "customers",
            "master_data",
            "customer_id bigint, zip int, city string, signup_date date, gender string, "
            "age_group string, acquisition_channel string",
            ("customer_id",),
        ),
        TableSpec(
            "promotions",
            "master_data",
            "promo_id string, promo_name string, promo_type string, discount_value double, "
            "start_date date, end_date date, applicable_category string, promo_channel string, "
            "stackable_flag int, min_order_value double",
            ("promo_id",),
        ),
        TableSpec(
            "geography",
            "master_data",
            "zip int, city string, region string, district string",
            ("zip",),
        ),
        TableSpec(
            "orders",
            "sales",
            "order_id bigint, order_date date, customer_id bigint, zip int, order_status string, "
            "payment_method string, device_type string, order_source string",
            ("order_id",),
        ),
        TableSpec(
            "order_items",
            "sales",
            "order_id bigint, product_id bigint, quantity int, unit_price double, "
            "discount_amount double, promo_id string, promo_id_2 string",
        ),
        TableSpec(
            "payments",
            "sales",
            "order_id bigint, payment_method string, payment_value double, installments int",
            ("order_id",),
        ),
        TableSpec(
            "returns",
            "sales",
            "return_id string, order_id bigint, product_id bigint, return_date date, "
            "return_reason string, return_quantity bigint, refund_amount double",
            ("return_id",),
        ),
        TableSpec("sales", "sales", "date date, revenue double, cogs double", ("date",)),
        TableSpec(
            "shipments",
            "supply_chain",
            "order_id bigint, ship_date date, delivery_date date, shipping_fee double",
            ("order_id",),
        ),
        TableSpec(
            "inventory",
            "supply_chain",
            "snapshot_date date, product_id bigint, stock_on_hand int, units_received int, "
            "units_sold bigint, stockout_days int, days_of_supply double, fill_rate double, "
            "stockout_flag int, overstock_flag int, reorder_flag int, sell_through_rate double, "
            "product_name string, category string, segment string, year int, month int",
            ("snapshot_date", "product_id"),
        ),
        TableSpec(
            "reviews",
            "marketing",
            "review_id string, order_id bigint, product_id bigint, customer_id bigint, "
            "review_date date, rating int, review_title string",
            ("review_id",),
        ),
        TableSpec(
            "web_traffic",
            "marketing",
            "date date, sessions bigint, unique_visitors bigint, page_views bigint, bounce_rate double, "
            "avg_session_duration_sec double, traffic_source string",
            ("date", "traffic_source"),
        ),
        # Read by planning and features only.
        TableSpec(
            "suppliers",
            "planning",
            "supplier_id string, supplier_name string, country string, reliability_score double",
            ("supplier_id",),
        ),
        TableSpec(
            "raw_materials",
            "planning",
            "rm_id string, rm_name string, unit string, std_cost double, current_stock double",
            ("rm_id",),
        ),
        TableSpec(
            "bom",
            "planning",
            "product_id bigint, rm_id string, quantity_required double",
            ("product_id", "rm_id"),
        ),
        TableSpec(
            "procurement_scenarios",
            "planning",
            "scenario_id string, scenario_name string, supplier_id string, rm_id string, "
            "unit_price double, lead_time_days int, min_qty double, discount_pct double",
            ("scenario_id",),
        ),
        TableSpec(
            "supplier_materials",
            "planning",
            "supplier_id string, rm_id string, std_unit_price double, base_lead_time int, moq double",
            ("supplier_id", "rm_id"),
        ),
        TableSpec(
            "cross_reference",
            "planning",
            "equipment_id string, line_name string",
            ("equipment_id",),
        ),
        TableSpec(
            "maintenance_orders",
            "planning",
            "order_id bigint, start_date date, equipment_id string, order_type string, "
            "description string",
            ("order_id",),
        ),
        TableSpec(
            "production_logs",
            "planning",
            "log_id bigint, productiondate_day_loc date, line_name string, shift_name string, "
            "size_type string, run_time double, production_available_time double, "
            "changeover_duration double, good_production_qty int, reject_production_qty int",
            ("log_id",),
        ),
    )
}

# The tables of the daily load: source group -> tables.
DAILY_LOAD: dict[str, list[str]] = {
    group: [t.name for t in TABLES.values() if t.group == group]
    for group in ("master_data", "sales", "supply_chain", "marketing")
}
