"""Material requirements, procurement choice, production schedule, full plans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.exprs import exact_sum, round_half_up
from stockweave.operators.running import running_total
from stockweave.plans.risk import (
    DEFAULT_INVENTORY_RISK,
    DEFAULT_SUPPLIER_DELAY,
    QUANTILE_WEIGHTS,
    scenario_array,
)
from stockweave.session import materialize

# Fixed values of the planning rules.
STOCK_PER_KNOWN_MATERIAL = 800.0
DEFAULT_STOCK = 800.0
AT_RISK_YIELD = 0.85
RUSH_FROM_P_DELAY = 0.15
RUSH_LEAD_DAYS = 4
RUSH_PENALTY_PER_UNIT = 2.5
BULK_BONUS = 0.05
MARKET_SUPPLIER = "SUP001 (Default Market)"
MARKET_SCENARIO = "DEFAULT"
MARKET_NAME = "Standard Market Purchase"
MARKET_PRICE = 5.0
MARKET_LEAD_DAYS = 3
LOCKOUT_TYPE = "PM10"

# Batches listed by one task row before the list is spread over tasks.
BATCH_BLOCK = 10_000


@dataclass(frozen=True)
class PlanSettings:
    """Site settings; the planning rules have no defaults for them."""

    safety_stock_pct: float
    max_lead_days: int
    lines: Sequence[str]
    shifts: Sequence[str]
    rate_per_shift: float


def net_requirements(
    demand: DataFrame, bom: DataFrame, materials: DataFrame, safety_stock_pct: float
) -> DataFrame:
    """Explode finished-goods demand (product_id, qty) into net material needs.

    Materials on file count as holding a flat stock, others none. Products
    without a bill of materials drop out.
    """
    parts = bom.select("product_id", F.trim("rm_id").alias("rm_id"), "quantity_required")
    need = F.col("quantity_required") * F.col("qty")
    gross = demand.join(parts, "product_id").groupBy("rm_id").agg(exact_sum(need).alias("_gross"))
    known = materials.select(
        F.trim("rm_id").alias("rm_id"), F.lit(STOCK_PER_KNOWN_MATERIAL).alias("_stock")
    ).dropDuplicates(["rm_id"])
    g = F.col("_gross")
    stock = F.coalesce("_stock", F.lit(0.0))
    net = g + g * safety_stock_pct - stock
    return gross.join(known, "rm_id", "left").select(
        "rm_id",
        round_half_up(g, 2).alias("gross_req"),
        stock.alias("current_inventory"),
        round_half_up(g * safety_stock_pct, 2).alias("safety_stock"),
        round_half_up(F.greatest(net, F.lit(0.0)), 2).alias("net_req"),
    )


def procurement_cheapest(
    requirements: DataFrame, quotes: DataFrame, max_lead_days: int
) -> DataFrame:
    """The cheapest quote in time per material; a market default without one.

    A quote with a discount demands its minimum quantity; the discount itself
    does not lower the price here. Equal costs go to the earlier quote.
    """
    wanted = requirements.where(F.col("net_req") > 0).select("rm_id", "net_req")
    offers = quotes.where(F.col("lead_time_days") <= max_lead_days)
    joined = wanted.join(offers, "rm_id", "left")
    qty = F.when(
        F.col("discount_pct") > 0, F.greatest("net_req", "min_qty")
    ).otherwise(F.col("net_req"))
    option = F.when(
        F.col("scenario_id").isNotNull(),
        F.struct(
            (qty * F.col("unit_price")).alias("cost"),
            "scenario_id",
            "scenario_name",
            "supplier_id",
            qty.alias("qty"),
            "unit_price",
            "lead_time_days",
            "discount_pct",
        ),
    )
    best = joined.groupBy("rm_id", "net_req").agg(F.min(option).alias("b"))
    has = F.col("b").isNotNull()

    def pick(chosen: Column, default) -> Column:
        return F.when(has, chosen).otherwise(default)

    return best.select(
        "rm_id",
        F.col("net_req").alias("net_requirement"),
        pick(F.col("b.supplier_id"), F.lit(MARKET_SUPPLIER)).alias("selected_supplier"),
        pick(F.col("b.scenario_id"), F.lit(MARKET_SCENARIO)).alias("scenario_id"),
        pick(F.col("b.scenario_name"), F.lit(MARKET_NAME)).alias("scenario_name"),
        pick(round_half_up(F.col("b.qty"), 2), F.col("net_req")).alias("order_qty"),
        pick(F.col("b.unit_price"), F.lit(MARKET_PRICE)).alias("unit_price"),
        round_half_up(pick(F.col("b.cost"), F.col("net_req") * MARKET_PRICE), 2).alias(
            "total_cost"
        ),
        pick(F.col("b.lead_time_days"), F.lit(MARKET_LEAD_DAYS)).alias("lead_time_days"),
        F.coalesce("b.discount_pct", F.lit(0.0)).alias("discount_pct"),
    )


def scenario_bom_explosion(outlook: DataFrame, bom: DataFrame) -> DataFrame:
    """Gross material need per product, scenario and material.

    The twelve scenarios are unfolded after the join, so the shuffle carries
    one row per product and material.
    """
    parts = bom.select("product_id", F.trim("rm_id").alias("rm_id"), "quantity_required")
    s = F.col("s")
    rate = F.when(s["inv_state"] == "AtRisk", AT_RISK_YIELD).otherwise(1.0)
    return (
        outlook.join(parts, "product_id")
        .select("product_id", "rm_id", "quantity_required", F.explode(scenario_array()).alias("s"))
        .select(
            "rm_id",
            "product_id",
            F.concat_ws("_", F.lit("SCN"), F.col("product_id"), s["scenario_no"]).alias(
                "scenario_id"
            ),
            s["probability"].alias("probability"),
            (s["demand_qty"] * F.col("quantity_required") / rate).alias("gross_req"),
            s["supplier_state"].alias("supplier_state"),
            s["inv_state"].alias("inv_state"),
        )
    )


def expected_requirements(
    outlook: DataFrame, bom: DataFrame, materials: DataFrame, safety_stock_pct: float
) -> DataFrame:
    """Expected net need and delay probability per material.

    Quantile, supplier and inventory states are independent, so the expectation
    over the twelve scenarios factors: expected demand times expected yield
    loss, and a delay mass equal to the delay probability. One row per product
    enters the explosion instead of twelve. The mass adds up over the products
    that share a material, and may exceed one.
    """
    demand = F.lit(0.0)
    for quantile, weight in QUANTILE_WEIGHTS.items():
        demand = demand + F.coalesce(quantile, F.lit(0.0)) * weight
    risk = F.coalesce("p_inv_risk", F.lit(DEFAULT_INVENTORY_RISK))
    delay = F.coalesce("p_sup_delay", F.lit(DEFAULT_SUPPLIER_DELAY))
    units = demand * ((1.0 - risk) + risk / AT_RISK_YIELD)
    expected = outlook.select(
        "product_id",
        units.cast("decimal(24,10)").alias("_units"),
        delay.cast("decimal(16,14)").alias("_delay"),
    )
    parts = bom.select(
        "product_id",
        F.trim("rm_id").alias("rm_id"),
        F.col("quantity_required").cast("decimal(12,4)").alias("_per_unit"),
    )
    per_material = (
        expected.join(parts, "product_id")
        .groupBy("rm_id")
        .agg(
            F.sum(F.col("_units") * F.col("_per_unit")).cast("double").alias("_gross"),
            F.sum("_delay").cast("double").alias("p_delay"),
            (F.count("*") * 12).alias("n_scenarios"),
        )
    )
    stock = materials.groupBy(F.trim("rm_id").alias("rm_id")).agg(
        F.max("current_stock").alias("_stock")
    )
    net = F.col("_gross") * (1.0 + safety_stock_pct) - F.coalesce("_stock", F.lit(DEFAULT_STOCK))
    return per_material.join(stock, "rm_id", "left").select(
        "rm_id",
        round_half_up(F.greatest(net, F.lit(0.0)), 6).alias("expected_net_req"),
        "p_delay",
        "n_scenarios",
    )


def procurement_expected_cost(requirements: DataFrame, quotes: DataFrame) -> DataFrame:
    """The quote with the least expected cost per material, risk included.

    A likely delay penalises slow quotes; otherwise a discounted quote earns a
    bonus. Materials without quotes drop out; equal costs go to the earlier quote.
    """
    qty = F.greatest("expected_net_req", "min_qty")
    price = F.col("unit_price") * (1.0 - F.col("discount_pct") / 100.0)
    base = qty * price
    rush = F.col("p_delay") >= RUSH_FROM_P_DELAY
    penalty = (
        F.when(
            rush & (F.col("lead_time_days") > RUSH_LEAD_DAYS),
            qty * RUSH_PENALTY_PER_UNIT * F.col("p_delay"),
        )
        .when(~rush & (F.col("discount_pct") > 0), -base * BULK_BONUS)
        .otherwise(0.0)
    )
    option = F.struct(
        (base + penalty).alias("total"),
        "scenario_id",
        "scenario_name",
        "supplier_id",
        qty.alias("qty"),
        price.alias("price"),
        "discount_pct",
        "lead_time_days",
        base.alias("base"),
        penalty.alias("penalty"),
    )
    best = (
        requirements.where(F.col("expected_net_req") > 0)
        .join(quotes.withColumn("rm_id", F.trim("rm_id")), "rm_id")
        .groupBy("rm_id", "expected_net_req", "p_delay", "n_scenarios")
        .agg(F.min(option).alias("b"))
    )
    return best.select(
        "rm_id",
        F.col("b.supplier_id").alias("selected_supplier"),
        F.col("b.scenario_name").alias("scenario_name"),
        round_half_up(F.col("expected_net_req"), 4).alias("expected_net_req"),
        round_half_up(F.col("b.qty"), 4).alias("order_qty"),
        round_half_up(F.col("b.price"), 6).alias("unit_price"),
        F.col("b.discount_pct").alias("discount_pct"),
        F.col("b.lead_time_days").alias("lead_time_days"),
        round_half_up(F.col("b.base"), 2).alias("expected_total_cost"),
        round_half_up(F.col("b.penalty"), 2).alias("risk_penalty_cost"),
        "n_scenarios",
        round_half_up(F.col("p_delay"), 6).alias("p_delay"),
    )


def procurement_budget(plan: DataFrame) -> DataFrame:
    """Totals of an expected-cost plan: budget, and what negative penalties saved."""
    cost, penalty = F.col("expected_total_cost"), F.col("risk_penalty_cost")
    saved = F.when(penalty < 0, -penalty).otherwise(0.0)

    def total(c: Column) -> Column:
        return F.coalesce(exact_sum(c), F.lit(0.0))

    return plan.agg(
        F.count("*").alias("n_materials"),
        total(cost + penalty).alias("total_expected_budget"),
        total(saved).alias("total_penalty_saved"),
    )


def line_lockouts(maintenance: DataFrame, cross_reference: DataFrame) -> DataFrame:
    """(line_name, lockout_date) of planned maintenance.

    An equipment named twice counts for the line that sorts last.
    """
    lines = (
        cross_reference.where(
            (F.trim("equipment_id") != "") & (F.trim("line_name") != "")
        )
        .groupBy(F.trim("equipment_id").alias("equipment_id"))
        .agg(F.max(F.trim("line_name")).alias("line_name"))
    )
    return (
        maintenance.where(F.trim("order_type") == LOCKOUT_TYPE)
        .where(F.col("start_date").isNotNull())
        .select(
            F.trim("equipment_id").alias("equipment_id"), F.col("start_date").alias("lockout_date")
        )
        .distinct()
        .join(lines, "equipment_id")
        .select("line_name", "lockout_date")
        .distinct()
    )


def production_schedule(
    demand: DataFrame,
    lockouts: DataFrame,
    day: str,
    lines: Sequence[str],
    shifts: Sequence[str],
    rate: float,
) -> DataFrame:
    """Cut demand (product_id, qty, seq) into batches and deal them to lines.

    Batches walk the lines in turn, skipping lines locked on ``day``. The k-th
    batch of the whole plan has counter ``n = (k div U) * L + open[k mod U]``
    for L lines of which U are open; its line is ``n mod L``, its shift
    ``n mod S``. k comes from a running total over ``seq``. A product with many
    batches is listed in blocks that spread over tasks. With every line locked
    each product comes back as one unscheduled row.
    """
    if rate <= 0:
        raise ValueError("rate must be positive")
    names = F.array(*[F.lit(x) for x in lines])
    # At most len(lines) rows reach this aggregate, whatever the maintenance table holds.
    locked = (
        lockouts.where(F.col("lockout_date") == F.lit(day).cast("date"))
        .where(F.col("line_name").isin(*lines))
        .agg(F.collect_set("line_name").alias("l"))
        .scalar()
    )
    positions = F.array(*[F.lit(i).cast("bigint") for i in range(len(lines))])
    open_lines = F.filter(
        positions, lambda i: ~F.array_contains(F.col("_locked"), names[i.cast("int")])
    )
    n_lines = len(lines)
    wanted = demand.where(F.col("qty") > 0)
    n_batches = F.ceil(F.col("qty") / F.lit(float(rate))).cast("bigint")
    counted = wanted.withColumn("_n", n_batches)
    placed = running_total(counted, F.col("_n"), [F.col("seq"), F.col("product_id")], "_end")
    last_block = F.floor((F.col("_n") - 1) / F.lit(BATCH_BLOCK)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    state = placed.withColumn("_locked", locked).withColumn("_open", open_lines)

    blocks = (
        state.where(F.size("_open") > 0)
        .withColumn("_block", F.explode(F.sequence(zero, last_block)))
        .repartition("product_id", "_block")
    )
    first = F.col("_block") * BATCH_BLOCK
    last = F.least(first + BATCH_BLOCK, F.col("_n")) - 1
    batches = blocks.withColumn("_b", F.explode(F.sequence(first, last)))
    k = F.col("_end") - F.col("_n") + F.col("_b")
    n_open = F.size("_open").cast("bigint")
    turn = F.element_at("_open", (F.pmod(k, n_open) + 1).cast("int"))
    n = F.floor(k / n_open).cast("bigint") * n_lines + turn
    shift_names = F.array(*[F.lit(x) for x in shifts])
    remainder = F.col("qty") - F.col("_b") * F.lit(float(rate))
    scheduled = batches.withColumn("_k", k).withColumn("_n_th", n).select(
        F.lit(day).cast("date").alias("production_date"),
        "product_id",
        F.element_at(names, (F.pmod(F.col("_n_th"), F.lit(n_lines)) + 1).cast("int")).alias(
            "assigned_line"
        ),
        F.element_at(
            shift_names, (F.pmod(F.col("_n_th"), F.lit(len(shifts))) + 1).cast("int")
        ).alias("shift_name"),
        round_half_up(F.least(remainder, F.lit(float(rate))), 4).alias("scheduled_qty"),
        F.col("_k").alias("batch_no"),
        F.lit("Ready for Execution (OEE Adjusted)").alias("status"),
    )
    unscheduled = state.where(F.size("_open") == 0).select(
        F.lit(day).cast("date").alias("production_date"),
        "product_id",
        F.lit(None).cast("string").alias("assigned_line"),
        F.lit(None).cast("string").alias("shift_name"),
        round_half_up(F.col("qty"), 4).alias("scheduled_qty"),
        F.lit(None).cast("bigint").alias("batch_no"),
        F.lit("Unscheduled: all lines locked").alias("status"),
    )
    return scheduled.unionByName(unscheduled)


def full_plan(
    demand: DataFrame,
    bom: DataFrame,
    materials: DataFrame,
    quotes: DataFrame,
    lockouts: DataFrame,
    day: str,
    settings: PlanSettings,
) -> dict[str, DataFrame]:
    """Net needs, procurement, schedule and their summary for a demand table."""
    demand = materialize(demand)  # read by needs, schedule and summary
    needs = net_requirements(demand, bom, materials, settings.safety_stock_pct)
    purchases = procurement_cheapest(needs, quotes, settings.max_lead_days)
    schedule = production_schedule(
        demand, lockouts, day, settings.lines, settings.shifts, settings.rate_per_shift
    )
    counts = [
        (demand, "total_fg_products"),
        (purchases, "total_rm_procured"),
        (schedule, "total_production_batches"),
    ]
    summary = demand.agg(F.count("*").alias(counts[0][1])).select(
        F.lit(day).cast("date").alias("planning_date"),
        counts[0][1],
        *[df.agg(F.count("*")).scalar().alias(name) for df, name in counts[1:]],
    )
    return {
        "net_requirements": needs,
        "procurement": purchases,
        "schedule": schedule,
        "summary": summary,
    }
