"""Markov risk matrices, risk lookup and probability-weighted demand scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.plans.registry import model

HEALTHY, AT_RISK = "S1_Healthy", "S2_AtRisk"
ON_TIME, DELAYED = "OnTime", "Delayed"

# The matrix without any history, and the risks without a match.
THEORETICAL = {
    (HEALTHY, HEALTHY): 0.85,
    (HEALTHY, AT_RISK): 0.15,
    (AT_RISK, HEALTHY): 0.60,
    (AT_RISK, AT_RISK): 0.40,
}
# A state never left: healthy stays healthy, at risk stays at risk.
ABSORBING = {
    (HEALTHY, HEALTHY): 1.0,
    (HEALTHY, AT_RISK): 0.0,
    (AT_RISK, HEALTHY): 0.0,
    (AT_RISK, AT_RISK): 1.0,
}
DEFAULT_RELIABILITY = 0.90
DEFAULT_INVENTORY_RISK = 0.15
DEFAULT_SUPPLIER_DELAY = 0.10
QUANTILE_WEIGHTS = {"P10": 0.20, "P50": 0.60, "P90": 0.20}


def transition_counts(inventory: DataFrame) -> DataFrame:
    """Counts of the four moves between consecutive snapshots of a product.

    Snapshots are first counted per (product, date) and state, healthy before
    at risk on one date. Moves inside a date follow from those counts; only one
    row per date enters the window that looks at the next date.
    """
    healthy = F.coalesce(
        (F.col("stockout_flag") == 0) & (F.col("fill_rate") >= 0.95), F.lit(False)
    )
    dated = inventory.groupBy("product_id", "snapshot_date").agg(
        F.count_if(healthy).alias("h"), F.count_if(~healthy).alias("r")
    )
    order = Window.partitionBy("product_id").orderBy("snapshot_date")
    last_healthy = F.col("r") == 0
    next_healthy = F.lead(F.col("h") > 0).over(order)
    moves = dated.select("h", "r", last_healthy.alias("last"), next_healthy.alias("next"))
    both = (F.col("h") > 0) & (F.col("r") > 0)
    return moves.agg(
        F.sum(F.greatest(F.col("h") - 1, F.lit(0))).alias("hh_in"),
        F.count_if(both).alias("hr_in"),
        F.sum(F.greatest(F.col("r") - 1, F.lit(0))).alias("rr_in"),
        F.count_if(F.col("last") & F.col("next")).alias("hh"),
        F.count_if(F.col("last") & ~F.col("next")).alias("hr"),
        F.count_if(~F.col("last") & F.col("next")).alias("rh"),
        F.count_if(~F.col("last") & ~F.col("next")).alias("rr"),
        F.count("*").alias("seen"),
    ).select(
        (F.col("hh") + F.coalesce("hh_in", F.lit(0))).alias("hh"),
        (F.col("hr") + F.col("hr_in")).alias("hr"),
        "rh",
        (F.col("rr") + F.coalesce("rr_in", F.lit(0))).alias("rr"),
        "seen",
    )


@model("risk", "stg_inventory")
def inventory_markov(inventory: DataFrame) -> DataFrame:
    """The 2x2 inventory state matrix in long form, with the counts behind it."""
    counts = {
        (HEALTHY, HEALTHY): ("hh", "hh + hr"),
        (HEALTHY, AT_RISK): ("hr", "hh + hr"),
        (AT_RISK, HEALTHY): ("rh", "rh + rr"),
        (AT_RISK, AT_RISK): ("rr", "rh + rr"),
    }
    cells = ", ".join(
        f"'{a}', '{b}', {n}, case when seen = 0 then {THEORETICAL[a, b]}D "
        f"when {out} = 0 then {ABSORBING[a, b]}D else {n} / cast({out} as double) end"
        for (a, b), (n, out) in counts.items()
    )
    return transition_counts(inventory).selectExpr(
        f"stack(4, {cells}) as (from_state, to_state, n_transitions, p)"
    )


@model("risk", "suppliers")
def supplier_markov(suppliers: DataFrame) -> DataFrame:
    """On-time / delayed matrix per supplier; a delay makes the next one likelier."""
    r = f"coalesce(reliability_score, {DEFAULT_RELIABILITY}D)"
    cells = {
        (ON_TIME, ON_TIME): r,
        (ON_TIME, DELAYED): f"1D - {r}",
        (DELAYED, ON_TIME): f"{r} * 0.8D",
        (DELAYED, DELAYED): f"1D - {r} * 0.8D",
    }
    rows = ", ".join(f"'{a}', '{b}', {p}" for (a, b), p in cells.items())
    return suppliers.selectExpr(
        "trim(supplier_id) as supplier_id", f"stack(4, {rows}) as (from_state, to_state, p)"
    )


def inventory_risk(matrix: DataFrame, state: str = HEALTHY) -> Column:
    """P(state -> at risk) as a scalar subquery; NULL when the state is unknown."""
    cell = matrix.where((F.col("from_state") == state) & (F.col("to_state") == AT_RISK))
    return cell.agg(F.max("p")).scalar()


def risk_lookup(
    sku_supplier: DataFrame, inventory_matrix: DataFrame, supplier_matrix: DataFrame, state=HEALTHY
) -> DataFrame:
    """Next-period risks per product, from its supplier and the inventory state."""
    delays = supplier_matrix.where(
        (F.col("from_state") == ON_TIME) & (F.col("to_state") == DELAYED)
    ).select("supplier_id", F.col("p").alias("_delay"))
    risk = F.coalesce(inventory_risk(inventory_matrix, state), F.lit(DEFAULT_INVENTORY_RISK))
    delay = F.coalesce("_delay", F.lit(DEFAULT_SUPPLIER_DELAY))
    return sku_supplier.join(delays, "supplier_id", "left").select(
        "product_id",
        "supplier_id",
        risk.alias("p_inv_risk"),
        delay.alias("p_sup_delay"),
        (1.0 - risk).alias("p_inv_healthy"),
        (1.0 - delay).alias("p_sup_ontime"),
    )


def scenario_array() -> Column:
    """The twelve scenarios of a row with P10, P50, P90, p_sup_delay, p_inv_risk.

    Order within a quantile: on time/healthy, delayed/healthy, on time/at risk,
    delayed/at risk. A literal array beside each product replaces a product
    with a grid table: no join, no shuffle.
    """
    delay = f"coalesce(p_sup_delay, {DEFAULT_SUPPLIER_DELAY}D)"
    risk = f"coalesce(p_inv_risk, {DEFAULT_INVENTORY_RISK}D)"
    supplier = {"OnTime": f"(1D - {delay})", "Delayed": delay}
    stock = {"Healthy": f"(1D - {risk})", "AtRisk": risk}
    cases = [
        (quantile, weight, s, i)
        for quantile, weight in QUANTILE_WEIGHTS.items()
        for i in stock
        for s in supplier
    ]
    rows = ", ".join(
        f"named_struct('scenario_no', {no}, 'quantile', '{quantile}', "
        f"'demand_qty', coalesce({quantile}, 0D), 'supplier_state', '{s}', 'inv_state', '{i}', "
        f"'probability', {weight}D * {supplier[s]} * {stock[i]})"
        for no, (quantile, weight, s, i) in enumerate(cases, start=1)
    )
    return F.expr(f"array({rows})")


def demand_scenarios(outlook: DataFrame) -> DataFrame:
    """Twelve rows per product of ``outlook`` (product_id, P10, P50, P90, risks)."""
    return outlook.select("product_id", F.explode(scenario_array()).alias("s")).select(
        F.concat_ws("_", F.lit("SCN"), F.col("product_id"), F.col("s.scenario_no")).alias(
            "scenario_id"
        ),
        "product_id",
        "s.quantile",
        "s.demand_qty",
        "s.supplier_state",
        "s.inv_state",
        "s.probability",
    )
