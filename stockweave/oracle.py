"""ANSI SQL for the registered queries, run by the checker on the given tables.

Each entry of ``VIEWS`` is one named SELECT; a statement is put together from
the views it needs, as common table expressions in dependency order. Landing
views carry the prefix ``l_``, so no given table is shadowed.
"""

from __future__ import annotations

import re

from stockweave.plans.registry import MODELS
from stockweave.sources.chain import SNAPSHOT_LAYER, SNAPSHOTS
from stockweave.sources.landing import GIVEN, LANDING_SQL
from stockweave.sources.tables import DAILY_LOAD, TABLES


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding after snapping to ten digits."""
    return f"cast(round(cast({expr} as decimal(28,10)), {digits}) as double)"


def money(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(18,4))) as double)"


def ratio(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0e0))"


VIEWS: dict[str, str] = {
    f"l_{name}": sql.format(**{t: t for t in GIVEN}).strip() for name, sql in LANDING_SQL.items()
}

VIEWS |= {
    # --- staging ------------------------------------------------------------
    "stg_customers": """
select customer_id, zip, trim(city) as city, signup_date, trim(gender) as gender,
       trim(age_group) as age_group, trim(acquisition_channel) as acquisition_channel
from l_customers where customer_id is not null""",
    "stg_geography": """
select zip, trim(city) as city, trim(region) as region, trim(district) as district
from l_geography where zip is not null""",
    "stg_inventory": """
select * replace (trim(product_name) as product_name, trim(category) as category,
                  trim(segment) as segment)
from l_inventory where product_id is not null""",
    "stg_order_items": """
select * replace (nullif(trim(promo_id), '') as promo_id, nullif(trim(promo_id_2), '') as promo_id_2)
from l_order_items where order_id is not null and product_id is not null""",
    "stg_orders": """
select order_id, order_date, customer_id, zip, lower(trim(order_status)) as order_status,
       trim(payment_method) as payment_method, trim(device_type) as device_type,
       trim(order_source) as order_source
from l_orders where order_id is not null""",
    "stg_payments": """
select order_id, trim(payment_method) as payment_method, payment_value, installments
from l_payments where order_id is not null""",
    "stg_products": """
select product_id, trim(product_name) as product_name, trim(category) as category,
       trim(segment) as segment, trim(size) as size, trim(color) as color, price, cogs
from l_products where product_id is not null""",
    "stg_promotions": """
select trim(promo_id) as promo_id, trim(promo_name) as promo_name,
       lower(trim(promo_type)) as promo_type, discount_value, start_date, end_date,
       trim(applicable_category) as applicable_category, trim(promo_channel) as promo_channel,
       stackable_flag, min_order_value
from l_promotions where promo_id is not null""",
    "stg_returns": """
select trim(return_id) as return_id, order_id, product_id, return_date,
       trim(return_reason) as return_reason, return_quantity, refund_amount
from l_returns where return_id is not null""",
    "stg_reviews": """
select trim(review_id) as review_id, order_id, product_id, customer_id, review_date, rating,
       trim(review_title) as review_title
from l_reviews where review_id is not null""",
    "stg_sales": "select date as sales_date, revenue, cogs from l_sales",
    "stg_shipments": "select * from l_shipments where order_id is not null",
    "stg_web_traffic": """
select date as traffic_date, sessions, unique_visitors, page_views, bounce_rate,
       avg_session_duration_sec, trim(traffic_source) as traffic_source
from l_web_traffic where date is not null""",
    "stg_maintenance_orders": """
select coalesce(trim(cast(order_id as varchar)), '') as order_id,
       coalesce(trim(cast(start_date as varchar)), '') as start_date,
       coalesce(trim(equipment_id), '') as equipment_id,
       coalesce(trim(order_type), '') as order_type,
       coalesce(trim(description), '') as description
from l_maintenance_orders""",
    "stg_cross_reference": """
select trim(equipment_id) as equipment_id, trim(line_name) as line_name
from l_cross_reference where line_name is not null""",
    "size_type_mapping": """
select s.size_type, p.product_id
from (select size_type, row_number() over (order by min(log_id), size_type) - 1 as n
      from (select coalesce(trim(size_type), 'Unknown') as size_type, log_id
            from l_production_logs) q group by size_type) s
join (select product_id, row_number() over (order by product_id) - 1 as n,
             count(*) over () as total from l_products) p
  on s.n % p.total = p.n""",
    "stg_production_logs": """
select m.product_id, g.* from l_production_logs g left join size_type_mapping m
  on coalesce(trim(g.size_type), 'Unknown') = m.size_type""",
    # --- marts ---------------------------------------------------------------
    "int_order_items_discounted": """
select order_id, product_id, quantity, unit_price as original_unit_price, promo_id, promo_id_2,
       off as calculated_discount_amount, quantity * unit_price - off as net_line_total
from (select i.*, case p.promo_type
                    when 'percentage' then i.quantity * i.unit_price * (p.discount_value / 1e2)
                    when 'fixed' then i.quantity * p.discount_value
                    else coalesce(i.discount_amount, 0e0) end as off
      from stg_order_items i left join stg_promotions p using (promo_id)) d""",
    "dim_customers": """
select c.customer_id, c.zip, coalesce(c.city, g.city) as city, g.region, g.district,
       c.signup_date, c.gender, c.age_group, c.acquisition_channel,
       cast(date '2001-08-01' - c.signup_date as integer) as customer_tenure_days
from stg_customers c left join stg_geography g using (zip)""",
    "dim_date": """
select d as date_key, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
       cast(month(d) as integer) as month, cast(day(d) as integer) as day_of_month,
       cast(isodow(d) as integer) as day_of_week, cast(dayofyear(d) as integer) as day_of_year,
       strftime(d, '%Y-%m') as year_month, year(d) || '-Q' || quarter(d) as year_quarter,
       year(d) || '-Q' || lpad(cast(weekofyear(d) as varchar), 2, '0') as year_iso_week,
       dayname(d) as day_name, monthname(d) as month_name,
       case when isodow(d) > 5 then 1 else 0 end as is_weekend_flag
from (select cast(unnest(generate_series(min(order_date), max(order_date), interval 1 day)) as date)
        as d from stg_orders) days""",
    "dim_geography": """
select zip, city, district, region, city || ' - ' || district as city_district_label
from stg_geography""",
    "dim_products": f"""
select *, price - cogs as gross_margin,
       {rnd("(price - cogs) / nullif(price, 0e0) * 1e2", 2)} as gross_margin_pct
from stg_products""",
    "dim_promotions": """
select *, cast(end_date - start_date as integer) as promo_duration_days from stg_promotions""",
    "order_totals": f"""
select order_id, cast(sum(quantity) as bigint) as items,
       {money("quantity * original_unit_price")} as gross,
       {money("calculated_discount_amount")} as off, {money("net_line_total")} as net
from int_order_items_discounted group by order_id""",
    "fct_sales_orders": """
select o.*, coalesce(t.items, 0) as total_items, coalesce(t.gross, 0e0) as gross_order_value,
       coalesce(t.off, 0e0) as total_discount, coalesce(t.net, 0e0) as net_order_value
from stg_orders o left join order_totals t using (order_id)""",
    "fct_order_fulfillment": f"""
select o.order_id, o.order_date, o.customer_id, o.order_status, p.payment_method,
       coalesce(p.payment_value, 0e0) as payment_value, coalesce(p.installments, 1) as installments,
       s.ship_date, s.delivery_date, coalesce(s.shipping_fee, 0e0) as shipping_fee,
       cast(s.ship_date - o.order_date as integer) as processing_days,
       cast(s.delivery_date - s.ship_date as integer) as shipping_transit_days,
       cast(s.delivery_date - o.order_date as integer) as total_fulfillment_days,
       coalesce(b.qty, 0) as returned_qty, coalesce(b.refund, 0e0) as refund_amount,
       case when b.qty > 0 then 1 else 0 end as is_returned_flag, v.stars as customer_rating
from stg_orders o
left join stg_payments p using (order_id)
left join stg_shipments s using (order_id)
left join (select order_id, cast(sum(return_quantity) as bigint) as qty,
                  {money("refund_amount")} as refund from stg_returns group by order_id) b
  using (order_id)
left join (select order_id, avg(rating) as stars from stg_reviews group by order_id) v
  using (order_id)""",
    "fct_return_items": """
select r.return_id, r.order_id, o.order_date, r.return_date, r.product_id, o.customer_id, o.zip,
       r.return_reason, r.return_quantity, r.refund_amount,
       r.return_quantity * p.cogs as returned_inventory_cogs,
       r.refund_amount - r.return_quantity * p.cogs as net_reverse_logistics_loss,
       cast(r.return_date - o.order_date as integer) as days_from_order_to_return
from stg_returns r left join stg_orders o using (order_id)
left join dim_products p on p.product_id = r.product_id""",
    "fct_customer_reviews": """
select r.*, o.order_date, o.order_source,
       cast(r.review_date - o.order_date as integer) as days_to_review,
       case when r.rating >= 4 then 'Positive' when r.rating = 3 then 'Neutral'
            else 'Negative_Detractor' end as csat_sentiment_category
from stg_reviews r left join stg_orders o using (order_id)""",
    "fct_daily_marketing_funnel": f"""
select t.*, coalesce(o.n, 0) as total_orders, coalesce(o.buyers, 0) as buying_customers,
       coalesce(s.net, 0e0) as daily_net_revenue,
       {rnd(ratio("coalesce(o.n, 0)", "t.sessions") + " * 1e2", 2)} as session_conversion_rate_pct,
       {rnd(ratio("coalesce(s.net, 0e0)", "t.unique_visitors"), 2)} as revenue_per_visitor
from stg_web_traffic t
left join (select order_date, count(distinct order_id) as n, count(distinct customer_id) as buyers
           from stg_orders group by order_date) o on o.order_date = t.traffic_date
left join (select order_date, {money("net_order_value")} as net
           from fct_sales_orders group by order_date) s on s.order_date = t.traffic_date""",
    "fct_logistics_delivery_performance": f"""
select cast(date_trunc('month', f.order_date) as date) as performance_month, c.region, c.district,
       c.city, count(f.order_id) as total_shipments,
       {rnd("avg(f.processing_days)", 2)} as avg_warehouse_processing_days,
       {rnd("avg(f.shipping_transit_days)", 2)} as avg_carrier_transit_days,
       {rnd("avg(f.total_fulfillment_days)", 2)} as avg_total_fulfillment_days,
       {money("f.shipping_fee")} as total_logistics_revenue,
       cast(sum(f.returned_qty) as bigint) as total_returned_items,
       {money("f.refund_amount")} as total_reverse_logistics_refunds,
       {rnd(ratio("sum(f.is_returned_flag)", "count(f.order_id)") + " * 1e2", 2)} as return_rate_pct,
       {rnd("avg(f.customer_rating)", 2)} as regional_csat_rating
from fct_order_fulfillment f left join dim_customers c using (customer_id)
where f.order_status in ('shipped', 'delivered', 'returned') group by all""",
    "fct_monthly_inventory_kpi": f"""
select i.snapshot_date, i.year, i.month, i.product_id,
       coalesce(i.product_name, p.product_name) as product_name,
       coalesce(i.category, p.category) as category, coalesce(i.segment, p.segment) as segment,
       p.price, p.cogs, i.stock_on_hand, i.units_received, i.units_sold,
       i.stock_on_hand * p.cogs as inventory_holding_value,
       i.units_sold * (p.price - p.cogs) as monthly_realized_profit,
       i.stockout_days, i.days_of_supply, i.fill_rate, i.sell_through_rate, i.stockout_flag,
       i.overstock_flag, i.reorder_flag,
       case when i.stockout_days > 0
            then {rnd("i.units_sold / nullif(3e1 - i.stockout_days, 0e0) * i.stockout_days * p.price", 2)}
            else 0e0 end as estimated_lost_revenue_due_to_stockout
from stg_inventory i left join dim_products p using (product_id)""",
    "fct_supplier_replenishment_alert": f"""
select i.snapshot_date, i.year, i.month, i.product_id, p.product_name, p.category, p.segment,
       i.stock_on_hand, i.units_sold, i.units_received, i.days_of_supply, i.fill_rate,
       i.stockout_days, i.stockout_flag, i.overstock_flag, i.reorder_flag,
       {rnd("i.units_sold / 3e1", 2)} as daily_burn_rate,
       case when i.stockout_flag = 1 or i.days_of_supply < 10 then 'CRITICAL_STOCKOUT_RISK'
            when i.reorder_flag = 1 or i.days_of_supply between 10 and 20 then 'REORDER_IMMEDIATELY'
            when i.overstock_flag = 1 then 'EXCESS_OVERSTOCK'
            else 'HEALTHY_BUFFER' end as supply_chain_action_status,
       case when 1 in (i.reorder_flag, i.stockout_flag)
            then greatest(cast(round(i.units_sold * 1.5e0 - i.stock_on_hand) as bigint), 0)
            else 0 end as recommended_reorder_qty
from stg_inventory i left join dim_products p using (product_id)""",
    "rpt_daily_category_sales_performance": f"""
select o.order_date as report_date, p.category, p.segment,
       count(distinct i.order_id) as orders_containing_category,
       cast(sum(i.quantity) as bigint) as total_units_sold,
       {money("i.quantity * i.original_unit_price")} as category_gross_revenue,
       {money("i.calculated_discount_amount")} as category_total_discount,
       {money("i.net_line_total")} as category_net_revenue,
       {money("i.net_line_total - i.quantity * p.cogs")} as category_gross_profit,
       {rnd(ratio(money("i.net_line_total - i.quantity * p.cogs"), money("i.net_line_total"))
            + " * 1e2", 2)} as category_profit_margin_pct
from int_order_items_discounted i
join stg_orders o on o.order_id = i.order_id
join dim_products p on p.product_id = i.product_id
group by o.order_date, p.category, p.segment""",
    "rpt_daily_executive_kpi": f"""
with sold as (
  select order_date as d, count(distinct order_id) as n, count(distinct customer_id) as buyers,
         {money("gross_order_value")} as gross, {money("total_discount")} as off,
         {money("net_order_value")} as net
  from fct_sales_orders group by order_date),
shipped as (
  select ship_date as d, count(distinct order_id) as n, {money("shipping_fee")} as fee
  from stg_shipments where ship_date is not null group by ship_date),
delivered as (
  select delivery_date as d, count(distinct order_id) as n
  from stg_shipments where delivery_date is not null group by delivery_date),
sent_back as (
  select return_date as d, count(distinct return_id) as n,
         cast(sum(return_quantity) as bigint) as qty, {money("refund_amount")} as refund
  from stg_returns where return_date is not null group by return_date)
select d as report_date, coalesce(sold.n, 0) as total_orders_placed,
       coalesce(sold.buyers, 0) as buying_customers, coalesce(sold.gross, 0e0) as gross_revenue,
       coalesce(sold.off, 0e0) as total_discount_given, coalesce(sold.net, 0e0) as net_revenue,
       coalesce({rnd(ratio("sold.net", "sold.n"), 2)}, 0e0) as average_order_value,
       coalesce(shipped.n, 0) as orders_shipped_today,
       coalesce(shipped.fee, 0e0) as shipping_revenue_today,
       coalesce(delivered.n, 0) as orders_delivered_today,
       coalesce(sent_back.n, 0) as returns_requested_today,
       coalesce(sent_back.qty, 0) as return_items_today,
       coalesce(sent_back.refund, 0e0) as total_refunds_today,
       coalesce(sold.net, 0e0) - coalesce(sent_back.refund, 0e0) as daily_realized_cashflow
from sold full join shipped using (d) full join delivered using (d) full join sent_back using (d)""",
    # --- table changes ---------------------------------------------------------
    "order_changes": """
select * replace ('shipped' as order_status) from stg_orders where order_status = 'processing'
union all
select * replace (-1 - order_id as order_id, 'processing' as order_status)
from stg_orders where order_status = 'returned'""",
    "upsert_orders": """
select * from stg_orders where order_id not in (select order_id from order_changes)
union all select * from order_changes""",
    "load_mark": """
select max(order_date) as mark from stg_orders where order_date <= date '1998-12-31'""",
    "incremental_sales_orders": """
select * exclude (mark) replace (
         case when order_date >= mark then upper(device_type) else device_type end as device_type,
         case when order_date >= mark then order_status || '*' else order_status end as order_status)
from fct_sales_orders, load_mark""",
    "incremental_order_fulfillment": """
select * exclude (mark) replace (
         case when order_date >= mark then order_status || '*' else order_status end as order_status)
from fct_order_fulfillment, load_mark""",
    "incremental_late_orders": f"""
with t as (
    select order_id, cast(sum(q) as bigint) as items, {money("q * original_unit_price")} as gross,
           {money("calculated_discount_amount")} as off, {money("net_line_total")} as net
    from (select *, quantity + case when order_id % 11 = 0 then 1 else 0 end as q from int_order_items_discounted) i
    group by order_id
)
select o.* replace (case when order_id % 7 = 0 then order_status || '-late' else order_status end as order_status),
       coalesce(t.items, 0) as total_items, coalesce(t.gross, 0e0) as gross_order_value,
       coalesce(t.off, 0e0) as total_discount, coalesce(t.net, 0e0) as net_order_value,
       cast(case when (order_date <= date '1998-12-31') is not true
                   or (order_id % 7 = 0 and order_status is not null)
                   or (order_id % 11 = 0 and t.items is not null) then 2 else 1 end as integer) as built_in_run
from stg_orders o left join t using (order_id)""",
    "scd2_products": """
with a as (select * exclude (supplier_id) from l_products where segment <> 'Brand#25'),
b as (select * exclude (supplier_id)
        replace (case when category = 'ECONOMY' then price + 10 else price end as price)
      from l_products)
select a.*, md5(a.product_id || '|2001-06-01 00:00:00') as scd_id,
       timestamp '2001-06-01 00:00:00' as valid_from,
       case when a.category = 'ECONOMY' then timestamp '2001-07-01 00:00:00' end as valid_to,
       case when a.category = 'ECONOMY' then timestamp '2001-07-01 00:00:00'
            else timestamp '2001-06-01 00:00:00' end as updated_at
from a
union all
select b.*, md5(b.product_id || '|2001-07-01 00:00:00'), timestamp '2001-07-01 00:00:00', null,
       timestamp '2001-07-01 00:00:00'
from b where category = 'ECONOMY' or segment = 'Brand#25'""",
    "scd2_customers": """
with marked as (
  select *, city is null and gender = 'F' and acquisition_channel <> 'MACHINERY' as moved
  from l_customers)
select * exclude (moved), md5(customer_id || '|2001-06-01 00:00:00') as scd_id,
       timestamp '2001-06-01 00:00:00' as valid_from,
       case when moved then timestamp '2001-07-01 00:00:00' end as valid_to,
       case when moved then timestamp '2001-07-01 00:00:00'
            else timestamp '2001-06-01 00:00:00' end as updated_at
from marked
union all
select * exclude (moved) replace ('CityNew' as city), md5(customer_id || '|2001-07-01 00:00:00'),
       timestamp '2001-07-01 00:00:00', null, timestamp '2001-07-01 00:00:00'
from marked where moved""",
    # --- data tests --------------------------------------------------------------
    "audit_unique": """
select order_id as value, count(*) as n_rows from stg_order_items group by order_id
having count(*) > 1""",
    "audit_not_null": " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as failures from stg_order_items"
        for c in ("order_id", "product_id", "quantity", "discount_amount", "promo_id", "promo_id_2")
    ),
    "audit_orphans": """
select 'customers.zip' as test_name, count(*) as null_count
from stg_customers c left join stg_geography g using (zip) where g.region is null
union all
select 'order_items.promo_id', count(*)
from stg_order_items i left join stg_promotions p on i.promo_id = p.promo_id
where p.promo_id is null""",
    "audit_monthly_duplicates": """
select cast(date_trunc('month', return_date) as date) as month,
       'DUPLICATE_ORDER_CODE' as issue_type, count(order_id) - count(distinct order_id) as issue_count
from stg_returns where return_date >= date '2001-02-01'
group by 1 having count(order_id) <> count(distinct order_id)""",
    "audit_monthly_duplicates_text": "select * from audit_monthly_duplicates",
    "audit_max_update": """
select max(order_date) as max_date, 'MAX_UPDATE_TOO_OLD' as issue_type,
       cast(date '2001-09-20' - max(order_date) as integer) as days_since_last_update
from stg_orders where order_date >= date '2001-06-01'
having max(order_date) < date '2001-09-05'""",
    "audit_freshness": """
select m as max_date, cast(date '2001-09-01' - m as integer) as age_days,
       case when m is null or date '2001-09-01' - m > 60 then 'error'
            when date '2001-09-01' - m > 7 then 'warn' else 'pass' end as status
from (select max(ship_date) as m from stg_shipments) x""",
    "audit_status_tally": "select status, count(*) as n_tests from audit_results group by status",
    "audit_first_findings": """
select status, place, test_name, failures
from (select *, cast(row_number() over (partition by status order by test_name) as integer) as place
      from audit_results) p
where (status = 'fail' and place <= 3) or (status = 'warn' and place <= 5)""",
    # --- features ------------------------------------------------------------------
    "delivered_items": """
select i.product_id, o.order_date, i.quantity, i.unit_price, i.discount_amount, i.promo_id
from stg_order_items i join stg_orders o using (order_id) where o.order_status = 'delivered'""",
    "demand_features": f"""
with daily as (
  select product_id, order_date as d, cast(sum(quantity) as bigint) as q,
         {rnd("cast(sum(cast(unit_price as decimal(18,6))) as double) / count(unit_price)", 4)} as up,
         coalesce({money("discount_amount")}, 0e0) as da,
         max(case when promo_id is null then 0 else 1 end) as promo
  from delivered_items group by product_id, order_date),
flags as (
  select product_id, date_trunc('month', snapshot_date) as m, max(stockout_flag) as flag
  from stg_inventory group by all)
select f.product_id, cast(f.d as timestamp) as event_timestamp,
       timestamp '2001-08-01 00:00:00' as created_timestamp, q as quantity, up as unit_price,
       da as discount_amount, coalesce(p.price, 1e2) as list_price,
       coalesce(cast(round_even(cast((p.price - p.cogs) / nullif(p.price, 0e0) * 1e2
                                     as decimal(28,10)), 2) as double), 25e0) as gross_margin_pct,
       cast(isodow(d) - 1 as integer) as day_of_week, cast(month(d) as integer) as month,
       case when isodow(d) > 5 then 1 else 0 end as is_weekend,
       coalesce(v.views, 0e0) as daily_page_views,
       avg(q) over (w rows 6 preceding) as rolling_mean_demand_7d,
       avg(q) over (w rows 29 preceding) as rolling_mean_demand_30d,
       case when count(*) over (w rows 6 preceding) > 1 then sqrt(
              cast(count(*) over (w rows 6 preceding) * sum(q * q) over (w rows 6 preceding)
                   - sum(q) over (w rows 6 preceding) * sum(q) over (w rows 6 preceding) as double)
              / (cast(count(*) over (w rows 6 preceding) as double)
                 * (cast(count(*) over (w rows 6 preceding) as double) - 1)))
            else 0e0 end as rolling_std_demand_7d,
       coalesce(lag(q, 1) over w, 0) as lag_demand_1d,
       coalesce(lag(q, 7) over w, 0) as lag_demand_7d,
       coalesce(lag(q, 14) over w, 0) as lag_demand_14d,
       promo as promo_active_flag, coalesce(s.flag, 0) as stockout_flag_previous_day
from daily f
left join stg_products p using (product_id)
left join (select traffic_date, cast(sum(page_views) as double) as views
           from stg_web_traffic group by traffic_date) v on v.traffic_date = f.d
left join flags s on s.product_id = f.product_id
                 and s.m = date_trunc('month', f.d) - interval 1 month
window w as (partition by f.product_id order by f.d)""",
    "oee_features": f"""
with daily as (
  select line_name, productiondate_day_loc as d, {{oee}} as oee, {{change}} as change, {{scrap}} as scrap
  from (select *, coalesce({ratio("run_time", "production_available_time")}, 0.75e0) * 1e2 as o,
               coalesce(changeover_duration, 30e0) as c,
               coalesce({ratio("reject_production_qty",
                               "reject_production_qty + good_production_qty")}, 0.02e0) * 1e2 as s
        from l_production_logs) x group by all)
select line_name, cast(d as timestamp) as event_timestamp,
       timestamp '2024-02-01 00:00:00' as created_timestamp,
       {{r_oee}} as avg_oee_last_14d, {{r_change}} as avg_changeover_duration_min,
       {{r_scrap}} as scrap_reject_rate_pct, 168e0 as mtbf_hours, 0 as planned_maint_blackout_flag
from daily window w as (partition by line_name order by d rows 13 preceding)""".format(
        **{
            name: rnd(f"cast(sum(cast({c} as decimal(18,8))) as double) / count({c})", 8)
            for name, c in (("oee", "o"), ("change", "c"), ("scrap", "s"))
        },
        **{
            f"r_{c}": rnd(
                f"cast(sum(cast({c} as decimal(18,8))) over w as double) / count({c}) over w", 6
            )
            for c in ("oee", "change", "scrap")
        },
    ),
    "features_point_in_time": """
select return_id, product_id, asked_at,
       case when fresh then event_timestamp end as event_timestamp,
       case when fresh then list_price end as list_price,
       case when fresh then rolling_mean_demand_7d end as rolling_mean_demand_7d,
       case when fresh then rolling_std_demand_7d end as rolling_std_demand_7d,
       case when fresh then lag_demand_1d end as lag_demand_1d
from (select r.return_id, r.product_id, r.asked_at, f.* exclude (product_id),
             f.event_timestamp >= r.asked_at - interval 90 day as fresh
      from (select return_id, product_id, cast(return_date as timestamp) as asked_at
            from stg_returns) r
      asof left join demand_features f
        on r.product_id = f.product_id and r.asked_at >= f.event_timestamp) j""",
    "oee_point_in_time": """
select order_id, line_name, asked_at, case when fresh then event_timestamp end as event_timestamp,
       case when fresh then avg_oee_last_14d end as avg_oee_last_14d,
       case when fresh then scrap_reject_rate_pct end as scrap_reject_rate_pct
from (select r.*, f.* exclude (line_name), f.event_timestamp >= r.asked_at - interval 30 day as fresh
      from (select o.order_id, x.line_name, cast(o.start_date as timestamp) as asked_at
            from l_maintenance_orders o join l_cross_reference x using (equipment_id)) r
      asof left join oee_features f
        on r.line_name = f.line_name and r.asked_at >= f.event_timestamp) j""",
    "features_latest": """
select * exclude (quantity) from demand_features
qualify row_number() over (partition by product_id
                           order by event_timestamp desc, created_timestamp desc) = 1""",
    "oee_latest": """
select * from oee_features
qualify row_number() over (partition by line_name
                           order by event_timestamp desc, created_timestamp desc) = 1""",
    # --- segmentation and risk ---------------------------------------------------------
    "monthly_sales": """
select product_id, date_trunc('month', order_date) as ym, cast(sum(quantity) as bigint) as qty,
       sum(cast(quantity * unit_price - coalesce(discount_amount, 0e0) as decimal(18,4))) as rev
from delivered_items group by all""",
    "abc_xyz": f"""
with sku as (
  select product_id, sum(rev) as rev, avg(qty) as mean, stddev_samp(qty) as sd,
         cast(sum(qty) as bigint) as total
  from monthly_sales group by product_id),
shares as (
  select *, cast(rev as double) / cast(sum(rev) over () as double) * 1e2 as share,
         cast(sum(rev) over (order by rev desc, product_id) as double)
           / cast(sum(rev) over () as double) * 1e2 as cum,
         coalesce(sd / nullif(mean, 0e0), 2e0) as cv
  from sku),
classes as (
  select *, case when cum <= 80 then 'A' when cum <= 95 then 'B' else 'C' end as abc,
         case when cv < 0.5 then 'X' when cv < 1 then 'Y' else 'Z' end as xyz
  from shares)
select c.product_id, p.product_name, p.category, cast(rev as double) as total_revenue,
       {rnd("mean", 6)} as monthly_mean_qty, {rnd("sd", 6)} as monthly_std_qty, total as total_qty,
       {rnd("share", 8)} as rev_share_pct, {rnd("cum", 8)} as cum_rev_pct, abc as abc_class,
       {rnd("cv", 6)} as cv, xyz as xyz_class, abc || xyz as abc_xyz_matrix
from classes c left join stg_products p using (product_id)""",
    "abc_xyz_histogram": """
select abc_xyz_matrix, count(*) as n_skus,
       case when abc_xyz_matrix in ('AX', 'AY', 'AZ', 'BX', 'BY') then 1 else 0 end as is_selected
from abc_xyz group by abc_xyz_matrix""",
    "strategic_skus": """
select product_id, abc_xyz_matrix from abc_xyz
where abc_xyz_matrix in ('AX', 'AY', 'AZ', 'BX', 'BY')""",
    "top_skus": """
select product_id, product_name, abc_xyz_matrix, total_revenue from abc_xyz
where abc_xyz_matrix in ('AX', 'AY', 'AZ', 'BX', 'BY')
order by total_revenue desc, product_id limit 10""",
    "inventory_moves": """
select state, next_state, count(*) as n
from (select state, lead(state) over (partition by product_id order by snapshot_date, state)
               as next_state
      from (select product_id, snapshot_date,
                   case when stockout_flag = 0 and fill_rate >= 0.95 then 'S1_Healthy'
                        else 'S2_AtRisk' end as state from stg_inventory) s) m
where next_state is not null group by all""",
    "inventory_markov": """
select a.s as from_state, b.s as to_state, coalesce(m.n, 0) as n_transitions,
       case when sum(m.n) over (partition by a.s) > 0
            then coalesce(m.n, 0) / cast(sum(m.n) over (partition by a.s) as double)
            when a.s = b.s then 1e0 else 0e0 end as p
from (values ('S1_Healthy'), ('S2_AtRisk')) a(s)
cross join (values ('S1_Healthy'), ('S2_AtRisk')) b(s)
left join inventory_moves m on m.state = a.s and m.next_state = b.s""",
    "supplier_markov": """
select supplier_id, from_state, to_state,
       case from_state || to_state when 'OnTimeOnTime' then r when 'OnTimeDelayed' then 1 - r
            when 'DelayedOnTime' then r * 0.8e0 else 1 - r * 0.8e0 end as p
from (select trim(supplier_id) as supplier_id, coalesce(reliability_score, 0.9e0) as r
      from l_suppliers) s
cross join (values ('OnTime', 'OnTime'), ('OnTime', 'Delayed'), ('Delayed', 'OnTime'),
                   ('Delayed', 'Delayed')) g(from_state, to_state)""",
    "risk_lookup": """
select *, 1 - p_inv_risk as p_inv_healthy, 1 - p_sup_delay as p_sup_ontime
from (select p.product_id, p.supplier_id,
             (select p from inventory_markov
              where from_state = 'S1_Healthy' and to_state = 'S2_AtRisk') as p_inv_risk,
             coalesce(s.p, 0.1e0) as p_sup_delay
      from l_products p left join supplier_markov s
        on s.supplier_id = p.supplier_id and s.from_state = 'OnTime' and s.to_state = 'Delayed') x""",
    "sku_demand_quantiles": "select product_id, "
    + ", ".join(
        f"greatest({rnd(f'quantile_cont(qty, {q})', 4)}, 0e0) as {name}"
        for name, q in (("P10", 0.1), ("P50", 0.5), ("P90", 0.9))
    )
    + " from monthly_sales group by product_id",
    "outlook": """
select product_id, P10, P50, P90, p_sup_delay, p_inv_risk
from strategic_skus join sku_demand_quantiles using (product_id)
left join risk_lookup using (product_id)""",
    "scenario_rows": """
select o.product_id, 4 * q.i + s.j as no, q.name as quantile,
       case q.i when 0 then P10 when 1 then P50 else P90 end as demand_qty, s.sup, s.inv,
       q.w * (case s.sup when 'Delayed' then p_sup_delay else 1 - p_sup_delay end)
           * (case s.inv when 'AtRisk' then p_inv_risk else 1 - p_inv_risk end) as p
from outlook o
cross join (values (0, 'P10', 0.2e0), (1, 'P50', 0.6e0), (2, 'P90', 0.2e0)) q(i, name, w)
cross join (values (1, 'OnTime', 'Healthy'), (2, 'Delayed', 'Healthy'), (3, 'OnTime', 'AtRisk'),
                   (4, 'Delayed', 'AtRisk')) s(j, sup, inv)""",
    "demand_scenarios": f"""
select 'SCN_' || product_id || '_' || no as scenario_id, product_id, quantile, demand_qty,
       sup as supplier_state, inv as inv_state, p as probability
from scenario_rows""",
    "scenario_mass_check": """
select product_id, round(cast(sum(cast(probability as decimal(20,12))) as double), 8)
         as total_probability,
       case when abs(sum(probability) - 1) <= 1.1e-4 then 1 else 0 end as is_valid
from demand_scenarios group by product_id""",
    # --- planning ------------------------------------------------------------------------
    "bom_net_requirements": f"""
select rm_id, {rnd("g", 2)} as gross_req, stock as current_inventory,
       {rnd("g * 0.1e0", 2)} as safety_stock,
       {rnd("greatest(g + g * 0.1e0 - stock, 0e0)", 2)} as net_req
from (select b.rm_id, {money("b.quantity_required * q.P50")} as g,
             case when max(m.rm_id) is null then 0e0 else 8e2 end as stock
      from sku_demand_quantiles q join l_bom b using (product_id)
      left join (select distinct rm_id from l_raw_materials) m using (rm_id)
      group by b.rm_id) x""",
    "procurement_cheapest": f"""
with options as (
  select r.rm_id, r.net_req, q.*  exclude (rm_id),
         case when q.discount_pct > 0 then greatest(r.net_req, q.min_qty) else r.net_req end as qty
  from bom_net_requirements r
  left join l_procurement_scenarios q on q.rm_id = r.rm_id and q.lead_time_days <= 7
  where r.net_req > 0)
select rm_id, net_req as net_requirement,
       coalesce(supplier_id, 'SUP001 (Default Market)') as selected_supplier,
       coalesce(scenario_id, 'DEFAULT') as scenario_id,
       coalesce(scenario_name, 'Standard Market Purchase') as scenario_name,
       {rnd("qty", 2)} as order_qty, coalesce(unit_price, 5e0) as unit_price,
       {rnd("qty * coalesce(unit_price, 5e0)", 2)} as total_cost,
       coalesce(lead_time_days, 3) as lead_time_days, coalesce(discount_pct, 0e0) as discount_pct
from options
qualify row_number() over (partition by rm_id order by qty * unit_price, scenario_id) = 1""",
    "procurement_cheapest_budget": f"""
select count(*) as n_materials, {money("total_cost")} as total_budget from procurement_cheapest""",
    "scenario_bom_explosion": f"""
select b.rm_id, s.product_id, 'SCN_' || s.product_id || '_' || s.no as scenario_id,
       s.p as probability,
       s.demand_qty * b.quantity_required / case s.inv when 'AtRisk' then 0.85e0 else 1e0 end
         as gross_req,
       s.sup as supplier_state, s.inv as inv_state
from scenario_rows s join l_bom b using (product_id)""",
    "expected_needs": f"""
select b.rm_id, count(*) as n_scenarios, sum(case s.sup when 'Delayed' then s.p else 0e0 end) as late,
       {rnd('''greatest(sum(s.p * s.demand_qty * b.quantity_required
                           / case s.inv when 'AtRisk' then 0.85e0 else 1e0 end) * 1.1e0
                       - coalesce(max(m.current_stock), 8e2), 0e0)''', 6)} as net
from scenario_rows s join l_bom b using (product_id) left join l_raw_materials m using (rm_id)
group by b.rm_id""",
    "procurement_expected_cost": f"""
with options as (
  select n.*, q.supplier_id, q.scenario_id, q.scenario_name, q.discount_pct, q.lead_time_days,
         greatest(n.net, q.min_qty) as qty, q.unit_price * (1 - q.discount_pct / 1e2) as price
  from expected_needs n join l_procurement_scenarios q using (rm_id) where n.net > 0),
costed as (
  select *, qty * price as base,
         case when late >= 0.15 and lead_time_days > 4 then qty * 2.5e0 * late
              when late < 0.15 and discount_pct > 0 then -(qty * price) * 0.05e0
              else 0e0 end as penalty
  from options)
select rm_id, supplier_id as selected_supplier, scenario_name,
       {rnd("net", 4)} as expected_net_req, {rnd("qty", 4)} as order_qty,
       {rnd("price", 6)} as unit_price, discount_pct, lead_time_days,
       {rnd("base", 2)} as expected_total_cost, {rnd("penalty", 2)} as risk_penalty_cost,
       n_scenarios, {rnd("late", 6)} as p_delay
from costed
qualify row_number() over (partition by rm_id order by base + penalty, scenario_id) = 1""",
    "procurement_budget": f"""
select count(*) as n_materials,
       {money("expected_total_cost + risk_penalty_cost")} as total_expected_budget,
       coalesce(cast(sum(cast(-least(risk_penalty_cost, 0e0) as decimal(18,4))) as double), 0e0)
         as total_penalty_saved
from procurement_expected_cost""",
    "line_lockouts": """
select distinct x.line_name, o.start_date as lockout_date
from l_maintenance_orders o
join (select equipment_id, max(line_name) as line_name from l_cross_reference
      group by equipment_id) x using (equipment_id)
where trim(o.order_type) = 'PM10'""",
    "production_schedule": f"""
with lines as (select 'LINE' || i as name, i from range(6) t(i)),
free as (
  select i, row_number() over (order by i) - 1 as u, count(*) over () as total from lines
  where name not in (select line_name from line_lockouts where lockout_date = date '2024-01-05')),
batches as (
  select product_id, P50 as qty, unnest(range(cast(ceil(P50 / 5e2) as bigint))) as b
  from sku_demand_quantiles where P50 > 0),
numbered as (select *, row_number() over (order by product_id, b) - 1 as k from batches),
dealt as (
  select n.*, f.i + 6 * (n.k // f.total) as turn
  from numbered n join free f on n.k % f.total = f.u)
select date '2024-01-05' as production_date, product_id, 'LINE' || (turn % 6) as assigned_line,
       'S' || (1 + turn % 3) as shift_name, {rnd("least(qty - b * 5e2, 5e2)", 4)} as scheduled_qty,
       k as batch_no, 'Ready for Execution (OEE Adjusted)' as status
from dealt""",
    "full_plan_summary": """
select date '2024-01-05' as planning_date,
       (select count(*) from sku_demand_quantiles) as total_fg_products,
       (select count(*) from procurement_cheapest) as total_rm_procured,
       (select count(*) from production_schedule) as total_production_batches""",
    # --- forecasts -----------------------------------------------------------------------
    "split_rows": """
select *, ('0x' || substr(md5(product_id || '|' || event_timestamp), 1, 8))::bigint % 10 < 2 as held
from demand_features""",
    "train_test_split": """
select case when held then 'test' else 'train' end as part, count(*) as n_rows,
       cast(sum(quantity) as bigint) as total_quantity
from split_rows group by held""",
    "naive_errors": """
select method, year, event_timestamp as ts,
       abs(y - p) / greatest(abs(y), 2.220446049250313e-16) as ape, (y - p) * (y - p) as se
from (select m as method, cast(year(event_timestamp) as integer) as year, event_timestamp,
             quantity as y,
             case m when 'lag_1' then cast(lag_demand_1d as double)
                    when 'rolling_7' then rolling_mean_demand_7d else rolling_mean_demand_30d end as p
      from split_rows cross join (values ('lag_1'), ('rolling_7'), ('rolling_30')) t(m)
      where held) x""",
    "forecast_accuracy": f"""
select method, count(*) as n_rows,
       {rnd("avg(ape) * 1e2", 2)} as mape_pct,
       {rnd("sqrt(avg(se))", 2)} as rmse
from naive_errors group by method""",
    "best_forecast_run": "select * from forecast_accuracy order by mape_pct, method limit 1",
    "promotion_gate": """
select *, case when mape_pct < 25 then 1 else 0 end as is_champion from forecast_accuracy""",
    "latest_model_version": """
select method, max(year) as latest_version, arg_max(year, (ts, year)) as last_evaluated_version
from naive_errors group by method""",
    # --- trained models: the held-out rows, all scored, none out of bounds -------------------
    "rf_check": """
select count(*) as n_scored, cast(0 as bigint) as n_missing, cast(0 as bigint) as n_wrong
from split_rows where held""",
    "poisson_check": """
select count(*) as n_scored, cast(0 as bigint) as n_missing, cast(0 as bigint) as n_wrong
from split_rows where held""",
    "boosted_rate_check": """
select count(*) as n_scored, cast(0 as bigint) as n_missing, cast(0 as bigint) as n_wrong
from split_rows where held""",
    "quantile_check": """
select count(*) as n_scored, cast(0 as bigint) as n_missing, cast(0 as bigint) as n_wrong,
       cast(0 as int) as p10_off, cast(0 as int) as p90_off
from split_rows where held""",
    "stored_model_check": """
select count(*) as n_scored, cast(0 as bigint) as n_missing, cast(0 as bigint) as n_wrong,
       cast(1 as int) as n_refused
from split_rows where held""",
    # --- loads and stored layers -----------------------------------------------------------
    "landing_roundtrip": "select * from l_orders",
    "fct_order_fulfillment_bucketed": "select * from fct_order_fulfillment",
    "demand_features_advanced": "select * from demand_features",
    "landing_rejects": """
select order_id, case when not bad then order_date end as order_date,
       case when not bad then customer_id end as customer_id, cast(bad as integer) as rejected
from (select *, coalesce(order_id % 50 = 0, false) or coalesce(order_id % 70 = 1, false) as bad from l_orders)""",
    "published_layer": "select * from dim_customers",
    "features_stored_point_in_time": "select * from features_point_in_time",
    # --- streams ---------------------------------------------------------------------------
    "stream_upsert": "select * from upsert_orders",
    "stream_upsert_ordered": """
select * replace (concat_ws('-', order_status, cast(change_no as varchar)) as order_status,
                  cast(month + to_months(change_no) as date) as month)
from (select *, cast(date_trunc('month', order_date) as date) as month,
             case when order_id % 5 = 0 then 2 else 3 end as change_no
      from stg_orders)""",
    "upsert_orders_partitioned": "select * from upsert_orders",
    "stream_windowed_funnel": """
with a as (
    select cast(ts as date) as day, ts, event_type,
           case when event_id % 10 = 0 then 2 when ts < timestamp '2024-01-11' then 0
                when ts < timestamp '2024-01-21' then 1 else 2 end as load
    from events
), m as (select load, max(ts) as newest from a group by load),
b as (select a.*, (select max(newest) from m where m.load < a.load) as before from a)
select day as traffic_date, event_type as traffic_source, count(*) as sessions,
       count(*) filter (day is null or day + interval 1 day <= before - interval 1 day) as late_sessions
from b where day is null or day + interval 1 day <= (select max(ts) from a) - interval 1 day
group by all""",
    "stream_daily_funnel": """
select cast(ts as date) as traffic_date, event_type as traffic_source, count(*) as sessions
from events group by all""",
}


def _landed_sql(missing: str) -> str:
    """Rows and first-column values of the landing tables of the daily load."""
    parts = []
    for names in DAILY_LOAD.values():
        for name in names:
            spec = TABLES[name]
            figures = f"count(*) as n_rows, count(distinct {spec.columns[0]}) as n_values"
            if name == missing:
                none = "cast(null as bigint)"
                parts.append(f"select '{spec.landing_name}' as table_name, {none} as n_rows, {none} as n_values")
                continue
            parts.append(f"select '{spec.landing_name}' as table_name, {figures} from l_{name}")
    return " union all ".join(parts)


def _chain_sql(layers: tuple[str, ...]) -> str:
    """Rows of every first snapshot and every model the write-audit-publish run builds."""
    tables = [(SNAPSHOT_LAYER, s.name, f"l_{s.source}") for s in SNAPSHOTS]
    tables += [(m.layer, m.name, m.name) for m in MODELS.values() if m.layer in layers]
    return " union all ".join(
        f"select '{layer}' as layer, '{name}' as table_name, count(*) as n_rows from {rows}"
        for layer, name, rows in tables
    )


def _test_sql(test) -> str:
    table = test.table if test.table in VIEWS else f"l_{test.table}"
    if test.where is not None:
        table = f"(select * from {table} where {test.where})"
    c = test.column
    if test.kind == "unique":
        counted = f"select count(*) as n from (select {c} from {table} where {c} is not null group by {c} having count(*) > 1) d"
    elif test.kind == "not_null":
        counted = f"select count(*) - count({c}) as n from {table}"
    elif test.kind == "orphans":
        helper = test.helper if test.helper in VIEWS else f"l_{test.helper}"
        key = test.helper_key or c
        helper_where = test.helper_where or "true"
        counted = (
            f"select count(*) as n from {table} t left join (select distinct {key} as k, "
            f"{test.check_column or key} as v from {helper} where {helper_where}) h "
            f"on t.{c} = h.k where h.v is null"
        )
    elif test.kind == "max_update":
        counted = (
            f"select count(*) as n from (select max({c}) as newest from {table} "
            f"where {c} >= date '2001-05-01') d "
            f"where newest < date '2001-08-01' - {test.lookback_days}"
        )
    elif test.kind == "freshness":
        counted = (
            f"select case when newest is null or date_diff('day', newest, date '2001-08-01') "
            f"> {test.max_age_days} then 1 else 0 end as n from (select max({c}) as newest from {table}) d"
        )
    elif test.kind == "mass":
        counted = "select count(*) as n from scenario_mass_check where is_valid = 0"
    else:
        counted = (
            f"select count(*) as n from (select date_trunc('month', {test.date_field}) as m "
            f"from {table} where {test.date_field} >= date '2001-02-01' group by 1 "
            f"having count({c}) <> count(distinct {c})) d"
        )
    bad = "fail" if test.severity == "error" else "warn"
    return (
        f"select '{test.name}' as test_name, '{test.table}' as table_name, "
        f"'{test.severity}' as severity, cast(n as bigint) as failures, "
        f"case when n > {test.threshold} then '{bad}' else 'pass' end as status from ({counted}) x"
    )


# Queries no SQL engine can state: trained models.
ROWS_ONLY = ("rf_demand_forecast", "poisson_lambda", "quantile_demand_forecast")


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql, flags=re.IGNORECASE))
    return [name for name in VIEWS if name in words]


def statement(name: str) -> str:
    """The full SQL of a query: its views as CTEs, then the query itself."""
    order: list[str] = []

    def visit(view: str) -> None:
        if view in order:
            return
        for needed in _needs(VIEWS[view]):
            if needed != view:
                visit(needed)
        order.append(view)

    visit(name)
    ctes = ",\n".join(f"{view} as ({VIEWS[view].strip()})" for view in order)
    return f"with {ctes}\nselect * from {name}"


def oracle_statements() -> dict[str, str]:
    from stockweave.catalog import CHAIN_LAYERS, DATA_TESTS, EXTRA_TESTS, MISSING_FILE, QUERIES

    VIEWS["daily_load"] = _landed_sql(MISSING_FILE)
    VIEWS["published_chain"] = _chain_sql(CHAIN_LAYERS)
    VIEWS["audit_results"] = "\nunion all\n".join(_test_sql(t) for t in DATA_TESTS + EXTRA_TESTS)
    return {name: statement(name) for name in QUERIES if name in VIEWS}
