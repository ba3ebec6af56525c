"""Landing adapters: the given tables, re-expressed as the declared source tables.

Each statement reads its whole input tables and only uses integer arithmetic,
exact decimal sums and functions that any ANSI engine shares, so the same text
serves Spark and the SQL check. ``{orders}`` and the like are the given tables.
Dirt is deliberate: padded and mixed-case codes, blank and unknown promo ids,
an unknown zip, NULL cities, unpaid and undelivered orders, NULL scores and
stock, materials without quotes.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stockweave.session import changed_at

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


LANDING_SQL: dict[str, str] = {
    "products": """
select p_partkey as product_id, ' ' || p_name || ' ' as product_name, p_type as category,
       p_brand as segment, cast(p_size as string) as size, split_part(p_name, ' ', 1) as color,
       p_retailprice as price, p_retailprice * ((50 + p_partkey % 30) / 1e2) as cogs,
       'SUP' || lpad(cast(p_partkey % 10 as string), 5, '0') as supplier_id
from {part}""",
    "geography": """
select n_nationkey as zip, n_name as city, r_name as region,
       r_name || '-D' || cast(n_nationkey % 3 as string) as district
from {nation} join {region} on n_regionkey = r_regionkey""",
    "customers": """
select c_custkey as customer_id,
       case when c_custkey % 97 = 5 then 999 else c_nationkey end as zip,
       case when c_custkey % 3 = 0 then null else 'City' || cast(c_custkey % 40 as string) end as city,
       date '1994-01-01' + cast(c_custkey % 365 as int) as signup_date,
       case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       case c_custkey % 4 when 0 then '18-24' when 1 then '25-34' when 2 then '35-44'
                          else '45+' end as age_group,
       c_mktsegment as acquisition_channel
from {customer}""",
    "promotions": """
select 'PROMO-' || cast(s_suppkey as string) as promo_id, s_name as promo_name,
       case when s_suppkey % 3 = 0 then ' Fixed' else 'PERCENTAGE ' end as promo_type,
       case when s_suppkey % 3 = 0 then 5e0 else 10e0 + s_suppkey % 10 end as discount_value,
       date '1995-01-01' + cast(s_suppkey * 3 as int) as start_date,
       date '1995-01-01' + cast(s_suppkey * 3 + 14 + s_suppkey % 5 as int) as end_date,
       'ALL' as applicable_category, 'online' as promo_channel,
       cast(s_suppkey % 2 as int) as stackable_flag, 100e0 as min_order_value
from {supplier} where s_acctbal > 0""",
    "orders": """
select o_orderkey as order_id, cast(o_orderdate as date) as order_date, o_custkey as customer_id,
       case when o_custkey % 97 = 5 then 999 else cast(o_custkey % 25 as int) end as zip,
       case when o_orderstatus = 'F' then 'Delivered ' when o_orderstatus = 'O' then ' SHIPPED'
            when o_orderpriority in ('1-URGENT', '2-HIGH') then 'returned'
            when o_orderpriority = '3-MEDIUM' then 'cancelled' else 'processing' end as order_status,
       case o_orderkey % 3 when 0 then 'card' when 1 then 'cod' else 'wallet' end as payment_method,
       case o_orderkey % 2 when 0 then 'mobile' else 'desktop' end as device_type,
       o_orderpriority as order_source
from {orders}""",
    "order_items": """
select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
       l_extendedprice / l_quantity as unit_price,
       case when l_linenumber = 7 then null else l_extendedprice * l_discount end as discount_amount,
       case when l_linenumber <= 2 then 'PROMO-' || cast(l_suppkey as string) else ' ' end as promo_id,
       '' as promo_id_2
from {lineitem}""",
    "payments": """
select o_orderkey as order_id,
       case o_orderkey % 3 when 0 then 'card' when 1 then 'cod' else 'wallet' end as payment_method,
       o_totalprice as payment_value, cast(1 + o_orderkey % 12 as int) as installments
from {orders} where o_orderstatus <> 'P' or o_orderpriority <> '5-LOW'""",
    "shipments": """
select o_orderkey as order_id,
       cast(o_orderdate as date) + cast(1 + o_orderkey % 5 as int) as ship_date,
       case when o_orderstatus = 'O' and o_orderkey % 4 = 0 then null
            else cast(o_orderdate as date) + cast(3 + o_orderkey % 5 + o_orderkey % 7 as int)
       end as delivery_date,
       5e0 + o_orderkey % 20 as shipping_fee
from {orders} where o_orderstatus <> 'P' or o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "returns": """
select 'R' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) as return_id,
       l_orderkey as order_id, l_partkey as product_id,
       max(cast(o_orderdate as date)) + cast(10 + l_orderkey % 20 as int) as return_date,
       case l_partkey % 3 when 0 then 'damaged' when 1 then 'wrong_item' else 'changed_mind'
       end as return_reason,
       cast(sum(cast(l_quantity as int)) as bigint) as return_quantity,
       cast(sum(cast(l_extendedprice * (1e0 - l_discount) as decimal(18,4))) as double) as refund_amount
from {lineitem} join {orders} on l_orderkey = o_orderkey
where l_returnflag = 'R' group by l_orderkey, l_partkey""",
    "reviews": """
select 'RV' || cast(l_orderkey as string) as review_id, l_orderkey as order_id,
       min(l_partkey) as product_id, max(o_custkey) as customer_id,
       max(cast(o_orderdate as date)) + cast(12 + l_orderkey % 9 as int) as review_date,
       cast(1 + (l_orderkey % 7) % 5 as int) as rating,
       'title ' || cast(l_orderkey % 10 as string) as review_title
from {lineitem} join {orders} on l_orderkey = o_orderkey
where o_orderstatus = 'F' group by l_orderkey""",
    "inventory": """
select snapshot_date, product_id,
       cast((product_id * 37 + month * 11 + year) % 400 as int) as stock_on_hand,
       cast((product_id * 13 + month * 7) % 300 as int) as units_received,
       units_sold, stockout_days,
       (product_id * 37 + month * 11 + year) % 400 * 3e1 / units_sold as days_of_supply,
       1e0 - stockout_days / 3e1 as fill_rate,
       case when stockout_days > 0 then 1 else 0 end as stockout_flag,
       case when (product_id * 37 + month * 11 + year) % 400 > 300 then 1 else 0 end as overstock_flag,
       case when (product_id * 37 + month * 11 + year) % 400 < 120 then 1 else 0 end as reorder_flag,
       units_sold * 1e0 / (units_sold + (product_id * 37 + month * 11 + year) % 400)
         as sell_through_rate,
       cast(null as string) as product_name, cast(null as string) as category,
       cast(null as string) as segment, year, month
from (select l_partkey as product_id, cast(year(o_orderdate) as int) as year,
             cast(month(o_orderdate) as int) as month,
             max(last_day(cast(o_orderdate as date))) as snapshot_date,
             cast(sum(cast(l_quantity as int)) as bigint) as units_sold,
             cast(case when (l_partkey + month(o_orderdate)) % 9 = 0
                       then 1 + l_partkey % 12 else 0 end as int) as stockout_days
      from {lineitem} join {orders} on l_orderkey = o_orderkey
      group by l_partkey, year(o_orderdate), month(o_orderdate)) m""",
    "sales": """
select cast(o_orderdate as date) as date,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) * 6e-1 as cogs
from {orders} group by cast(o_orderdate as date)""",
    "web_traffic": """
select cast(ts as date) - 10227 as date, count(*) as sessions,
       count(distinct user_id) as unique_visitors,
       count(*) * 3 as page_views,
       sum(case when value < 10 then 1e0 else 0e0 end) / count(*) as bounce_rate,
       cast(sum(cast(value as decimal(18,2))) as double) / count(*) as avg_session_duration_sec,
       event_type as traffic_source
from {events} group by cast(ts as date), event_type""",
    "suppliers": """
select 'SUP' || lpad(cast(s_suppkey as string), 5, '0') as supplier_id, s_name as supplier_name,
       n_name as country,
       case when s_suppkey % 11 = 8 then null else (70 + s_suppkey % 30) / 1e2 end
         as reliability_score
from {supplier} join {nation} on s_nationkey = n_nationkey""",
    # One raw material per ten parts; materials for which a part of size 50
    # exists have no quotes.
    "raw_materials": """
select 'RM' || cast(n as string) as rm_id, 'material ' || cast(n as string) as rm_name,
       'kg' as unit, 1e0 + n % 9 as std_cost,
       case when n % 10 = 3 then null else 200e0 + (n * 29) % 900 end as current_stock
from (select distinct cast((p_partkey - p_partkey % 10) / 10 as bigint) as n from {part}) m""",
    "bom": """
select product_id, 'RM' || cast(n as string) as rm_id, sum(q) as quantity_required
from (select p_partkey as product_id,
             case j when 0 then cast((p_partkey - p_partkey % 10) / 10 as bigint)
                    when 1 then cast((p_partkey - p_partkey % 100) / 100 as bigint)
                    else p_partkey % 10 end as n,
             1e0 + (p_partkey + j) % 5 as q
      from (select p_partkey, 0 as j from {part} union all select p_partkey, 1 from {part}
            union all select p_partkey, 2 from {part}) t) x
group by product_id, n""",
    "procurement_scenarios": """
select 'Q' || cast(n as string) || '-' || cast(j as string) as scenario_id,
       case j when 0 then 'spot' when 1 then 'bulk' else 'contract' end as scenario_name,
       'SUP' || lpad(cast((n * 3 + j) % 10 as string), 5, '0') as supplier_id,
       'RM' || cast(n as string) as rm_id, 2e0 + (n % 40) / 4e0 - j / 4e0 as unit_price,
       cast(2 + (n + j * 3) % 9 as int) as lead_time_days, j * 500e0 as min_qty,
       j * 5e0 as discount_pct
from (select n, j
      from (select cast((p_partkey - p_partkey % 10) / 10 as bigint) as n, 0 as j, p_size from {part}
            union all
            select cast((p_partkey - p_partkey % 10) / 10 as bigint), 1, p_size from {part}
            union all
            select cast((p_partkey - p_partkey % 10) / 10 as bigint), 2, p_size from {part}) t
      group by n, j having max(p_size) < 50) m""",
    "supplier_materials": """
select 'SUP' || lpad(cast((n * 3 + j) % 10 as string), 5, '0') as supplier_id,
       'RM' || cast(n as string) as rm_id, 2e0 + (n % 40) / 4e0 as std_unit_price,
       cast(2 + (n + j * 3) % 9 as int) as base_lead_time, j * 500e0 as moq
from (select n, j
      from (select cast((p_partkey - p_partkey % 10) / 10 as bigint) as n, 0 as j, p_size from {part}
            union all
            select cast((p_partkey - p_partkey % 10) / 10 as bigint), 1, p_size from {part}
            union all
            select cast((p_partkey - p_partkey % 10) / 10 as bigint), 2, p_size from {part}) t
      group by n, j having max(p_size) < 50) m""",
    "cross_reference": """
select distinct 'EQ' || cast(user_id as string) as equipment_id,
       'LINE' || cast(user_id % 6 as string) as line_name
from {events}""",
    "maintenance_orders": """
select event_id as order_id, cast(ts as date) as start_date,
       'EQ' || cast(user_id as string) as equipment_id,
       case when user_id % 6 < 2 and event_id % 4 = 0 then ' PM10' else 'PM20' end as order_type,
       'error event' as description
from {events} where event_type = 'error'""",
    "production_logs": """
select event_id as log_id, cast(ts as date) as productiondate_day_loc,
       'LINE' || cast(user_id % 6 as string) as line_name,
       case when event_id % 2 = 0 then 'S1' else 'S2' end as shift_name,
       'ST' || cast(event_id % 12 as string) as size_type, 200e0 + event_id % 250 as run_time,
       case when event_id % 31 = 0 then 0e0 else 480e0 end as production_available_time,
       case when event_id % 11 = 0 then null else 20e0 + event_id % 25 end as changeover_duration,
       cast(100 + event_id % 50 as int) as good_production_qty,
       cast(event_id % 7 as int) as reject_production_qty
from {events} where event_type <> 'error'""",
}


def inputs_of(statement: str) -> list[str]:
    """The given tables a landing statement reads."""
    return sorted({name for _, name, _, _ in string.Formatter().parse(statement) if name})


@functools.lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str, changed: int) -> StructType:
    return spark.read.parquet(path).schema


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its footer is read once per session and state of the file."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path, changed_at(spark, path))).parquet(path)


def landing_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One landing table over the given Parquet files of ``sf_dir``."""
    statement = LANDING_SQL[name]
    frames = {t: given_table(spark, sf_dir, t) for t in inputs_of(statement)}
    return spark.sql(statement, **frames)
