"""Adapters that give the star-schema test tables the shape of the nine raw tables.

Each text runs unchanged on Spark and on DuckDB; only the base-table placeholders differ. They
build in the irregularities the rules look for: missing and padded codes, impossible timestamps,
orphan keys, duplicate ids, zero and negative values, blank comments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopscope.sources.lazy import LazyTables
from shopscope.sources.schemas import conform

BASE_TABLES = ("customer", "supplier", "part", "orders", "lineitem")

ADAPTERS: dict[str, str] = {
    "customers": """
select concat(case when o_orderkey % 997 = 3 then 'x' else '' end, cast(o_orderkey as string)) as customer_id,
  concat(cast(o_custkey as string), '-', cast(o_orderkey % 20 as string)) as customer_unique_id,
  cast(o_custkey % 400 as string) as customer_zip_code_prefix,
  concat(' City ', cast(o_custkey % 40 as string), ' ') as customer_city,
  concat('s', cast(c_nationkey % 10 as string), ' ') as customer_state
from {orders} join {customer} on o_custkey = c_custkey""",
    "orders": """
select order_id, customer_id, order_status, pts as order_purchase_timestamp,
  case when k % 60 = 9 then null else pts + interval '1' hour * (k % 48 - 1) end as order_approved_at,
  case when k % 50 in (4, 5) or k % 500 = 11 then null else pts + interval '1' hour * (k % 90) end as order_delivered_carrier_date,
  case when k % 50 = 5 or k % 100 = 4 or (k % 50 = 3 and k % 100 <> 3) or k % 500 = 12 then null
       when k % 400 = 17 then pts - interval '1' hour * 5
       else pts + interval '1' hour * (20 + (k * 37) % 500) end as order_delivered_customer_date,
  cast(pts + interval '1' day * (10 + (k % 15) - (case when k % 211 = 1 then 20 else 0 end)) as date) as order_estimated_delivery_date
from (select o_orderkey as k, cast(o_orderkey as string) as order_id, cast(o_orderkey as string) as customer_id,
        o_orderdate + interval '1' minute * ((o_orderkey * 7919) % 1440) as pts,
        case when o_orderkey % 50 = 3 then 'canceled' when o_orderkey % 50 = 4 then 'unavailable'
             when o_orderkey % 50 = 5 then ' Shipped ' else 'delivered' end as order_status
      from {orders}) x""",
    "order_items": """
select cast(l_orderkey as string) as order_id, l_linenumber as order_item_id,
  cast(l_partkey as string) as product_id, cast(l_suppkey as string) as seller_id,
  l_shipdate as shipping_limit_date,
  cast(case when l_linenumber = 7 and l_orderkey % 40 = 1 then -l_extendedprice else l_extendedprice end as decimal(10,2)) as price,
  case when l_linenumber = 6 and l_orderkey % 50 = 2 then null else cast(l_quantity as decimal(10,2)) end as freight_value
from {lineitem}
union all
select concat('x', cast(o_orderkey as string)), 1, '1', '1', o_orderdate, cast(1 as decimal(10,2)), cast(1 as decimal(10,2))
from {orders} where o_orderkey % 1500 = 9""",
    "payments": """
select concat(case when o_orderkey % 101 = 7 then 'y' else '' end, cast(o_orderkey as string)) as order_id, 1 as payment_sequential,
  case substr(o_orderpriority, 1, 1) when '1' then 'credit_card' when '2' then ' Credit_Card' when '3' then 'boleto'
       when '4' then 'voucher' else 'debit_card' end as payment_type,
  o_orderkey % 13 as payment_installments,
  cast(case when o_orderkey % 331 = 5 then 0 else o_totalprice end as decimal(10,2)) as payment_value
from {orders}
union all
select cast(o_orderkey as string), 2, 'voucher', 1, cast(o_orderkey % 100 as decimal(10,2)) from {orders} where o_orderkey % 10 = 0
union all
select concat('x', cast(o_orderkey as string)), 1, 'not_defined', 1, cast(-1 as decimal(10,2)) from {orders} where o_orderkey % 1500 = 9""",
    "reviews": """
select concat('r', cast(case when o_orderkey % 40 = 1 then o_orderkey - 1 else o_orderkey end as string)) as review_id,
  concat(case when o_orderkey % 1400 = 3 then 'x' when o_orderkey % 7 = 0 then 'y' else '' end, cast(o_orderkey as string)) as order_id,
  case when o_orderkey % 443 = 2 then 0 when o_orderkey % 449 = 2 then null else 1 + (o_orderkey * 31) % 5 end as review_score,
  case when o_orderkey % 4 = 0 then 'Title' when o_orderkey % 4 = 1 then '' when o_orderkey % 4 = 2 then '  ' else null end as review_comment_title,
  case when o_orderkey % 3 = 0 then concat(' msg ', cast(o_orderkey as string)) when o_orderkey % 3 = 1 then ' ' else null end as review_comment_message,
  cast(o_orderdate + interval '1' day * 12 as date) as review_creation_date,
  o_orderdate + interval '1' day * 13 as review_answer_timestamp
from {orders}""",
    "products": """
select concat(case when p_partkey % 97 = 5 then 'x' else '' end, cast(p_partkey as string)) as product_id,
  case when p_partkey % 53 = 0 then null when p_partkey % 59 = 0 then '' else replace(lower(p_brand), '#', '_') end as product_category_name,
  length(p_name) as product_name_length, p_size * 20 as product_description_length, p_size % 6 as product_photos_qty,
  case when p_partkey % 400 = 1 then 0 when p_partkey % 500 = 2 then null else p_size * 10 end as product_weight_g,
  p_size % 40 as product_length_cm, p_size % 30 as product_height_cm, p_size % 35 as product_width_cm
from {part}""",
    "sellers": """
select concat(case when s_suppkey % 50 = 7 then 'x' else '' end, cast(s_suppkey as string)) as seller_id, cast(s_suppkey % 400 as string) as seller_zip_code_prefix,
  concat(' Town ', cast(s_suppkey % 30 as string)) as seller_city,
  concat('s', cast(s_nationkey % 10 as string)) as seller_state
from {supplier}""",
    "geolocation": """
select cast(c_custkey % 400 as string) as geolocation_zip_code_prefix,
  cast(case when c_custkey % 700 = 1 then 95 else (c_custkey % 60) - 33 end as decimal(9,6)) as geolocation_lat,
  cast(case when c_custkey % 700 = 2 then -190 when c_custkey % 700 = 3 then null else -(c_custkey % 70) end as decimal(9,6)) as geolocation_lng,
  concat(' City ', cast(c_custkey % 40 as string), ' ') as geolocation_city,
  concat('s', cast((c_custkey % 400 + (case when c_custkey % 9 = 0 then 1 else 0 end)) % 10 as string)) as geolocation_state
from {customer}""",
    "category_translation": """
select distinct concat(case when p_brand in ('Brand#3', 'Brand#5') then 'x' else '' end, replace(lower(p_brand), '#', '_')) as product_category_name,
  case when p_brand = 'Brand#7' then '' else concat(' ', p_brand, ' ') end as product_category_name_english
from {part}
union all select 'brand_9', null""",
}


def raw_tables(spark: SparkSession, directory: str) -> LazyTables:
    """The nine raw tables as lazy frames over the Parquet files in ``directory``."""
    root = directory.rstrip("/")
    base = LazyTables({name: lambda name=name: spark.read.parquet(f"{root}/{name}.parquet") for name in BASE_TABLES})

    def build(name: str) -> DataFrame:
        text = ADAPTERS[name]
        used = {table: base[table] for table in BASE_TABLES if f"{{{table}}}" in text}
        return conform(spark.sql(text, **used), name)

    return LazyTables({name: lambda name=name: build(name) for name in ADAPTERS})
