"""Common table expressions for the raw (b_), silver (s_) and gold (g_) layers.

Money is held in whole cents (``_c``), days in 1e-10 units (``_e10``).
"""

from __future__ import annotations

import re

from oracles.exact import half_up
from shopscope.sources.testdata import ADAPTERS, BASE_TABLES



def _raw(name: str) -> str:
    """The adapter's rows; trailing blanks of fixed-width columns do not count."""
    text = ADAPTERS[name].format(**{table: table for table in BASE_TABLES}).strip()
    fixed = {"customers": "customer", "sellers": "seller", "geolocation": "geolocation"}.get(name)
    if fixed is None:
        return text
    columns = ", ".join(f"rtrim({fixed}_{column}) as {fixed}_{column}" for column in ("zip_code_prefix", "state"))
    return f"select * replace ({columns}) from ({text}) x"


LAYERS: dict[str, str] = {f"b_{name}": _raw(name) for name in ADAPTERS}

LAYERS["s_customers"] = """
select customer_id, customer_unique_id, lpad(rtrim(customer_zip_code_prefix), 5, '0') as zip,
  lower(trim(customer_city)) as city, upper(trim(customer_state)) as state
from b_customers"""

LAYERS["s_orders"] = f"""
select order_id, customer_id, trim(lower(order_status)) as status, order_purchase_timestamp as bought,
  order_approved_at as approved, order_delivered_carrier_date as shipped, order_delivered_customer_date as delivered,
  order_estimated_delivery_date as promised,
  coalesce(order_approved_at > order_delivered_carrier_date, false) as early_carrier,
  coalesce(order_delivered_carrier_date > order_delivered_customer_date, false) as early_delivery,
  case when order_purchase_timestamp <= order_delivered_customer_date then
    {half_up("date_diff('microsecond', order_purchase_timestamp, order_delivered_customer_date)", "86400000000", 10)}
  end as days_e10,
  date_diff('day', order_estimated_delivery_date, order_delivered_customer_date::date) as days_late
from b_orders"""

LAYERS["s_items"] = """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  (price * 100)::bigint as price_c, (freight_value * 100)::bigint as freight_c
from b_order_items"""

LAYERS["s_payments"] = """
select order_id, payment_sequential, trim(lower(payment_type)) as kind, payment_installments as installments,
  (payment_value * 100)::bigint as paid_c
from b_payments"""

LAYERS["s_reviews"] = """
select review_id, order_id, review_score as score,
  case when trim(review_comment_title) <> '' then trim(review_comment_title) end as title,
  case when trim(review_comment_message) <> '' then trim(review_comment_message) end as message,
  review_creation_date, review_answer_timestamp
from b_reviews"""

LAYERS["s_products"] = """
select p.*, case when trim(p.product_category_name) <> '' then trim(p.product_category_name) else 'unknown' end as category,
  case when trim(t.product_category_name_english) <> '' then trim(t.product_category_name_english) else 'unknown' end as english
from b_products p left join b_category_translation t using (product_category_name)"""

LAYERS["s_sellers"] = """
select seller_id, lpad(rtrim(seller_zip_code_prefix), 5, '0') as zip, lower(trim(seller_city)) as city,
  upper(trim(seller_state)) as state
from b_sellers"""

LAYERS["s_points"] = """
select lpad(rtrim(geolocation_zip_code_prefix), 5, '0') as zip, (geolocation_lat * 1000000)::bigint as lat_m,
  (geolocation_lng * 1000000)::bigint as lng_m, lower(trim(geolocation_city)) as city, upper(trim(geolocation_state)) as state
from b_geolocation"""

LAYERS["s_places"] = f"""
select c.zip, c.latitude_e10, c.longitude_e10, c.states, r.city, r.state
from (
  select zip, {half_up("sum(lat_m)", "count(lat_m) * 1000000", 10)} as latitude_e10,
    {half_up("sum(lng_m)", "count(lng_m) * 1000000", 10)} as longitude_e10, count(distinct state) as states
  from s_points where zip is not null group by 1
) c join (
  select zip, city, state from s_points group by zip, city, state
  qualify row_number() over (partition by zip order by count(*) desc, city nulls last, state nulls last) = 1
) r on r.zip = c.zip"""

LAYERS["g_items"] = """
select order_id, count(*) as lines, count(distinct product_id) as products, count(distinct seller_id) as sellers,
  sum(price_c) as price_c, sum(freight_c) as freight_c, sum(price_c + freight_c) as value_c, count(price_c) as priced,
  max(price_c) as top_c
from s_items group by 1"""

LAYERS["g_payments"] = """
select order_id, count(*) as records, sum(paid_c) as paid_c, count(paid_c) as paid_n, max(paid_c) as top_c,
  max(installments) as installments,
  sum((kind = 'credit_card')::int) as cards, sum((kind = 'boleto')::int) as boletos,
  sum((kind = 'voucher')::int) as vouchers, sum((kind = 'debit_card')::int) as debits
from s_payments group by 1"""

LAYERS["g_reviews"] = f"""
select order_id, count(*) as n, {half_up("sum(score)", "count(score)", 2)} as score_c,
  count(case when score <= 2 then 1 end) as low, count(case when score >= 4 then 1 end) as high, count(message) as messages
from s_reviews group by 1"""

LAYERS["g_orders"] = """
select o.*, coalesce(i.lines, 0) as lines, coalesce(i.products, 0) as products, coalesce(i.sellers, 0) as sellers,
  coalesce(i.price_c, 0) as price_c, coalesce(i.freight_c, 0) as freight_c, coalesce(i.value_c, 0) as value_c,
  i.price_c as item_sum_c, i.priced, i.top_c as item_top_c,
  coalesce(p.records, 0) as records, coalesce(p.paid_c, 0) as paid_c, p.paid_c as paid_sum_c, p.paid_n, p.top_c as paid_top_c,
  p.installments, coalesce(p.cards, 0) as cards, coalesce(p.boletos, 0) as boletos, coalesce(p.vouchers, 0) as vouchers,
  coalesce(p.debits, 0) as debits, coalesce(r.n, 0) as reviews, r.score_c, coalesce(r.low, 0) as low,
  coalesce(r.high, 0) as high, coalesce(r.messages, 0) as messages
from s_orders o left join g_items i using (order_id) left join g_payments p using (order_id) left join g_reviews r using (order_id)"""

LAYERS["g_owned"] = """
select a.customer_unique_id as person, g.*
from (select distinct customer_id, customer_unique_id from s_customers) a join g_orders g on g.customer_id = a.customer_id"""

LAYERS["g_people"] = """
select person, count(distinct order_id) as orders,
  count(distinct case when status = 'delivered' then order_id end) as delivered,
  count(distinct case when status = 'canceled' or status = 'unavailable' then order_id end) as failed,
  sum(lines) as lines, sum(products) as products, sum(value_c) as value_c, sum(paid_c) as paid_c, count(paid_c) as paid_n,
  max(paid_c) as top_c, sum(freight_c) as freight_c, min(bought) as first_buy, max(bought) as last_buy,
  sum(days_e10) as days_e10, count(days_e10) as days_n, sum(days_late) as late_days, count(days_late) as late_days_n,
  count(case when days_late > 0 then 1 end) as late, sum(reviews) as reviews, sum(score_c) as score_c, count(score_c) as score_n,
  sum(low) as low, sum(high) as high, sum(records) as records, sum(cards) as cards, sum(boletos) as boletos,
  sum(vouchers) as vouchers, sum(debits) as debits, sum(installments) as inst, count(installments) as inst_n,
  list_sort(list(days_e10) filter (days_e10 is not null)) as all_days
from g_owned group by 1"""

LAYERS["g_address"] = """
select c.customer_unique_id as person, c.city, c.state, c.zip
from s_customers c join s_orders o on o.customer_id = c.customer_id
qualify row_number() over (partition by c.customer_unique_id order by o.bought desc nulls first, c.customer_id desc) = 1"""

LAYERS["g_experience"] = f"""
select person, days_n, {half_up("days_e10", "days_n", 0)} as avg_days_e10, late, reviews, low, high,
  {half_up("late", "days_n", 2)} as late_rate_c, {half_up("late_days", "late_days_n", 2)} as vs_estimate_c,
  {half_up("score_c", "score_n * 100", 2)} as score_c, {half_up("low", "reviews", 2)} as low_rate_c,
  late > 0 and low > 0 as poor, all_days
from g_people"""

LAYERS["g_day"] = "select max(last_buy)::date + 1 as today from g_people"

LAYERS["g_scores"] = """
select p.person, today, date_diff('day', last_buy::date, today) as recency, p.orders as frequency, p.paid_c as monetary_c,
  p.paid_n, p.delivered, p.last_buy,
  ntile(5) over (order by date_diff('day', last_buy::date, today) desc nulls first, p.person desc) as r,
  ntile(5) over (order by p.orders, p.person) as f,
  ntile(5) over (order by p.paid_c, p.person) as m,
  6 - ntile(5) over (order by date_diff('day', last_buy::date, today) nulls last, p.person) as rq
from g_people p, g_day"""

LAYERS["g_segments"] = """
select s.*, case
    when frequency >= 2 and m >= 4 then 'High-Value Repeat'
    when frequency >= 2 then 'Developing Repeat'
    when frequency = 1 and m >= 4 then 'High-Value One-Time'
    when frequency = 1 and rq >= 4 then 'Recent One-Time'
    when frequency = 1 and m <= 2 and rq <= 2 then 'Low-Value Inactive'
    else 'Established One-Time' end as segment
from g_scores s"""

LAYERS["g_profile"] = """
select s.*, e.avg_days_e10, e.late_rate_c, e.score_c, coalesce(e.poor, false) as poor
from g_segments s left join g_experience e on e.person = s.person"""


def with_layers(body: str) -> str:
    """Prefix ``body`` with the layers it mentions, directly or through other layers."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        for name in re.findall(r"\b[bsg]_[a-z_]+\b", pending.pop()):
            if name in LAYERS and name not in needed:
                needed.add(name)
                pending.append(LAYERS[name])
    parts = [f"{name} as ({text.strip()})" for name, text in LAYERS.items() if name in needed]
    return f"with {', '.join(parts)}\n{body.strip()}" if parts else body.strip()
