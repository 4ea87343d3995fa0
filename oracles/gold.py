"""Gold tables, views and checks."""

from __future__ import annotations

from oracles.exact import mean, money, percent, quotient, scaled

_ITEM_COLUMNS = f"""
lines::bigint as total_items, products::bigint as distinct_products, sellers::bigint as distinct_sellers,
{money("price_c")} as merchandise_value, {money("freight_c")} as freight_value, {money("value_c")} as order_item_value"""

_ORDER = f"""
select order_id, customer_id, status as order_status, bought as order_purchase_timestamp, approved as order_approved_at,
  shipped as order_delivered_carrier_date, delivered as order_delivered_customer_date, promised as order_estimated_delivery_date,
  {scaled("days_e10", 10)} as delivery_days, days_late::bigint as delivery_vs_estimate_days, days_late > 0 as delivered_late,
  early_carrier as approval_carrier_timestamp_anomaly, early_delivery as delivery_sequence_anomaly, {_ITEM_COLUMNS},
  {quotient("item_sum_c", "priced * 100", 10)} as average_item_price, {money("item_top_c")} as maximum_item_price,
  records::bigint as payment_records, {money("paid_c")} as total_payment_value,
  {quotient("paid_sum_c", "paid_n * 100", 10)} as average_payment_value, {money("paid_top_c")} as maximum_payment_value,
  installments::bigint as maximum_installments, cards::bigint as credit_card_payment_records,
  boletos::bigint as boleto_payment_records, vouchers::bigint as voucher_payment_records,
  debits::bigint as debit_card_payment_records, reviews::bigint as review_count, {scaled("score_c", 2)} as average_review_score,
  low::bigint as low_score_reviews, high::bigint as high_score_reviews, messages::bigint as reviews_with_message
from g_orders"""

_ACTIVE = "(date_diff('microsecond', first_buy, last_buy) // 86400000000)"

_CUSTOMER = f"""
select p.person as customer_unique_id, a.city as customer_city, a.state as customer_state, a.zip as customer_zip_code_prefix,
  orders as total_orders, delivered as delivered_orders, failed as unsuccessful_orders, lines::bigint as total_items,
  products::bigint as product_instances, {money("value_c")} as total_merchandise_value, {money("paid_c")} as total_payment_value,
  {quotient("paid_c", "paid_n * 100", 2)} as average_order_value, {money("top_c")} as maximum_order_value,
  {money("freight_c")} as total_freight_value, first_buy as first_purchase_timestamp, last_buy as last_purchase_timestamp,
  {_ACTIVE} as customer_activity_days, orders > 1 as repeat_customer,
  {quotient("orders * 30", _ACTIVE, 10)} as orders_per_month, {quotient("days_e10", "days_n * 10000000000", 10)} as average_delivery_days,
  {quotient("late_days", "late_days_n", 10)} as average_delivery_vs_estimate_days, late as late_orders,
  days_n as orders_with_delivery_data, {quotient("late", "days_n", 10)} as late_order_rate, reviews::bigint as total_reviews,
  {quotient("score_c", "score_n * 100", 10)} as average_review_score, low::bigint as low_score_reviews,
  high::bigint as high_score_reviews, {quotient("low", "reviews", 10)} as low_review_rate, records::bigint as total_payment_records,
  cards::bigint as credit_card_payments, boletos::bigint as boleto_payments, vouchers::bigint as voucher_payments,
  debits::bigint as debit_card_payments, {quotient("inst", "inst_n", 10)} as average_max_installments,
  case when cards = greatest(cards, boletos, vouchers, debits) then 'credit_card'
       when boletos = greatest(boletos, vouchers, debits) then 'boleto'
       when vouchers >= debits then 'voucher' else 'debit_card' end as primary_payment_method
from g_people p left join g_address a on a.person = p.person"""

_CATEGORY = f"""
with spend as (
  select c.customer_unique_id, coalesce(p.english, 'unknown') as product_category, count(distinct i.order_id) as orders,
    count(*) as items, count(distinct i.product_id) as products, sum(i.price_c) as price_c, count(i.price_c) as priced,
    sum(i.freight_c) as freight_c
  from s_items i join s_orders o on o.order_id = i.order_id join s_customers c on c.customer_id = o.customer_id
    left join s_products p on p.product_id = i.product_id
  group by 1, 2
), person as (
  select customer_unique_id, sum(price_c) as all_c, sum(orders) as all_orders from spend group by 1
)
select s.customer_unique_id, product_category, orders as category_orders, items as category_items, products as distinct_products,
  {money("price_c")} as category_merchandise_value, {money("freight_c")} as category_freight_value,
  {quotient("price_c", "priced * 100", 2)} as average_item_price,
  rank() over (partition by s.customer_unique_id order by price_c desc nulls first) as category_value_rank,
  {quotient("price_c", "all_c", 2)} as category_spend_share, {quotient("orders", "all_orders", 2)} as category_order_share
from spend s join person p on p.customer_unique_id is not distinct from s.customer_unique_id"""

_MIDDLE = "all_days[(len(all_days) + 1) // 2] + all_days[(len(all_days) + 2) // 2]"

_EXPERIENCE = f"""
select person as customer_unique_id, days_n as orders_with_delivery_data, {scaled("avg_days_e10", 10)} as average_delivery_days,
  ({_MIDDLE})::double / 2e10 as median_delivery_days, late as late_orders, {scaled("late_rate_c", 2)} as late_order_rate,
  {scaled("vs_estimate_c", 2)} as average_delivery_vs_estimate_days, reviews::bigint as total_reviews,
  {scaled("score_c", 2)} as average_review_score, low::bigint as low_score_reviews, high::bigint as high_score_reviews,
  {scaled("low_rate_c", 2)} as low_review_rate, late > 0 as has_delivery_delay, low > 0 as has_low_rating,
  poor as poor_experience_flag
from g_experience"""

_SCORES = f"""
select person as customer_unique_id, recency as recency_days, frequency, {money("monetary_c")} as monetary_value,
  r as recency_score, f as frequency_score, m as monetary_score, rq as recency_quintile, m as monetary_quintile
from g_scores"""

_INTELLIGENCE = f"""
select s.person as customer_unique_id, today as analysis_date, a.state as customer_state, last_buy as last_purchase_timestamp,
  recency as recency_days, frequency, {money("monetary_c")} as monetary_value, r as recency_score, f as frequency_score,
  m as monetary_score, r + f + m as rfm_score, concat(r, f, m) as rfm_code, rq as recency_quintile, m as monetary_quintile,
  frequency > 1 as repeat_customer, delivered as delivered_orders, {quotient("monetary_c", "paid_n * 100", 2)} as average_order_value,
  segment as customer_segment
from g_segments s left join g_address a on a.person = s.person"""

_FEELINGS = f"""
{mean("avg_days_e10", 2, 10**10)} as average_delivery_days, {mean("late_rate_c", 2)} as average_late_order_rate_pct,
{mean("score_c", 2, 100)} as average_review_score, {percent("count(case when poor then 1 end)", "count(*)")} as poor_experience_rate_pct"""

_REPEAT_C = "sum(case when frequency > 1 then monetary_c end)"

_KPIS = f"""
select count(*) as total_customers, count(case when frequency > 1 then 1 end) as repeat_customers,
  count(case when frequency = 1 then 1 end) as one_time_customers,
  {percent("count(case when frequency > 1 then 1 end)", "count(*)")} as repeat_customer_rate,
  sum(frequency)::bigint as total_orders, {money("sum(monetary_c)")} as total_revenue,
  {quotient("sum(monetary_c)", "sum(frequency) * 100", 2)} as average_order_value,
  {mean("monetary_c", 2, 100)} as average_customer_value, {money(_REPEAT_C)} as repeat_customer_revenue,
  {percent(_REPEAT_C, "sum(monetary_c)")} as repeat_customer_revenue_share, {_FEELINGS}
from g_profile"""

_VALUE = f"""
{mean("monetary_c", 2, 100)} as average_customer_value, {mean("frequency", 2)} as average_orders"""


def _group(key: str, alias: str, *columns: str) -> str:
    """Customers and revenue per group with their shares of the whole, plus more columns."""
    everyone, revenue = "(select count(*) from g_profile)", "(select sum(monetary_c) from g_profile)"
    more = "".join(f", {column}" for column in columns)
    return f"""
select {key} as {alias}, count(*) as customers, {percent("count(*)", everyone)} as customer_percentage,
  {money("sum(monetary_c)")} as total_revenue, {percent("sum(monetary_c)", revenue)} as revenue_percentage{more}
from g_profile group by 1"""


_PER_ORDER = f"{quotient('sum(monetary_c)', 'sum(frequency) * 100', 2)} as average_order_value"
_RECENCY = f"{mean('recency', 1)} as average_recency_days"
TYPE = "case when frequency >= 2 then 'Repeat customer' else 'One-time customer' end"


def _key_check(name: str, table: str, key: str) -> str:
    return f"select '{name}' as table_name, count(*) as row_count, count(*) - count(distinct {key}) as duplicate_keys from {table}"


QUERIES: dict[str, str] = {
    "gold_item_summary": f"""
select order_id, {_ITEM_COLUMNS}, {quotient("price_c", "priced * 100", 10)} as average_item_price,
  {money("top_c")} as maximum_item_price
from g_items""",
    "gold_payment_summary": f"""
select order_id, records as payment_records, {money("paid_c")} as total_payment_value,
  {quotient("paid_c", "paid_n * 100", 10)} as average_payment_value, {money("top_c")} as maximum_payment_value,
  installments::bigint as maximum_installments, cards::bigint as credit_card_payment_records,
  boletos::bigint as boleto_payment_records, vouchers::bigint as voucher_payment_records,
  debits::bigint as debit_card_payment_records
from g_payments""",
    "gold_review_summary": f"""
select order_id, n as review_count, {scaled("score_c", 2)} as average_review_score, low as low_score_reviews,
  high as high_score_reviews, messages as reviews_with_message
from g_reviews""",
    "gold_order_summary": _ORDER,
    "gold_customer_360": _CUSTOMER,
    "gold_customer_category_behavior": f"select * from ({_CATEGORY}) q",
    "gold_customer_experience": _EXPERIENCE,
    "gold_analysis_date": "select today as analysis_date from g_day",
    "gold_rfm_scores": _SCORES,
    "gold_customer_intelligence": _INTELLIGENCE,
    "gold_executive_kpis": _KPIS,
    "gold_check_keys": " union all ".join(
        [
            _key_check("gold.order_summary", "g_orders", "order_id"),
            _key_check("gold.customer_360", "g_people", "person"),
            _key_check("gold.customer_experience", "g_experience", "person"),
            _key_check("gold.customer_intelligence", "g_segments", "person"),
        ]
    ),
    "gold_check_kpis": _KPIS,
    "view_customer_segments": _group("segment", "customer_segment", _VALUE, _PER_ORDER, _RECENCY),
    "view_customer_type_performance": _group(TYPE, "customer_type", _VALUE, _PER_ORDER),
    "view_revenue_concentration": _group(
        "m", "monetary_quintile", f"{money('min(monetary_c)')} as minimum_customer_value",
        f"{money('max(monetary_c)')} as maximum_customer_value", f"{mean('monetary_c', 2, 100)} as average_customer_value",
    ),
    "view_customer_experience": f"""
select segment as customer_segment, count(*) as customers, {_FEELINGS} from g_profile where person is not null group by 1""",
    "view_retention_opportunities": f"""
select segment as customer_segment, count(*) as customers, {money("sum(monetary_c)")} as associated_revenue, {_VALUE}, {_RECENCY},
  {_FEELINGS}
from g_profile where person is not null and segment in ('High-Value One-Time', 'Developing Repeat', 'Recent One-Time', 'Low-Value Inactive') group by 1""",
}
