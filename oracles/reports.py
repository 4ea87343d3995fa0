"""Documentation reports."""

from __future__ import annotations

import re

from oracles.exact import mean, money, percent, quotient
from oracles.gold import _FEELINGS, TYPE
from oracles.layers import LAYERS


def _rounded(value: str, from_digits: int, digits: int) -> str:
    return quotient(value, str(10**from_digits), digits)


def _spend() -> str:
    """Quantiles by linear interpolation between the neighbouring ranks, in integers."""
    parts = [
        f"select 'minimum' as metric, {money('min(paid_c)')} as value from g_people",
        f"select 'maximum', {money('max(paid_c)')} from g_people",
    ]
    for p in (25, 50, 75, 90, 95):
        picked = f"""
select max(case when i = {p} * (n - 1) // 100 then paid_c end) as lo,
  max(case when i = ({p} * (n - 1) + 99) // 100 then paid_c end) as hi, max(({p} * (n - 1)) % 100) as w
from (select paid_c, row_number() over (order by paid_c) - 1 as i, count(*) over () as n from g_people) x"""
        parts.append(f"select 'p{p}', {quotient('lo * 100 + (hi - lo) * w', '10000', 2)} from ({picked}) y")
    return " union all ".join(parts)


# The layers that change when only the orders known a year before the analysis date count.
_PAST = ("g_orders", "g_owned", "g_people", "g_day", "g_scores", "g_segments")
_KNOWN = "select * from g_orders where bought::date < (select max(bought)::date + 1 - 365 from s_orders)"


def _earlier() -> str:
    """The chain from orders to segments over the earlier orders, under names starting with ``was_``."""

    def renamed(text: str) -> str:
        return re.sub(r"\b(" + "|".join(_PAST) + r")\b", r"was_\1", text)

    later = [f"was_{name} as ({renamed(LAYERS[name])})" for name in _PAST[1:]]
    return ", ".join([f"was_g_orders as ({_KNOWN})", *later])


_DELAYS = """
select case when days_late <= 0 then '0: on time' when days_late < 4 then '1: 1-3 days late'
    when days_late < 8 then '2: 4-7 days late' when days_late < 15 then '3: 8-14 days late'
    else '4: over 14 days late' end as bucket,
  days_late::bigint as x, score_c::bigint as y, low
from s_orders join g_reviews using (order_id) where days_late is not null and score_c is not null"""

QUERIES: dict[str, str] = {
    "doc_silver_delivery_metrics": f"""
select count(*) as total_orders, count(days_e10) as valid_delivery_records,
  count(case when days_e10 < 0 then 1 end) as negative_delivery_durations,
  {_rounded("min(days_e10)", 10, 2)} as minimum_delivery_days, {_rounded("max(days_e10)", 10, 2)} as maximum_delivery_days,
  {mean("days_e10", 2, 10**10)} as average_delivery_days,
  (select count(distinct customer_unique_id) from s_customers) as unique_customers
from s_orders""",
    "doc_spend_distribution": _spend(),
    "doc_type_experience": f"""
select {TYPE} as customer_type, count(*) as customers, {_FEELINGS} from g_profile where person is not null group by 1""",
    "doc_top_customers": f"""
select s.person as customer_unique_id, a.state as customer_state, segment as customer_segment, frequency,
  {money("monetary_c")} as monetary_value
from g_segments s left join g_address a on a.person = s.person
qualify row_number() over (order by monetary_c desc, s.person) <= 100""",
    "doc_monthly_trend": f"""
select date_trunc('month', bought)::date as purchase_month, count(*) as orders, {money("sum(paid_c)")} as revenue
from g_orders group by 1""",
    "doc_rfm_matrix": f"""
select r as recency_score, f as frequency_score, m as monetary_score, count(*) as customers, {money("sum(monetary_c)")} as revenue
from g_scores group by all""",
    "doc_pareto_curve": f"""
select tile as customer_percentile, n as customers, {money("c")} as revenue, {money("upto")} as cumulative_revenue,
  {percent("upto", "(select sum(paid_c) from g_people)")} as cumulative_revenue_share
from (
  select tile, count(*) as n, sum(paid_c) as c, sum(sum(paid_c)) over (order by tile) as upto
  from (select paid_c, ntile(100) over (order by paid_c desc nulls first, person desc) as tile from g_people) t group by 1
) x""",
    "doc_segment_migration": f"""
select b.segment as segment_before, a.segment as segment_after, count(*) as customers
from g_segments a full join (with {_earlier()} select person, segment from was_g_segments) b on b.person = a.person group by all""",
    "doc_delay_vs_review": f"""
select q.* from (with d as ({_DELAYS}), t as (
  select count(*)::double as n, sum(x)::double as sx, sum(y)::double as sy, sum(x * y)::double as sxy,
    sum(x * x)::double as sxx, sum(y * y)::double as syy from d
)
select bucket as delay_bucket, count(*) as orders, {mean("y", 2, 100)} as average_review_score,
  {percent("count(case when low > 0 then 1 end)", "count(*)")} as low_score_percentage,
  (select round((n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 6) from t) as delay_score_correlation
from d group by 1) q""",
    "doc_late_rate_by_state": f"""
select c.state as customer_state, count(*) as deliveries, count(case when o.days_late > 0 then 1 end) as late_deliveries,
  {percent("count(case when o.days_late > 0 then 1 end)", "count(*)")} as late_percentage
from s_orders o join (select distinct customer_id, state from s_customers) c using (customer_id)
where o.days_late is not null group by 1""",
    "doc_late_rate_by_route": f"""
select l.state as seller_state, c.state as customer_state, count(*) as deliveries,
  count(case when o.days_late > 0 then 1 end) as late_deliveries,
  {percent("count(case when o.days_late > 0 then 1 end)", "count(*)")} as late_percentage
from (select distinct order_id, seller_id from s_items) i join s_orders o using (order_id)
  join (select distinct customer_id, state from s_customers) c using (customer_id)
  join (select distinct seller_id, state from s_sellers) l using (seller_id)
where o.days_late is not null group by 1, 2""",
    "doc_segment_csat": f"""
select segment as customer_segment, count(*) as customers, count(score_c) as reviewing_customers,
  {percent("count(case when score_c >= 400 then 1 end)", "count(score_c)")} as satisfied_percentage,
  {percent("count(case when poor then 1 end)", "count(*)")} as poor_experience_percentage
from g_profile where person is not null group by 1""",
}
