"""Bronze load and profiles."""

from __future__ import annotations

from oracles.exact import mean, percent, quotient
from shopscope.sources.schemas import RAW_SCHEMAS



def _raw_column(name: str, kind: str) -> str:
    if kind in ("short", "integer", "long"):
        return f"{name}::bigint as {name}"
    if kind.startswith("decimal"):
        return f"{name}::double as {name}"
    return name


def _table(name: str) -> str:
    columns = ", ".join(_raw_column(f.name, f.dataType.typeName()) for f in RAW_SCHEMAS[name].fields)
    return f"select {columns} from b_{name}"


def _counts(labels: dict[str, str], *more: str) -> str:
    extra = "".join(f", {m}" for m in more)
    return " union all ".join(
        f"select '{label}' as table_name, count(*)::bigint as row_count{extra} from b_{table}"
        for table, label in labels.items()
    )


_SAME = {table: table for table in RAW_SCHEMAS}
_LABELS = {**_SAME, "payments": "order_payments", "reviews": "order_reviews"}


def _shares(table: str, key: str, count: str, share: str) -> str:
    cast = "::bigint" if key == "review_score" else ""
    return f"""
select {key}{cast} as {key}, n as {count}, {percent("n", f"(select count(*) from b_{table})")} as {share}
from (select {key}, count(*) as n from b_{table} group by 1) x"""


def _median(table: str, value: str, unit: int) -> str:
    """Median of an integer-coded column, rounded to two digits."""
    middle = f"""
select sum(v) as pair, count(*) as k from (
  select v, row_number() over (order by v) as i, count(*) over () as n
  from (select ({value})::bigint as v from b_{table}) where v is not null
) where i = (n + 1) // 2 or i = (n + 2) // 2"""
    return f"(select {quotient('pair', f'k * {unit}', 2)} from ({middle}))"


def _nulls(table: str, **names: str) -> str:
    counts = ", ".join(f"(count(*) - count({column}))::bigint as {alias}" for alias, column in names.items())
    return f"select count(*)::bigint as total_rows, {counts} from b_{table}"


def _spread(table: str, column: str, name: str) -> str:
    cents = f"({column} * 100)::bigint"
    return (
        f"min({column})::double as min_{name}, max({column})::double as max_{name}, "
        f"{mean(cents, 2, 100)} as avg_{name}, {_median(table, f'{column} * 100', 100)} as median_{name}"
    )


QUERIES: dict[str, str] = {
    "bronze_load": " union all ".join(
        f"select '{t}' as table_name, count(*)::bigint as row_count, {len(s)}::bigint as column_count from b_{t}"
        for t, s in RAW_SCHEMAS.items()
    ),
    "bronze_load_audit": _counts(_SAME, "'SUCCESS' as status"),
    **{f"bronze_load_{name}": _table(name) for name in RAW_SCHEMAS},
    "profile_row_counts": _counts(_LABELS),
    "profile_customers_cardinality": """
select count(*) as total_rows, count(customer_id) as non_null_customer_id,
  count(distinct customer_id) as distinct_customer_id, count(distinct customer_unique_id) as distinct_customer_unique_id
from b_customers""",
    "profile_customers_by_state": _shares("customers", "customer_state", "customers", "percentage_of_customers"),
    "profile_cities_by_state": """
select customer_state, count(customer_city) as distinct_cities
from (select distinct customer_state, customer_city from b_customers) x group by 1""",
    "profile_orders_timeline": """
select count(*) as total_orders, count(distinct order_id) as distinct_orders, count(distinct customer_id) as distinct_customers,
  min(order_purchase_timestamp) as first_order, max(order_purchase_timestamp) as last_order
from b_orders""",
    "profile_orders_by_year": "select year(order_purchase_timestamp)::bigint as order_year, count(*) as orders from b_orders group by 1",
    "profile_orders_by_status": _shares("orders", "order_status", "order_count", "percentage_of_orders"),
    "profile_order_items": f"""
select count(*) as total_items, count(distinct order_id) as distinct_orders, count(distinct product_id) as distinct_products,
  count(distinct seller_id) as distinct_sellers, {_spread("order_items", "price", "price")},
  {_spread("order_items", "freight_value", "freight")}
from b_order_items""",
    "profile_payments_by_type": _shares("payments", "payment_type", "transactions", "percentage"),
    "profile_payment_values": f"select {_spread('payments', 'payment_value', 'payment')} from b_payments",
    "profile_products": f"""
select count(*) as total_products, count(distinct product_id) as distinct_products,
  count(distinct product_category_name) as categories, min(product_weight_g)::bigint as min_weight,
  max(product_weight_g)::bigint as max_weight, {mean("product_weight_g", 2)} as avg_weight,
  {_median("products", "product_weight_g", 1)} as median_weight
from b_products""",
    "profile_top_categories": """
select product_category_name, product_count from (
  select product_category_name, count(*) as product_count,
    row_number() over (order by count(*) desc, product_category_name nulls last) as place
  from b_products group by 1
) x where place <= 5""",
    "profile_reviews_by_score": _shares("reviews", "review_score", "review_count", "percentage"),
    "profile_review_comments": f"""
select count(*) as total_reviews, count(review_comment_title) as reviews_with_title,
  {percent("count(review_comment_title)", "count(*)")} as perc_reviews_with_title,
  count(review_comment_message) as reviews_with_message,
  {percent("count(review_comment_message)", "count(*)")} as perc_reviews_with_message
from b_reviews""",
    "profile_sellers": """
select count(*) as total_sellers, count(distinct seller_id) as distinct_sellers, count(distinct seller_state) as states
from b_sellers""",
    "profile_geolocation": """
select count(*) as total_rows, count(distinct geolocation_zip_code_prefix) as distinct_zip_prefixes,
  count(distinct geolocation_city) as distinct_cities, count(distinct geolocation_state) as distinct_states
from b_geolocation""",
    "profile_missing_customers": _nulls(
        "customers", missing_customer_id="customer_id", missing_customer_unique_id="customer_unique_id",
        missing_zip="customer_zip_code_prefix", missing_customer_city="customer_city", missing_customer_state="customer_state",
    ),
    "profile_missing_orders": _nulls(
        "orders", missing_order_id="order_id", missing_customer_id="customer_id", missing_order_status="order_status",
        missing_purchase_timestamp="order_purchase_timestamp", missing_approved_at="order_approved_at",
        missing_carrier_date="order_delivered_carrier_date", missing_delivery_date="order_delivered_customer_date",
        missing_estimated_delivery_date="order_estimated_delivery_date",
    ),
    "profile_missing_order_items": _nulls("order_items", **{f"missing_{f.name}": f.name for f in RAW_SCHEMAS["order_items"]}),
    "profile_missing_payments": _nulls("payments", **{f"missing_{f.name}": f.name for f in RAW_SCHEMAS["payments"]}),
    "profile_missing_reviews": _nulls("reviews", **{f"missing_{f.name}": f.name for f in RAW_SCHEMAS["reviews"]}),
    "profile_missing_products": _nulls("products", **{f"missing_{f.name}": f.name for f in RAW_SCHEMAS["products"]}),
    "profile_missing_sellers": _nulls("sellers", **{f"missing_{f.name}": f.name for f in RAW_SCHEMAS["sellers"]}),
    "profile_missing_geolocation": _nulls(
        "geolocation", missing_zip="geolocation_zip_code_prefix", missing_lat="geolocation_lat", missing_lng="geolocation_lng",
        missing_city="geolocation_city", missing_state="geolocation_state",
    ),
    "profile_missing_translation": _nulls(
        "category_translation", missing_portuguese_name="product_category_name", missing_english_name="product_category_name_english",
    ),
}
