"""The 53 rules and two deep dives, and the scorecard over them."""

from __future__ import annotations

import re


def _tally(table: str, **conditions: str) -> str:
    counts = ", ".join(f"count(case when {text} then 1 end) as {alias}" for alias, text in conditions.items())
    return f"select {counts} from b_{table}"


def _unset(table: str, **columns: str) -> str:
    return _tally(table, **{alias: f"{column} is null" for alias, column in columns.items()})


def _unique(table: str, key: str, rows: str, distinct: str, extra: str) -> str:
    return f"""
select count(*) as {rows}, count(distinct {key}) as {distinct}, count(*) - count(distinct {key}) as {extra} from b_{table}"""


def _repeated(table: str, keys: str, count: str) -> str:
    return f"select {keys}, n as {count} from (select {keys}, count(*) as n from b_{table} group by all) x where n > 1"


def _lone(child: str, key: str, parent: str, name: str, measure: str = "count(*)", extra: str = "") -> str:
    return f"""
select {measure} as {name} from b_{child} c
where not exists (select 1 from b_{parent} p where p.{key} = c.{key}){extra}"""


QUERIES: dict[str, str] = {
    "dq_001": _unique("customers", "customer_id", "total_rows", "distinct_customer_ids", "duplicate_customer_id_rows"),
    "dq_002": _repeated("customers", "customer_unique_id", "customer_id_count"),
    "dq_003": """
select count(*) as customers_with_multiple_customer_ids from (
  select customer_unique_id from (select distinct customer_unique_id, customer_id from b_customers) x
  group by 1 having count(customer_id) >= 2
) y""",
    "dq_004": _unset("customers", missing_customer_id="customer_id", missing_customer_unique_id="customer_unique_id"),
    "dq_005": _unique("orders", "order_id", "total_rows", "distinct_order_ids", "duplicate_order_rows"),
    "dq_006": _unset("orders", missing_order_id="order_id", missing_customer_id="customer_id"),
    "dq_007": _lone("orders", "customer_id", "customers", "orphan_orders"),
    "dq_008": _repeated("order_items", "order_id, order_item_id", "duplicate_count").replace(
        "select order_id, order_item_id, n", "select order_id, order_item_id::bigint as order_item_id, n", 1
    ),
    "dq_009": _unset("order_items", missing_order_id="order_id", missing_product_id="product_id", missing_seller_id="seller_id"),
    "dq_010": _lone("order_items", "order_id", "orders", "orphan_order_items"),
    "dq_011": _lone("order_items", "product_id", "products", "orphan_product_references"),
    "dq_012": _lone("order_items", "seller_id", "sellers", "orphan_seller_references"),
    "dq_013": _tally("order_items", invalid_price_records="price is null or price < 0"),
    "dq_014": _tally("order_items", invalid_freight_records="freight_value is null or freight_value < 0"),
    "dq_015": _unset(
        "payments", missing_order_id="order_id", missing_payment_sequence="payment_sequential", missing_payment_type="payment_type"
    ),
    "dq_016": _lone("payments", "order_id", "orders", "orphan_payments"),
    "dq_017": _tally(
        "payments", negative_payment_values="payment_value < 0", missing_payment_values="payment_value is null",
        zero_payment_values="payment_value = 0",
    ),
    "dq_018": "select payment_type from b_payments group by 1",
    "dq_019": _tally("payments", invalid_installments="payment_installments is null or payment_installments < 1"),
    "dq_020": _tally("reviews", invalid_review_scores="review_score is null or review_score < 1 or review_score > 5"),
    "dq_021": _unset("reviews", missing_review_id="review_id", missing_order_id="order_id"),
    "dq_022": _lone("reviews", "order_id", "orders", "orphan_reviews"),
    "dq_023": _repeated("reviews", "review_id", "duplicate_count"),
    "dq_024": _tally("orders", invalid_approval_timestamps="order_purchase_timestamp > order_approved_at"),
    "dq_025": _tally("orders", invalid_carrier_timestamps="order_approved_at > order_delivered_carrier_date"),
    "dq_026": _tally("orders", invalid_delivery_sequence="order_delivered_carrier_date > order_delivered_customer_date"),
    "dq_027": _tally("orders", invalid_estimated_delivery="order_purchase_timestamp::date > order_estimated_delivery_date"),
    "dq_028": _tally("orders", delivery_before_purchase="order_purchase_timestamp > order_delivered_customer_date"),
    "dq_029": _tally(
        "orders", delivered_without_delivery_date="order_delivered_customer_date is null and order_status = 'delivered'"
    ),
    "dq_030": _tally(
        "orders", delivered_without_carrier_date="order_delivered_carrier_date is null and order_status = 'delivered'"
    ),
    "dq_031": _tally(
        "orders", canceled_with_delivery_date="order_delivered_customer_date is not null and order_status = 'canceled'"
    ),
    "dq_032": _tally(
        "orders", unavailable_with_delivery_date="order_delivered_customer_date is not null and order_status = 'unavailable'"
    ),
    "dq_033": "select order_status from b_orders group by 1",
    "dq_034": _unique("products", "product_id", "total_products", "distinct_product_ids", "duplicate_product_rows"),
    "dq_035": _unset("products", missing_product_id="product_id"),
    "dq_036": _tally(
        "products", negative_weight="product_weight_g < 0", zero_weight="product_weight_g = 0", missing_weight="product_weight_g is null"
    ),
    "dq_037": _tally(
        "products", invalid_length="product_length_cm < 1", invalid_height="product_height_cm < 1", invalid_width="product_width_cm < 1"
    ),
    "dq_038": _unset("products", missing_category="product_category_name"),
    "dq_039": _unique("sellers", "seller_id", "total_sellers", "distinct_sellers", "duplicate_seller_rows"),
    "dq_040": _unset("sellers", missing_seller_id="seller_id"),
    "dq_041": _unset("sellers", missing_zip="seller_zip_code_prefix", missing_city="seller_city", missing_state="seller_state"),
    "dq_042": _unset(
        "geolocation", missing_zip="geolocation_zip_code_prefix", missing_latitude="geolocation_lat",
        missing_longitude="geolocation_lng", missing_city="geolocation_city", missing_state="geolocation_state",
    ),
    "dq_043": _tally("geolocation", invalid_latitude="geolocation_lat < -90 or geolocation_lat > 90"),
    "dq_044": _tally("geolocation", invalid_longitude="geolocation_lng < -180 or geolocation_lng > 180"),
    "dq_045": """
select geolocation_zip_code_prefix, n as state_count from (
  select geolocation_zip_code_prefix, count(distinct geolocation_state) as n from b_geolocation group by 1
) x where n > 1""",
    "dq_046": _repeated("category_translation", "product_category_name", "occurrences"),
    "dq_047": _unset(
        "category_translation", missing_portuguese_category="product_category_name",
        missing_english_category="product_category_name_english",
    ),
    "dq_048": _lone(
        "products", "product_category_name", "category_translation", "untranslated_product_categories",
        extra=" and c.product_category_name is not null",
    ),
    "dq_049": _lone("orders", "order_id", "order_items", "orders_without_items"),
    "dq_050": _lone("orders", "order_id", "payments", "orders_without_payment"),
    "dq_051": _lone("orders", "order_id", "reviews", "orders_without_review"),
    "dq_052": _lone("order_items", "seller_id", "sellers", "missing_sellers", "count(distinct c.seller_id)"),
    "dq_053": _lone("order_items", "product_id", "products", "missing_products", "count(distinct c.product_id)"),
    "dq_deep_carrier_before_approval": """
select order_status, count(*) as affected_orders from b_orders
where order_approved_at > order_delivered_carrier_date group by 1""",
    "dq_deep_orders_without_items": _lone(
        "orders", "order_id", "order_items", "orders_without_items", "order_status, count(*)"
    ) + " group by 1",
}

_ENTITIES = {
    "customers": range(1, 5), "orders": [*range(5, 8), *range(24, 34), 49, 50, 51],
    "order_items": [*range(8, 15), 52, 53], "payments": range(15, 20), "reviews": range(20, 24),
    "products": [*range(34, 39), 48], "sellers": range(39, 42), "geolocation": range(42, 46),
    "category_translation": range(46, 48),
}
_LISTED = {"dq_002", "dq_008", "dq_018", "dq_023", "dq_033", "dq_045", "dq_046"}
_VALUES = {"dq_018", "dq_033"}
_NESTED = {"dq_003": "as customers_with_multiple_customer_ids"}
_SURPLUS = {"dq_001": "duplicate_customer_id_rows", "dq_005": "duplicate_order_rows", "dq_034": "duplicate_product_rows",
            "dq_039": "duplicate_seller_rows"}


def _violations(name: str) -> str:
    """The number of violations of a rule, from its own query."""
    if name in _LISTED:
        return f"select count(*) from ({QUERIES[name]}) q"
    if name in _SURPLUS:
        return f"select {_SURPLUS[name]} from ({QUERIES[name]}) q"
    columns = re.findall(r"\bas (\w+)", QUERIES[name].rsplit(" from b_", 1)[0] if name not in _NESTED else _NESTED[name])
    return f"select {' + '.join(columns)} from ({QUERIES[name]}) q"


def _scorecard() -> str:
    rows = []
    for entity, numbers in _ENTITIES.items():
        for number in numbers:
            name = f"dq_{number:03d}"
            passed = "null::boolean" if name in _VALUES else "v = 0"
            rows.append(
                f"select '{name}' as rule_id, '{entity}' as entity, v::bigint as violations, {passed} as passed"
                f" from (select ({_violations(name)}) as v) r"
            )
    return " union all ".join(rows)


QUERIES["doc_dq_scorecard"] = _scorecard()
