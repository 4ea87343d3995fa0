"""Silver tables and their checks."""

from __future__ import annotations

from oracles.exact import money, scaled

_DELIVERY = f"""
order_id, customer_id, status as order_status, bought as order_purchase_timestamp, approved as order_approved_at,
shipped as order_delivered_carrier_date, delivered as order_delivered_customer_date, promised as order_estimated_delivery_date,
early_carrier as approval_carrier_timestamp_anomaly, early_delivery as delivery_sequence_anomaly,
{scaled("days_e10", 10)} as delivery_days, days_late::bigint as delivery_vs_estimate_days"""

_INTS = ("product_name_length", "product_description_length", "product_photos_qty", "product_weight_g", "product_length_cm",
         "product_height_cm", "product_width_cm")


def _reconcile() -> str:
    same = {"customers": "customers", "orders": "orders", "order_items": "items", "payments": "payments",
            "reviews": "reviews", "products": "products", "sellers": "sellers"}
    counts = [(name, f"select count(*) from b_{name}", f"select count(*) from s_{layer}") for name, layer in same.items()]
    counts.append(("geolocation (deduplicated)", "select count(distinct zip) from s_points", "select count(*) from s_places"))
    return " union all ".join(
        f"select '{n}' as table_name, b as bronze_rows, s as silver_rows, s - b as difference"
        f" from (select ({before}) as b, ({after}) as s) x"
        for n, before, after in counts
    )


def _surplus() -> str:
    single = {"customers": ("customers", "customer_id"), "orders": ("orders", "order_id"),
              "products": ("products", "product_id"), "sellers": ("sellers", "seller_id")}
    parts = [
        f"select '{name}' as table_name, count(*) - count(distinct {key}) as duplicate_keys from s_{layer}"
        for name, (layer, key) in single.items()
    ]
    for name, layer, keys in (("order_items", "items", "order_id, order_item_id"), ("reviews", "reviews", "review_id, order_id")):
        groups = f"(select count(*) from (select distinct {keys} from s_{layer}) d)"
        parts.append(f"select '{name}', count(*) - {groups} from s_{layer}")
    return " union all ".join(parts)


def _orphans() -> str:
    links = {
        "orphan_orders": ("orders", "customer_id", "customers"),
        "orphan_order_items_orders": ("items", "order_id", "orders"),
        "orphan_order_items_products": ("items", "product_id", "products"),
        "orphan_order_items_sellers": ("items", "seller_id", "sellers"),
        "orphan_payments_orders": ("payments", "order_id", "orders"),
        "orphan_reviews_orders": ("reviews", "order_id", "orders"),
    }
    return " union all ".join(
        f"select '{name}' as check_name, count(*) as violations from s_{child} c"
        f" where not exists (select 1 from s_{parent} p where p.{key} = c.{key})"
        for name, (child, key, parent) in links.items()
    )


QUERIES: dict[str, str] = {
    "silver_customers": """
select customer_id, customer_unique_id, zip as customer_zip_code_prefix, city as customer_city, state as customer_state
from s_customers""",
    "silver_orders": f"select {_DELIVERY} from s_orders",
    "silver_order_items": f"""
select order_id, order_item_id::bigint as order_item_id, product_id, seller_id, shipping_limit_date,
  {money("price_c")} as price, {money("freight_c")} as freight_value, {money("price_c + freight_c")} as item_total_value
from s_items""",
    "silver_payments": f"""
select order_id, payment_sequential::bigint as payment_sequential, kind as payment_type,
  installments::bigint as payment_installments, {money("paid_c")} as payment_value,
  coalesce(installments <= 0, false) as invalid_installment_flag
from s_payments""",
    "silver_reviews": """
select review_id, order_id, score::bigint as review_score, title as review_comment_title, message as review_comment_message,
  review_creation_date, review_answer_timestamp
from s_reviews""",
    "silver_products": f"""
select product_id, category as product_category_name, english as product_category_name_english,
  coalesce(product_weight_g = 0, false) as zero_weight_flag, {", ".join(f"{c}::bigint as {c}" for c in _INTS)}
from s_products""",
    "silver_sellers": "select seller_id, zip as seller_zip_code_prefix, city as seller_city, state as seller_state from s_sellers",
    "silver_geolocation": f"""
select zip as zip_prefix, {scaled("latitude_e10", 10)} as latitude, {scaled("longitude_e10", 10)} as longitude, city, state,
  states >= 2 as geographic_ambiguity_flag
from s_places""",
    "silver_category_translation": """
select trim(product_category_name) as product_category_name, trim(product_category_name_english) as product_category_name_english
from b_category_translation""",
    "silver_check_row_counts": _reconcile(),
    "silver_check_key_uniqueness": _surplus(),
    "silver_check_foreign_keys": _orphans(),
    "silver_check_sanity": """
select count(case when length(zip) <> 5 then 1 end) as invalid_cust_zip_lengths,
  (select count(*) from s_sellers where length(zip) <> 5) as invalid_seller_zip_lengths,
  (select count(*) from s_orders where days_e10 < 0) as negative_delivery_days,
  (select count(*) from s_payments where installments <= 0) as flagged_installments,
  (select count(*) from s_products where product_weight_g = 0) as zero_weight_products
from s_customers""",
}
