"""Cleaning rules on hand-made rows."""

from decimal import Decimal

from shopscope.plans import silver
from tests.fixtures import order, raw_table, raw_tables


def test_zip_is_padded_and_cut(spark):
    zips = ["123", "123  ", "1234567", None]
    rows = [{"customer_id": str(i), "customer_zip_code_prefix": z, "customer_city": " São X ", "customer_state": " sp"} for i, z in enumerate(zips)]
    found = silver.customers(raw_table(spark, "customers", rows)).orderBy("customer_id").collect()
    assert [row["customer_zip_code_prefix"] for row in found] == ["00123", "00123", "12345", None]
    assert found[0]["customer_city"] == "são x" and found[0]["customer_state"] == "SP"


def test_delivery_metrics_and_flags(spark):
    rows = [
        order(1, order_delivered_customer_date="2020-01-01 09:00:00", order_estimated_delivery_date="2020-01-02"),
        order(2),
        order(3, order_delivered_customer_date="2020-01-02 11:00:00", order_estimated_delivery_date="2020-01-02",
              order_delivered_carrier_date="2020-01-03 00:00:00", order_approved_at="2020-01-04 00:00:00"),
    ]
    found = silver.orders(raw_table(spark, "orders", rows)).orderBy("order_id").collect()
    assert [row["delivery_days"] for row in found] == [None, None, Decimal("1.0416666667")]
    assert [row["delivery_vs_estimate_days"] for row in found] == [-1, None, 0]
    assert [row["approval_carrier_timestamp_anomaly"] for row in found] == [False, False, True]
    assert [row["delivery_sequence_anomaly"] for row in found] == [False, False, True]


def test_item_total_needs_both_parts(spark):
    rows = [{"order_id": "a", "price": "1.10", "freight_value": "2.20"}, {"order_id": "b", "price": "1.10"}]
    found = silver.order_items(raw_table(spark, "order_items", rows)).orderBy("order_id").collect()
    assert [row["item_total_value"] for row in found] == [Decimal("3.30"), None]


def test_installment_flag(spark):
    rows = [{"order_id": str(i), "payment_type": " BOLETO ", "payment_installments": n} for i, n in enumerate([0, 1, None])]
    found = silver.payments(raw_table(spark, "payments", rows)).orderBy("order_id").collect()
    assert [row["invalid_installment_flag"] for row in found] == [True, False, False]
    assert found[0]["payment_type"] == "boleto"


def test_blank_comments_become_null_and_repeats_stay(spark):
    rows = [{"review_id": "r", "order_id": "o", "review_comment_title": "  ", "review_comment_message": " hi "}] * 2
    found = silver.reviews(raw_table(spark, "reviews", rows)).collect()
    assert [(row["review_comment_title"], row["review_comment_message"]) for row in found] == [(None, "hi")] * 2


def test_products_take_names_by_raw_category(spark):
    raw = raw_tables(
        spark,
        products=[
            {"product_id": "1", "product_category_name": "casa", "product_weight_g": 0},
            {"product_id": "2", "product_category_name": " casa "},
            {"product_id": "3"},
            {"product_id": "4", "product_category_name": "dup", "product_weight_g": 5},
        ],
        category_translation=[
            {"product_category_name": "casa", "product_category_name_english": " home "},
            {"product_category_name": "dup", "product_category_name_english": ""},
            {"product_category_name": "dup"},
        ],
    )
    found = silver.products(raw["products"], raw["category_translation"]).orderBy("product_id").collect()
    names = [(r["product_category_name"], r["product_category_name_english"], r["zero_weight_flag"]) for r in found]
    assert names == [("casa", "home", True), ("casa", "unknown", False), ("unknown", "unknown", False)] + [("dup", "unknown", False)] * 2


def test_geolocation_mode_and_ambiguity(spark):
    def point(zip_code, city, state, lat=1):
        return {"geolocation_zip_code_prefix": zip_code, "geolocation_city": city, "geolocation_state": state, "geolocation_lat": lat}

    rows = [point("1", "b", "sp", 1), point("1", "a", "sp", 2), point("2", "x", "rj"), point("2", "x", "rj"), point("2", "a", "sp"),
            point(None, "a", "sp"), point("3", None, "sp", None), point("3", "z", None, None)]
    found = {r["zip_prefix"]: r for r in silver.geolocation(raw_table(spark, "geolocation", rows)).collect()}
    assert set(found) == {"00001", "00002", "00003"}
    assert (found["00001"]["city"], found["00001"]["geographic_ambiguity_flag"]) == ("a", False)
    assert found["00001"]["latitude"] == Decimal("1.5")
    assert (found["00002"]["city"], found["00002"]["state"], found["00002"]["geographic_ambiguity_flag"]) == ("x", "RJ", True)
    assert (found["00003"]["city"], found["00003"]["latitude"]) == ("z", None)


def test_composite_keys_count_null_parts(spark):
    rows = [{"order_id": "a"}, {"order_id": "a", "order_item_id": 2}, {}, {"order_id": "a"}]
    checks = silver.check_key_uniqueness(silver.build(raw_tables(spark, order_items=rows)))
    assert {r["table_name"]: r["duplicate_keys"] for r in checks.collect()}["order_items"] == 1


def test_foreign_keys_count_null_keys(spark):
    raw = raw_tables(spark, orders=[order(1), order(2, customer="gone"), {"order_id": "o3"}], customers=[{"customer_id": "c1"}])
    checks = silver.check_foreign_keys(silver.build(raw))
    assert {r["check_name"]: r["violations"] for r in checks.collect()}["orphan_orders"] == 2
