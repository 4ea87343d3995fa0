"""Order, customer and category rules on hand-made rows."""

from decimal import Decimal

import pytest

from shopscope.plans import gold
from shopscope.plans.lakehouse import Lakehouse
from tests.fixtures import customer, order, raw_tables


def _lake(spark, workspace, **tables):
    return Lakehouse(raw_tables(spark, **tables), workspace)


def _by(df, key):
    return {row[key]: row for row in df.collect()}


def test_bare_order_has_zeros_and_no_averages(spark, workspace):
    row = _lake(spark, workspace, orders=[order(1)]).order_summary.first()
    assert (row["total_items"], row["payment_records"], row["review_count"]) == (0, 0, 0)
    assert row["order_item_value"] == 0 and row["total_payment_value"] == 0
    assert row["average_item_price"] is None and row["average_review_score"] is None and row["delivered_late"] is None


def test_orders_without_an_id_are_kept(spark, workspace):
    orders = [{"customer_id": "c1"}, {"customer_id": "c1"}, order(1)]
    lake = _lake(spark, workspace, orders=orders, payments=[{"payment_value": "5"}, {"order_id": "o1", "payment_value": "7"}])
    rows = lake.order_summary.collect()
    assert sorted((str(r["order_id"]), r["total_payment_value"]) for r in rows) == [("None", 0), ("None", 0), ("o1", 7)]


def test_delivered_late_has_three_states(spark, workspace):
    def delivered(number, day):
        return order(number, order_delivered_customer_date=day, order_estimated_delivery_date="2020-01-10")

    lake = _lake(spark, workspace, orders=[delivered(1, "2020-01-11 00:00:00"), delivered(2, "2020-01-10 23:00:00"), delivered(3, None)])
    assert {k: r["delivered_late"] for k, r in _by(lake.order_summary, "order_id").items()} == {"o1": True, "o2": False, "o3": None}


def test_customer_activity_and_profile(spark, workspace):
    lake = _lake(
        spark, workspace,
        customers=[customer(1, "u", customer_city="old"), customer(2, "u", customer_city="new"), customer(3, "v", customer_city="dated"),
                   customer(4, "v", customer_city="undated"), customer(5, "w"), customer(6, "none")],
        orders=[order(1, bought="2020-01-01 23:00:00"), order(2, bought="2020-01-03 01:00:00"), order(3), order(4, bought=None),
                order(5), order(7, customer="c5"), order(8, customer="gone")],
    )
    found = _by(lake.customer_360, "customer_unique_id")
    assert set(found) == {"u", "v", "w"}
    assert (found["u"]["customer_activity_days"], found["u"]["customer_city"], found["u"]["repeat_customer"]) == (1, "new", True)
    assert found["u"]["orders_per_month"] == 60
    assert found["v"]["customer_city"] == "undated"
    assert (found["w"]["customer_activity_days"], found["w"]["orders_per_month"], found["w"]["total_orders"]) == (0, None, 2)


@pytest.mark.parametrize(
    ("kinds", "expected"),
    [
        (["boleto", "credit_card"], "credit_card"),
        (["voucher", "boleto"], "boleto"),
        (["debit_card", "voucher"], "voucher"),
        (["debit_card"], "debit_card"),
        (["not_defined"], "credit_card"),
        ([], "credit_card"),
    ],
)
def test_primary_payment(spark, workspace, kinds, expected):
    payments = [{"order_id": "o1", "payment_type": kind, "payment_value": "1"} for kind in kinds]
    lake = _lake(spark, workspace, customers=[customer(1)], orders=[order(1)], payments=payments)
    assert lake.customer_360.first()["primary_payment_method"] == expected


def test_review_average_is_rounded_per_order_first(spark, workspace):
    reviews = [{"review_id": "r", "order_id": "o1", "review_score": s} for s in (5, 5, 4)]
    reviews += [{"review_id": "r", "order_id": "o2", "review_score": s} for s in (1, 1, 2)]
    lake = _lake(spark, workspace, customers=[customer(1, "u"), customer(2, "u")], orders=[order(1), order(2)], reviews=reviews)
    # 4.67 and 1.33, whose mean is 3.00; the low rate is 3 of 6.
    row = lake.customer_experience.first()
    assert (row["average_review_score"], row["low_review_rate"]) == (Decimal("3.00"), Decimal("0.50"))
    assert (row["has_low_rating"], row["has_delivery_delay"], row["poor_experience_flag"]) == (True, False, False)


def test_late_rate_may_exceed_one(spark, workspace):
    early = {"order_delivered_customer_date": "2019-12-31 10:00:00", "order_estimated_delivery_date": "2019-12-01"}
    late = {"order_delivered_customer_date": "2020-01-09 10:00:00", "order_estimated_delivery_date": "2020-01-02"}
    lake = _lake(spark, workspace, customers=[customer(i, "u") for i in (1, 2)], orders=[order(1, **early), order(2, **late)])
    assert lake.customer_experience.first()["late_order_rate"] == 2


def test_category_ranks_and_shares(spark, workspace):
    def item(number, product, price):
        return {"order_id": f"o{number}", "order_item_id": 1, "product_id": product, "seller_id": "s", "price": price}

    lake = _lake(
        spark, workspace,
        customers=[customer(1, "u"), customer(2, "z"), customer(2, "z")],
        orders=[order(1), order(2)],
        products=[{"product_id": p, "product_category_name": p} for p in "ab"],
        category_translation=[{"product_category_name": p, "product_category_name_english": p} for p in "ab"],
        order_items=[item(1, "a", "10"), item(1, "b", "10"), item(1, "gone", None), item(2, "a", "0")],
    )
    found = {(r["customer_unique_id"], r["product_category"]): r for r in lake.customer_category_behavior.collect()}
    assert found["u", "unknown"]["category_value_rank"] == 1 and found["u", "unknown"]["category_spend_share"] is None
    assert found["u", "a"]["category_value_rank"] == found["u", "b"]["category_value_rank"] == 2
    assert found["u", "a"]["category_spend_share"] == Decimal("0.50")
    assert found["u", "a"]["category_order_share"] == Decimal("0.33")
    # The account is listed twice, so its item counts twice; zero spend has no share.
    assert (found["z", "a"]["category_items"], found["z", "a"]["category_orders"]) == (2, 1)
    assert found["z", "a"]["category_spend_share"] is None


@pytest.mark.parametrize(
    ("frequency", "monetary", "recency", "label"),
    [
        (2, 4, 1, "High-Value Repeat"),
        (2, 3, 5, "Developing Repeat"),
        (1, 4, 5, "High-Value One-Time"),
        (1, 3, 4, "Recent One-Time"),
        (1, 2, 2, "Low-Value Inactive"),
        (1, 3, 3, "Established One-Time"),
    ],
)
def test_segments(spark, frequency, monetary, recency, label):
    df = spark.createDataFrame([(frequency, monetary, recency)], "frequency int, monetary_quintile int, recency_quintile int")
    assert df.select(gold.segment()).first()[0] == label


def test_recency_score_and_quintile_differ(spark, workspace):
    orders = [order(i, bought=f"2020-01-0{i} 00:00:00") for i in range(1, 7)]
    lake = _lake(spark, workspace, customers=[customer(i) for i in range(1, 7)], orders=orders)
    rows = sorted(lake.customer_intelligence.collect(), key=lambda r: r["recency_days"])
    assert [r["recency_days"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["recency_quintile"] for r in rows] == [5, 5, 4, 3, 2, 1]
    assert [r["recency_score"] for r in rows] == [5, 4, 3, 2, 1, 1]


def test_empty_input(spark, workspace):
    lake = _lake(spark, workspace)
    assert lake.customer_intelligence.count() == 0
    row = lake.executive_kpis.first()
    assert row["total_customers"] == 0 and row["repeat_customer_rate"] is None and row["total_revenue"] is None


def test_a_person_without_id_has_no_address(spark, workspace):
    nobody = {**customer(1, "u"), "customer_unique_id": None, "customer_city": "x", "customer_state": "S"}
    lake = _lake(spark, workspace, customers=[nobody], orders=[order(1)])
    row = lake.customer_360.first()
    assert row["customer_unique_id"] is None and row["total_orders"] == 1
    assert (row["customer_city"], row["customer_state"], row["customer_zip_code_prefix"]) == (None, None, None)
    assert lake.customer_intelligence.first()["customer_state"] is None
