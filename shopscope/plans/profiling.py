"""Profiles of the raw tables: sizes, cardinalities, distributions and missing values."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.numeric import mean, percent
from shopscope.operators.keys import beside, distinct_counts
from shopscope.operators.order_stats import column_quantiles, interpolated
from shopscope.operators.shares import counts_with_share

Raw = Mapping[str, DataFrame]

# Labels of the row-count report.
TABLE_LABELS = {
    "customers": "customers",
    "orders": "orders",
    "order_items": "order_items",
    "payments": "order_payments",
    "reviews": "order_reviews",
    "products": "products",
    "sellers": "sellers",
    "geolocation": "geolocation",
    "category_translation": "category_translation",
}

# Missing-value reports: output alias -> column, where the alias is not simply missing_<column>.
MISSING_ALIASES: dict[str, dict[str, str]] = {
    "customers": {"customer_zip_code_prefix": "missing_zip"},
    "orders": {
        "order_purchase_timestamp": "missing_purchase_timestamp",
        "order_approved_at": "missing_approved_at",
        "order_delivered_carrier_date": "missing_carrier_date",
        "order_delivered_customer_date": "missing_delivery_date",
        "order_estimated_delivery_date": "missing_estimated_delivery_date",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "missing_zip",
        "geolocation_lat": "missing_lat",
        "geolocation_lng": "missing_lng",
        "geolocation_city": "missing_city",
        "geolocation_state": "missing_state",
    },
    "category_translation": {
        "product_category_name": "missing_portuguese_name",
        "product_category_name_english": "missing_english_name",
    },
}


def row_counts(raw: Raw) -> DataFrame:
    counts = [
        raw[table].agg(F.count("*").alias("row_count")).select(F.lit(label).alias("table_name"), "row_count")
        for table, label in TABLE_LABELS.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("row_count"), "table_name")


def missing_alias(table: str, column: str) -> str:
    return MISSING_ALIASES.get(table, {}).get(column, f"missing_{column}")


def missing(df: DataFrame, table: str) -> DataFrame:
    """Total rows and the NULL count of every column, in one pass."""
    nulls = [F.count_if(F.col(c).isNull()).alias(missing_alias(table, c)) for c in df.columns]
    return df.agg(F.count("*").alias("total_rows"), *nulls)


def customers_cardinality(raw: Raw) -> DataFrame:
    df = raw["customers"]
    counts = df.agg(F.count("*").alias("total_rows"), F.count("customer_id").alias("non_null_customer_id"))
    distinct = distinct_counts(df, distinct_customer_id="customer_id", distinct_customer_unique_id="customer_unique_id")
    return beside([counts, *distinct])


def customers_by_state(raw: Raw) -> DataFrame:
    shares = counts_with_share(raw["customers"], "customer_state", "customers", "percentage_of_customers")
    return shares.orderBy(F.desc("customers"), "customer_state")


def cities_by_state(raw: Raw) -> DataFrame:
    pairs = raw["customers"].select("customer_state", "customer_city").distinct()
    counts = pairs.groupBy("customer_state").agg(F.count("customer_city").alias("distinct_cities"))
    return counts.orderBy(F.desc("distinct_cities"), "customer_state")


def orders_timeline(raw: Raw) -> DataFrame:
    df = raw["orders"]
    span = df.agg(
        F.count("*").alias("total_orders"),
        F.min("order_purchase_timestamp").alias("first_order"),
        F.max("order_purchase_timestamp").alias("last_order"),
    )
    distinct = distinct_counts(df, distinct_orders="order_id", distinct_customers="customer_id")
    return beside([span, *distinct]).select(
        "total_orders", "distinct_orders", "distinct_customers", "first_order", "last_order"
    )


def orders_by_year(raw: Raw) -> DataFrame:
    year = F.year("order_purchase_timestamp").alias("order_year")
    return raw["orders"].groupBy(year).agg(F.count("*").alias("orders")).orderBy(F.asc_nulls_last("order_year"))


def orders_by_status(raw: Raw) -> DataFrame:
    shares = counts_with_share(raw["orders"], "order_status", "order_count", "percentage_of_orders")
    return shares.orderBy(F.desc("order_count"), "order_status")


def _spread(column: str, name: str) -> list[Column]:
    return [
        F.min(column).alias(f"min_{name}"),
        F.max(column).alias(f"max_{name}"),
        mean(F.col(column), 2).alias(f"avg_{name}"),
    ]


def _medians(df: DataFrame, columns: dict[str, str], money: bool, bits: int) -> DataFrame:
    """One row with the median of each column, rounded to two digits."""
    scale = 100 if money else 1
    coded = {name: F.col(column) * scale for name, column in columns.items()}
    found = column_quantiles(df, coded, [50], bits).withColumn(
        "median", F.round(interpolated() / F.lit(scale).cast("decimal(3,0)"), 2).cast("decimal(20,2)")
    )
    picked = [F.max(F.when(F.col("metric") == name, F.col("median"))).alias(f"median_{name}") for name in columns]
    return found.agg(*picked)


# decimal(10,2) in cents needs 34 bits with its sign; a raw integer column has 32.
_MONEY_BITS = 34
_INT_BITS = 32


def order_items(raw: Raw) -> DataFrame:
    df = raw["order_items"]
    spread = df.agg(F.count("*").alias("total_items"), *_spread("price", "price"), *_spread("freight_value", "freight"))
    distinct = distinct_counts(
        df, distinct_orders="order_id", distinct_products="product_id", distinct_sellers="seller_id"
    )
    medians = _medians(df, {"price": "price", "freight": "freight_value"}, True, _MONEY_BITS)
    return beside([spread, *distinct, medians]).select(
        "total_items",
        "distinct_orders",
        "distinct_products",
        "distinct_sellers",
        *[f"{stat}_{name}" for name in ("price", "freight") for stat in ("min", "max", "avg", "median")],
    )


def payments_by_type(raw: Raw) -> DataFrame:
    shares = counts_with_share(raw["payments"], "payment_type", "transactions", "percentage")
    return shares.orderBy(F.desc("transactions"), "payment_type")


def payment_values(raw: Raw) -> DataFrame:
    df = raw["payments"]
    return beside([df.agg(*_spread("payment_value", "payment")), _medians(df, {"payment": "payment_value"}, True, _MONEY_BITS)])


def products(raw: Raw) -> DataFrame:
    df = raw["products"]
    spread = df.agg(F.count("*").alias("total_products"), *_spread("product_weight_g", "weight"))
    distinct = distinct_counts(df, distinct_products="product_id", categories="product_category_name")
    medians = _medians(df, {"weight": "product_weight_g"}, False, _INT_BITS)
    return beside([spread, *distinct, medians]).select(
        "total_products", "distinct_products", "categories", "min_weight", "max_weight", "avg_weight", "median_weight"
    )


def top_categories(raw: Raw, limit: int = 5) -> DataFrame:
    counts = raw["products"].groupBy("product_category_name").agg(F.count("*").alias("product_count"))
    return counts.orderBy(F.desc("product_count"), F.asc_nulls_last("product_category_name")).limit(limit)


def reviews_by_score(raw: Raw) -> DataFrame:
    shares = counts_with_share(raw["reviews"], "review_score", "review_count", "percentage")
    return shares.orderBy(F.asc_nulls_last("review_score"))


def review_comments(raw: Raw) -> DataFrame:
    every = F.count("*")
    title, message = F.count("review_comment_title"), F.count("review_comment_message")
    return raw["reviews"].agg(
        every.alias("total_reviews"),
        title.alias("reviews_with_title"),
        percent(title, every).alias("perc_reviews_with_title"),
        message.alias("reviews_with_message"),
        percent(message, every).alias("perc_reviews_with_message"),
    )


def sellers(raw: Raw) -> DataFrame:
    df = raw["sellers"]
    return beside(
        [
            df.agg(F.count("*").alias("total_sellers")),
            *distinct_counts(df, distinct_sellers="seller_id", states="seller_state"),
        ]
    )


def geolocation(raw: Raw) -> DataFrame:
    df = raw["geolocation"]
    distinct = distinct_counts(
        df,
        distinct_zip_prefixes="geolocation_zip_code_prefix",
        distinct_cities="geolocation_city",
        distinct_states="geolocation_state",
    )
    return beside([df.agg(F.count("*").alias("total_rows")), *distinct])


PROFILES = {
    "profile_row_counts": row_counts,
    "profile_customers_cardinality": customers_cardinality,
    "profile_customers_by_state": customers_by_state,
    "profile_cities_by_state": cities_by_state,
    "profile_orders_timeline": orders_timeline,
    "profile_orders_by_year": orders_by_year,
    "profile_orders_by_status": orders_by_status,
    "profile_order_items": order_items,
    "profile_payments_by_type": payments_by_type,
    "profile_payment_values": payment_values,
    "profile_products": products,
    "profile_top_categories": top_categories,
    "profile_reviews_by_score": reviews_by_score,
    "profile_review_comments": review_comments,
    "profile_sellers": sellers,
    "profile_geolocation": geolocation,
    "profile_missing_customers": lambda raw: missing(raw["customers"], "customers"),
    "profile_missing_orders": lambda raw: missing(raw["orders"], "orders"),
    "profile_missing_order_items": lambda raw: missing(raw["order_items"], "order_items"),
    "profile_missing_payments": lambda raw: missing(raw["payments"], "payments"),
    "profile_missing_reviews": lambda raw: missing(raw["reviews"], "reviews"),
    "profile_missing_products": lambda raw: missing(raw["products"], "products"),
    "profile_missing_sellers": lambda raw: missing(raw["sellers"], "sellers"),
    "profile_missing_geolocation": lambda raw: missing(raw["geolocation"], "geolocation"),
    "profile_missing_translation": lambda raw: missing(raw["category_translation"], "category_translation"),
}
