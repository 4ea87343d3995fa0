"""Cleaned, conformed tables and the checks that reconcile them with the raw load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.functions.numeric import DAYS, ratio
from shopscope.functions.text import blank_to_null, lower_trim, pad_zip, upper_trim
from shopscope.operators.keys import beside, key_counts, orphan_keys, surplus, total
from shopscope.operators.nulls import spread_null_key
from shopscope.sources.lazy import LazyTables

MICROS_PER_DAY = 86_400_000_000


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        pad_zip("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        lower_trim("customer_city").alias("customer_city"),
        upper_trim("customer_state").alias("customer_state"),
    )


def orders(raw: DataFrame) -> DataFrame:
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    shipped, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    elapsed = F.timestamp_diff("MICROSECOND", bought, delivered)
    return raw.select(
        "order_id",
        "customer_id",
        lower_trim("order_status").alias("order_status"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce(shipped < approved, F.lit(False)).alias("approval_carrier_timestamp_anomaly"),
        F.coalesce(delivered < shipped, F.lit(False)).alias("delivery_sequence_anomaly"),
        F.when(delivered >= bought, ratio(elapsed, F.lit(MICROS_PER_DAY), 10).cast(DAYS)).alias("delivery_days"),
        F.datediff(delivered.cast("date"), "order_estimated_delivery_date").alias("delivery_vs_estimate_days"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    money = "decimal(12,2)"
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        F.col("price").cast(money).alias("price"),
        F.col("freight_value").cast(money).alias("freight_value"),
        (F.col("price") + F.col("freight_value")).cast(money).alias("item_total_value"),
    )


def payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "payment_sequential",
        lower_trim("payment_type").alias("payment_type"),
        "payment_installments",
        F.col("payment_value").cast("decimal(14,2)").alias("payment_value"),
        F.coalesce(F.col("payment_installments") < 1, F.lit(False)).alias("invalid_installment_flag"),
    )


def reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        "review_score",
        blank_to_null("review_comment_title").alias("review_comment_title"),
        blank_to_null("review_comment_message").alias("review_comment_message"),
        "review_creation_date",
        "review_answer_timestamp",
    )


def products(raw: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """English names are looked up by the raw category; a repeated translation repeats the product."""
    names = raw_translation.select(
        F.col("product_category_name").alias("_category"), "product_category_name_english"
    )
    keyed = raw.withColumn("_key", spread_null_key(raw, "product_category_name"))
    joined = keyed.join(names, F.col("_key") == F.col("_category"), "left")
    unknown = F.lit("unknown")
    return joined.select(
        "product_id",
        F.coalesce(blank_to_null("product_category_name"), unknown).alias("product_category_name"),
        F.coalesce(blank_to_null("product_category_name_english"), unknown).alias("product_category_name_english"),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        F.coalesce(F.col("product_weight_g") == 0, F.lit(False)).alias("zero_weight_flag"),
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        pad_zip("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        lower_trim("seller_city").alias("seller_city"),
        upper_trim("seller_state").alias("seller_state"),
    )


def geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip: mean coordinates, most frequent place, and whether states disagree.

    Places are counted first, so the per-zip aggregate sees each (zip, city, state) once and needs
    neither a window nor a second look at the raw rows.
    """
    places = (
        raw.select(
            pad_zip("geolocation_zip_code_prefix").alias("zip_prefix"),
            lower_trim("geolocation_city").alias("city"),
            upper_trim("geolocation_state").alias("state"),
            "geolocation_lat",
            "geolocation_lng",
        )
        .filter(F.col("zip_prefix").isNotNull())
        .groupBy("zip_prefix", "city", "state")
        .agg(
            F.count("*").alias("n"),
            F.sum("geolocation_lat").alias("lat"),
            F.count("geolocation_lat").alias("lats"),
            F.sum("geolocation_lng").alias("lng"),
            F.count("geolocation_lng").alias("lngs"),
        )
    )
    # Smallest struct = most observations, then names in order with NULLs last.
    rank = F.struct(-F.col("n"), F.col("city").isNull(), "city", F.col("state").isNull(), "state")
    by_zip = places.groupBy("zip_prefix").agg(
        ratio(F.sum("lat"), F.sum("lats")).alias("latitude"),
        ratio(F.sum("lng"), F.sum("lngs")).alias("longitude"),
        F.min(rank).alias("top"),
        F.min("state").alias("first_state"),
        F.max("state").alias("last_state"),
    )
    return by_zip.select(
        "zip_prefix",
        "latitude",
        "longitude",
        "top.city",
        "top.state",
        F.coalesce(F.col("first_state") != F.col("last_state"), F.lit(False)).alias("geographic_ambiguity_flag"),
    )


def category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("product_category_name").alias("product_category_name"),
        F.trim("product_category_name_english").alias("product_category_name_english"),
    )


def build(raw: Mapping[str, DataFrame]) -> LazyTables:
    """All nine silver tables as lazy frames."""
    narrow = {
        "customers": customers,
        "orders": orders,
        "order_items": order_items,
        "payments": payments,
        "reviews": reviews,
        "sellers": sellers,
        "geolocation": geolocation,
        "category_translation": category_translation,
    }
    builders = {name: lambda name=name, clean=clean: clean(raw[name]) for name, clean in narrow.items()}
    builders["products"] = lambda: products(raw["products"], raw["category_translation"])
    return LazyTables(builders)


# --- checks -----------------------------------------------------------------------------------


def check_row_counts(raw: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Raw and silver row counts per table; locations compare with the distinct padded zips."""

    def pair(label: str, before: DataFrame, after: DataFrame) -> DataFrame:
        return beside([before, after]).select(
            F.lit(label).alias("table_name"),
            "bronze_rows",
            "silver_rows",
            (F.col("silver_rows") - F.col("bronze_rows")).alias("difference"),
        )

    def rows(df: DataFrame, alias: str) -> DataFrame:
        return df.agg(F.count("*").alias(alias))

    names = ["customers", "orders", "order_items", "payments", "reviews", "products", "sellers"]
    pairs = [pair(n, rows(raw[n], "bronze_rows"), rows(silver[n], "silver_rows")) for n in names]
    zips = raw["geolocation"].select(pad_zip("geolocation_zip_code_prefix").alias("zip")).distinct()
    located = pair(
        "geolocation (deduplicated)",
        zips.agg(F.count("zip").alias("bronze_rows")),
        rows(silver["geolocation"], "silver_rows"),
    )
    return reduce(DataFrame.unionByName, [*pairs, located])


def check_key_uniqueness(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Surplus rows per declared key. A composite key counts as one value, NULL parts included."""
    single = {"customers": "customer_id", "orders": "order_id", "products": "product_id", "sellers": "seller_id"}
    pairs = {"order_items": ("order_id", "order_item_id"), "reviews": ("review_id", "order_id")}
    checks = []
    for table, key in single.items():
        checks.append((table, key_counts(silver[table], key).agg(surplus(key).alias("duplicate_keys"))))
    for table, keys in pairs.items():
        counts = key_counts(silver[table], *keys)
        checks.append((table, counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))))
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(table).alias("table_name"), F.col("duplicate_keys").cast("bigint")) for table, df in checks],
    )


FOREIGN_KEYS = {
    "orphan_orders": ("orders", "customer_id", "customers"),
    "orphan_order_items_orders": ("order_items", "order_id", "orders"),
    "orphan_order_items_products": ("order_items", "product_id", "products"),
    "orphan_order_items_sellers": ("order_items", "seller_id", "sellers"),
    "orphan_payments_orders": ("payments", "order_id", "orders"),
    "orphan_reviews_orders": ("reviews", "order_id", "orders"),
}


def check_foreign_keys(silver: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for name, (child, key, parent) in FOREIGN_KEYS.items():
        violations = total(orphan_keys(silver[child], key, silver[parent]), "violations")
        parts.append(violations.select(F.lit(name).alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def check_sanity(silver: Mapping[str, DataFrame]) -> DataFrame:
    conditions = [
        ("customers", "invalid_cust_zip_lengths", F.length("customer_zip_code_prefix") != 5),
        ("sellers", "invalid_seller_zip_lengths", F.length("seller_zip_code_prefix") != 5),
        ("orders", "negative_delivery_days", F.col("delivery_days") < 0),
        ("payments", "flagged_installments", F.col("invalid_installment_flag")),
        ("products", "zero_weight_products", F.col("zero_weight_flag")),
    ]
    return beside([silver[table].agg(F.count_if(rule).alias(alias)) for table, alias, rule in conditions])
