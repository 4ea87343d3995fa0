"""Declared schemas of the nine raw tables and of the load audit.

Text columns are plain strings: Spark strings are unbounded, and blank padding of fixed-width
codes is stripped where the codes are used (see ``functions.text.pad_zip``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TS = T.TimestampNTZType()
_MONEY = T.DecimalType(10, 2)
_COORD = T.DecimalType(9, 6)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


def _text(*names: str) -> list[tuple[str, T.DataType]]:
    return [(name, T.StringType()) for name in names]


RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _table(
        *_text(
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        )
    ),
    "orders": _table(
        *_text("order_id", "customer_id", "order_status"),
        ("order_purchase_timestamp", _TS),
        ("order_approved_at", _TS),
        ("order_delivered_carrier_date", _TS),
        ("order_delivered_customer_date", _TS),
        ("order_estimated_delivery_date", T.DateType()),
    ),
    "order_items": _table(
        ("order_id", T.StringType()),
        ("order_item_id", T.ShortType()),
        *_text("product_id", "seller_id"),
        ("shipping_limit_date", _TS),
        ("price", _MONEY),
        ("freight_value", _MONEY),
    ),
    "payments": _table(
        ("order_id", T.StringType()),
        ("payment_sequential", T.ShortType()),
        ("payment_type", T.StringType()),
        ("payment_installments", T.ShortType()),
        ("payment_value", _MONEY),
    ),
    "reviews": _table(
        *_text("review_id", "order_id"),
        ("review_score", T.ShortType()),
        *_text("review_comment_title", "review_comment_message"),
        ("review_creation_date", T.DateType()),
        ("review_answer_timestamp", _TS),
    ),
    "products": _table(
        *_text("product_id", "product_category_name"),
        ("product_name_length", T.ShortType()),
        ("product_description_length", T.IntegerType()),
        ("product_photos_qty", T.ShortType()),
        ("product_weight_g", T.IntegerType()),
        ("product_length_cm", T.ShortType()),
        ("product_height_cm", T.ShortType()),
        ("product_width_cm", T.ShortType()),
    ),
    "sellers": _table(*_text("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")),
    "geolocation": _table(
        ("geolocation_zip_code_prefix", T.StringType()),
        ("geolocation_lat", _COORD),
        ("geolocation_lng", _COORD),
        *_text("geolocation_city", "geolocation_state"),
    ),
    "category_translation": _table(*_text("product_category_name", "product_category_name_english")),
}

AUDIT_SCHEMA = _table(
    ("table_name", T.StringType()),
    ("load_timestamp", _TS),
    ("row_count", T.LongType()),
    ("status", T.StringType()),
)


# Columns of fixed width, in which trailing blanks do not count.
FIXED_WIDTH = {
    "customers": ("customer_zip_code_prefix", "customer_state"),
    "sellers": ("seller_zip_code_prefix", "seller_state"),
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_state"),
}


def unpadded(df: DataFrame, table: str) -> DataFrame:
    """The frame without the blanks that fill up its fixed-width columns."""
    return df.withColumns({name: F.rtrim(name) for name in FIXED_WIDTH.get(table, ())})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project and cast a frame onto the declared schema of ``table``."""
    return unpadded(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[table].fields]), table)
