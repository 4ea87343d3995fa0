"""Small raw tables from partial rows; columns not given are NULL."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from shopscope.sources.schemas import RAW_SCHEMAS


def _value(field: T.StructField, value):
    if value is None:
        return None
    if isinstance(field.dataType, T.DecimalType):
        return Decimal(str(value))
    if isinstance(field.dataType, T.TimestampNTZType) and isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(field.dataType, T.DateType) and isinstance(value, str):
        return date.fromisoformat(value)
    return value


def raw_table(spark, table: str, rows: list[dict]):
    schema = RAW_SCHEMAS[table]
    return spark.createDataFrame([tuple(_value(f, row.get(f.name)) for f in schema) for row in rows], schema)


def raw_tables(spark, **tables: list[dict]):
    return {name: raw_table(spark, name, tables.get(name, [])) for name in RAW_SCHEMAS}


def order(number, customer=None, bought="2020-01-01 10:00:00", **more):
    return {
        "order_id": f"o{number}",
        "customer_id": customer or f"c{number}",
        "order_status": "delivered",
        "order_purchase_timestamp": bought,
        **more,
    }


def customer(number, person=None, **more):
    return {"customer_id": f"c{number}", "customer_unique_id": person or f"u{number}", **more}
