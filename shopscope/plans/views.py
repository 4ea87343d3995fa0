"""Management views over the customer profile. Results are a handful of rows, sorted for reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.numeric import MONEY, mean, money_percent, percent, ratio
from shopscope.operators.shares import over_all
from shopscope.plans.gold import PERSON, experience_averages

TARGET_SEGMENTS = ("High-Value One-Time", "Recent One-Time", "Developing Repeat", "Low-Value Inactive")


def _economics() -> list[Column]:
    value, orders = F.col("monetary_value"), F.col("frequency")
    return [
        F.count("*").alias("customers"),
        F.sum(value).cast(MONEY).alias("total_revenue"),
        mean(value, 2).alias("average_customer_value"),
        mean(orders, 2).alias("average_orders"),
        ratio(F.sum(value), F.sum(orders), 2).alias("average_order_value"),
        mean(F.col("recency_days"), 1).alias("average_recency_days"),
        F.min(value).cast(MONEY).alias("minimum_customer_value"),
        F.max(value).cast(MONEY).alias("maximum_customer_value"),
    ]


def _shared(grouped: DataFrame, *columns: str) -> DataFrame:
    """Add each group's share of customers and revenue and keep the named columns."""
    return grouped.select(
        "*",
        percent(F.col("customers"), over_all("customers")).alias("customer_percentage"),
        money_percent(F.col("total_revenue"), over_all("total_revenue")).alias("revenue_percentage"),
    ).select(*columns)


def customer_segments(profile: DataFrame) -> DataFrame:
    return _shared(
        profile.groupBy("customer_segment").agg(*_economics()),
        "customer_segment",
        "customers",
        "customer_percentage",
        "total_revenue",
        "revenue_percentage",
        "average_customer_value",
        "average_orders",
        "average_order_value",
        "average_recency_days",
    ).orderBy(F.desc_nulls_first("total_revenue"), "customer_segment")


def customer_type() -> Column:
    return F.when(F.col("frequency") > 1, "Repeat customer").otherwise("One-time customer")


def customer_type_performance(profile: DataFrame) -> DataFrame:
    return _shared(
        profile.groupBy(customer_type().alias("customer_type")).agg(*_economics()),
        "customer_type",
        "customers",
        "customer_percentage",
        "total_revenue",
        "revenue_percentage",
        "average_customer_value",
        "average_orders",
        "average_order_value",
    ).orderBy(F.desc_nulls_first("total_revenue"), "customer_type")


def revenue_concentration(profile: DataFrame) -> DataFrame:
    """By monetary quintile. The quintile already stored is the same tiling of the same values."""
    return _shared(
        profile.groupBy("monetary_quintile").agg(*_economics()),
        "monetary_quintile",
        "customers",
        "customer_percentage",
        "minimum_customer_value",
        "maximum_customer_value",
        "average_customer_value",
        "total_revenue",
        "revenue_percentage",
    ).orderBy("monetary_quintile")


def _known(profile: DataFrame) -> DataFrame:
    """Customers that have an experience row; a NULL person matches none."""
    return profile.filter(F.col(PERSON).isNotNull())


def experience_by(profile: DataFrame, key: Column, alias: str) -> DataFrame:
    return _known(profile).groupBy(key.alias(alias)).agg(F.count("*").alias("customers"), *experience_averages())


def customer_experience(profile: DataFrame) -> DataFrame:
    by_segment = experience_by(profile, F.col("customer_segment"), "customer_segment")
    return by_segment.orderBy(F.asc_nulls_last("average_review_score"), "customer_segment")


def retention_opportunities(profile: DataFrame) -> DataFrame:
    targets = _known(profile).filter(F.col("customer_segment").isin(*TARGET_SEGMENTS))
    return (
        targets.groupBy("customer_segment")
        .agg(*_economics(), *experience_averages())
        .select(
            "customer_segment",
            "customers",
            F.col("total_revenue").alias("associated_revenue"),
            "average_customer_value",
            "average_orders",
            "average_recency_days",
            "average_delivery_days",
            "average_late_order_rate_pct",
            "average_review_score",
            "poor_experience_rate_pct",
        )
        .orderBy(F.desc_nulls_first("associated_revenue"), "customer_segment")
    )
