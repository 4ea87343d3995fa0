"""Share-of-total columns over an aggregated frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.numeric import percent


def with_total(grouped: DataFrame, column: str, alias: str) -> DataFrame:
    """Append the grand total of a column, for any number of groups.

    The total is a scalar subquery over the same grouped plan, whose exchange Spark reuses. An
    unpartitioned window would pull every group into one task instead.
    """
    return grouped.withColumn(alias, grouped.agg(F.sum(column)).scalar())


def over_all(column: str) -> Column:
    """The grand total of a column, for a frame whose rule allows a handful of groups only."""
    return F.sum(column).over(Window.partitionBy())


def counts_with_share(df: DataFrame, key: str | Column, count: str, share: str) -> DataFrame:
    """Rows per key and their percentage of all rows."""
    grouped = df.groupBy(key).agg(F.count("*").alias(count))
    rows = with_total(grouped, count, "_all")
    return rows.withColumn(share, percent(F.col(count), F.col("_all"))).drop("_all")
