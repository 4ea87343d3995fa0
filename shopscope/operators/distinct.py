"""Sums and several distinct counts per key, in one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sums_and_distincts(
    df: DataFrame, keys: list[str], distinct: dict[str, str], sums: dict[str, Column], maxima: dict[str, Column] | None = None
) -> DataFrame:
    """Per ``keys``: the distinct non-NULL values of columns, sums, and maxima.

    One grouping set per counted column turns each (key, value) into a single row, to be counted in
    a second step; the sums ride on the first set. Both steps combine map-side, so a key with very
    many rows is spread over its values. Plain DISTINCT aggregates would do the same with one more
    copy of every row.
    """
    maxima = maxima or {}
    counted = list(distinct.values())
    inputs = {**sums, **maxima}
    rows = df.select(*keys, *counted, *[column.alias(f"_{name}") for name, column in inputs.items()])
    per_value = rows.groupingSets([[*keys, column] for column in counted], *keys, *counted).agg(
        *[F.grouping(column).alias(f"_not_{column}") for column in counted],
        *[F.sum(f"_{name}").alias(f"_{name}") for name in sums],
        *[F.max(f"_{name}").alias(f"_{name}") for name in maxima],
    )

    def within(column: str, value: str) -> Column:
        return F.when(F.col(f"_not_{column}") == 0, F.col(value))

    return per_value.groupBy(*keys).agg(
        *[F.count(within(column, column)).alias(alias) for alias, column in distinct.items()],
        *[F.sum(within(counted[0], f"_{name}")).alias(name) for name in sums],
        *[F.max(within(counted[0], f"_{name}")).alias(name) for name in maxima],
    )


def sums_and_distincts_in_place(df: DataFrame, keys: list[str], distinct: dict[str, str], sums: dict[str, Column]) -> DataFrame:
    """The same without maxima, for rows that are already dealt by some of ``keys``: none is copied or shuffled.

    The first row of each value is marked after a sort within the partition.
    """
    rows = df.select(*keys, *distinct.values(), *[column.alias(f"_{name}") for name, column in sums.items()])
    for alias, column in distinct.items():
        alike = Window.partitionBy(*keys, column).orderBy(column)
        rows = rows.withColumn(f"_{alias}", (F.row_number().over(alike) == 1) & F.col(column).isNotNull())
    return rows.groupBy(*keys).agg(
        *[F.count_if(f"_{alias}").alias(alias) for alias in distinct],
        *[F.sum(f"_{name}").alias(name) for name in sums],
    )
