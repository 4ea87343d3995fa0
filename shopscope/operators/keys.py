"""Key-grain operators: duplicates, cardinalities and orphan checks.

All of them reduce to one row per key with a map-side partial aggregate before anything is
shuffled or joined, so a single key holding a large share of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per distinct key; NULL parts form groups of their own."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def surplus(key: str) -> Column:
    """All rows minus distinct non-NULL keys, as an aggregate over a ``key_counts`` frame."""
    return F.coalesce(F.sum("n"), F.lit(0)) - F.count(key)


def beside(frames: list[DataFrame]) -> DataFrame:
    """Put one-row frames next to each other: the first one, with the others as scalar subqueries."""
    first, *others = frames
    rows = [frame.select(F.struct("*")).scalar() for frame in others]
    columns = [row[name].alias(name) for row, frame in zip(rows, others) for name in frame.columns]
    return first.select("*", *columns)


def distinct_counts(df: DataFrame, **columns: str) -> list[DataFrame]:
    """One single-row frame per requested distinct count.

    A single aggregate with several DISTINCTs would multiply every row by the number of columns
    before its shuffle. Separate aggregates read one column each instead.
    """
    return [
        df.select(column).distinct().agg(F.count(column).alias(alias)) for alias, column in columns.items()
    ]


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Keys of ``child``, with their row counts ``n``, that ``parent`` does not contain.

    A NULL key has no parent and is returned. Both sides hold each key once when they meet.
    """
    known = parent.select(F.col(parent_key or key).alias("_parent")).distinct()
    counts = key_counts(child, key)
    return counts.join(known, counts[key] == known["_parent"], "left_anti")


def total(counts: DataFrame, alias: str) -> DataFrame:
    """Number of rows behind a ``key_counts`` or ``orphan_keys`` frame."""
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(alias))
