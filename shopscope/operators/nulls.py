"""Keeping NULL keys from piling up in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_null_key(df: DataFrame, key: str) -> Column:
    """``key`` for an outer join, with NULLs replaced by values that match nothing.

    NULL keys never join but would all hash to one partition. The replacement starts with a NUL
    character, which the text type of the raw tables cannot hold, and differs from row to row.
    """
    others = [F.col(name) for name in df.columns if name != key]
    filler = F.concat(F.lit("\0"), F.xxhash64(*others).cast("string"))
    return F.coalesce(F.col(key), filler)
