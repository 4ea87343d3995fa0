"""Text clean-up used by the silver transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_zip(column: str) -> Column:
    """Five characters, zero-filled on the left; fixed-width blank padding is dropped first."""
    return F.lpad(F.rtrim(F.col(column)), 5, "0")


def lower_trim(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


def upper_trim(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def blank_to_null(column: str | Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))
