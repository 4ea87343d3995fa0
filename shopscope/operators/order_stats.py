"""Exact order statistics without sorting the data.

The value at a given rank is found digit by digit: a histogram over the leading bits tells
which bucket holds the rank, and the next pass looks only inside that bucket. Every histogram is
combined map-side and has at most 2**17 buckets per group, whatever the data looks like.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_DIGIT_BITS = 17


def digit_width(bits: int) -> int:
    """Bits per pass: as few passes as the limit allows, of about equal width."""
    return ceil(bits / ceil(bits / MAX_DIGIT_BITS))


def leading_digits(values: DataFrame, group: list[str], bits: int) -> DataFrame:
    """Histogram of the leading digit of ``v`` per group."""
    shift = max(bits - digit_width(bits), 0)
    return values.groupBy(*group, F.shiftright("v", shift).alias("digit")).agg(F.count("*").alias("n"))


def _bucket_of_rank(histogram: DataFrame, by: list[str], targets: DataFrame) -> DataFrame:
    """The bucket each target rank falls into, and the rank left over inside it."""
    so_far = Window.partitionBy(*by).orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = histogram.withColumn("upto", F.sum("n").over(so_far))
    before = F.col("upto") - F.col("n")
    return (
        running.join(F.broadcast(targets), by)
        .filter((F.col("rank") >= before) & (F.col("rank") < F.col("upto")))
        .withColumn("rank", F.col("rank") - before)
    )


def values_at_ranks(values: DataFrame, targets: DataFrame, group: list[str], bits: int = 64) -> DataFrame:
    """Exact values at zero-based ranks, per group: (group…, slot, v).

    ``values`` has the group columns and a non-NULL bigint ``v`` of at most ``bits`` bits with its
    sign. ``targets`` has the group columns, a label ``slot`` and the ``rank``; it is broadcast, so
    the caller must ask for a bounded number of ranks.
    """
    width = digit_width(bits)
    shift = max(bits - width, 0)
    found = _bucket_of_rank(leading_digits(values, group, bits), group, targets).select(
        *group, "slot", "rank", F.col("digit").alias("prefix")
    )
    while shift > 0:
        step = min(width, shift)
        by = [*group, "prefix"]
        inside = values.withColumn("prefix", F.shiftright("v", shift)).join(
            F.broadcast(found.select(*by).distinct()), by, "left_semi"
        )
        shift -= step
        digit = F.shiftright("v", shift).bitwiseAND(F.lit((1 << step) - 1).cast("bigint"))
        histogram = inside.groupBy(*by, digit.alias("digit")).agg(F.count("*").alias("n"))
        found = _bucket_of_rank(histogram, by, found).select(
            *group, "slot", "rank", (F.shiftleft("prefix", step) + F.col("digit")).alias("prefix")
        )
    return found.select(*group, "slot", F.col("prefix").alias("v"))


def _neighbours(sizes: DataFrame, group: list[str], percents: list[int]) -> DataFrame:
    """Zero-based ranks on either side of each quantile, for groups of ``n`` values."""
    at = sizes.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents])))
    scaled = F.col("percent") * (F.col("n") - 1)
    below = F.floor(scaled / 100).cast("bigint")
    return at.select(
        *group,
        F.explode(
            F.array(
                F.struct(F.struct("percent", F.lit(False).alias("upper")).alias("slot"), below.alias("rank")),
                F.struct(
                    F.struct("percent", F.lit(True).alias("upper")).alias("slot"),
                    (below + F.when(scaled % 100 > 0, 1).otherwise(0)).alias("rank"),
                ),
            )
        ).alias("t"),
        (scaled % 100).alias("weight"),
    ).select(*group, "t.slot", "t.rank", "weight")


def quantiles_by_group(
    values: DataFrame, sizes: DataFrame, group: list[str], percents: list[int], bits: int = 64
) -> DataFrame:
    """Interpolated quantiles of bigint ``v``: (group…, percent, lower, upper, weight).

    The quantile is ``lower + (upper - lower) * weight / 100``. ``sizes`` names the groups wanted and
    their number of values ``n``; it must be bounded.
    """
    targets = _neighbours(sizes.filter("n > 0"), group, percents)
    found = values_at_ranks(values, targets.drop("weight"), group, bits)
    ends = found.groupBy(*group, F.col("slot.percent").alias("percent")).agg(
        F.max(F.when(~F.col("slot.upper"), F.col("v"))).alias("lower"),
        F.max(F.when(F.col("slot.upper"), F.col("v"))).alias("upper"),
    )
    weights = targets.select(*group, F.col("slot.percent").alias("percent"), "weight").distinct()
    return ends.join(F.broadcast(weights), [*group, "percent"])


def signed_bits(df: DataFrame, column: Column) -> int:
    """Bits that hold every value of a bigint expression, sign included. Runs one aggregate."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return max(2, *[(value if value >= 0 else ~value).bit_length() + 1 for value in (low or 0, high or 0)])


def column_quantiles(
    df: DataFrame, columns: dict[str, Column], percents: list[int], bits: int = 64
) -> DataFrame:
    """Quantiles of whole columns, given as bigint expressions, in shared passes over ``df``."""
    names = list(columns)
    values = (
        df.select(*[expression.cast("bigint").alias(name) for name, expression in columns.items()])
        .unpivot([], names, "metric", "v")
        .filter(F.col("v").isNotNull())
    )
    # The sizes come from the first histogram, which the search reuses.
    sizes = leading_digits(values, ["metric"], bits).groupBy("metric").agg(F.sum("n").alias("n"))
    return quantiles_by_group(values, sizes, ["metric"], percents, bits)


def interpolated() -> Column:
    """The quantile in the units of ``v``, with two more decimals."""
    step = (F.col("upper") - F.col("lower")).cast("decimal(20,0)") * F.col("weight").cast("decimal(4,2)")
    return (F.col("lower").cast("decimal(20,0)") + step / F.lit(100).cast("decimal(3,0)")).cast("decimal(24,4)")
