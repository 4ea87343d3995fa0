"""Exact global ranks and NTILE without a single-task window.

``rank_rows`` range-partitions the keys on (value, id), sorts each partition and writes it with its
partition number and row position. The number of rows in the earlier partitions then turns each
position into the global rank. The id in the key keeps partitions even when one value dominates.
"""

from __future__ import annotations

from functools import cached_property
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.session import shuffle_width
from shopscope.sources.workspace import Workspace

# monotonically_increasing_id puts the partition number above these bits, the row position below.
_POSITION_BITS = 33


class Ranked:
    """Rows sorted by (value, id) NULLS LAST, with their ``part`` and ``position`` in it."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    @cached_property
    def parts(self) -> list[tuple[int, int, int]]:
        """(part, rows before it, rows in it): as many entries as the sort had partitions."""
        sizes = sorted((row["part"], row["n"]) for row in self.rows.groupBy("part").agg(F.count("*").alias("n")).collect())
        before = accumulate((n for _, n in sizes), initial=0)
        return [(part, start, n) for (part, n), start in zip(sizes, before)]

    @property
    def total(self) -> int:
        return sum(n for _, _, n in self.parts)

    def with_rank(self) -> DataFrame:
        """value, id and the one-based global ``rank`` of every row, and the row count ``total``."""
        spark = self.rows.sparkSession
        offsets = spark.createDataFrame([(part, before) for part, before, _ in self.parts], "part bigint, before bigint")
        rank = (F.col("position") + F.col("before") + 1).alias("rank")
        return self.rows.join(F.broadcast(offsets), "part").select("value", "id", rank, F.lit(self.total).alias("total"))


def tile_end_ranks(total: int, tiles: int) -> list[int]:
    """Ranks at which the tiles end, first tiles one larger while a remainder lasts."""
    size, rest = divmod(total, tiles)
    return [tile * size + min(tile, rest) for tile in range(1, min(tiles, total) + 1)]


def rank_rows(df: DataFrame, value: str, id_column: str, workspace: Workspace, name: str) -> Ranked:
    keys = df.select(F.col(value).alias("value"), F.col(id_column).alias("id"))
    order = [F.asc_nulls_last("value"), F.asc_nulls_last("id")]
    marker = F.monotonically_increasing_id()
    position = F.lit((1 << _POSITION_BITS) - 1).cast("bigint")
    ordered = keys.repartitionByRange(shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("_row", marker)
    rows = workspace.store(
        name,
        ordered.select(
            "value",
            "id",
            F.shiftright("_row", _POSITION_BITS).alias("part"),
            F.col("_row").bitwiseAND(position).alias("position"),
        ),
    )
    return Ranked(rows)


def tile_of_rank(rank: Column, total: Column, tiles: int) -> Column:
    """NTILE computed from a global rank."""
    size, rest = F.floor(total / tiles), total % tiles
    large = rest * (size + 1)
    return (
        F.when(rank <= large, F.ceil(rank / (size + 1)))
        .otherwise(rest + F.ceil((rank - large) / F.greatest(size, F.lit(1))))
        .cast("int")
    )


def tile_of_key(df: DataFrame, value: str, id_column: str, ends: list[tuple], descending: bool = False) -> Column:
    """NTILE of a row, by comparing its (value, id) with the last key of each tile, as a search tree of comparisons."""
    kind = df.schema[value].dataType
    own = (F.col(value), F.col(id_column))

    def passed(end: tuple) -> Column:
        last = (F.lit(end[0]).cast(kind), F.lit(end[1]).cast("string"))
        return key_after(last, own) if descending else key_after(own, last)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low + 1)
        middle = (low + high) // 2
        return F.when(passed(ends[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(ends))


def key_after(key: tuple[Column, Column], other: tuple[Column, Column]) -> Column:
    """``key`` > ``other`` with NULLs after everything else."""

    def greater(a: Column, b: Column) -> Column:
        return F.coalesce(a > b, a.isNull() & b.isNotNull())

    return greater(key[0], other[0]) | (key[0].eqNullSafe(other[0]) & greater(key[1], other[1]))
