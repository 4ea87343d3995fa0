"""Left joins with a dimension in which few keys hold many rows of the left side.

A mergeable counter sketch over the left key finds the keys that hold more than a given share of the rows; there can't be
many of them, so their rows of the dimension are broadcast. Rows they match take no further part in the shuffled join:
their key is replaced by values that differ from row to row and match nothing, so they are dealt evenly. The left side is
read and computed once. Which keys the sketch names has no influence on the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from 1 / SHARE of all rows on; the sketch keeps some times as many counters.
SHARE, TRACKED = 200, 8192


def hot_keys(rows: DataFrame, key: str, share: int = SHARE, nulls: bool = False) -> list:
    """At most ``share`` keys: all that hold more than 1 / ``share`` of the rows, up to the sketch's error. Reads the key column once.

    With ``nulls``, None is one more where NULL keys hold as many.
    """
    top = F.expr(f"approx_top_k({key}, {share}, {TRACKED}) filter (where {key} is not null)")
    found = rows.agg(top.alias("top"), F.count(key).alias("n"), F.count_if(F.col(key).isNull()).alias("nobody")).first()
    hot = [entry["item"] for entry in found["top"] or [] if entry["count"] * share > found["n"]]
    return [*hot, None] if nulls and found["nobody"] * share > found["n"] + found["nobody"] else hot


def left_join(left: DataFrame, right: DataFrame, key: str, hot: list, unlike: list[str]) -> DataFrame:
    """``left`` with the columns of ``right``, a dimension with its text key (nearly) unique; NULL where nothing matches.

    ``hot`` is what ``hot_keys`` found; ``unlike`` names columns of the left side that tell rows of one key apart. NULL keys
    match nothing and are dealt evenly too. What rows are dealt by is computed on both sides of the shuffle, as a column
    of its own would be shuffled beside the key.
    """
    names = [c for c in right.columns if c != key]
    filler = F.concat(F.lit("\0"), F.xxhash64(*unlike).cast("string"))
    others = right.select(F.col(key).alias("_other"), F.struct(*names).alias("_many"))
    if not hot:
        joined = left.join(others, F.coalesce(F.col(key), filler) == F.col("_other"), "left")
        return joined.select(*left.columns, *[F.col("_many")[name].alias(name) for name in names])
    few = right.where(F.col(key).isin(hot)).select(F.col(key).alias("_hot"), F.struct(*names).alias("_few"))
    marked = left.join(F.broadcast(few), F.col(key) == F.col("_hot"), "left")
    own = F.when(F.col("_hot").isNotNull(), filler).otherwise(F.coalesce(F.col(key), filler))
    rest = others.where(~F.col("_other").isin(hot))
    joined = marked.join(rest, own == F.col("_other"), "left")
    found = F.coalesce("_few", "_many")
    return joined.select(*left.columns, *[found[name].alias(name) for name in names])
