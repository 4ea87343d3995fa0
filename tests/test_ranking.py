"""Exact ranks and tiles against the window functions they replace."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopscope.operators.order_stats import column_quantiles, interpolated, quantiles_by_group, signed_bits
from shopscope.operators.ranking import rank_rows, tile_end_ranks, tile_of_key, tile_of_rank
from shopscope.operators.selection import Selection, tile_ends


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id string, v int")


def _cases():
    rng = random.Random(7)
    some = [(f"c{i:04d}", rng.choice([None, 1, 1, 1, 2, 3, rng.randrange(1000)])) for i in range(997)]
    return {
        "mixed": some,
        "ties": [(f"c{i}", 1) for i in range(103)],
        "nulls": [(f"c{i}", None) for i in range(11)],
        "six": [(f"c{i}", i) for i in range(6)],
        "four": [(f"c{i}", 9 - i) for i in range(4)],
        "one": [("c", 1)],
        "none": [],
    }


@pytest.mark.parametrize("case", list(_cases()))
def test_tiles_match_ntile(case, spark, workspace):
    df = _frame(spark, _cases()[case])
    ranked = rank_rows(df, "v", "id", workspace, "ranks")
    up, down = tile_ends(df, ["v"], "id", 5)["v"]
    assert tile_ends(df, ["v"], "id", 5, fetched=9, sampled=20)["v"] == (up, down)  # in several rounds
    tiled = df.select(
        "*",
        tile_of_key(df, "v", "id", up).alias("up"),
        tile_of_key(df, "v", "id", down, descending=True).alias("down"),
        F.ntile(5).over(Window.orderBy(F.asc_nulls_last("v"), "id")).alias("expected_up"),
        F.ntile(5).over(Window.orderBy(F.desc_nulls_first("v"), F.desc("id"))).alias("expected_down"),
    )
    assert tiled.filter("up <> expected_up or down <> expected_down").count() == 0
    by_rank = ranked.with_rank().withColumn("tile", tile_of_rank(F.col("rank"), F.col("total"), 5))
    assert by_rank.join(tiled, "id").filter("tile <> expected_up").count() == 0
    assert by_rank.count() == len(_cases()[case])


def test_keys_at_ranks_of_several_measures(spark):
    rng = random.Random(2)
    rows = [(f"c{i}" if i else None, rng.choice([None, 3, 3, 3, i]), Decimal(rng.randrange(50)).scaleb(-2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, a int, b decimal(9,2)")
    ranks = [1, 2, 700, 1500, 1501, 2999, 3000]
    found = Selection(df, ["a", "b"], "id", fetched=10, sampled=60).keys_at({"a": ranks, "b": ranks})
    order = lambda key: (key[0] is None, key[0] or 0, key[1] is None, key[1] or "")
    for n, measure in enumerate("ab", 1):
        keys = sorted(((row[n], row[0]) for row in rows), key=order)
        assert found[measure] == {rank: keys[rank - 1] for rank in ranks}


def test_too_many_rows_of_one_key(spark):
    df = spark.createDataFrame([("same", 1)] * 500, "id string, v int")
    with pytest.raises(ValueError, match="share one key"):
        Selection(df, ["v"], "id", fetched=10, sampled=20).keys_at({"v": [250]})


def test_more_tiles_than_rows(spark, workspace):
    df = _frame(spark, [(f"c{i}", i % 3) for i in range(20)])
    ranked = rank_rows(df, "v", "id", workspace, "ranks").with_rank()
    tiles = ranked.select(tile_of_rank(F.col("rank"), F.col("total"), 100).alias("tile")).collect()
    assert sorted(row["tile"] for row in tiles) == list(range(1, 21))


def test_tile_sizes():
    def sizes(total):
        ends = [0, *tile_end_ranks(total, 5)]
        return [b - a for a, b in zip(ends, ends[1:])]

    assert sizes(6) == [2, 1, 1, 1, 1]
    assert sizes(7) == [2, 2, 1, 1, 1]
    assert sizes(4) == [1, 1, 1, 1]
    assert sizes(0) == []


@pytest.mark.parametrize("bits", [34, 64])
def test_column_quantiles(spark, bits):
    rng = random.Random(3)
    low = -(1 << (bits - 2))
    values = [rng.choice([5, 5, 5, None, low, -low, rng.randrange(low, -low)]) for _ in range(501)]
    df = spark.createDataFrame([(v, 7) for v in values], "a long, b long")
    found = {
        (row["metric"], row["percent"]): (row["lower"], row["upper"], row["weight"])
        for row in column_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0, 25, 50, 95, 100], bits).collect()
    }
    known = sorted(v for v in values if v is not None)
    for percent in (0, 25, 50, 95, 100):
        position, weight = divmod(percent * (len(known) - 1), 100)
        upper = known[position + (1 if weight else 0)]
        assert found["a", percent] == (known[position], upper, weight)
        assert found["b", percent][:2] == (7, 7)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a long")
    assert column_quantiles(df, {"a": F.col("a")}, [50]).count() == 0


def test_median_is_interpolated(spark):
    values = spark.createDataFrame([("x", 1), ("x", 4), ("y", -3)], "k string, v long")
    sizes = values.groupBy("k").agg(F.count("*").alias("n"))
    rows = quantiles_by_group(values, sizes, ["k"], [50]).select("k", interpolated().alias("m")).collect()
    assert {row["k"]: float(row["m"]) for row in rows} == {"x": 2.5, "y": -3.0}


def test_signed_bits(spark):
    def bits(*values):
        return signed_bits(spark.createDataFrame([(v,) for v in values], "v long"), F.col("v"))

    assert [bits(0), bits(1), bits(-2), bits(127, None), bits(128), bits(-129), bits(None)] == [2, 2, 2, 8, 9, 9, 2]
    assert bits(2**63 - 1) == bits(-(2**63)) == 64


@pytest.mark.parametrize("bits", [2, 9, 18, 35])
def test_quantiles_at_awkward_widths(spark, bits):
    top = 1 << (bits - 1)
    values = sorted({-top, top - 1, 0, -1, top // 2, -(top // 2)})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    steps = len(values) - 1
    row = column_quantiles(df, {"v": F.col("v")}, [0, 100], bits).orderBy("percent").collect()
    assert [row[0]["lower"], row[1]["upper"]] == [values[0], values[steps]]
