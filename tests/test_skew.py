"""Operators on keys that hold a large share of the rows, and on NULL keys."""

import random
from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from shopscope.operators.distinct import sums_and_distincts
from shopscope.operators.hot_keys import hot_keys, left_join
from shopscope.operators.keys import key_counts, orphan_keys, surplus, total
from shopscope.operators.medians import median_by_key
from shopscope.operators.nulls import spread_null_key


def _rows():
    rng = random.Random(11)
    people = ["hot"] * 400 + [None] * 300 + [f"p{i % 90}" for i in range(300)]
    return [(person, Decimal(rng.randrange(1, 10**12)).scaleb(-10)) for person in people]


def test_median_of_hot_and_null_people(spark, workspace):
    rows = spark.createDataFrame(_rows(), "k string, v decimal(16,10)")
    medians = median_by_key(rows, "k", "v", workspace, "ranks")
    plan = medians._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SinglePartition" not in plan
    found = {row["k"]: row["median"] for row in medians.collect()}
    expected: dict = {}
    for key, value in _rows():
        expected.setdefault(key, []).append(value)
    assert found == {key: median(values) for key, values in expected.items()}


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
@pytest.mark.parametrize("groups", [1, 3, 40, 5000])
def test_medians_across_partitions_and_batches(spark, workspace, chunk, groups):
    rng = random.Random(groups)
    rows = [(rng.choice([None, *range(groups)]), Decimal(rng.randrange(-(10**12), 10**12)).scaleb(-10)) for _ in range(9000)]
    df = spark.createDataFrame(rows, "k int, v decimal(16,10)")
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
        found = {row["k"]: row["median"] for row in median_by_key(df, "k", "v", workspace, "ranks", chunk).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    expected: dict = {}
    for key, value in rows:
        expected.setdefault(key, []).append(value)
    assert found == {key: median(values) for key, values in expected.items()}


def test_median_of_nothing(spark, workspace):
    assert median_by_key(spark.createDataFrame([], "k string, v decimal(16,10)"), "k", "v", workspace, "ranks").count() == 0


def test_sums_and_distincts(spark):
    rows = [("a", 1, None, 5), ("a", 1, "x", 5), ("a", 2, "x", None), (None, None, None, 1), ("b", None, "y", 0)]
    df = spark.createDataFrame(rows, "k string, p int, s string, v int")
    found = sums_and_distincts(df, ["k"], {"ps": "p", "ss": "s"}, {"v": F.col("v")}, {"top": F.col("v")})
    assert {tuple(row[c] for c in ("k", "ps", "ss", "v", "top")) for row in found.collect()} == {
        ("a", 2, 1, 10, 5),
        ("b", 0, 1, 0, 0),
        (None, 0, 0, 1, 1),
    }


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("b",), (None,), ("b",)], "k string")
    found = orphan_keys(child, "k", parent)
    assert {(row["k"], row["n"]) for row in found.collect()} == {("a", 2), (None, 2)}
    assert total(found, "n").first()["n"] == 4
    assert found.agg(F.count("k").alias("n")).first()["n"] == 1
    assert total(orphan_keys(child.limit(0), "k", parent), "n").first()["n"] == 0


def test_surplus_ignores_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert key_counts(df, "k").agg(surplus("k").alias("s")).first()["s"] == 2


def test_null_keys_are_spread(spark):
    df = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id").unionByName(
        spark.createDataFrame([("a", -1)], "k string, id long")
    )
    keys = df.select(spread_null_key(df, "k").alias("k"))
    assert keys.distinct().count() == 1001
    assert keys.filter("k = 'a'").count() == 1


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_keys_are_dealt_evenly(spark):
    """One key with half of all rows, one of NULLs with a tenth: no partition of the join has three times the median."""
    n = 40_000
    left = spark.range(n).selectExpr("id", "case when id % 2 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 3000) end as k")
    right = spark.range(3000).selectExpr("if(id = 0, 'hot', concat('k', id)) as k", "id as number", "if(id % 5 = 0, null, 'x') as text")
    hot = hot_keys(left, "k")
    assert hot == ["hot"]
    before = {key: spark.conf.get(key) for key in SPLIT_EARLY}
    try:
        for key, value in SPLIT_EARLY.items():
            spark.conf.set(key, value)
        joined = left_join(left, right, "k", hot, ["id"])
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
        found = {tuple(row) for row in joined.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(sizes) == 8 and max(sizes) < 3 * sorted(sizes)[4]
    assert found == {tuple(row) for row in left.join(right, "k", "left").select("id", "k", "number", "text").collect()}
    nobody = hot_keys(left.where("false"), "k")
    assert nobody == [] and left_join(left, right, "k", nobody, ["id"]).count() == n


def test_hot_product_in_the_category_join(spark, workspace):
    """A product with a third of all lines is found and takes no part in the shuffled join."""
    from shopscope.plans import gold

    n = 60_000
    spark.range(n, numPartitions=8).selectExpr(
        "concat('o', id) as order_id",
        "if(id % 3 = 0, 'hot', concat('p', id % 5000)) as product_id",
        "cast(1.25 as decimal(12,2)) as price",
        "cast(0.25 as decimal(12,2)) as freight_value",
    ).write.parquet(workspace.location("items"))
    people = spark.range(n).selectExpr("concat('c', id) as customer_id", "concat('u', id % 50) as customer_unique_id")
    orders = spark.range(n).selectExpr("concat('o', id) as order_id", "concat('c', id) as customer_id")
    products = spark.range(5000).selectExpr(
        "if(id = 0, 'hot', concat('p', id)) as product_id", "concat('k', id % 7) as product_category_name_english"
    )
    silver = {"order_items": spark.read.parquet(workspace.location("items")), "customers": people, "orders": orders, "products": products}
    before = {key: spark.conf.get(key) for key in SPLIT_EARLY}
    try:
        for key, value in SPLIT_EARLY.items():
            spark.conf.set(key, value)
        found = gold.customer_category_behavior(silver)
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "BroadcastHashJoin" in plan  # with a table of one product, as larger ones may not be broadcast here
    assert sum(row["category_items"] for row in rows) == n
    assert sum(row["category_merchandise_value"] for row in rows) == Decimal("1.25") * n
