"""Category behaviour in stored stages: what lies on disk, and people who hold many lines."""

import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopscope.operators.distinct import sums_and_distincts, sums_and_distincts_in_place
from shopscope.operators.hot_keys import hot_keys
from shopscope.plans import gold
from shopscope.plans.lakehouse import Lakehouse


def _shuffled(spark) -> int:
    """Bytes of shuffle files on disk."""
    folders = [str(folder) for folder in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = [os.path.join(at, name) for top in folders for at, _, names in os.walk(top) for name in names if name.startswith("shuffle_")]
    return sum(os.path.getsize(file) for file in files if os.path.exists(file))


def _silver(spark, lines: int, person: str) -> dict:
    """An order for every three lines, an account for every order."""
    items = spark.range(lines, numPartitions=8).selectExpr(
        "concat('o', id div 3) as order_id",
        "concat('p', (id * 7919) % 5000) as product_id",
        "cast(1 + id % 977 as decimal(12,2)) as price",
        "cast(0.25 as decimal(12,2)) as freight_value",
    )
    orders = spark.range(lines // 3).selectExpr("concat('o', id) as order_id", "concat('c', id) as customer_id")
    customers = spark.range(lines // 3).selectExpr("concat('c', id) as customer_id", f"{person} as customer_unique_id")
    products = spark.range(5000).selectExpr("concat('p', id) as product_id", "concat('k', id % 7) as product_category_name_english")
    return {"order_items": items, "orders": orders, "customers": customers, "products": products}


def _lake(silver: dict, workspace) -> Lakehouse:
    lake = Lakehouse({}, workspace)
    lake.__dict__["silver"] = silver
    return lake


def _rows(df) -> list:
    return sorted((tuple(row) for row in df.collect()), key=repr)


NO_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get(NO_BROADCAST)
    spark.conf.set(NO_BROADCAST, "-1")
    yield
    spark.conf.set(NO_BROADCAST, before)


def test_disk_holds_one_shuffle_of_the_lines(spark, workspace, no_broadcast):
    """What is left is the last shuffle; those before are gone once their result is stored."""
    n = 120_000
    silver = _silver(spark, n, "concat('u', id % 30000)")
    before = _shuffled(spark)
    found = _lake(silver, workspace).customer_category_behavior
    assert found.agg(F.sum("category_items")).first()[0] == n
    until = time.time() + 20  # removal is asynchronous
    while _shuffled(spark) - before > 45 * n and time.time() < until:
        time.sleep(0.2)
    assert _shuffled(spark) - before < 45 * n


def test_a_persons_lines_meet_in_one_shuffle(spark, workspace):
    found = _lake(_silver(spark, 30_000, "concat('u', id % 9000)"), workspace).customer_category_behavior
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def _odd(spark) -> dict:
    """A person with a third of all lines, lines of nobody, repeated accounts, products and lines, missing prices and products."""
    silver = _silver(spark, 30_000, "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('u', id % 2500) end")
    items = silver["order_items"].selectExpr(
        "if(hash(order_id) % 97 = 0, null, order_id) as order_id",
        "if(hash(product_id, order_id) % 50 = 0, null, product_id) as product_id",
        "if(hash(order_id, product_id, 1) % 5 = 0, null, price) as price",
        "if(hash(order_id, product_id, 2) % 7 = 0, null, freight_value) as freight_value",
    )
    customers, products = silver["customers"], silver["products"].where("hash(product_id) % 11 <> 0")
    silver["order_items"] = items.unionByName(items.where("hash(order_id) % 4 = 0"))
    silver["customers"] = customers.unionByName(customers.where("hash(customer_id) % 6 = 0")).unionByName(
        customers.where("hash(customer_id) % 13 = 0").withColumn("customer_unique_id", F.lit("other"))
    )
    silver["orders"] = silver["orders"].unionByName(silver["orders"].where("hash(order_id) % 8 = 0"))
    silver["products"] = products.unionByName(products.where("hash(product_id) % 3 = 0").withColumn("product_category_name_english", F.lit(None).cast("string")))
    return silver


BY_SQL = """
select c.customer_unique_id, coalesce(p.product_category_name_english, 'unknown') as product_category,
  count(distinct i.order_id) as orders, count(*) as items, count(distinct i.product_id) as products, sum(i.price) as value,
  sum(i.freight_value) as freight
from {order_items} i join {orders} o on o.order_id = i.order_id join {customers} c on c.customer_id = o.customer_id
  left join {products} p on p.product_id = i.product_id
group by 1, 2"""


def test_busy_people_and_nobody(spark, workspace, no_broadcast):
    silver = _odd(spark)
    in_stages, lazy = gold.customer_category_behavior(silver, workspace), gold.customer_category_behavior(silver)
    assert "Union" in in_stages._jdf.queryExecution().executedPlan().toString()
    assert _rows(in_stages) == _rows(lazy)
    found = in_stages.select(
        "customer_unique_id", "product_category", "category_orders", "category_items", "distinct_products", "category_merchandise_value", "category_freight_value"
    )
    assert _rows(found) == _rows(spark.sql(BY_SQL, **silver))


def test_hot_keys_may_name_null(spark):
    rows = spark.range(2000).selectExpr("case when id % 2 = 0 then null when id % 5 = 0 then 'hot' else concat('k', id) end as k")
    assert hot_keys(rows, "k") == ["hot"]
    assert hot_keys(rows, "k", nulls=True) == ["hot", None]
    assert hot_keys(rows.where("k is not null"), "k", nulls=True) == ["hot"]
    assert hot_keys(rows.limit(0), "k", nulls=True) == []


def test_sums_in_place(spark):
    rows = [("a", "x", 1, None, 5), ("a", "x", 1, "s", 5), ("a", "y", 2, "s", None), (None, "x", None, None, 1), ("b", "x", None, "t", 0), ("a", "x", 2, "t", 7)]
    df = spark.createDataFrame(rows, "k string, c string, p int, s string, v int")
    distinct = {"ps": "p", "ss": "s"}
    expected = sums_and_distincts(df, ["k", "c"], distinct, {"v": F.col("v")})
    found = sums_and_distincts_in_place(df.repartition("k"), ["k", "c"], distinct, {"v": F.col("v")})
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert _rows(found.select(*expected.columns)) == _rows(expected)


def test_kept_tables(spark, workspace):
    """A kept table leaves no shuffle files, the session's setting is as before, and it can be dropped alone."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, lying = spark.conf.get(name, None), _shuffled(spark)
    rows = spark.range(200_000).selectExpr("concat('k', id) as k", "cast(id as decimal(12,2)) as v")
    kept = workspace.keep("some", rows.repartition("k"))
    other = workspace.keep("other", rows.limit(5))
    until = time.time() + 20
    while _shuffled(spark) > lying + 100_000 and time.time() < until:
        time.sleep(0.2)
    assert _shuffled(spark) <= lying + 100_000
    assert spark.conf.get(name, None) == before
    assert kept.agg(F.count("k"), F.sum("v")).first()[:] == (200_000, Decimal(200_000 * 199_999 // 2))
    workspace.drop("some")
    assert not os.path.exists(workspace.location("some")) and other.count() == 5
