"""The full refresh from CSV files, and the views over its stored tables."""

import os

import pytest

from shopscope.plans import gold, views
from shopscope.plans import refresh as jobs
from shopscope.plans.lakehouse import Lakehouse
from shopscope.sources import csv_files
from shopscope.sources.releases import Release
from tests.compare import rows_of

VIEWS = ["v_customer_segments", "v_customer_type_performance", "v_revenue_concentration", "v_customer_experience", "v_retention_opportunities"]
DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture()
def files(spark, tmp_path):
    raw = Lakehouse.over_testdata(spark, DIRECTORY).raw
    paths = {table: str(tmp_path / "csv" / table) for table in raw}
    for table, path in paths.items():
        csv_files.write_csv(raw[table], path)
    return paths


def _rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def test_refresh_twice_and_compare(spark, files, tmp_path):
    target = str(tmp_path / "lake")
    for _ in range(2):
        built = jobs.refresh(spark, files, target, prefix="shop_")
    lake = Lakehouse.over_testdata(spark, DIRECTORY)
    assert _rows(spark.table("shop_gold.customer_experience")) == _rows(lake.customer_experience)
    assert _rows(spark.table("shop_gold.executive_kpis")) == _rows(lake.executive_kpis)
    for name in VIEWS:
        found, expected = spark.newSession().table(f"shop_gold.{name}"), getattr(views, name.removeprefix("v_"))(lake.customer_profile)
        assert found.columns == expected.columns and [f.dataType for f in found.schema] == [f.dataType for f in expected.schema]
        assert [tuple(row) for row in found.collect()] == [tuple(row) for row in expected.collect()]
        assert name in built and spark.catalog.getTable(f"shop_gold.{name}").tableType == "VIEW"
    versions = os.listdir(f"{target}/versions")
    assert len(versions) == 2  # the published one and the one before
    assert spark.table("shop_bronze.reviews").count() == 1500
    assert {t.name for t in spark.catalog.listTables("shop_silver")} >= {"geolocation", "products"}


def test_repeated_order_ids_stop_the_refresh(spark, files, tmp_path):
    raw = Lakehouse.over_testdata(spark, DIRECTORY).raw
    csv_files.write_csv(raw["orders"].unionByName(raw["orders"].limit(1)), files["orders"])
    with pytest.raises(jobs.DuplicateKeys, match="gold.order_summary: 1"):
        jobs.refresh(spark, files, str(tmp_path / "lake"), prefix="twice_")


def test_orders_without_id_are_no_repeats(spark):
    df = spark.createDataFrame([(None,), (None,), ("o1",)], "order_id string")
    jobs.require_unique(df, "gold.order_summary", "order_id")
    with pytest.raises(jobs.DuplicateKeys, match="t: 1"):
        jobs.require_unique(df.unionByName(df), "t", "order_id")


def _everything(spark, prefix):
    return {f"{layer}.{t.name}": spark.table(f"{prefix}{layer}.{t.name}").count() for layer in jobs.LAYERS for t in spark.catalog.listTables(f"{prefix}{layer}")}


@pytest.mark.parametrize("stage", ["order_summary", "executive_kpis"])
def test_a_failing_refresh_leaves_all_tables_as_they_were(spark, files, tmp_path, monkeypatch, stage):
    target, prefix = str(tmp_path / "lake"), f"kept_{stage}_"
    jobs.refresh(spark, files, target, prefix)
    before = _everything(spark, prefix)
    reader = spark.newSession().table(f"{prefix}gold.customer_360")  # planned before the failure
    raw = Lakehouse.over_testdata(spark, DIRECTORY).raw
    csv_files.write_csv(raw["sellers"].limit(3), files["sellers"])

    def broken(*_):
        raise RuntimeError("no gold today")

    with monkeypatch.context() as patched:
        patched.setattr(gold, stage, broken)
        with pytest.raises(RuntimeError, match="no gold today"):
            jobs.refresh(spark, files, target, prefix)
    assert _everything(spark, prefix) == before and reader.count() == before["gold.customer_360"]
    jobs.refresh(spark, files, target, prefix)
    after = _everything(spark, prefix)
    assert after["bronze.sellers"] == after["silver.sellers"] == 3 and before["bronze.sellers"] != 3
    assert reader.count() == before["gold.customer_360"]  # the version before is still there
    assert len(os.listdir(f"{target}/versions")) == 2


def test_a_table_that_cannot_be_switched_takes_the_others_back(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS back_gold LOCATION '{tmp_path}/gold'")
    old = Release(spark, str(tmp_path))
    for name in ("a", "b"):
        old.store("gold", name, spark.range(3))
    old.publish("back_")
    new = Release(spark, str(tmp_path))
    for name in ("a", "b", "no such `name"):
        new.store("gold", name, spark.range(5))
    with pytest.raises(Exception, match="(?i)syntax|parse"):
        new.publish("back_")
    assert [spark.table(f"back_gold.{name}").count() for name in ("a", "b")] == [3, 3]


def test_other_columns_than_before(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wider_gold LOCATION '{tmp_path}/gold'")
    for df in (spark.range(2), spark.range(2).selectExpr("id", "id as more")):
        release = Release(spark, str(tmp_path))
        release.store("gold", "t", df)
        release.publish("wider_")
    assert spark.table("wider_gold.t").columns == ["id", "more"]


def test_versions_that_tables_are_in_stay(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS some_gold LOCATION '{tmp_path}/gold'")
    for names in (("a", "b"), ("b",), ("b",), ("b",)):
        release = Release(spark, str(tmp_path))
        for name in names:
            release.store("gold", name, spark.range(4))
        release.publish("some_")
    assert [spark.table(f"some_gold.{name}").count() for name in ("a", "b")] == [4, 4]
    assert len(os.listdir(f"{tmp_path}/versions")) == 3


def test_views_show_a_rebuilt_table_at_once(spark, files, tmp_path):
    jobs.refresh(spark, files, str(tmp_path / "lake"), prefix="live_")
    view = "live_gold.v_customer_segments"
    customers = spark.table(view).agg({"customers": "sum"}).first()[0]
    alone = Release(spark, str(tmp_path / "lake"))
    table = spark.table("live_gold.customer_intelligence")
    alone.store("gold", "customer_intelligence", table.where("customer_segment = 'Recent One-Time'"))
    alone.publish("live_")
    rows = spark.table(view).collect()
    assert [row["customer_segment"] for row in rows] == ["Recent One-Time"] and rows[0]["customers"] < customers
