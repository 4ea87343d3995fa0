"""Full refresh: CSV files in, bronze, silver and gold tables and the management views out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.plans import gold, silver, view_sql
from shopscope.sources import csv_files
from shopscope.sources.releases import Release
from shopscope.sources.workspace import Workspace

LAYERS = ("bronze", "silver", "gold")

class DuplicateKeys(Exception):
    """A gold table holds a key more than once."""


def create_namespaces(spark: SparkSession, target: str, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{target}/{layer}'")


def build_silver(raw: Mapping[str, DataFrame], release: Release) -> dict[str, DataFrame]:
    return {name: release.store("silver", name, df) for name, df in silver.build(raw).items()}


def build_gold(tables: Mapping[str, DataFrame], release: Release) -> dict[str, DataFrame]:
    """Store the six gold tables. Each is computed from stored ones, so no step repeats another."""

    def store(name: str, df: DataFrame) -> DataFrame:
        return release.store("gold", name, df)

    workspace = Workspace(release.spark)
    try:
        built = {"order_summary": store("order_summary", gold.order_summary(tables))}
        require_unique(built["order_summary"], "gold.order_summary", "order_id")  # what follows counts orders by rows
        facts = workspace.store("customer_facts", gold.customer_facts(built["order_summary"], tables["customers"]))
        built["customer_360"] = store("customer_360", gold.customer_360(facts))
        built["customer_category_behavior"] = store("customer_category_behavior", gold.customer_category_behavior(tables, workspace))
        built["customer_experience"] = store(
            "customer_experience", gold.customer_experience(facts, tables["orders"], tables["customers"], workspace)
        )
        built["customer_intelligence"] = store("customer_intelligence", gold.customer_intelligence(facts))
        profile = gold.customer_profile(built["customer_intelligence"], built["customer_experience"])
        built["executive_kpis"] = store("executive_kpis", gold.executive_kpis(profile))
    finally:
        workspace.discard()
    return built


def require_unique(df: DataFrame, name: str, key: str) -> None:
    """Raise if a key is there more than once. Rows without key are no repeats, as in a unique index."""
    repeats = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").count()
    if repeats:
        raise DuplicateKeys(f"{name}: {repeats}")


def check_gold(built: Mapping[str, DataFrame]) -> None:
    for name in ("customer_360", "customer_experience", "customer_intelligence"):
        require_unique(built[name], f"gold.{name}", gold.PERSON)


def create_views(spark: SparkSession, prefix: str = "") -> dict[str, DataFrame]:
    """The management views in the gold schema, as SQL text that is run when they are read, from any session."""
    schema = f"{prefix}gold"
    known = {table.name: table.tableType for table in spark.catalog.listTables(schema)}
    for name, select in view_sql.definitions(schema).items():
        if known.get(name, "VIEW") != "VIEW":  # a table of that name, from before there were views
            spark.sql(f"DROP TABLE {schema}.{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {select}")
    return {name: spark.table(f"{schema}.{name}") for name in view_sql.definitions(schema)}


def refresh(spark: SparkSession, files: dict[str, str], target: str, prefix: str = "") -> dict[str, DataFrame]:
    """Run everything and return the gold tables and views by name.

    All layers are written as one release and published together once the checks have passed; until then, and if
    anything fails, readers have the tables of the refresh before.
    """
    create_namespaces(spark, target, prefix)
    release = Release(spark, target)
    raw = csv_files.load(spark, files, release.location("bronze"))
    for name, df in {**raw, "load_audit": csv_files.load_audit(spark, release.location("bronze"))}.items():
        release.add("bronze", name, df)
    built = build_gold(build_silver(raw, release), release)
    check_gold(built)
    release.publish(prefix)
    return {**{name: spark.table(f"{prefix}gold.{name}") for name in built}, **create_views(spark, prefix)}
