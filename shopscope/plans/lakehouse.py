"""The layers wired together.

``Lakehouse`` hands out every table as a DataFrame. Tables that several plans read more than once
are written to the workspace the first time they are needed; the rest stays lazy.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shopscope.plans import gold, silver
from shopscope.sources.lazy import LazyTables
from shopscope.sources.testdata import raw_tables
from shopscope.sources.workspace import Workspace


class Lakehouse:
    """Close it, or use it as a context manager, once nothing reads its tables any more."""

    def __init__(self, raw: Mapping[str, DataFrame], workspace: Workspace):
        self.raw = raw
        self.workspace = workspace

    @classmethod
    def over_testdata(cls, spark: SparkSession, directory: str) -> Lakehouse:
        return cls(raw_tables(spark, directory), Workspace(spark))

    def close(self) -> None:
        self.workspace.discard()

    def __enter__(self) -> Lakehouse:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    @cached_property
    def silver(self) -> LazyTables:
        return silver.build(self.raw)

    @cached_property
    def order_summary(self) -> DataFrame:
        return gold.order_summary(self.silver)

    @cached_property
    def facts(self) -> DataFrame:
        """Customer facts before they are written, for plans that read them once."""
        return gold.customer_facts(self.order_summary, self.silver["customers"])

    @cached_property
    def stored_facts(self) -> DataFrame:
        return self.workspace.store("customer_facts", self.facts)

    @cached_property
    def customer_360(self) -> DataFrame:
        return gold.customer_360(self.facts)

    @cached_property
    def customer_category_behavior(self) -> DataFrame:
        return gold.customer_category_behavior(self.silver, self.workspace)

    @cached_property
    def customer_experience(self) -> DataFrame:
        return gold.customer_experience(self.stored_facts, self.silver["orders"], self.silver["customers"], self.workspace)

    @cached_property
    def customer_intelligence(self) -> DataFrame:
        return gold.customer_intelligence(self.stored_facts)

    @cached_property
    def customer_profile(self) -> DataFrame:
        return gold.customer_profile_from_facts(self.stored_facts)

    @cached_property
    def executive_kpis(self) -> DataFrame:
        return gold.executive_kpis(self.customer_profile)
