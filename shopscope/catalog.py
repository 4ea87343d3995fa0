"""Every named query, as a function of the lakehouse."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.plans import gold, profiling, quality, reports, silver, views
from shopscope.plans.lakehouse import Lakehouse
from shopscope.sources import csv_files
from shopscope.sources.schemas import RAW_SCHEMAS

Query = Callable[[Lakehouse], DataFrame]


def _export(lake: Lakehouse, table: str) -> str:
    path = lake.workspace.location(f"csv/{table}")
    csv_files.write_csv(lake.raw[table], path)
    return path


def _loaded(table: str, lake: Lakehouse) -> DataFrame:
    """One raw table after a trip through CSV files and the typed load."""
    spark, target = lake.workspace.spark, lake.workspace.location("bronze")
    return csv_files.load(spark, {table: _export(lake, table)}, target)[table]


def _load_all(lake: Lakehouse) -> str:
    target = lake.workspace.location("bronze")
    csv_files.load(lake.workspace.spark, {table: _export(lake, table) for table in RAW_SCHEMAS}, target)
    return target


def _load_audit(lake: Lakehouse) -> DataFrame:
    return csv_files.load_audit(lake.workspace.spark, _load_all(lake)).select("table_name", "row_count", "status")


def _load_summary(lake: Lakehouse) -> DataFrame:
    """Row and column counts of the nine loaded tables."""
    log = csv_files.load_audit(lake.workspace.spark, _load_all(lake))
    widths = F.create_map(*[F.lit(x) for table, schema in RAW_SCHEMAS.items() for x in (table, len(schema))])
    return log.select("table_name", "row_count", widths[F.col("table_name")].cast("bigint").alias("column_count"))


def _gold_keys(lake: Lakehouse) -> DataFrame:
    lake.order_summary = lake.workspace.store("order_summary", lake.order_summary)  # checked, and read by the others
    return gold.check_keys(
        {
            "gold.order_summary": (lake.order_summary, "order_id"),
            "gold.customer_360": (gold.customer_360(lake.stored_facts), gold.PERSON),
            "gold.customer_experience": (lake.customer_experience, gold.PERSON),
            "gold.customer_intelligence": (lake.customer_intelligence, gold.PERSON),
        }
    )


BRONZE: dict[str, Query] = {
    "bronze_load": _load_summary,
    "bronze_load_audit": _load_audit,
    **{f"bronze_load_{table}": partial(_loaded, table) for table in RAW_SCHEMAS},
}

PROFILES: dict[str, Query] = {
    name: (lambda lake, build=build: build(lake.raw)) for name, build in profiling.PROFILES.items()
}

QUALITY: dict[str, Query] = {
    **{name: (lambda lake, name=name: quality.run(name, lake.raw)) for name in quality.RULES},
    **{name: (lambda lake, build=build: build(lake.raw)) for name, build in quality.DEEP_DIVES.items()},
}

SILVER: dict[str, Query] = {
    **{f"silver_{table}": (lambda lake, table=table: lake.silver[table]) for table in RAW_SCHEMAS},
    "silver_check_row_counts": lambda lake: silver.check_row_counts(lake.raw, lake.silver),
    "silver_check_key_uniqueness": lambda lake: silver.check_key_uniqueness(lake.silver),
    "silver_check_foreign_keys": lambda lake: silver.check_foreign_keys(lake.silver),
    "silver_check_sanity": lambda lake: silver.check_sanity(lake.silver),
}

GOLD: dict[str, Query] = {
    "gold_item_summary": lambda lake: gold.item_summary(lake.silver["order_items"]),
    "gold_payment_summary": lambda lake: gold.payment_summary(lake.silver["payments"]),
    "gold_review_summary": lambda lake: gold.review_summary(lake.silver["reviews"]),
    "gold_order_summary": lambda lake: lake.order_summary,
    "gold_customer_360": lambda lake: lake.customer_360,
    "gold_customer_category_behavior": lambda lake: lake.customer_category_behavior,
    "gold_customer_experience": lambda lake: lake.customer_experience,
    "gold_analysis_date": lambda lake: gold.analysis_date(lake.facts),
    "gold_rfm_scores": lambda lake: gold.rfm_score_table(lake.stored_facts),
    "gold_customer_intelligence": lambda lake: lake.customer_intelligence,
    "gold_executive_kpis": lambda lake: lake.executive_kpis,
    "gold_check_keys": _gold_keys,
    "gold_check_kpis": lambda lake: lake.executive_kpis.select("*"),
}

VIEWS: dict[str, Query] = {
    "view_customer_segments": lambda lake: views.customer_segments(lake.customer_profile),
    "view_customer_type_performance": lambda lake: views.customer_type_performance(lake.customer_profile),
    "view_revenue_concentration": lambda lake: views.revenue_concentration(lake.customer_profile),
    "view_customer_experience": lambda lake: views.customer_experience(lake.customer_profile),
    "view_retention_opportunities": lambda lake: views.retention_opportunities(lake.customer_profile),
}

REPORTS: dict[str, Query] = {
    "doc_dq_scorecard": lambda lake: quality.scorecard(lake.raw),
    "doc_silver_delivery_metrics": lambda lake: reports.delivery_metrics(lake.silver),
    "doc_spend_distribution": lambda lake: reports.spend_distribution(lake.stored_facts),
    "doc_type_experience": lambda lake: reports.type_experience(lake.customer_profile),
    "doc_top_customers": lambda lake: reports.top_customers(lake.customer_profile),
    "doc_monthly_trend": lambda lake: reports.monthly_trend(lake.silver["orders"], lake.silver["payments"]),
    "doc_rfm_matrix": lambda lake: reports.rfm_matrix(lake.customer_profile),
    "doc_pareto_curve": lambda lake: reports.pareto_curve(lake.stored_facts),
    "doc_segment_migration": lambda lake: reports.segment_migration(lake.silver, lake.workspace),
    "doc_delay_vs_review": lambda lake: reports.delay_vs_review(lake.silver["orders"], lake.silver["reviews"]),
    "doc_late_rate_by_state": lambda lake: reports.late_rate_by_state(lake.silver),
    "doc_late_rate_by_route": lambda lake: reports.late_rate_by_route(lake.silver),
    "doc_segment_csat": lambda lake: reports.segment_csat(lake.customer_profile),
}

CATALOG: dict[str, Query] = {**BRONZE, **PROFILES, **QUALITY, **SILVER, **GOLD, **VIEWS, **REPORTS}
