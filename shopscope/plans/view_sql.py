"""The management views as SQL text over the gold tables, for the catalog.

The same definitions as the DataFrame plans in ``views``; averages and rates are exact sums divided once, in decimal,
and rounded half up, as there.
"""

from __future__ import annotations

from shopscope.plans.gold import PERSON
from shopscope.plans.views import TARGET_SEGMENTS


def _ratio(num: str, den: str, digits: int) -> str:
    quotient = f"CAST({num} AS DECIMAL(28,10)) / NULLIF(CAST({den} AS DECIMAL(20,0)), CAST(0 AS DECIMAL(20,0)))"
    return f"CAST(ROUND({quotient}, {digits}) AS DECIMAL(20,{digits}))"


def _mean(column: str, digits: int) -> str:
    return _ratio(f"SUM({column})", f"COUNT({column})", digits)


def _percent(num: str, den: str) -> str:
    return _ratio(f"CAST({num} AS DECIMAL(28,10)) * 100", den, 2)


def _money_percent(num: str, den: str) -> str:
    return _ratio(f"CAST({num} AS DECIMAL(20,2)) * 10000", f"CAST({den} * 100 AS BIGINT)", 2)


_MONEY = "CAST({} AS DECIMAL(20,2))"
_GROUP = {
    "customers": "COUNT(*)",
    "total_revenue": _MONEY.format("SUM(monetary_value)"),
    "average_customer_value": _mean("monetary_value", 2),
    "average_orders": _mean("frequency", 2),
    "average_order_value": _ratio("SUM(monetary_value)", "SUM(frequency)", 2),
    "average_recency_days": _mean("recency_days", 1),
    "minimum_customer_value": _MONEY.format("MIN(monetary_value)"),
    "maximum_customer_value": _MONEY.format("MAX(monetary_value)"),
    "average_delivery_days": _mean("average_delivery_days", 2),
    "average_late_order_rate_pct": _ratio("SUM(late_order_rate) * 100", "COUNT(late_order_rate)", 2),
    "average_review_score": _mean("average_review_score", 2),
    "poor_experience_rate_pct": _percent("COUNT_IF(poor_experience_flag)", "COUNT(*)"),
}
_SHARES = {
    "customer_percentage": _percent("customers", "SUM(customers) OVER ()"),
    "revenue_percentage": _money_percent("total_revenue", "SUM(total_revenue) OVER ()"),
}


def _shared(source: str, key: str, order: str, *columns: str) -> str:
    """Groups with their shares of all customers and revenue."""
    inner = ", ".join(f"{_GROUP[c]} AS {c}" for c in dict.fromkeys(("customers", "total_revenue", *columns)) if c in _GROUP)
    outer = ", ".join(f"{_SHARES[c]} AS {c}" if c in _SHARES else c for c in columns)
    name = key.split(" AS ")[-1]
    return f"SELECT {name}, {outer} FROM (SELECT {key}, {inner} FROM {source} GROUP BY 1) ORDER BY {order}"


def _experienced(intelligence: str, experience: str, where: str, order: str, **columns: str) -> str:
    """Groups of customers that have an experience row."""
    chosen = ", ".join(f"{_GROUP[source]} AS {name}" for name, source in columns.items())
    return (
        f"SELECT customer_segment, {chosen} FROM {intelligence} JOIN {experience} USING ({PERSON}) WHERE {where} "
        f"GROUP BY customer_segment ORDER BY {order}"
    )


def definitions(schema: str) -> dict[str, str]:
    """View name to SELECT, over the tables of ``schema``."""
    intelligence = f"{schema}.customer_intelligence"
    columns = ("average_delivery_days", "late_order_rate", "average_review_score", "poor_experience_flag")
    experience = f"(SELECT {PERSON}, {', '.join(columns)} FROM {schema}.customer_experience)"
    segments = ", ".join(f"'{name}'" for name in TARGET_SEGMENTS)
    revenue = "total_revenue DESC NULLS FIRST"
    own = lambda *names: {name: name for name in names}
    averages = own("average_delivery_days", "average_late_order_rate_pct", "average_review_score", "poor_experience_rate_pct")
    type_key = "CASE WHEN frequency > 1 THEN 'Repeat customer' ELSE 'One-time customer' END AS customer_type"
    shares = ("customers", "customer_percentage", "total_revenue", "revenue_percentage", "average_customer_value", "average_orders", "average_order_value")
    return {
        "v_customer_segments": _shared(intelligence, "customer_segment", f"{revenue}, customer_segment", *shares, "average_recency_days"),
        "v_customer_type_performance": _shared(intelligence, type_key, f"{revenue}, customer_type", *shares),
        "v_revenue_concentration": _shared(
            intelligence,
            "monetary_quintile",
            "monetary_quintile",
            "customers",
            "customer_percentage",
            "minimum_customer_value",
            "maximum_customer_value",
            "average_customer_value",
            "total_revenue",
            "revenue_percentage",
        ),
        "v_customer_experience": _experienced(
            intelligence, experience, "TRUE", "average_review_score ASC NULLS LAST, customer_segment", customers="customers", **averages
        ),
        "v_retention_opportunities": _experienced(
            intelligence,
            experience,
            f"customer_segment IN ({segments})",
            "associated_revenue DESC NULLS FIRST, customer_segment",
            customers="customers",
            associated_revenue="total_revenue",
            **own("average_customer_value", "average_orders", "average_recency_days"),
            **averages,
        ),
    }
