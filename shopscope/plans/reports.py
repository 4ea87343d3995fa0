"""Reports named in the business documentation and dashboards, with definitions of our own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.numeric import MONEY, cents, from_cents, mean, percent, ratio
from shopscope.operators.keys import beside
from shopscope.operators.nulls import spread_null_key
from shopscope.operators.order_stats import column_quantiles, interpolated, signed_bits
from shopscope.operators.ranking import tile_of_key
from shopscope.operators.selection import tile_ends
from shopscope.plans import gold, views
from shopscope.plans.gold import PERSON
from shopscope.sources.workspace import Workspace

SPEND_PERCENTS = [25, 50, 75, 90, 95]
PARETO_BUCKETS = 100


def delivery_metrics(silver: Mapping[str, DataFrame]) -> DataFrame:
    days = F.col("delivery_days")
    people = silver["customers"].select(PERSON).distinct().agg(F.count(PERSON).alias("unique_customers"))
    orders = silver["orders"].agg(
        F.count("*").alias("total_orders"),
        F.count(days).alias("valid_delivery_records"),
        F.count_if(days < 0).alias("negative_delivery_durations"),
        F.round(F.min(days), 2).cast("decimal(20,2)").alias("minimum_delivery_days"),
        F.round(F.max(days), 2).cast("decimal(20,2)").alias("maximum_delivery_days"),
        mean(days, 2).alias("average_delivery_days"),
    )
    return beside([orders, people])


def spend_distribution(facts: DataFrame) -> DataFrame:
    """Minimum, quantiles and maximum of customer spend, one row each, over the stored facts."""
    spend = F.col("payment_cents")
    found = column_quantiles(facts, {"spend": spend}, SPEND_PERCENTS, signed_bits(facts, spend)).select(
        F.concat(F.lit("p"), "percent").alias("metric"),
        F.round(interpolated() / F.lit(100).cast("decimal(3,0)"), 2).cast(MONEY).alias("value"),
    )
    ends = facts.agg(F.min(spend).alias("minimum"), F.max(spend).alias("maximum")).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), from_cents(F.col(name)).alias("value"))
                    for name in ("minimum", "maximum")
                ]
            )
        )
    )
    return ends.unionByName(found)


def type_experience(profile: DataFrame) -> DataFrame:
    return views.experience_by(profile, views.customer_type(), "customer_type").orderBy("customer_type")


def top_customers(profile: DataFrame, limit: int = 100) -> DataFrame:
    return (
        profile.select(PERSON, "customer_state", "customer_segment", "frequency", "monetary_value")
        .orderBy(F.desc("monetary_value"), PERSON)
        .limit(limit)
    )


def monthly_trend(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders and payments per purchase month."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    month = F.trunc(F.col("order_purchase_timestamp").cast("date"), "month").alias("purchase_month")
    joined = orders.select("order_id", month).join(paid, "order_id", "left")
    return (
        joined.groupBy("purchase_month")
        .agg(F.count("*").alias("orders"), F.coalesce(F.sum("paid"), F.lit(0)).cast(MONEY).alias("revenue"))
        .orderBy("purchase_month")
    )


def rfm_matrix(profile: DataFrame) -> DataFrame:
    scores = ["recency_score", "frequency_score", "monetary_score"]
    return (
        profile.groupBy(*scores)
        .agg(F.count("*").alias("customers"), F.sum("monetary_value").cast(MONEY).alias("revenue"))
        .orderBy(*scores)
    )


def pareto_curve(facts: DataFrame) -> DataFrame:
    """Cumulative revenue share by percentile of customers, biggest spenders first."""
    _, ends = tile_ends(facts, ["payment_cents"], PERSON, PARETO_BUCKETS)["payment_cents"]
    bucket = tile_of_key(facts, "payment_cents", PERSON, ends, descending=True).cast("bigint")
    by_bucket = facts.groupBy(bucket.alias("customer_percentile")).agg(
        F.count("*").alias("customers"), F.sum("payment_cents").alias("cents")
    )
    # At most PARETO_BUCKETS rows from here on.
    so_far = Window.orderBy("customer_percentile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    running = F.sum("cents").over(so_far)
    return by_bucket.select(
        "customer_percentile",
        "customers",
        from_cents(F.col("cents")).alias("revenue"),
        from_cents(running).alias("cumulative_revenue"),
        percent(running, F.sum("cents").over(everything)).alias("cumulative_revenue_share"),
    ).orderBy("customer_percentile")


def _measures_then_and_now(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Per person the orders, spend and last purchase of all orders, and of those known 365 days before the analysis date."""
    orders = silver["orders"]
    last = orders.agg(F.max("order_purchase_timestamp").cast("date")).scalar()
    early = F.col("order_purchase_timestamp").cast("date") < F.date_add(last, 1 - 365)
    paid = silver["payments"].groupBy(F.col("order_id").alias("_paid")).agg(F.sum(cents(F.col("payment_value"))).alias("cents"))
    keyed = orders.withColumn("_key", spread_null_key(orders, "order_id")).filter("customer_id is not null")
    rows = keyed.join(paid, F.col("_key") == F.col("_paid"), "left").withColumn("early", F.coalesce(early, F.lit(False)))

    def both(name: str, then: Column, now: Column) -> list[Column]:
        return [then.alias(f"{name}_then"), now.alias(f"{name}_now")]

    spend = F.coalesce("cents", F.lit(0))
    at = F.col("order_purchase_timestamp")
    accounts = rows.groupBy("customer_id").agg(
        F.count_if("early").alias("rows_then"),
        *both("orders", F.count(F.when(F.col("early"), F.col("order_id"))), F.count("order_id")),
        *both("cents", F.sum(F.when(F.col("early"), spend).otherwise(0)), F.sum(spend)),
        *both("last", F.max(F.when(F.col("early"), at)), F.max(at)),
    )
    people = silver["customers"].select("customer_id", PERSON).distinct()
    summed = ["rows_then", *[f"{name}_{when}" for name in ("orders", "cents") for when in ("then", "now")]]
    return accounts.join(people, "customer_id").groupBy(PERSON).agg(
        *[F.sum(name).alias(name) for name in summed], *[F.max(f"last_{when}").alias(f"last_{when}") for when in ("then", "now")]
    )


def segment_migration(silver: Mapping[str, DataFrame], workspace: Workspace) -> DataFrame:
    """Customers per (earlier segment, current segment); newcomers have no earlier one."""
    measures = workspace.store("measures", _measures_then_and_now(silver))

    def segments(rows: DataFrame, when: str) -> DataFrame:
        last = F.col(f"last_{when}").cast("date")
        base = rows.select(
            PERSON,
            F.datediff(F.date_add(rows.agg(F.max(f"last_{when}").cast("date")).scalar(), 1), last).alias("recency_days"),
            F.col(f"orders_{when}").alias("frequency"),
            from_cents(F.col(f"cents_{when}")).alias("monetary_value"),
        )
        scored = gold.scored(base)
        return scored.select(PERSON, gold.segment().alias(f"segment_{when}"))

    before = segments(measures.filter("rows_then > 0"), "then").select(F.col(PERSON).alias("_person"), F.col("segment_then").alias("segment_before"))
    after = segments(measures, "now").select(PERSON, F.col("segment_now").alias("segment_after"))
    moved = after.join(before, F.col(PERSON).eqNullSafe(F.col("_person")), "full")
    return (
        moved.groupBy("segment_before", "segment_after")
        .agg(F.count("*").alias("customers"))
        .orderBy("segment_before", "segment_after")
    )


def _delay_bucket() -> Column:
    late = F.col("delivery_vs_estimate_days")
    return (
        F.when(late <= 0, "0: on time")
        .when(late <= 3, "1: 1-3 days late")
        .when(late <= 7, "2: 4-7 days late")
        .when(late <= 14, "3: 8-14 days late")
        .otherwise("4: over 14 days late")
    )


def delay_vs_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review scores by delivery delay, with the overall correlation on every row.

    The correlation is taken from exact integer sums, so it does not depend on partitioning.
    """
    scored = gold.review_summary(reviews).filter("average_review_score is not null")
    delayed = orders.filter("delivery_vs_estimate_days is not null").select("order_id", "delivery_vs_estimate_days")
    rows = delayed.join(scored, "order_id").select(
        _delay_bucket().alias("delay_bucket"),
        F.col("delivery_vs_estimate_days").cast("bigint").alias("x"),
        cents(F.col("average_review_score")).alias("y"),
        (F.col("low_score_reviews") > 0).alias("low"),
    )
    x, y = F.col("x"), F.col("y")
    by_bucket = rows.groupBy("delay_bucket").agg(
        F.count("*").alias("n"),
        F.count_if("low").alias("lows"),
        *[F.sum(v.cast("decimal(28,0)")).alias(name) for name, v in {"sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y}.items()],
    )
    names = ("n", "sx", "sy", "sxy", "sxx", "syy")
    sums = by_bucket.agg(F.struct(*[F.sum(name).cast("double").alias(name) for name in names])).scalar()
    n, sx, sy, sxy, sxx, syy = (F.col("sums")[name] for name in names)
    spread = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    correlation = F.round((n * sxy - sx * sy) / F.nullif(spread, F.lit(0.0)), 6)
    return (
        by_bucket.withColumn("sums", sums)
        .select(
            "delay_bucket",
            F.col("n").alias("orders"),
            ratio(F.col("sy"), F.col("n") * 100, 2).alias("average_review_score"),
            percent(F.col("lows"), F.col("n")).alias("low_score_percentage"),
            correlation.alias("delay_score_correlation"),
        )
        .orderBy("delay_bucket")
    )


def _late_counts(grouped) -> DataFrame:
    return grouped.agg(F.sum("known").alias("deliveries"), F.sum("late").alias("late_deliveries")).withColumn(
        "late_percentage", percent(F.col("late_deliveries"), F.col("deliveries"))
    )


def late_rate_by_state(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Late share of delivered orders per customer state; orders are reduced to accounts first."""
    late = F.col("delivery_vs_estimate_days") > 0
    by_account = silver["orders"].filter("delivery_vs_estimate_days is not null").groupBy("customer_id").agg(
        F.count("*").alias("known"), F.count_if(late).alias("late")
    )
    places = silver["customers"].select("customer_id", "customer_state").distinct()
    return _late_counts(by_account.join(places, "customer_id").groupBy("customer_state")).orderBy("customer_state")


def late_rate_by_route(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Late share per seller state and customer state, over the shipments (order, seller)."""
    shipments = silver["order_items"].select("order_id", "seller_id").distinct()
    late = (F.col("delivery_vs_estimate_days") > 0).cast("bigint").alias("late")
    orders = silver["orders"].filter("delivery_vs_estimate_days is not null").select("order_id", "customer_id", late)
    places = silver["customers"].select("customer_id", "customer_state").distinct()
    origins = silver["sellers"].select("seller_id", "seller_state").distinct()
    buyers = orders.join(places, "customer_id").select("order_id", "customer_state", "late")
    # a seller's shipments become a row a customer state before they meet the seller
    rows = shipments.join(buyers, "order_id").groupBy("seller_id", "customer_state").agg(
        F.count("*").alias("known"), F.sum("late").alias("late")
    )
    routes = _late_counts(rows.join(origins, "seller_id").groupBy("seller_state", "customer_state"))
    return routes.orderBy("seller_state", "customer_state")


def segment_csat(profile: DataFrame) -> DataFrame:
    """Share of reviewing customers with an average of at least 4, and of poor experiences."""
    score = F.col("average_review_score")
    return (
        profile.filter(F.col(PERSON).isNotNull())
        .groupBy("customer_segment")
        .agg(
            F.count("*").alias("customers"),
            F.count(score).alias("reviewing_customers"),
            percent(F.count_if(score >= 4), F.count(score)).alias("satisfied_percentage"),
            percent(F.count_if("poor_experience_flag"), F.count("*")).alias("poor_experience_percentage"),
        )
        .orderBy("customer_segment")
    )
