"""Order-, customer- and category-grain tables, scores, segments and indicators.

The order and customer tables are chains of aggregates that reduce before they join: items,
payments and reviews to order grain, orders to account grain, accounts to person grain. Customer
360, experience and scoring are then narrow projections of one customer-grain table,
``customer_facts``, so the order history is aggregated once.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.numeric import MONEY, cents, from_cents, mean, money_percent, percent, ratio
from shopscope.operators.distinct import sums_and_distincts, sums_and_distincts_in_place
from shopscope.operators.keys import key_counts, surplus
from shopscope.operators.medians import median_by_key
from shopscope.operators.nulls import spread_null_key
from shopscope.operators.hot_keys import hot_keys, left_join
from shopscope.operators.ranking import tile_of_key
from shopscope.operators.selection import tile_ends
from shopscope.sources.workspace import Workspace

PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
UNSUCCESSFUL = ("canceled", "unavailable")
PERSON = "customer_unique_id"


# --- order grain ------------------------------------------------------------------------------


def item_summary(items: DataFrame) -> DataFrame:
    """Items per order."""
    price = F.col("price")
    summed = sums_and_distincts(
        items,
        ["order_id"],
        {"distinct_products": "product_id", "distinct_sellers": "seller_id"},
        {
            "total_items": F.lit(1).cast("bigint"),
            "merchandise": cents(price),
            "priced": price.isNotNull().cast("bigint"),
            "freight": cents(F.col("freight_value")),
            "value": cents(F.col("item_total_value")),
        },
        {"maximum_item_price": price},
    )
    return summed.select(
        "order_id",
        "total_items",
        "distinct_products",
        "distinct_sellers",
        from_cents(F.col("merchandise")).alias("merchandise_value"),
        from_cents(F.col("freight")).alias("freight_value"),
        from_cents(F.col("value")).alias("order_item_value"),
        ratio(F.col("merchandise"), F.col("priced") * 100).alias("average_item_price"),
        "maximum_item_price",
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    by_type = [
        F.count_if(F.col("payment_type") == kind).alias(f"{kind}_payment_records") for kind in PAYMENT_TYPES
    ]
    paid = F.sum(cents(F.col("payment_value")))
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_records"),
        from_cents(paid).alias("total_payment_value"),
        ratio(paid, F.count("payment_value") * 100).alias("average_payment_value"),
        F.max("payment_value").alias("maximum_payment_value"),
        F.max("payment_installments").alias("maximum_installments"),
        *by_type,
    )


def review_summary(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("review_count"),
        mean(score, 2).alias("average_review_score"),
        F.count_if(score <= 2).alias("low_score_reviews"),
        F.count_if(score >= 4).alias("high_score_reviews"),
        F.count_if(F.col("review_comment_message").isNotNull()).alias("reviews_with_message"),
    )


def order_summary(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Order header with its items, payments and reviews; absent parts count and sum to zero."""
    orders = silver["orders"]
    joined = orders.withColumn("_key", spread_null_key(orders, "order_id"))
    parts = [
        item_summary(silver["order_items"]),
        payment_summary(silver["payments"]),
        review_summary(silver["reviews"]),
    ]
    for part in parts:
        joined = joined.join(part.withColumnRenamed("order_id", "_part"), F.col("_key") == F.col("_part"), "left").drop("_part")

    def zero(*names: str) -> list[Column]:
        return [F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names]

    def zero_money(*names: str) -> list[Column]:
        return [F.coalesce(F.col(n), F.lit(0).cast(MONEY)).alias(n) for n in names]

    return joined.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "delivery_days",
        "delivery_vs_estimate_days",
        (F.col("delivery_vs_estimate_days") > 0).alias("delivered_late"),
        "approval_carrier_timestamp_anomaly",
        "delivery_sequence_anomaly",
        *zero("total_items", "distinct_products", "distinct_sellers"),
        *zero_money("merchandise_value", "freight_value", "order_item_value"),
        "average_item_price",
        "maximum_item_price",
        *zero("payment_records"),
        *zero_money("total_payment_value"),
        "average_payment_value",
        "maximum_payment_value",
        "maximum_installments",
        *zero(*[f"{kind}_payment_records" for kind in PAYMENT_TYPES]),
        *zero("review_count"),
        "average_review_score",
        *zero("low_score_reviews", "high_score_reviews", "reviews_with_message"),
    )


# --- customer grain ---------------------------------------------------------------------------

_SUMMED = {
    "total_items": "total_items",
    "product_instances": "distinct_products",
    "total_reviews": "review_count",
    "low_score_reviews": "low_score_reviews",
    "high_score_reviews": "high_score_reviews",
    "total_payment_records": "payment_records",
    **{f"{kind}_payments": f"{kind}_payment_records" for kind in PAYMENT_TYPES},
}
_SUMMED_CENTS = {
    "merchandise_cents": "order_item_value",
    "payment_cents": "total_payment_value",
    "freight_cents": "freight_value",
}
# Averages are carried as a sum and a count until the last level; review scores in hundredths.
_AVERAGED = {
    "delivery": "delivery_days",
    "estimate": "delivery_vs_estimate_days",
    "installment": "maximum_installments",
}


def account_facts(summary: DataFrame) -> DataFrame:
    """Order history per account (``customer_id``)."""
    status = F.col("order_status")
    sums = [F.sum(source).alias(name) for name, source in _SUMMED.items()]
    sums += [F.sum(cents(F.col(source))).alias(name) for name, source in _SUMMED_CENTS.items()]
    parts = [
        part
        for name, source in _AVERAGED.items()
        for part in (F.sum(source).alias(f"{name}_sum"), F.count(source).alias(f"{name}_n"))
    ]
    parts += [F.sum(cents(F.col("average_review_score"))).alias("score_sum"), F.count("average_review_score").alias("score_n")]
    return summary.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("*").alias("order_rows"),
        F.count("order_id").alias("total_orders"),
        F.count(F.when(status == "delivered", F.col("order_id"))).alias("delivered_orders"),
        F.count(F.when(status.isin(*UNSUCCESSFUL), F.col("order_id"))).alias("unsuccessful_orders"),
        *sums,
        *parts,
        F.max("total_payment_value").alias("maximum_order_value"),
        F.min("order_purchase_timestamp").alias("first_purchase_timestamp"),
        F.max("order_purchase_timestamp").alias("last_purchase_timestamp"),
        F.count_if(F.col("order_purchase_timestamp").isNull()).alias("undated_orders"),
        F.count_if(F.col("delivered_late")).alias("late_orders"),
    )


def accounts(customers: DataFrame) -> DataFrame:
    """Each (account, person) once, with one of its addresses."""
    address = F.struct("customer_city", "customer_state", "customer_zip_code_prefix")
    return customers.groupBy("customer_id", PERSON).agg(F.max(address).alias("address"))


def customer_facts(summary: DataFrame, customers: DataFrame) -> DataFrame:
    """Everything the customer-grain tables need, one row per person.

    Orders are reduced to accounts before the join, so both join sides are unique per key and no
    account or person, however busy, concentrates rows. The address is that of the account with
    the latest order, undated orders first; equal times are settled by the account id.
    """
    joined = account_facts(summary).join(accounts(customers), "customer_id")
    latest = F.struct(
        F.col("undated_orders") > 0, "last_purchase_timestamp", "customer_id", F.col("address").alias("address")
    )
    again = [
        "order_rows",
        "total_orders",
        "delivered_orders",
        "unsuccessful_orders",
        *_SUMMED,
        *_SUMMED_CENTS,
        *[f"{name}_{part}" for name in (*_AVERAGED, "score") for part in ("sum", "n")],
        "late_orders",
    ]
    return joined.groupBy(PERSON).agg(
        *[F.sum(name).alias(name) for name in again],
        F.max("maximum_order_value").alias("maximum_order_value"),
        F.min("first_purchase_timestamp").alias("first_purchase_timestamp"),
        F.max("last_purchase_timestamp").alias("last_purchase_timestamp"),
        # a person without id has no account of their own, so no address either
        F.when(F.col(PERSON).isNotNull(), F.max(latest)["address"]).alias("address"),
    )


def _average(name: str, digits: int = 10) -> Column:
    unit = 100 if name == "score" else 1
    return ratio(F.col(f"{name}_sum"), F.col(f"{name}_n") * unit, digits)


def _primary_payment() -> Column:
    """The type with most payments; on a tie the earliest in PAYMENT_TYPES, also when all are zero."""
    counts = {kind: F.col(f"{kind}_payments") for kind in PAYMENT_TYPES}
    most = F.greatest(*counts.values())
    return F.coalesce(*[F.when(count == most, F.lit(kind)) for kind, count in counts.items()])


def _customer_360() -> list[Column]:
    first, last = F.col("first_purchase_timestamp"), F.col("last_purchase_timestamp")
    active = F.timestamp_diff("DAY", first, last)
    orders = F.col("total_orders")
    columns = [
        PERSON,
        "address.customer_city",
        "address.customer_state",
        "address.customer_zip_code_prefix",
        "total_orders",
        "delivered_orders",
        "unsuccessful_orders",
        "total_items",
        "product_instances",
        from_cents(F.col("merchandise_cents")).alias("total_merchandise_value"),
        from_cents(F.col("payment_cents")).alias("total_payment_value"),
        ratio(F.col("payment_cents"), F.col("order_rows") * 100, 2).alias("average_order_value"),
        "maximum_order_value",
        from_cents(F.col("freight_cents")).alias("total_freight_value"),
        "first_purchase_timestamp",
        "last_purchase_timestamp",
        active.alias("customer_activity_days"),
        (orders >= 2).alias("repeat_customer"),
        F.when(active > 0, ratio(orders * 30, active)).alias("orders_per_month"),
        _average("delivery").alias("average_delivery_days"),
        _average("estimate").alias("average_delivery_vs_estimate_days"),
        "late_orders",
        F.col("delivery_n").alias("orders_with_delivery_data"),
        ratio(F.col("late_orders"), F.col("delivery_n")).alias("late_order_rate"),
        "total_reviews",
        _average("score").alias("average_review_score"),
        "low_score_reviews",
        "high_score_reviews",
        ratio(F.col("low_score_reviews"), F.col("total_reviews")).alias("low_review_rate"),
        "total_payment_records",
        *[f"{kind}_payments" for kind in PAYMENT_TYPES],
        _average("installment").alias("average_max_installments"),
        _primary_payment().alias("primary_payment_method"),
    ]
    return [F.col(column) if isinstance(column, str) else column for column in columns]


def customer_360(facts: DataFrame) -> DataFrame:
    return facts.select(*_customer_360())


def _experience() -> list[Column]:
    """Customer experience without the median."""
    late, low = F.col("late_orders"), F.col("low_score_reviews")
    columns = [
        PERSON,
        F.col("delivery_n").alias("orders_with_delivery_data"),
        _average("delivery").alias("average_delivery_days"),
        "late_orders",
        ratio(late, F.col("delivery_n"), 2).alias("late_order_rate"),
        _average("estimate", 2).alias("average_delivery_vs_estimate_days"),
        "total_reviews",
        _average("score", 2).alias("average_review_score"),
        "low_score_reviews",
        "high_score_reviews",
        ratio(low, F.col("total_reviews"), 2).alias("low_review_rate"),
        (late > 0).alias("has_delivery_delay"),
        (low > 0).alias("has_low_rating"),
        ((late > 0) & (low > 0)).alias("poor_experience_flag"),
    ]
    return [F.col(column) if isinstance(column, str) else column for column in columns]


def customer_experience(
    facts: DataFrame, orders: DataFrame, customers: DataFrame, workspace: Workspace
) -> DataFrame:
    rates = facts.select(*_experience())
    pairs = customers.select("customer_id", PERSON).distinct()
    delivered = orders.filter("delivery_days is not null").select("customer_id", "delivery_days")
    rows = delivered.join(pairs, "customer_id").select(PERSON, "delivery_days")
    medians = median_by_key(rows, PERSON, "delivery_days", workspace, "rank_delivery").withColumnRenamed(PERSON, "_person")
    joined = rates.join(medians, F.col(PERSON).eqNullSafe(F.col("_person")), "left")
    order = rates.columns
    order.insert(order.index("average_delivery_days") + 1, "median_delivery_days")
    return joined.withColumn("median_delivery_days", F.col("median").cast("double")).select(*order)


# --- category grain ---------------------------------------------------------------------------


SPEND_KEYS = [PERSON, "product_category"]
SPEND_DISTINCT = {"category_orders": "order_id", "distinct_products": "product_id"}


def _spend_sums() -> dict[str, Column]:
    times = F.col("times")
    return {
        "category_items": times,
        "value": F.col("price") * times,
        "freight": F.col("freight") * times,
        "prices": F.col("price").isNotNull().cast("bigint") * times,
    }


def _category_shares(spend: DataFrame) -> DataFrame:
    # A window holds one person's categories, one row each.
    person = Window.partitionBy(PERSON)
    value, orders = F.col("value"), F.col("category_orders")
    return spend.select(
        PERSON,
        "product_category",
        "category_orders",
        "category_items",
        "distinct_products",
        from_cents(value).alias("category_merchandise_value"),
        from_cents(F.col("freight")).alias("category_freight_value"),
        ratio(value, F.col("prices") * 100, 2).alias("average_item_price"),
        F.rank().over(person.orderBy(value.desc_nulls_first())).alias("category_value_rank"),
        ratio(value, F.sum(value).over(person), 2).alias("category_spend_share"),
        ratio(orders, F.sum(orders).over(person), 2).alias("category_order_share"),
    )


def customer_category_behavior(silver: Mapping[str, DataFrame], workspace: Workspace | None = None) -> DataFrame:
    """Spend per person and category, with its rank and shares within the person.

    A line is shuffled three times: to its product, to its order, and to its person, where all that follows needs no
    further shuffle. What the first two make is kept in the workspace, so that their shuffle files don't lie beside those
    of the third. Products that hold many lines are joined by a broadcast of just their rows; the join on orders ends in
    a write, so adaptive execution is free to split it. The lines of people who hold many are spread over their orders
    and products instead, and summed up in steps. Without a workspace all is one lazy plan, and everybody's are.
    """
    kept = workspace.keep if workspace else lambda name, rows: rows
    # A repeated account repeats its items; carrying the multiplicity keeps the account rows unique.
    people = silver["customers"].groupBy("customer_id", PERSON).agg(F.count("*").alias("times"))
    buyers = silver["orders"].select("order_id", "customer_id").join(people, "customer_id").drop("customer_id")
    buyers = kept("category_buyers", buyers)
    lines = silver["order_items"].select(
        "order_id", "product_id", cents(F.col("price")).alias("price"), cents(F.col("freight_value")).alias("freight")
    )
    products = silver["products"].select("product_id", F.col("product_category_name_english").alias("category"))
    hot = hot_keys(silver["order_items"], "product_id")
    named = kept("category_lines", left_join(lines.where("order_id is not null"), products, "product_id", hot, ["order_id"]))
    category = F.coalesce("category", F.lit("unknown")).alias("product_category")
    bought = named.join(buyers, "order_id").select("price", "freight", "times", PERSON, "order_id", "product_id", category)
    if workspace is None:
        return _category_shares(sums_and_distincts(bought, SPEND_KEYS, SPEND_DISTINCT, _spend_sums()))
    bought = kept("category_bought", bought)
    workspace.drop("category_lines")
    workspace.drop("category_buyers")

    def at_home(rows: DataFrame) -> DataFrame:
        return _category_shares(sums_and_distincts_in_place(rows.repartition(PERSON), SPEND_KEYS, SPEND_DISTINCT, _spend_sums()))

    busy = hot_keys(bought, PERSON, nulls=True)
    if not busy:
        return at_home(bought)
    spread = F.when(F.col(PERSON).isNull(), None in busy).otherwise(F.col(PERSON).isin([name for name in busy if name is not None]))
    theirs = sums_and_distincts(bought.where(spread), SPEND_KEYS, SPEND_DISTINCT, _spend_sums())
    return at_home(bought.where(~spread)).unionByName(_category_shares(theirs))


# --- scores and segments ----------------------------------------------------------------------

TILES = 5


def analysis_date(facts: DataFrame) -> DataFrame:
    """The day after the last purchase, as one row."""
    return facts.agg(F.date_add(F.max("last_purchase_timestamp").cast("date"), 1).alias("analysis_date"))


def customer_base(facts: DataFrame) -> DataFrame:
    """Customer 360 with the three scored measures, and the experience columns as a struct."""
    own = facts.select(*_customer_360(), F.struct(*_experience()[1:]).alias("experience"))
    dated = own.withColumn("analysis_date", analysis_date(facts).scalar())
    return dated.select(
        "*",
        F.datediff("analysis_date", F.col("last_purchase_timestamp").cast("date")).alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.col("total_payment_value").alias("monetary_value"),
    )


def rfm_scores(facts: DataFrame) -> DataFrame:
    """Customer base with quintile scores; equal values are ordered by customer id.

    ``facts`` should be a stored table: it is read a few times to find the few keys that end a quintile, and the scores
    are then comparisons with these.
    """
    return scored(customer_base(facts))


def scored(base: DataFrame) -> DataFrame:
    """A stored table with a person's recency_days, frequency and monetary_value, with quintile scores."""
    found = tile_ends(base, ["recency_days", "frequency", "monetary_value"], PERSON, TILES)

    def tile(measure: str, descending: bool = False) -> Column:
        return tile_of_key(base, measure, PERSON, found[measure][descending], descending)

    monetary = tile("monetary_value")
    return base.select(
        "*",
        tile("recency_days", descending=True).alias("recency_score"),
        tile("frequency").alias("frequency_score"),
        monetary.alias("monetary_score"),
        monetary.alias("monetary_quintile"),
        (TILES + 1 - tile("recency_days")).alias("recency_quintile"),
    )


RFM = (
    PERSON,
    "recency_days",
    "frequency",
    "monetary_value",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "recency_quintile",
    "monetary_quintile",
)


def rfm_score_table(facts: DataFrame) -> DataFrame:
    return rfm_scores(facts).select(*RFM)


def segment() -> Column:
    """Behavioural segment; the first rule that holds wins."""
    repeat, once = F.col("frequency") >= 2, F.col("frequency") == 1
    high = F.col("monetary_quintile") >= 4
    low = (F.col("monetary_quintile") <= 2) & (F.col("recency_quintile") <= 2)
    return (
        F.when(repeat & high, "High-Value Repeat")
        .when(repeat, "Developing Repeat")
        .when(once & high, "High-Value One-Time")
        .when(once & (F.col("recency_quintile") >= 4), "Recent One-Time")
        .when(once & low, "Low-Value Inactive")
        .otherwise("Established One-Time")
    )


INTELLIGENCE = (
    PERSON,
    "analysis_date",
    "customer_state",
    "last_purchase_timestamp",
    "recency_days",
    "frequency",
    "monetary_value",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "rfm_score",
    "rfm_code",
    "recency_quintile",
    "monetary_quintile",
    "repeat_customer",
    "delivered_orders",
    "average_order_value",
    "customer_segment",
)
EXPERIENCE = ("average_delivery_days", "late_order_rate", "average_review_score", "poor_experience_flag")


def _scored(facts: DataFrame) -> DataFrame:
    scores = [F.col(f"{name}_score") for name in ("recency", "frequency", "monetary")]
    return rfm_scores(facts).select(
        "*",
        (scores[0] + scores[1] + scores[2]).alias("rfm_score"),
        F.concat(*[score.cast("string") for score in scores]).alias("rfm_code"),
        segment().alias("customer_segment"),
    )


def customer_intelligence(facts: DataFrame) -> DataFrame:
    return _scored(facts).select(*INTELLIGENCE)


def customer_profile(intelligence: DataFrame, experience: DataFrame) -> DataFrame:
    """Intelligence with the experience columns the reports use, from two stored tables."""
    other = experience.select(F.col(PERSON).alias("_person"), *EXPERIENCE)
    return intelligence.join(other, F.col(PERSON) == F.col("_person"), "left").drop("_person")


def customer_profile_from_facts(facts: DataFrame) -> DataFrame:
    """``customer_profile`` without its join: both halves are projections of the same row.

    A NULL person matches nothing in that join, so it has no experience here either.
    """
    known = F.col(PERSON).isNotNull()
    experience = [F.when(known, F.col(f"experience.{name}")).alias(name) for name in EXPERIENCE]
    return _scored(facts).select(*INTELLIGENCE, *experience)


def executive_kpis(profile: DataFrame) -> DataFrame:
    money, orders = F.col("monetary_value"), F.col("frequency")
    repeat = orders > 1
    everyone, revenue = F.count("*"), F.sum(money)
    repeat_revenue = F.sum(F.when(repeat, money))
    return profile.agg(
        everyone.alias("total_customers"),
        F.count_if(repeat).alias("repeat_customers"),
        F.count_if(orders == 1).alias("one_time_customers"),
        percent(F.count_if(repeat), everyone).alias("repeat_customer_rate"),
        F.sum(orders).alias("total_orders"),
        revenue.cast(MONEY).alias("total_revenue"),
        ratio(revenue, F.sum(orders), 2).alias("average_order_value"),
        mean(money, 2).alias("average_customer_value"),
        repeat_revenue.cast(MONEY).alias("repeat_customer_revenue"),
        money_percent(repeat_revenue, revenue).alias("repeat_customer_revenue_share"),
        *experience_averages(),
    )


def experience_averages() -> list[Column]:
    """Delivery, lateness, review and poor-experience averages over customers."""
    late = F.col("late_order_rate")
    return [
        mean(F.col("average_delivery_days"), 2).alias("average_delivery_days"),
        ratio(F.sum(late) * 100, F.count(late), 2).alias("average_late_order_rate_pct"),
        mean(F.col("average_review_score"), 2).alias("average_review_score"),
        percent(F.count_if(F.col("poor_experience_flag")), F.count("*")).alias("poor_experience_rate_pct"),
    ]


# --- checks -----------------------------------------------------------------------------------


def check_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and surplus rows per gold table, given as name -> (table, key)."""
    rows = [
        key_counts(df, key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), surplus(key).alias("duplicate_keys"))
        .select(F.lit(name).alias("table_name"), "row_count", "duplicate_keys")
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
