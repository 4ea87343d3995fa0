"""The catalogue of 53 data-quality rules on the raw tables, two deep dives, and a scorecard.

Each rule is declared once, by kind. ``run`` answers one rule the way a user would ask it;
``scorecard`` answers all of them with one pass per table for the row conditions and one for all
its keys, which meet in a single count for the duplicate, orphan and domain rules.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.operators.keys import key_counts, orphan_keys, surplus, total

Raw = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Conditions:
    """Counts of the rows meeting each named condition."""

    table: str
    counts: dict[str, Callable[[], Column]]


@dataclass(frozen=True)
class UniqueKey:
    """All rows, distinct non-NULL keys, and the surplus; named in that order."""

    table: str
    key: str
    names: tuple[str, str, str]


@dataclass(frozen=True)
class RepeatedKeys:
    """Keys held by more than one row, with their row count."""

    table: str
    keys: tuple[str, ...]
    count: str
    sort: bool = False


@dataclass(frozen=True)
class SeveralPerKey:
    """Keys that go with more than one distinct value; listed, or only counted."""

    table: str
    key: str
    value: str
    listed: str | None = None
    counted: str | None = None


@dataclass(frozen=True)
class Orphans:
    """Child rows (or distinct child keys) without a parent."""

    child: str
    key: str
    parent: str
    name: str
    distinct: bool = False
    skip_null: bool = False


@dataclass(frozen=True)
class Domain:
    """The distinct values of a column."""

    table: str
    column: str


Rule = Conditions | UniqueKey | RepeatedKeys | SeveralPerKey | Orphans | Domain


def _null(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNull()


def _where(text: str) -> Callable[[], Column]:
    return lambda: F.expr(text)


def _missing(table: str, **names: str) -> Conditions:
    return Conditions(table, {alias: _null(column) for alias, column in names.items()})


def _rows(table: str, **conditions: str) -> Conditions:
    return Conditions(table, {alias: _where(text) for alias, text in conditions.items()})


RULES: dict[str, Rule] = {
    "dq_001": UniqueKey("customers", "customer_id", ("total_rows", "distinct_customer_ids", "duplicate_customer_id_rows")),
    "dq_002": RepeatedKeys("customers", ("customer_unique_id",), "customer_id_count", sort=True),
    "dq_003": SeveralPerKey(
        "customers", "customer_unique_id", "customer_id", counted="customers_with_multiple_customer_ids"
    ),
    "dq_004": _missing(
        "customers", missing_customer_id="customer_id", missing_customer_unique_id="customer_unique_id"
    ),
    "dq_005": UniqueKey("orders", "order_id", ("total_rows", "distinct_order_ids", "duplicate_order_rows")),
    "dq_006": _missing("orders", missing_order_id="order_id", missing_customer_id="customer_id"),
    "dq_007": Orphans("orders", "customer_id", "customers", "orphan_orders"),
    "dq_008": RepeatedKeys("order_items", ("order_id", "order_item_id"), "duplicate_count"),
    "dq_009": _missing(
        "order_items", missing_order_id="order_id", missing_product_id="product_id", missing_seller_id="seller_id"
    ),
    "dq_010": Orphans("order_items", "order_id", "orders", "orphan_order_items"),
    "dq_011": Orphans("order_items", "product_id", "products", "orphan_product_references"),
    "dq_012": Orphans("order_items", "seller_id", "sellers", "orphan_seller_references"),
    "dq_013": _rows("order_items", invalid_price_records="price < 0 or price is null"),
    "dq_014": _rows("order_items", invalid_freight_records="freight_value < 0 or freight_value is null"),
    "dq_015": _missing(
        "payments",
        missing_order_id="order_id",
        missing_payment_sequence="payment_sequential",
        missing_payment_type="payment_type",
    ),
    "dq_016": Orphans("payments", "order_id", "orders", "orphan_payments"),
    "dq_017": _rows(
        "payments",
        negative_payment_values="payment_value < 0",
        missing_payment_values="payment_value is null",
        zero_payment_values="payment_value = 0",
    ),
    "dq_018": Domain("payments", "payment_type"),
    "dq_019": _rows("payments", invalid_installments="payment_installments <= 0 or payment_installments is null"),
    "dq_020": _rows("reviews", invalid_review_scores="review_score not between 1 and 5 or review_score is null"),
    "dq_021": _missing("reviews", missing_review_id="review_id", missing_order_id="order_id"),
    "dq_022": Orphans("reviews", "order_id", "orders", "orphan_reviews"),
    "dq_023": RepeatedKeys("reviews", ("review_id",), "duplicate_count"),
    "dq_024": _rows("orders", invalid_approval_timestamps="order_approved_at < order_purchase_timestamp"),
    "dq_025": _rows("orders", invalid_carrier_timestamps="order_delivered_carrier_date < order_approved_at"),
    "dq_026": _rows(
        "orders", invalid_delivery_sequence="order_delivered_customer_date < order_delivered_carrier_date"
    ),
    "dq_027": _rows(
        "orders", invalid_estimated_delivery="order_estimated_delivery_date < to_date(order_purchase_timestamp)"
    ),
    "dq_028": _rows("orders", delivery_before_purchase="order_delivered_customer_date < order_purchase_timestamp"),
    "dq_029": _rows(
        "orders",
        delivered_without_delivery_date="order_status = 'delivered' and order_delivered_customer_date is null",
    ),
    "dq_030": _rows(
        "orders",
        delivered_without_carrier_date="order_status = 'delivered' and order_delivered_carrier_date is null",
    ),
    "dq_031": _rows(
        "orders",
        canceled_with_delivery_date="order_status = 'canceled' and order_delivered_customer_date is not null",
    ),
    "dq_032": _rows(
        "orders",
        unavailable_with_delivery_date="order_status = 'unavailable' and order_delivered_customer_date is not null",
    ),
    "dq_033": Domain("orders", "order_status"),
    "dq_034": UniqueKey("products", "product_id", ("total_products", "distinct_product_ids", "duplicate_product_rows")),
    "dq_035": _missing("products", missing_product_id="product_id"),
    "dq_036": _rows(
        "products",
        negative_weight="product_weight_g < 0",
        zero_weight="product_weight_g = 0",
        missing_weight="product_weight_g is null",
    ),
    "dq_037": _rows(
        "products",
        invalid_length="product_length_cm <= 0",
        invalid_height="product_height_cm <= 0",
        invalid_width="product_width_cm <= 0",
    ),
    "dq_038": _missing("products", missing_category="product_category_name"),
    "dq_039": UniqueKey("sellers", "seller_id", ("total_sellers", "distinct_sellers", "duplicate_seller_rows")),
    "dq_040": _missing("sellers", missing_seller_id="seller_id"),
    "dq_041": _missing(
        "sellers",
        missing_zip="seller_zip_code_prefix",
        missing_city="seller_city",
        missing_state="seller_state",
    ),
    "dq_042": _missing(
        "geolocation",
        missing_zip="geolocation_zip_code_prefix",
        missing_latitude="geolocation_lat",
        missing_longitude="geolocation_lng",
        missing_city="geolocation_city",
        missing_state="geolocation_state",
    ),
    "dq_043": _rows("geolocation", invalid_latitude="geolocation_lat not between -90 and 90"),
    "dq_044": _rows("geolocation", invalid_longitude="geolocation_lng not between -180 and 180"),
    "dq_045": SeveralPerKey(
        "geolocation", "geolocation_zip_code_prefix", "geolocation_state", listed="state_count"
    ),
    "dq_046": RepeatedKeys("category_translation", ("product_category_name",), "occurrences"),
    "dq_047": _missing(
        "category_translation",
        missing_portuguese_category="product_category_name",
        missing_english_category="product_category_name_english",
    ),
    "dq_048": Orphans(
        "products", "product_category_name", "category_translation", "untranslated_product_categories", skip_null=True
    ),
    "dq_049": Orphans("orders", "order_id", "order_items", "orders_without_items"),
    "dq_050": Orphans("orders", "order_id", "payments", "orders_without_payment"),
    "dq_051": Orphans("orders", "order_id", "reviews", "orders_without_review"),
    "dq_052": Orphans("order_items", "seller_id", "sellers", "missing_sellers", distinct=True),
    "dq_053": Orphans("order_items", "product_id", "products", "missing_products", distinct=True),
}


def _several(raw: Raw, rule: SeveralPerKey, count: str) -> DataFrame:
    """Keys with more than one distinct value, from (key, value) pairs combined before the shuffle."""
    pairs = raw[rule.table].select(rule.key, rule.value).distinct()
    return pairs.groupBy(rule.key).agg(F.count(rule.value).alias(count)).filter(F.col(count) > 1)


def _orphans(raw: Raw, rule: Orphans) -> DataFrame:
    child = raw[rule.child]
    if rule.skip_null:
        child = child.filter(F.col(rule.key).isNotNull())
    return orphan_keys(child, rule.key, raw[rule.parent])


def run(name: str, raw: Raw) -> DataFrame:
    """The result of one rule."""
    rule = RULES[name]
    match rule:
        case Conditions():
            counts = [F.count_if(condition()).alias(alias) for alias, condition in rule.counts.items()]
            return raw[rule.table].agg(*counts)
        case UniqueKey():
            rows, distinct, extra = rule.names
            counts = key_counts(raw[rule.table], rule.key)
            return counts.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias(rows),
                F.count(rule.key).alias(distinct),
                surplus(rule.key).alias(extra),
            )
        case RepeatedKeys():
            counts = key_counts(raw[rule.table], *rule.keys).withColumnRenamed("n", rule.count)
            found = counts.filter(F.col(rule.count) > 1)
            return found.orderBy(F.desc(rule.count), *rule.keys) if rule.sort else found
        case SeveralPerKey():
            if rule.counted:
                return _several(raw, rule, "n").agg(F.count("*").alias(rule.counted))
            return _several(raw, rule, rule.listed).orderBy(F.desc(rule.listed), rule.key)
        case Orphans():
            found = _orphans(raw, rule)
            return found.agg(F.count(rule.key).alias(rule.name)) if rule.distinct else total(found, rule.name)
        case Domain():
            return raw[rule.table].select(rule.column).distinct().orderBy(F.asc_nulls_last(rule.column))


def carrier_before_approval_by_status(raw: Raw) -> DataFrame:
    early = raw["orders"].filter("order_delivered_carrier_date < order_approved_at")
    counts = early.groupBy("order_status").agg(F.count("*").alias("affected_orders"))
    return counts.orderBy(F.desc("affected_orders"), "order_status")


def orders_without_items_by_status(raw: Raw) -> DataFrame:
    """Orders are counted per (order, status) so the anti join sees each pair once."""
    known = raw["order_items"].select(F.col("order_id").alias("_known")).distinct()
    counts = key_counts(raw["orders"], "order_id", "order_status")
    lonely = counts.join(known, F.col("order_id") == F.col("_known"), "left_anti")
    by_status = lonely.groupBy("order_status").agg(F.sum("n").alias("orders_without_items"))
    return by_status.orderBy(F.desc("orders_without_items"), "order_status")


DEEP_DIVES = {
    "dq_deep_carrier_before_approval": carrier_before_approval_by_status,
    "dq_deep_orders_without_items": orders_without_items_by_status,
}


# --- scorecard --------------------------------------------------------------------------------


def _entity(rule: Rule) -> str:
    return rule.child if isinstance(rule, Orphans) else rule.table


def _from_row(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Turn a one-row frame into (rule, violations) rows; ``columns`` maps rule -> column."""
    pairs = [
        F.struct(F.lit(rule).alias("rule_id"), F.col(column).cast("bigint").alias("violations"))
        for rule, column in columns.items()
    ]
    return frame.select(F.inline(F.array(*pairs)))


def _domain(rule: Rule) -> str:
    """The name of the keys that a rule counts; the same key column of several tables is one domain."""
    match rule:
        case RepeatedKeys():
            return "+".join(rule.keys)
        case Domain():
            return rule.column
        case _:
            return rule.key


def _key(domain: str) -> Column:
    """The key as text; parts of a longer key are kept apart and a missing part is a value of its own."""
    columns = domain.split("+")
    if len(columns) == 1:
        return F.col(domain).cast("string")
    return F.concat_ws("\u0001", *[F.coalesce(F.col(column).cast("string"), F.lit("\u0002")) for column in columns])


def _counted_keys(raw: Raw, rules: Mapping[str, Rule]) -> DataFrame:
    """Every key of every domain with its number of rows in each table: each table is read once and all meet in one shuffle."""
    domains: dict[str, set[str]] = {}
    for rule in rules.values():
        for table in (rule.child, rule.parent) if isinstance(rule, Orphans) else (rule.table,):
            domains.setdefault(table, set()).add(_domain(rule))
    tagged = [
        raw[table]
        .select(F.inline(F.array(*[F.struct(F.lit(domain).alias("domain"), _key(domain).alias("key")) for domain in sorted(own)])))
        .withColumn("table", F.lit(table))
        for table, own in domains.items()
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    return rows.groupBy("domain", "key").agg(*[F.count_if(F.col("table") == table).alias(table) for table in domains])


def _violations(rule: Rule) -> Column:
    """What a rule counts, from the counted keys."""
    here, known = F.col("domain") == _domain(rule), F.col("key").isNotNull()

    def rows(table: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(here & condition, F.col(table))), F.lit(0))

    match rule:
        case Orphans():
            lonely = (F.col(rule.parent) == 0) | ~known
            if rule.distinct:
                return F.count_if(here & known & lonely & (F.col(rule.child) > 0))
            return rows(rule.child, lonely & known if rule.skip_null else lonely)
        case UniqueKey():
            return rows(rule.table, F.lit(True)) - F.count_if(here & known & (F.col(rule.table) > 0))
        case RepeatedKeys():
            return F.count_if(here & (F.col(rule.table) > 1))
        case Domain():
            return F.count_if(here & (F.col(rule.table) > 0))


def scorecard(raw: Raw) -> DataFrame:
    """One row per rule: violations and whether it passed; domain rules report their value count."""
    parts: list[DataFrame] = []

    # Row conditions: one aggregate per table holds every rule of that table.
    tables: dict[str, dict[str, Column]] = {}
    for name, rule in RULES.items():
        if isinstance(rule, Conditions):
            each = [F.count_if(condition()) for condition in rule.counts.values()]
            tables.setdefault(rule.table, {})[name] = reduce(lambda a, b: a + b, each)
    for table, counts in tables.items():
        one_row = raw[table].agg(*[column.alias(name) for name, column in counts.items()])
        parts.append(_from_row(one_row, {name: name for name in counts}))

    # Keys: duplicates, orphans and domains from one count of all keys.
    keyed = {name: rule for name, rule in RULES.items() if isinstance(rule, (Orphans, UniqueKey, RepeatedKeys, Domain))}
    one_row = _counted_keys(raw, keyed).agg(*[_violations(rule).alias(name) for name, rule in keyed.items()])
    parts.append(_from_row(one_row, {name: name for name in keyed}))

    for name, rule in RULES.items():
        if isinstance(rule, SeveralPerKey):
            parts.append(_from_row(_several(raw, rule, "n").agg(F.count("*").alias(name)), {name: name}))

    result = reduce(DataFrame.unionByName, parts)
    entity = F.create_map(*[F.lit(x) for name, rule in RULES.items() for x in (name, _entity(rule))])
    informative = [name for name, rule in RULES.items() if isinstance(rule, Domain)]
    return result.select(
        "rule_id",
        entity[F.col("rule_id")].alias("entity"),
        "violations",
        F.when(~F.col("rule_id").isin(*informative), F.col("violations") == 0).alias("passed"),
    ).orderBy("rule_id")
