"""Silver layer: order-grain tables.

Each raw fact table is reduced to one row per order before any join, so joins never multiply rows, and map-side
partial aggregation absorbs an order, customer or reviewer that holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.measures import cents, from_cents
from goldpan.operators.skew import join_spreading_hot_keys


ENRICHED_COLUMNS = (
    "order_id",
    "customer_id",
    "ordered",
    "delivered",
    "promised",
    "delay_days",
    "is_late",
    "n_items",
    "items_value",
    "paid",
    "instalments",
    "in_instalments",
    "score_sum",
    "score_count",
    "state",
    "region",
    "gdp",
    "income_class",
)


def _item_measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("n_items"), F.sum(cents(F.col("value"))).alias("items_cents")]


def _payment_measures(instalments: Callable[[str], Column]) -> list[Column]:
    return [F.sum(cents(F.col("value"))).alias("paid_cents"), instalments("instalments").alias("instalments")]


def item_facts(items: DataFrame) -> DataFrame:
    """(order_id, n_items, items_cents) from items(order_id, value)."""
    return items.groupBy("order_id").agg(*_item_measures())


def payment_facts(payments: DataFrame, instalments: Callable[[str], Column] = F.max) -> DataFrame:
    """(order_id, paid_cents, instalments) from payments(order_id, value, instalments)."""
    return payments.groupBy("order_id").agg(*_payment_measures(instalments))


def line_facts(lines: DataFrame) -> DataFrame:
    """Item and payment facts plus the delivery date, where one table holds all three: one scan, one shuffle."""
    return lines.groupBy("order_id").agg(
        *_item_measures(), *_payment_measures(F.min), F.max("shipped").cast("date").alias("delivered")
    )


def items_per_order(facts: DataFrame) -> DataFrame:
    """(order_id, n_items, items_value)."""
    return facts.select("order_id", "n_items", from_cents(F.col("items_cents")).alias("items_value"))


def payments_per_order(facts: DataFrame) -> DataFrame:
    """(order_id, paid, instalments, in_instalments)."""
    return facts.select(
        "order_id",
        from_cents(F.col("paid_cents")).alias("paid"),
        "instalments",
        (F.col("instalments") > 1).alias("in_instalments"),
    )


def review_scores(reviews: DataFrame, key: str) -> DataFrame:
    """(key, score_sum, score_count); the mean is taken last, so it can be re-weighted."""
    return reviews.groupBy(key).agg(F.sum("score").alias("score_sum"), F.count("score").alias("score_count"))


def with_delay(orders: DataFrame) -> DataFrame:
    """Add delay_days (negative: early) and is_late to orders that have delivered and promised dates."""
    delay = F.datediff("delivered", "promised")
    return orders.withColumns({"delay_days": delay, "is_late": delay > 0})


def order_facts(orders: DataFrame, *per_order: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Delivered orders with everything known per order. Orders without items or payments drop out; reviews may be
    missing. Every input is keyed on order_id, so each one is shuffled once at most."""
    for facts in per_order:
        orders = orders.join(facts, "order_id")
    if reviews is not None:
        orders = orders.join(reviews, "order_id", "left")
    return with_delay(orders)


def delivered(orders: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Every delivered order with its delay, null where no delivery date is known.

    ``dates`` has the date by order_id where ``orders`` do not hold it themselves.
    """
    if dates is not None:
        orders = orders.join(dates.select("order_id", "delivered"), "order_id", "left")
    return with_delay(orders).select("order_id", "customer_id", "ordered", "delivered", "promised", "delay_days", "is_late")


def customer_profiles(customers: DataFrame, states: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Customers with state, region, GDP and class, and review scores where those are kept per customer."""
    profiles = customers.join(states, "state_key").drop("state_key")
    if reviews is None:
        return profiles
    return profiles.join(reviews, "customer_id", "left")


def enrich(facts: DataFrame, profiles: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per delivered order with all facts and the customer's profile.

    ``orders`` supplies the customer keys for the balance sketch; a customer holding a large share of the orders is
    spread over many tasks.
    """
    joined = join_spreading_hot_keys(facts, profiles, "customer_id", "order_id", orders.select("customer_id"))
    computed = {
        "items_value": from_cents(F.col("items_cents")),
        "paid": from_cents(F.col("paid_cents")),
        "in_instalments": F.col("instalments") > 1,
    }
    return joined.select(*[computed[c].alias(c) if c in computed else c for c in ENRICHED_COLUMNS])
