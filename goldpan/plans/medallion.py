"""The pipeline from bronze to gold, lazily or written layer by layer."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from goldpan.operators import gold, quality, silver
from goldpan.sources import star_tables, store_csv
from goldpan.sources.publication import Publication, publish_version, version_folder
from goldpan.sources.writers import COLUMNAR, write_bucketed_layer, write_layer

# The checks of the star-schema tables. Line keys repeat in that data, so the last one reports failures.
STAR_CHECKS = [
    quality.not_null("orders", "o_orderkey"),
    quality.not_null("orders", "o_custkey"),
    quality.not_null("orders", "o_orderdate"),
    quality.accepted_values("orders", "o_orderstatus", "F", "O", "P"),
    quality.not_null("customer", "c_custkey"),
    quality.not_null("customer", "c_nationkey"),
    quality.not_null("lineitem", "l_orderkey"),
    quality.not_null("lineitem", "l_extendedprice"),
    quality.accepted_values("events", "event_type", "click", "error", "purchase", "signup", "view"),
    quality.not_null("nation", "n_name"),
    quality.not_null("region", "r_name"),
    quality.unique("orders", "o_orderkey"),
    quality.unique("customer", "c_custkey"),
    quality.unique("nation", "n_name"),
    quality.unique("region", "r_regionkey"),
    quality.unique("lineitem", "l_orderkey", "l_linenumber"),
]

# The checks run on every refreshed gold and silver layer.
LAYER_CHECKS = [
    quality.not_null("silver_delivered", "order_id"),
    quality.not_null("silver_delivered", "customer_id"),
    quality.unique("silver_delivered", "order_id"),
    quality.not_null("silver_items", "items_value"),
    quality.unique("silver_items", "order_id"),
    quality.not_null("silver_payments", "paid"),
    quality.unique("silver_payments", "order_id"),
    quality.not_null("silver_reviews", "score_sum"),
    quality.not_null("gold_kpis", "avg_ticket"),
    quality.not_null("silver_orders_enriched", "paid"),
    quality.not_null("silver_orders_enriched", "is_late"),
    quality.unique("silver_orders_enriched", "order_id"),
    quality.not_null("gold_state", "customer_state"),
    quality.not_null("gold_state", "regiao"),
    quality.not_null("gold_state", "total_pedidos"),
    quality.unique("gold_state", "customer_state"),
    quality.not_null("gold_class", "income_class"),
    quality.unique("gold_class", "income_class"),
]


@dataclass(frozen=True)
class OrderModel:
    """The logical order model over raw tables.

    ``per_order`` holds the raw fact tables reduced to one row per order, by name; together they have the item,
    payment and (if orders lack it) delivery columns. ``reviews`` holds review sums per order or per customer.
    """

    orders: DataFrame
    per_order: dict[str, DataFrame]
    reviews: DataFrame
    customers: DataFrame
    states: DataFrame

    @property
    def reviews_per_order(self) -> bool:
        return "order_id" in self.reviews.columns

    @property
    def facts(self) -> DataFrame:
        reviews = self.reviews if self.reviews_per_order else None
        return silver.order_facts(self.orders, *self.per_order.values(), reviews=reviews)

    @property
    def profiles(self) -> DataFrame:
        reviews = None if self.reviews_per_order else self.reviews
        return silver.customer_profiles(self.customers, self.states, reviews)

    def facts_with(self, column: str) -> DataFrame:
        """The per-order table that has ``column``."""
        return next(frame for frame in self.per_order.values() if column in frame.columns)

    def delivered(self) -> DataFrame:
        dates = None if "delivered" in self.orders.columns else self.facts_with("delivered")
        return silver.delivered(self.orders, dates)

    def items(self) -> DataFrame:
        return silver.items_per_order(self.facts_with("n_items"))

    def payments(self) -> DataFrame:
        return silver.payments_per_order(self.facts_with("paid_cents"))

    def enriched(self) -> DataFrame:
        return silver.enrich(self.facts, self.profiles, self.orders)

    def lost_orders(self) -> DataFrame:
        """(cause, lost): delivered orders that the enriched table cannot have, by what they lack."""
        facts = {"items": self.facts_with("n_items"), "payments": self.facts_with("paid_cents")}
        return quality.lost_orders(self.orders, facts, self.customers, self.states)

    def state_totals(self) -> DataFrame:
        return gold.state_totals_from_facts(self.facts, self.profiles)

    def gold_state(self) -> DataFrame:
        return gold.gold_state(self.state_totals())

    def stored(self, folder: str, fmt: str = COLUMNAR, buckets: int = 0) -> OrderModel:
        """The same model with every per-order and review table written once and read back; with ``buckets``, those with one row per order
        are bucketed on the order."""

        def write(name: str, frame: DataFrame) -> DataFrame:
            path = f"{folder}/{name}"
            if buckets and "order_id" in frame.columns:
                return write_bucketed_layer(frame, path, "order_id", buckets, fmt)
            return write_layer(frame, path, fmt)

        per_order = {name: write(name, frame) for name, frame in self.per_order.items()}
        return replace(self, per_order=per_order, reviews=write("silver_reviews", self.reviews))


def from_star_tables(tables: dict[str, DataFrame]) -> OrderModel:
    """Order model of the star-schema tables. Line items are scanned and shuffled once for items, payments and
    delivery date together."""
    return OrderModel(
        orders=star_tables.delivered_orders(tables["orders"]),
        per_order={"line_facts": silver.line_facts(star_tables.order_lines(tables["lineitem"]))},
        reviews=silver.review_scores(star_tables.reviews(tables["events"]), "customer_id"),
        customers=star_tables.customers(tables["customer"]),
        states=star_tables.states(tables["nation"], tables["region"]),
    )


def from_store_csv(spark: SparkSession, tables: dict[str, DataFrame]) -> OrderModel:
    """Order model of the public seven-table dataset, where reviews are kept per order."""
    return OrderModel(
        orders=store_csv.delivered_orders(tables["orders"]),
        per_order={
            "item_facts": silver.item_facts(store_csv.items(tables["order_items"])),
            "payment_facts": silver.payment_facts(store_csv.payments(tables["order_payments"])),
        },
        reviews=silver.review_scores(store_csv.reviews(tables["order_reviews"]), "order_id"),
        customers=store_csv.customers(tables["customers"]),
        states=store_csv.gdp_seed(spark),
    )


def refresh(model: OrderModel, folder: str, fmt: str = COLUMNAR, buckets: int = 0) -> dict[str, DataFrame]:
    """Write the layers in order and return the tables: four silver tables, enriched silver, three gold tables,
    the orders lost on the way by cause, and the report.

    Each raw fact table is reduced and written once; the silver tables are made of those files. Orders
    are joined once for all gold tables. Every step reads the stored files of the one before, so a lost executor costs
    no more than re-reading. Give every refresh a new folder and publish at the end: a refresh that fails then leaves
    the published tables as they were.

    With ``buckets`` and a bronze layer bucketed alike on the order (``write_bronze``), raw facts are grouped and orders joined with their facts without
    an exchange on the order.
    """

    def write(name: str, frame: DataFrame) -> DataFrame:
        return write_layer(frame, f"{folder}/{name}", fmt)

    base = model.stored(folder, fmt, buckets)
    enriched = write("silver_orders_enriched", base.enriched())
    totals = write("state_totals", gold.state_totals(enriched))
    tables = {
        "silver_delivered": write("silver_delivered", base.delivered()),
        "silver_items": write("silver_items", base.items()),
        "silver_payments": write("silver_payments", base.payments()),
        "silver_reviews": base.reviews,
        "silver_orders_enriched": enriched,
        "gold_state": write("gold_state", gold.gold_state(totals)),
        "gold_class": write("gold_class", gold.gold_class(totals)),
        "gold_kpis": write("gold_kpis", gold.gold_kpis(totals)),
    }
    tables["lost_orders"] = write("lost_orders", base.lost_orders())
    tests = quality.run_checks(tables, LAYER_CHECKS)
    tests = tests.unionByName(quality.reconciled(tables["silver_delivered"], enriched, tables["lost_orders"]))
    tables["dq_report"] = write("dq_report", tests)
    return tables


def refresh_and_publish(spark: SparkSession, model: OrderModel, root: str, fmt: str = COLUMNAR, buckets: int = 0) -> tuple[dict[str, DataFrame], Publication | None]:
    """Refresh into a new version folder below ``root`` and publish it if all its quality tests pass.

    A refresh that fails, or whose tests fail, leaves the version that readers see as it was; the tables of the latter are returned, without
    a publication.
    """
    folder = version_folder(root)
    tables = refresh(model, folder, fmt, buckets)
    if not tables["dq_report"].filter("NOT passed").isEmpty():
        return tables, None
    return tables, publish_version(spark, root, folder, tables, fmt)
