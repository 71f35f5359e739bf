"""Raw order tables of the public Brazilian e-commerce dataset: seven CSV tables with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.catalog import STATE_GDP, lookup
from goldpan.functions.bands import income_class

# The columns of the seven public tables.
SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp, price double, freight_value double",
    "order_payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value double",
    "order_reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, product_length_cm int, "
    "product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
}


def read_csv(spark: SparkSession, folder: str, name: str, pattern: str = "*{name}*.csv") -> DataFrame:
    """One raw table. Malformed rows stop the load instead of turning into nulls.

    Only review comments hold line breaks inside quotes, so only that table gives up splitting its files.
    """
    return (
        spark.read.schema(SCHEMAS[name])
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", name == "order_reviews")
        .csv(f"{folder}/{pattern.format(name=name)}")
    )


#: The key on which the large raw tables meet.
BUCKET_KEYS = {name: "order_id" for name in ("orders", "order_items", "order_payments", "order_reviews")}


def bronze(spark: SparkSession, folder: str, pattern: str = "*{name}*.csv") -> dict[str, DataFrame]:
    """All seven raw tables by name."""
    return {name: read_csv(spark, folder, name, pattern) for name in SCHEMAS}


def gdp_seed(spark: SparkSession) -> DataFrame:
    """(state_key, state, region, gdp, income_class) for the 27 Brazilian states."""
    rows = lookup(spark, STATE_GDP, "state string, region string, gdp double")
    return rows.select(
        F.col("state").alias("state_key"), "state", "region", "gdp", income_class(F.col("gdp")).alias("income_class")
    )


def delivered_orders(orders: DataFrame) -> DataFrame:
    """(order_id, customer_id, ordered, promised, delivered) of delivered orders."""
    return orders.filter(F.col("order_status") == "delivered").select(
        "order_id",
        "customer_id",
        F.col("order_purchase_timestamp").cast("date").alias("ordered"),
        F.col("order_estimated_delivery_date").cast("date").alias("promised"),
        F.col("order_delivered_customer_date").cast("date").alias("delivered"),
    )


def items(order_items: DataFrame) -> DataFrame:
    """(order_id, value)."""
    return order_items.select("order_id", F.col("price").alias("value"))


def payments(order_payments: DataFrame) -> DataFrame:
    """(order_id, value, instalments)."""
    return order_payments.select(
        "order_id", F.col("payment_value").alias("value"), F.col("payment_installments").alias("instalments")
    )


def reviews(order_reviews: DataFrame) -> DataFrame:
    """(order_id, score)."""
    return order_reviews.select("order_id", F.col("review_score").cast("bigint").alias("score"))


def customers(raw: DataFrame) -> DataFrame:
    """(customer_id, state_key)."""
    return raw.select("customer_id", F.col("customer_state").alias("state_key"))
