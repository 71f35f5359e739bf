"""Bindings from the star-schema Parquet tables to the logical order model.

Each function returns a lazy frame with only the columns the jobs use, so scans stay pruned. Schemas are
declared, so opening a table reads no file footers.

Design decisions of this binding: status ``F`` means delivered; the last ship date is the delivery date; the
order date plus ``PROMISE_DAYS`` is the promised date; the lowest line number stands in for the instalments;
event values stand in for review scores and model runs; conversation turns stand in for questions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.catalog import BENCH_QUESTIONS, BLOCKED_MESSAGE, bench_models
from goldpan.functions.bands import income_class

PROMISE_DAYS = 1800

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One stored table with its declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


ORDER_TABLES = ("customer", "events", "lineitem", "nation", "orders", "region")


#: The key on which the large raw tables meet.
BUCKET_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def bronze(spark: SparkSession, folder: str, names: Sequence[str] = ORDER_TABLES) -> dict[str, DataFrame]:
    """Stored tables by name; by default those of the order pipeline."""
    return {name: table(spark, folder, name) for name in names}


def delivered_orders(orders: DataFrame) -> DataFrame:
    """(order_id, customer_id, ordered, promised) of delivered orders; the filter reaches the scan."""
    ordered = F.col("o_orderdate").cast("date")
    return orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        ordered.alias("ordered"),
        F.date_add(ordered, PROMISE_DAYS).alias("promised"),
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    """(order_id, value, instalments, shipped): one row is an item and a payment at once."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_linenumber").alias("instalments"),
        F.col("l_shipdate").alias("shipped"),
    )


def customers(customer: DataFrame) -> DataFrame:
    """(customer_id, state_key)."""
    return customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("state_key"))


def states(nation: DataFrame, region: DataFrame) -> DataFrame:
    """(state_key, state, region, gdp, income_class): the GDP seed, spread evenly over the states by rule."""
    gdp = (10000 + 2000 * ((F.col("n_nationkey") * 7) % 25)).cast("double")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("state_key"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        gdp.alias("gdp"),
        income_class(gdp).alias("income_class"),
    )


def reviews(events: DataFrame) -> DataFrame:
    """(customer_id, score): a score of 1 to 5 per event."""
    score = F.least(F.lit(5), 1 + F.floor(F.col("value") / 50)).cast("bigint")
    return events.select(F.col("user_id").alias("customer_id"), score.alias("score"))


def questions(conversations: DataFrame) -> DataFrame:
    """(id, text, override): every conversation turn as a question; some name a model they want."""
    slot = F.col("turn") % 4
    return conversations.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        "text",
        F.when(slot == 1, "GPT-4o Mini").when(slot == 2, "Gemini 1.5 Pro").when(slot == 3, "unknown").alias("override"),
    )


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def model_runs(events: DataFrame) -> DataFrame:
    """Model runs as fixtures describe them, one per event; a zero token count means the run reported none.

    Columns: run_id, started, question, llm, ok, blocked_message, generation_error, generated, row_count, answer,
    first_row, sql_error, attempts, tokens_in, tokens_out, tokens_out_2, latency_ms.
    """
    kind = F.col("event_type")
    reported = F.get_json_object("props", "$.k").cast("bigint")
    whole = F.floor(F.col("value")).cast("bigint")
    return events.select(
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("started"),
        _pick(BENCH_QUESTIONS, F.col("user_id") % 3).alias("question"),
        _pick(bench_models(), F.col("event_id") % 7).alias("llm"),
        (kind != "error").alias("ok"),
        F.when(kind == "signup", BLOCKED_MESSAGE).alias("blocked_message"),
        F.when(kind == "error", F.concat(F.lit("run failed with "), F.col("props"))).alias("generation_error"),
        F.concat(F.lit("```sql\nSELECT '"), F.col("props"), F.lit("'\n```")).alias("generated"),
        F.when(kind == "view", 0).otherwise(F.col("user_id") % 4 + 1).cast("bigint").alias("row_count"),
        F.when(kind != "click", F.concat(F.lit(" resposta "), F.col("props"), F.lit("\n"))).alias("answer"),
        F.col("props").alias("first_row"),
        F.when((kind == "view") & (F.col("user_id") % 2 == 0), F.col("props")).alias("sql_error"),
        F.when(kind == "view", 2).otherwise(1).alias("attempts"),
        F.nullif(reported, F.lit(0)).alias("tokens_in"),
        F.nullif(whole, F.lit(0)).alias("tokens_out"),
        F.nullif(reported % 50, F.lit(0)).alias("tokens_out_2"),
        F.floor(F.col("value") * 10).cast("bigint").alias("latency_ms"),
    )


def query_results(events: DataFrame) -> DataFrame:
    """(id, position, event_type, cents): result rows per question, here the events of one user."""
    return events.select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("position"),
        "event_type",
        F.floor(F.col("value") * 100 + 0.5).alias("cents"),
    )


def run_rows(lineitem: DataFrame) -> DataFrame:
    """(id, position, part, quantity): result rows of runs, here the lines of the order with the run's number."""
    return lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
