"""Gold layer: measures by state, by income class and overall.

All three tables are ratios of the same additive measures. The measures are summed step by step (order, customer,
state, class, total), so the facts are read once and each step shuffles only partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = (
    "orders",
    "paid_cents",
    "items",
    "instalments",
    "instalment_orders",
    "timed_orders",
    "late_orders",
    "delay_days",
    "score_sum",
    "score_count",
)
STATE_KEYS = ("state", "region", "gdp", "income_class")


def roll_up(frame: DataFrame, *keys: str) -> DataFrame:
    """Sum every additive measure by ``keys``."""
    present = set(frame.columns)
    return frame.groupBy(*keys).agg(*[F.expr(f"sum({m}) AS {m}") for m in MEASURES if m in present])


def order_measures(facts: DataFrame) -> DataFrame:
    """Additive measures of each order, from ``silver.order_facts`` or from the enriched silver table."""
    present = set(facts.columns)
    kept = [c for c in ("customer_id", *STATE_KEYS, "score_sum", "score_count") if c in present]
    paid = "paid_cents" if "paid_cents" in present else "paid * 100"
    return facts.selectExpr(
        *kept,
        "1L AS orders",
        f"CAST({paid} AS bigint) AS paid_cents",
        "n_items AS items",
        "instalments",
        "int(instalments > 1) AS instalment_orders",
        "int(delay_days IS NOT NULL) AS timed_orders",
        "int(is_late) AS late_orders",
        "delay_days",
    )


def state_totals(enriched: DataFrame) -> DataFrame:
    """Measures by state from the stored silver table: one partial aggregation, no join."""
    return roll_up(order_measures(enriched), *STATE_KEYS)


def state_totals_from_facts(facts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Measures by state straight from order facts.

    Orders are summed per customer before customers are joined. A customer with many orders is one row by then, so
    the join is one-to-one and cannot be skewed, and it moves sums instead of orders. Review scores kept per
    customer count once per order of that customer.
    """
    by_customer = roll_up(order_measures(facts), "customer_id").join(profiles, "customer_id")
    if "score_sum" in profiles.columns:
        by_customer = by_customer.withColumns(
            {score: F.col(score) * F.col("orders") for score in ("score_sum", "score_count")}
        )
    return roll_up(by_customer, *STATE_KEYS)


def _ratio(top: str, bottom: str, decimals: int) -> str:
    """SQL for a rounded quotient, null where the denominator is zero. One division, rounded once."""
    return f"round(try_divide(double({top}), double({bottom})), {decimals})"


# Money is in cents and percentages are in parts of a hundred, so the factor goes into the whole-number side.
def _ticket(decimals: int) -> str:
    return _ratio("paid_cents", "orders * 100", decimals)


def _percent(measure: str, decimals: int, of: str = "orders") -> str:
    return _ratio(f"{measure} * 100", of, decimals)


_SATISFACTION = ("score_sum", "score_count")


def gold_state(totals: DataFrame) -> DataFrame:
    """One row per state with the thirteen gold columns. Means are over orders; delay figures are over
    orders with both dates and ``satisfacao_media`` over orders with a review, null where there are none."""
    return totals.selectExpr(
        "state AS customer_state",
        "region AS regiao",
        "round(gdp, 1) AS pib_per_capita",
        "income_class AS classe_economica",
        "orders AS total_pedidos",
        f"{_ticket(2)} AS ticket_medio",
        f"{_ratio('items', 'orders', 2)} AS media_itens",
        f"{_ratio('instalments', 'orders', 2)} AS media_parcelas",
        f"{_percent('instalment_orders', 1)} AS pct_parcelados",
        f"{_ratio(*_SATISFACTION, 2)} AS satisfacao_media",
        f"{_percent('late_orders', 1, 'timed_orders')} AS pct_atrasados",
        f"{_ratio('delay_days', 'timed_orders', 1)} AS media_dias_atraso",
    ).withColumn("ticket_por_pib", F.expr(_ratio("ticket_medio * 1000", "pib_per_capita", 2)))


def gold_class(totals: DataFrame) -> DataFrame:
    """Instalment behaviour by income class, weighted by orders."""
    return roll_up(totals, "income_class").selectExpr(
        "income_class",
        "orders",
        f"{_ratio('instalments', 'orders', 4)} AS avg_instalments",
        f"{_percent('instalment_orders', 4)} AS pct_instalments",
        f"{_ticket(4)} AS avg_ticket",
    )


def gold_kpis(totals: DataFrame) -> DataFrame:
    """One row over all orders, weighted by orders."""
    return roll_up(totals).selectExpr(
        "coalesce(orders, 0L) AS orders",
        f"{_ticket(4)} AS avg_ticket",
        f"{_percent('late_orders', 4, 'timed_orders')} AS pct_late",
        f"{_ratio(*_SATISFACTION, 4)} AS satisfaction",
    )
