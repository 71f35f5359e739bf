"""The analytical questions users ask of the gold state table, each with one fixed answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.functions.bands import late_severity
from goldpan.functions.measures import mean_of, ratio


def region_with_highest_late_rate(gold: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Which region has the highest late rate? Ranked by the mean of its states; the rate over its orders is beside it.

    With the additive measures by state (``totals``) that rate is exact. The gold table alone has rounded percentages
    and all orders, so the rate is then an approximation.
    """
    late_orders = F.sum(F.col("pct_atrasados") * F.col("total_pedidos"))
    ranked = (
        gold.filter(F.col("regiao").isNotNull())
        .groupBy(F.col("regiao").alias("region"))
        .agg(
            mean_of("pct_atrasados").alias("pct_late"),
            F.round(ratio(late_orders, F.sum("total_pedidos")), 6).alias("pct_late_weighted"),
        )
        .withColumn("severity", late_severity(F.col("pct_late")))
        .orderBy(F.desc("pct_late"), "region")
        .limit(1)
    )
    if totals is None:
        return ranked
    exact = F.round(ratio(F.sum("late_orders") * 100, F.sum("timed_orders")), 6)
    rates = totals.groupBy("region").agg(exact.alias("pct_late_weighted"))
    return ranked.drop("pct_late_weighted").join(rates, "region").select(*ranked.columns)


def instalments_by_class(gold: DataFrame) -> DataFrame:
    """Do low-income states use instalments more? Class means and the gap to the richest class, in points."""
    by_class = (
        gold.filter(F.col("classe_economica").isNotNull())
        .groupBy(F.col("classe_economica").alias("income_class"))
        .agg(mean_of("pct_parcelados").alias("pct_instalments"), mean_of("media_parcelas").alias("avg_instalments"))
    )
    # At most one element per income class is collected, so the array is bounded.
    entries = F.collect_list(F.struct("income_class", "pct_instalments", "avg_instalments"))
    rich = F.max(F.when(F.col("income_class") == "Rico", F.col("pct_instalments")))
    return (
        by_class.agg(rich.alias("rich"), entries.alias("classes"))
        .select("rich", F.inline("classes"))
        .withColumn("diff_from_rich", F.round(F.col("pct_instalments") - F.col("rich"), 6))
        .drop("rich")
    )


def gdp_and_satisfaction(gold: DataFrame) -> DataFrame:
    """How are GDP and satisfaction related? Pearson correlation over the states that have both, null where all of them share one value of either."""
    both = gold.filter(F.col("pib_per_capita").isNotNull() & F.col("satisfacao_media").isNotNull())
    pair = ("pib_per_capita", "satisfacao_media")
    # F.corr fails by a division where a deviation is zero; sums of partitions may leave a trace of one, so equal values are told by their bounds
    varied = (F.min(pair[0]) < F.max(pair[0])) & (F.min(pair[1]) < F.max(pair[1]))
    correlation = ratio(F.covar_pop(*pair), F.stddev_pop(pair[0]) * F.stddev_pop(pair[1]))
    return both.agg(
        F.round(F.when(varied, correlation), 6).alias("correlation"),
        F.count(F.lit(1)).alias("states"),
    )


def top_delivery_states(gold: DataFrame, n: int = 3) -> DataFrame:
    """Top states by delivery efficiency: lowest late rate, then earliest deliveries, then state."""
    ranked = gold.orderBy("pct_atrasados", "media_dias_atraso", "customer_state").limit(n)
    return ranked.select(
        F.col("customer_state").alias("state"),
        F.col("pct_atrasados").alias("pct_late"),
        F.col("media_dias_atraso").alias("avg_delay_days"),
    )


def ticket_by_class(gold: DataFrame) -> DataFrame:
    """Compare the average ticket by class: mean, lowest and highest state, and number of states."""
    return (
        gold.filter(F.col("classe_economica").isNotNull())
        .groupBy(F.col("classe_economica").alias("income_class"))
        .agg(
            mean_of("ticket_medio").alias("avg_ticket"),
            F.min("ticket_medio").alias("min_ticket"),
            F.max("ticket_medio").alias("max_ticket"),
            F.count(F.lit(1)).alias("states"),
        )
    )


def state_with_highest_ticket(gold: DataFrame) -> DataFrame:
    """State with the highest average ticket; the state code settles ties."""
    ranked = gold.orderBy(F.desc("ticket_medio"), "customer_state").limit(1)
    return ranked.select(F.col("customer_state").alias("state"), F.col("ticket_medio").alias("ticket"))
