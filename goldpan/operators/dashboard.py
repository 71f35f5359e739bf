"""Dashboard datasets over the gold state table.

Means here are over states, each state counting once, as the dashboard shows them; ``gold.gold_kpis`` and
``gold.gold_class`` hold the order-weighted figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.catalog import DISPLAY_COLUMNS, INCOME_CLASSES, lookup
from goldpan.functions.bands import class_band, late_severity
from goldpan.functions.measures import mean_of


def gold_scan(spark: SparkSession, table: str) -> DataFrame:
    """All gold rows, most orders first; the state settles ties."""
    return spark.table(table).orderBy(F.desc("total_pedidos"), "customer_state")


def display(gold: DataFrame) -> DataFrame:
    """The columns shown to users under their headings, doubles to one decimal, with the class band.

    A column missing from ``gold`` is left out; the others keep their own headings.
    """
    types = dict(gold.dtypes)
    shown = [
        (F.round(name, 1) if types[name] == "double" else F.col(name)).alias(heading)
        for name, heading in DISPLAY_COLUMNS
        if name in types
    ]
    if "classe_economica" in types:
        shown.append(class_band(F.col("classe_economica")).alias("class_band"))
    return gold.select(*shown)


def dashboard_kpis(gold: DataFrame) -> DataFrame:
    """One row: total orders and the unweighted state means of ticket, late rate and satisfaction."""
    return gold.agg(
        F.coalesce(F.sum("total_pedidos"), F.lit(0)).cast("bigint").alias("orders"),
        mean_of("ticket_medio").alias("ticket"),
        mean_of("pct_atrasados").alias("late"),
        mean_of("satisfacao_media").alias("satisfaction"),
    )


def top_states(gold: DataFrame, n: int = 7) -> DataFrame:
    """(state, orders) of the ``n`` states with most orders."""
    ranked = gold.orderBy(F.desc("total_pedidos"), "customer_state").limit(n)
    return ranked.select(F.col("customer_state").alias("state"), F.col("total_pedidos").alias("orders"))


def scatter(gold: DataFrame) -> DataFrame:
    """(state, gdp, ticket, class_band) per state."""
    return gold.select(
        F.col("customer_state").alias("state"),
        F.col("pib_per_capita").alias("gdp"),
        F.col("ticket_medio").alias("ticket"),
        class_band(F.col("classe_economica")).alias("class_band"),
    )


def class_profile(gold: DataFrame) -> DataFrame:
    """Unweighted instalment means by class: always one row per known class, null where no state has it.

    ``pct_scaled`` is the percentage over ten, to share an axis with the instalment count.
    """
    rows = [(name, position) for position, (name, _) in enumerate(INCOME_CLASSES)]
    classes = lookup(gold.sparkSession, rows, "income_class string, position int")
    means = gold.groupBy(F.col("classe_economica").alias("income_class")).agg(
        mean_of("media_parcelas").alias("avg_instalments"), mean_of("pct_parcelados").alias("pct_instalments")
    )
    return classes.join(means, "income_class", "left").select(
        "income_class",
        "position",
        "avg_instalments",
        "pct_instalments",
        F.round(F.col("pct_instalments") / 10, 6).alias("pct_scaled"),
    )


def region_late(gold: DataFrame) -> DataFrame:
    """(region, pct_late, severity), unweighted, worst first. States without a region are left out."""
    means = gold.filter(F.col("regiao").isNotNull()).groupBy(F.col("regiao").alias("region"))
    return (
        means.agg(mean_of("pct_atrasados").alias("pct_late"))
        .withColumn("severity", late_severity(F.col("pct_late")))
        .orderBy(F.desc("pct_late"), "region")
    )
