"""Data-quality tests: not_null, unique and accepted_values, reported as a table and never raised."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One test on a table. ``columns`` is a single column, or a composite key for ``unique``."""

    table: str
    test: str
    columns: tuple[str, ...]
    values: tuple = ()

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(table: str, column: str) -> Check:
    return Check(table, "not_null", (column,))


def unique(table: str, *columns: str) -> Check:
    return Check(table, "unique", columns)


def accepted_values(table: str, column: str, *values) -> Check:
    return Check(table, "accepted_values", (column,), values)


def _failing_rows(check: Check) -> Column:
    column = F.col(check.columns[0])
    bad = column.isNull() if check.test == "not_null" else ~column.isin(*check.values)
    return F.count_if(bad)


def _row_checks(frame: DataFrame, checks: list[Check]) -> DataFrame:
    """Every row-level test of one table in a single scan, then one output row per test."""
    totals = frame.agg(*[_failing_rows(c).alias(f"c{i}") for i, c in enumerate(checks)])
    found = [
        F.struct(
            F.lit(c.table).alias("table"),
            F.lit(c.label).alias("column"),
            F.lit(c.test).alias("test"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*found)))


def _unique_check(frame: DataFrame, check: Check) -> DataFrame:
    """Number of key values that occur more than once. Counts are combined map-side, so a key held by a large share
    of the rows sends one partial count per task. Keys with a null part are not tested."""
    repeated = frame.dropna(subset=list(check.columns)).groupBy(*check.columns).count().filter(F.col("count") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check.table).alias("table"),
        F.lit(check.label).alias("column"),
        F.lit(check.test).alias("test"),
        "failures",
    )


#: Why a delivered order is not in the enriched table, in the order in which causes are told.
LOST_CAUSES = ("items", "payments", "customer", "state")


def lost_orders(orders: DataFrame, per_order: dict[str, DataFrame], customers: DataFrame, states: DataFrame) -> DataFrame:
    """(cause, lost), a row for every cause: delivered ``orders`` that lack items, payments, a customer or a state.

    ``per_order`` gives by cause a table with one row per order. An order that lacks several things counts for the first one. One pass: outer joins
    on the order set a flag each, then orders are counted by customer and cause, so that customers are joined with one row per
    customer and cause, however many orders one has.
    """
    flagged, cause = orders.select("order_id", "customer_id"), F.lit(None).cast("string")
    for name, facts in per_order.items():
        flagged = flagged.join(facts.select("order_id", F.lit(True).alias(name)), "order_id", "left")
        cause = F.coalesce(cause, F.when(F.col(name).isNull(), F.lit(name)))
    counts = flagged.groupBy("customer_id", cause.alias("cause")).agg(F.count(F.lit(1)).alias("n"))
    known = customers.select("customer_id", "state_key", F.lit(True).alias("customer"))
    known = known.join(states.select("state_key", F.lit(True).alias("state")), "state_key", "left")
    counts = counts.join(known, "customer_id", "left")
    for name in ("customer", "state"):
        counts = counts.withColumn("cause", F.coalesce("cause", F.when(F.col(name).isNull(), F.lit(name))))
    total = counts.agg(*[F.coalesce(F.sum(F.when(F.col("cause") == c, F.col("n"))), F.lit(0)).alias(c) for c in LOST_CAUSES])
    return total.select(F.inline(F.array(*[F.struct(F.lit(c).alias("cause"), F.col(c).alias("lost")) for c in LOST_CAUSES])))


def lost_checks(lost: DataFrame, table: str = "silver_orders_enriched") -> DataFrame:
    """The lost orders as rows of the quality report: test ``lost``, the cause as its column."""
    rows = lost.select(F.lit(table).alias("table"), F.col("cause").alias("column"), F.lit("lost").alias("test"), F.col("lost").alias("failures"))
    return rows.withColumn("passed", F.col("failures") == 0)


def reconciled(before: DataFrame, after: DataFrame, lost: DataFrame, table: str = "silver_orders_enriched") -> DataFrame:
    """One row of the quality report: by how many rows ``before`` less the lost ones differs from ``after``."""
    sizes = before.select(F.lit(1).alias("n")).union(after.select(F.lit(-1))).union(lost.select(-F.col("lost")))
    rows = sizes.agg(F.abs(F.coalesce(F.sum("n"), F.lit(0))).cast("bigint").alias("failures"))
    rows = rows.select(F.lit(table).alias("table"), F.lit("order_id").alias("column"), F.lit("reconciled").alias("test"), "failures")
    return rows.withColumn("passed", F.col("failures") == 0)


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(table, column, test, failures, passed), one row per check."""
    parts = []
    for name in dict.fromkeys(c.table for c in checks):
        row_level = [c for c in checks if c.table == name and c.test != "unique"]
        if row_level:
            parts.append(_row_checks(tables[name], row_level))
    parts += [_unique_check(tables[c.table], c) for c in checks if c.test == "unique"]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)
