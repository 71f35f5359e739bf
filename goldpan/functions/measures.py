"""Numeric columns: exact money in integer cents, guarded ratios, token cost."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldpan.catalog import FREE_LABEL


def cents(amount: Column) -> Column:
    """Money as whole cents; NaN is null. Integer sums are exact, stay in codegen and do not depend on row order."""
    return F.floor(F.nanvl(amount, F.lit(None).cast("double")) * F.lit(100.0) + F.lit(0.5))


def from_cents(amount: Column) -> Column:
    """Whole cents as ``decimal(20,2)``."""
    return (amount.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean_of(column: str) -> Column:
    """Unweighted mean that skips nulls and NaN, to six decimals."""
    return F.round(F.avg(F.nanvl(F.col(column), F.lit(None).cast("double"))), 6)


def cost_micros(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    """Run cost in whole millionths of a dollar; prices are dollars per million tokens, exact to six decimals.

    Unknown prices count as zero. Halves round up, once. Whole numbers add up exactly in any order.
    """

    def spent(tokens: Column, price: Column) -> Column:
        return tokens.cast("decimal(18,0)") * F.coalesce(price.cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))

    return F.round(spent(tokens_in, price_in) + spent(tokens_out, price_out), 0).cast("bigint")


def cost_label(micros: Column, free: str = FREE_LABEL) -> Column:
    """Cost in dollars to six decimals as text; runs that cost nothing are labelled free."""
    return F.when(micros > 0, F.format_string("$%.6f", micros / 1e6)).otherwise(free)
