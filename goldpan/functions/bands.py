"""Classification rules: income class, delay severity, question complexity, model family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldpan.catalog import INCOME_CLASSES, LATE_DANGER, LATE_WARN, MEDIUM_WORDS, SIMPLE_WORDS


def income_class(gdp: Column) -> Column:
    """Income class of a state from its GDP per head; null GDP has no class."""
    rule = F.when(gdp.isNull(), F.lit(None))
    for name, lowest in reversed(INCOME_CLASSES):
        rule = rule.otherwise(name) if lowest is None else rule.when(gdp >= lowest, name)
    return rule


def class_band(name: Column) -> Column:
    """Legend entry for a class: unknown classes share the lowest band."""
    return F.when(name.isin("Rico", "Médio"), name).otherwise("Baixa Renda")


def late_severity(rate: Column) -> Column:
    """danger, warn or success, by percent late; both limits are strict."""
    return F.when(rate > LATE_DANGER, "danger").when(rate > LATE_WARN, "warn").when(rate.isNotNull(), "success")


def complexity(words: Column) -> Column:
    """simple, medium or complex, by number of words."""
    return F.when(words <= SIMPLE_WORDS, "simple").when(words <= MEDIUM_WORDS, "medium").otherwise("complex")


def model_family(llm: Column) -> Column:
    """Vendor family named inside a model id."""
    rule = F.when(llm.contains("claude"), "claude")
    for family in ("gpt", "mistral", "qwen"):
        rule = rule.when(llm.contains(family), family)
    return rule.otherwise("other")
