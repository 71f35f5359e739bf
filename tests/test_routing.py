"""Routing truth table: complexity, provider set and override."""

from __future__ import annotations

from itertools import product

import pytest

from goldpan import catalog as cat
from goldpan.operators import question_log as ql

PROVIDERS = ("groq", "anthropic", "openai", "gemini")
WORDS = {"simple": 3, "medium": 50, "complex": 100}
OVERRIDES = [None, "GPT-4o Mini", "Gemini 1.5 Pro", "Mistral Saba 24B (Gratis)", "Claude Sonnet 4.6", "no such model"]


def expected(level, have, override):
    for name, model, provider, _, _ in cat.MODELS:
        if name == override and have[provider]:
            return model
    if have["groq"] and level == "simple":
        return "llama-3.1-8b-instant"
    if have["groq"] and level == "medium":
        return "llama-3.3-70b-versatile"
    for provider, model in (
        ("anthropic", "claude-sonnet-4-6"),
        ("openai", "gpt-4o"),
        ("gemini", "gemini-2.0-flash"),
        ("groq", "llama-3.3-70b-versatile"),
    ):
        if have[provider]:
            return model
    return None


@pytest.mark.parametrize("flags", list(product([False, True], repeat=4)))
def test_every_combination(spark, flags):
    have = dict(zip(PROVIDERS, flags))
    cases = list(product(WORDS, OVERRIDES))
    rows = [(i, "p " * WORDS[level], override) for i, (level, override) in enumerate(cases)]
    asked = spark.createDataFrame(rows, "id int, text string, override string")
    found = {r.id: (r.complexity, r.llm) for r in ql.route(asked, have, "override").collect()}
    assert found == {i: (level, expected(level, have, override)) for i, (level, override) in enumerate(cases)}


def test_without_override_column(spark):
    asked = spark.createDataFrame([(1, "qual região?")], "id int, text string")
    assert ql.route(asked, {"gemini": True}).first().llm == "gemini-2.0-flash"
    assert ql.route(asked, {}).first().llm is None


def test_prices_and_routes_agree_with_the_catalogue(spark):
    known = {model for _, model, _, _, _ in cat.MODELS}
    assert {r.llm for r in cat.price_table(spark).collect()} == known
    assert {model for _, _, model in cat.ROUTES} <= known
    assert set(cat.bench_models()) <= known
    assert len(cat.bench_models({"groq": True, "anthropic": True})) == 5
