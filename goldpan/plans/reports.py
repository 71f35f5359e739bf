"""Everything computed from one gold state table: the dashboard datasets and the answers to the fixed questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from goldpan.operators import dashboard, questions

GoldJob = Callable[[DataFrame], DataFrame]

DASHBOARD: dict[str, GoldJob] = {
    "gold_display": dashboard.display,
    "dashboard_kpis": dashboard.dashboard_kpis,
    "top_states": dashboard.top_states,
    "scatter": dashboard.scatter,
    "class_profile": dashboard.class_profile,
    "region_late": dashboard.region_late,
}

ANSWERS: dict[str, GoldJob] = {
    "q_region_late": questions.region_with_highest_late_rate,
    "q_class_installments": questions.instalments_by_class,
    "q_gdp_satisfaction": questions.gdp_and_satisfaction,
    "q_top_delivery": questions.top_delivery_states,
    "q_ticket_by_class": questions.ticket_by_class,
    "q_top_ticket": questions.state_with_highest_ticket,
}


def report(gold: DataFrame) -> dict[str, DataFrame]:
    """All datasets and answers of one gold table. Pass the stored table: each dataset reads its one row per state."""
    return {name: job(gold) for name, job in {**DASHBOARD, **ANSWERS}.items()}
