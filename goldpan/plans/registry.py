"""Every job bound to the star-schema tables, by name. Each takes (spark, folder) and returns a lazy frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan import catalog as cat
from goldpan.operators import adhoc, benchmark, dashboard, gold, quality, question_log, questions, silver
from goldpan.plans import reports
from goldpan.plans.medallion import STAR_CHECKS, OrderModel, from_star_tables
from goldpan.session import work_dir
from goldpan.sources import star_tables as star
from goldpan.sources.publication import publish_version, version_folder
from goldpan.sources.snapshot import gold_or_snapshot, published_gold
from goldpan.sources.writers import write_layer

Query = Callable[[SparkSession, str], DataFrame]

PROVIDERS = {"groq": True, "anthropic": True, "openai": True, "gemini": False}
ADHOC_SQL = """
SELECT regiao, count(*) AS states, sum(total_pedidos) AS orders, max(ticket_medio) AS best_ticket
FROM gold_adhoc -- gold view
GROUP BY regiao HAVING count(*) > 1
ORDER BY orders DESC, regiao;
"""


def _model(spark: SparkSession, folder: str) -> OrderModel:
    return from_star_tables(star.bronze(spark, folder))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return silver.line_facts(star.order_lines(star.table(spark, folder, "lineitem")))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return star.table(spark, folder, "events")


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return star.model_runs(_events(spark, folder))


def _questions(spark: SparkSession, folder: str) -> DataFrame:
    return star.questions(star.table(spark, folder, "conversations"))


def _gold(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: job(_model(spark, folder).gold_state())


def _totals(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: job(_model(spark, folder).state_totals())


def bronze_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(table, rows): size of every bronze table, read from file footers."""
    counts = [
        star.table(spark, folder, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name in star.ORDER_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def gdp_seed(spark: SparkSession, folder: str) -> DataFrame:
    states = star.states(star.table(spark, folder, "nation"), star.table(spark, folder, "region"))
    return states.select("state", "region", "gdp", "income_class")


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _model(spark, folder).enriched()


def _gold_scan(spark: SparkSession, folder: str) -> DataFrame:
    _model(spark, folder).gold_state().createOrReplaceTempView("gold_live")
    return dashboard.gold_scan(spark, "gold_live")


def _gold_with_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return gold_or_snapshot(spark, "gold_state_unpublished", _model(spark, folder).gold_state())


def _gold_published(spark: SparkSession, folder: str) -> DataFrame:
    """Gold written as a version, published, and read back through its manifest: the live branch."""
    root, gold_rows = work_dir(spark, "publication", uuid.uuid4().hex), _model(spark, folder).gold_state()
    version = version_folder(root)
    publish_version(spark, root, version, {"gold_state": write_layer(gold_rows, f"{version}/gold_state")})
    return published_gold(spark, root, gold_rows.limit(0))


def _dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of the raw tables, and the orders lost between delivered and enriched silver."""
    tables = star.bronze(spark, folder)
    return quality.run_checks(tables, STAR_CHECKS).unionByName(quality.lost_checks(from_star_tables(tables).lost_orders()))


def _guardrail(spark: SparkSession, folder: str) -> DataFrame:
    return question_log.guardrail(star.table(spark, folder, "documents"), id_col="doc_id")


def _prompts(spark: SparkSession, folder: str) -> DataFrame:
    return question_log.prompts(_questions(spark, folder), question_log.schema_text())


def _question_plan(spark: SparkSession, folder: str) -> DataFrame:
    asked = star.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return question_log.question_plan(asked, PROVIDERS, question_log.schema_text())


def _interpretation(n: int) -> Query:
    """The question of the user's first run with the events of that user as its result rows."""

    def job(spark: SparkSession, folder: str) -> DataFrame:
        events = _events(spark, folder)
        asked = _runs(spark, folder).join(events.select(F.col("event_id").alias("run_id"), "user_id"), "run_id")
        asked = asked.groupBy(F.col("user_id").alias("id")).agg(F.min_by("question", "run_id").alias("text"))
        return question_log.interpretation_prompts(asked, star.query_results(events), n)

    return job


def _clean_sql(spark: SparkSession, folder: str) -> DataFrame:
    fenced = F.concat(F.lit(" ```sql\nSELECT '"), F.col("text"), F.lit("'\n```\n\t"))
    return question_log.clean_sql(_questions(spark, folder).withColumn("generated", fenced))


def _adhoc(spark: SparkSession, folder: str) -> DataFrame:
    _model(spark, folder).gold_state().createOrReplaceTempView("gold_adhoc")
    return adhoc.run_select(spark, ADHOC_SQL, adhoc.AGENT_ROWS)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    results = star.run_rows(star.table(spark, folder, "lineitem"))
    return question_log.answer_records(_runs(spark, folder), cat.price_table(spark), results, adhoc.PREVIEW_ROWS)


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    models = cat.bench_models()
    return benchmark.answer_matrix(_runs(spark, folder), cat.price_table(spark), cat.BENCH_QUESTIONS, models)


def _region_late(spark: SparkSession, folder: str) -> DataFrame:
    totals = _model(spark, folder).state_totals()
    return questions.region_with_highest_late_rate(gold.gold_state(totals), totals)


def _bounded(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.bounded(silver.payments_per_order(_lines(spark, folder)), adhoc.AGENT_ROWS, F.desc("paid"), "order_id")


def queries() -> dict[str, Query]:
    """All registered jobs."""
    price = cat.price_table
    return {
        "bronze_counts": bronze_counts,
        "gdp_seed": gdp_seed,
        "silver_delivered": lambda s, d: _model(s, d).delivered(),
        "silver_items": lambda s, d: silver.items_per_order(_lines(s, d)),
        "silver_payments": lambda s, d: silver.payments_per_order(_lines(s, d)),
        "silver_reviews": lambda s, d: silver.review_scores(star.reviews(_events(s, d)), "customer_id"),
        "silver_orders_enriched": _enriched,
        "gold_state": _totals(gold.gold_state),
        "gold_state_from_silver": lambda s, d: gold.gold_state(gold.state_totals(_model(s, d).enriched())),
        "gold_class": _totals(gold.gold_class),
        "gold_kpis": _totals(gold.gold_kpis),
        "gold_scan": _gold_scan,
        "gold_with_fallback": _gold_with_fallback,
        "gold_published": _gold_published,
        **{name: _gold(job) for name, job in {**reports.DASHBOARD, **reports.ANSWERS}.items()},
        "q_region_late": _region_late,
        "dq_report": _dq_report,
        "guardrail": _guardrail,
        "complexity": lambda s, d: question_log.complexity(_questions(s, d)),
        "routing": lambda s, d: question_log.route(_questions(s, d), PROVIDERS, "override"),
        "prompt_table": _prompts,
        "question_plan": _question_plan,
        "interpretation_prompts": _interpretation(adhoc.AGENT_ROWS),
        "interpretation_prompts_bench": _interpretation(adhoc.BENCH_ROWS),
        "grounding_table": lambda s, d: question_log.grounding(star.query_results(_events(s, d)), adhoc.AGENT_ROWS),
        "sql_clean": _clean_sql,
        "adhoc_sql": _adhoc,
        "bounded_result": _bounded,
        "answer_status": lambda s, d: question_log.answer_status(_runs(s, d)),
        "run_cost": lambda s, d: question_log.run_cost(_runs(s, d), price(s)),
        "answer_records": _records,
        "run_log": lambda s, d: question_log.log_rows(_runs(s, d), price(s)),
        "chat_latest": lambda s, d: question_log.newest_first(star.table(s, d, "conversations")),
        "benchmark_grid": lambda s, d: benchmark.grid(cat.BENCH_QUESTIONS, cat.bench_models(), _runs(s, d)),
        "benchmark_runs": lambda s, d: benchmark.bench_runs(_runs(s, d), price(s)),
        "benchmark_by_model": lambda s, d: benchmark.by_model(_runs(s, d), price(s)),
        "benchmark_answers": _answers,
        "benchmark_cells": lambda s, d: benchmark.cells(_runs(s, d), price(s), cat.BENCH_QUESTIONS, cat.bench_models()),
    }
