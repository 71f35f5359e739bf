"""Benchmark jobs over a table of model runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan import catalog as cat
from goldpan.functions import text as tx
from goldpan.functions.bands import model_family
from goldpan.functions.measures import cost_label, cost_micros, ratio

#: Cost of a benchmark cell that costs nothing.
CELL_FREE = "Gratis"


def grid(questions: list[str], models: list[str], runs: DataFrame) -> DataFrame:
    """(question, llm, runs): every benchmark question with every available model and the number of its runs, zero
    included. The pairs come from unfolding two constant lists, not from joining tables."""
    pairs = cat.lookup(runs.sparkSession, [(q,) for q in questions], "question string").select(
        "question", F.explode(F.array(*[F.lit(m) for m in models])).alias("llm")
    )
    counts = runs.groupBy("question", "llm").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(counts, ["question", "llm"], "left").select(
        "question", "llm", F.coalesce("n", F.lit(0)).cast("bigint").alias("runs")
    )


def _with_outcome(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """Latency, cost, answer and SQL of each run. A failed run counts zero latency and cost and shows its error, cut to 80
    characters. Only the tokens of the first prompt are charged, with defaults where a run reports none; a failed run has empty SQL."""
    ok = F.col("ok")
    spent = cost_micros(
        F.coalesce("tokens_in", F.lit(cat.DEFAULT_TOKENS_IN)),
        F.coalesce("tokens_out", F.lit(cat.DEFAULT_TOKENS_OUT)),
        F.col("price_in"),
        F.col("price_out"),
    )
    error = F.concat(F.lit("Erro: "), tx.prefix(F.coalesce("generation_error", F.lit("")), 80))
    zero = F.lit(0).cast("bigint")
    return runs.join(prices, "llm", "left").select(
        "run_id",
        "question",
        "llm",
        "ok",
        F.when(ok, F.col("latency_ms")).otherwise(zero).alias("latency_ms"),
        F.when(ok, spent).otherwise(zero).alias("cost_micros"),
        F.when(ok, tx.strip(F.coalesce("answer", F.lit("")))).otherwise(error).alias("answer"),
        F.when(ok, tx.strip_fences(F.coalesce("generated", F.lit("")))).otherwise("").alias("sql"),
    )


def bench_runs(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """(run_id, question, llm, ok, latency_ms, cost_usd, answer) per run, cost to six decimals."""
    outcome = _with_outcome(runs, prices)
    return outcome.select(
        "run_id", "question", "llm", "ok", "latency_ms", (F.col("cost_micros") / 1e6).alias("cost_usd"), "answer"
    )


def _price_label(llm: Column) -> Column:
    """Price of a benchmark model as text, a dash for other models."""
    label = F.lit("-")
    for model, _, text in reversed(cat.BENCH_MODELS):
        label = F.when(llm == model, text).otherwise(label)
    return label


def by_model(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """Totals per model. Costs are rounded per run and then summed, in whole millionths. Failed runs add nothing to
    ``latency_sum``, so ``avg_latency_ok`` divides by the runs that succeeded."""
    totals = (
        _with_outcome(runs, prices)
        .groupBy("llm")
        .agg(
            F.sum("latency_ms").alias("latency_sum"),
            F.sum("cost_micros").alias("cost_micros"),
            F.count_if("ok").alias("ok_count"),
            F.count(F.lit(1)).alias("run_count"),
        )
    )
    return totals.select(
        "llm",
        model_family(F.col("llm")).alias("family"),
        "latency_sum",
        (F.col("cost_micros") / 1e6).alias("cost_sum"),
        "ok_count",
        "run_count",
        _price_label(F.col("llm")).alias("price_label"),
        F.round(ratio(F.col("latency_sum"), F.col("ok_count")), 4).alias("avg_latency_ok"),
    )


def answer_matrix(runs: DataFrame, prices: DataFrame, questions: list[str], models: list[str]) -> DataFrame:
    """One row per benchmark question with one column per model: the answer of its first run, cut to 180 characters."""
    answers = _first_outcomes(runs, prices, questions, models)
    return answers.groupBy("question").pivot("llm", models).agg(F.min_by("answer", "run_id"))


def cells(runs: DataFrame, prices: DataFrame, questions: list[str], models: list[str]) -> DataFrame:
    """(question, llm, ok, answer, sql, latency_ms, cost_usd, cost_label, price_label): what a benchmark shows for a question and a model.

    Each is the first run of the pair; pairs without runs have no row. A failed run shows its error at no latency and no cost.
    """
    micros = F.col("cost_micros")
    shown = {"cost_usd": micros / 1e6, "cost_label": cost_label(micros, CELL_FREE), "price_label": _price_label(F.col("llm"))}
    first = _first_outcomes(runs, prices, questions, models)
    return first.select("question", "llm", "ok", "answer", "sql", "latency_ms", *[c.alias(name) for name, c in shown.items()])


def _first_outcomes(runs: DataFrame, prices: DataFrame, questions: list[str], models: list[str]) -> DataFrame:
    """The outcome of the first run of each benchmark question with each model, its answer cut to 180 characters.

    The first run of each pair is found by number alone, which hashes; keeping the answer text in the aggregate would
    sort all runs. Only the first runs are then read in full. There is at most one per question and model of the two
    given lists, so the hint is safe.
    """
    wanted = runs.filter(F.col("question").isin(questions) & F.col("llm").isin(models))
    first = wanted.groupBy("question", "llm").agg(F.min("run_id").alias("run_id"))
    kept = wanted.join(F.broadcast(first), ["question", "llm", "run_id"], "left_semi")
    return _with_outcome(kept, prices).withColumn("answer", tx.prefix(F.col("answer"), 180))
