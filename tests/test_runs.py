"""Run outcomes, cost, log and benchmark over small run tables."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal, ROUND_HALF_UP

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from goldpan import catalog as cat
from goldpan.functions.measures import cost_micros
from goldpan.operators import benchmark as bm
from goldpan.operators import question_log as ql
from goldpan.sources import star_tables as star
from goldpan.sources.writers import append_run_log, new_log_rows, read_run_log
from goldpan.streaming.run_log_stream import _checkpoint_for, append_runs, read_runs

SCHEMA = (
    "run_id bigint, started timestamp_ntz, question string, llm string, ok boolean, blocked_message string, "
    "generation_error string, generated string, row_count bigint, answer string, first_row string, sql_error string, attempts int, "
    "tokens_in bigint, tokens_out bigint, tokens_out_2 bigint, latency_ms bigint"
)
START = dt.datetime(2024, 3, 1, 12, 0, 0, 500000)


def run(run_id, **changes):
    row = {
        "run_id": run_id, "started": START, "question": "Qual região?", "llm": "gpt-4o", "ok": True,
        "blocked_message": None, "generation_error": None, "generated": "```sql\nSELECT 1\n```", "row_count": 3, "answer": " SP lidera\n",
        "first_row": "{'a': 1}", "sql_error": "", "attempts": 1, "tokens_in": None, "tokens_out": None,
        "tokens_out_2": None, "latency_ms": 900,
    }
    return tuple((row | changes).values())


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [
            run(0),
            run(1, answer=None),
            run(2, row_count=0, sql_error="e" * 90),
            run(3, row_count=0, sql_error=None),
            run(4, blocked_message=cat.TOO_SHORT_MESSAGE, llm=None),
            run(5, llm=None),
            run(6, generation_error="x" * 300, ok=False),
            run(7, llm="mystery", tokens_in=10, tokens_out=20, tokens_out_2=30),
            run(8, llm="claude-sonnet-4-6", tokens_in=1234, tokens_out=567, tokens_out_2=89),
        ],
        SCHEMA,
    )


def by_id(frame, key="id"):
    return {r[key]: r for r in frame.collect()}


def test_outcomes(runs):
    found = {k: (r.status, r.message) for k, r in by_id(ql.answer_status(runs)).items()}
    assert found == {
        0: ("answered", "SP lidera"),
        1: ("interpretation_failed", "{'a': 1}"),
        2: ("no_rows", cat.NO_ROWS_MESSAGE + " Erro: " + "e" * 60),
        3: ("no_rows", cat.NO_ROWS_MESSAGE),
        4: ("blocked", cat.TOO_SHORT_MESSAGE),
        5: ("no_model", cat.NO_MODEL_MESSAGE),
        6: ("error", ("Erro LLM: " + "x" * 300)[:200]),
        7: ("answered", "SP lidera"),
        8: ("answered", "SP lidera"),
    }


def test_records_have_one_shape(spark, runs):
    rows = [(0, p, p * p) for p in range(9)] + [(7, 1, 1)]
    results = spark.createDataFrame(rows, "id bigint, position int, v int")
    found = by_id(ql.answer_records(runs, cat.price_table(spark), results, 2), "run_id")
    assert found.keys() == set(range(9))
    assert found[0].resultado == '[{"position":0,"v":0},{"position":1,"v":1}]'
    assert (found[0].sql_gerado, found[0].custo_usd, found[0].guardrail, found[0].erro) == ("SELECT 1", 0.00255, False, None)
    assert (found[4].guardrail, found[4].resposta, found[4].llm, found[4].sql_gerado) == (
        True, cat.TOO_SHORT_MESSAGE, None, None,
    )
    assert (found[5].llm, found[5].resposta, found[5].tokens_input) == (None, cat.NO_MODEL_MESSAGE, None)
    assert found[6].erro == "Erro LLM: " + "x" * 300 and found[6].resposta is None
    assert (found[0].custo_rotulo, found[7].custo_rotulo, found[4].custo_rotulo) == ("$0.002550", "Gratuito", None)
    assert found[2].resultado is None and found[8].resultado is None


def test_token_defaults_and_cost(spark, runs):
    found = {
        k: (r.tokens_in, r.tokens_out, r.cost_usd)
        for k, r in by_id(ql.run_cost(runs, cat.price_table(spark)), "run_id").items()
    }
    assert found[0] == (300, 180, 0.00255)
    assert found[1][:2] == (300, 150)
    assert found[2][:2] == found[3][:2] == (300, 120)
    assert found[4] == found[5] == found[6] == (0, 0, 0.0)
    assert found[7] == (10, 50, 0.0)
    assert found[8] == (1234, 656, 0.013542)


def test_cost_rounds_half_up_exactly(spark):
    prices = [("a", Decimal("0.15"), Decimal("0.60")), ("b", Decimal("1.25"), Decimal("5.00"))]
    table = cat.lookup(spark, prices, "llm string, price_in decimal(6,2), price_out decimal(6,2)")
    rows = [run(i, llm="ab"[i % 2], tokens_in=i, tokens_out=0, tokens_out_2=0) for i in range(200)]
    found = by_id(ql.run_cost(spark.createDataFrame(rows, SCHEMA), table), "run_id")
    for i in range(200):
        exact = (prices[i % 2][1] * i).quantize(Decimal(1), ROUND_HALF_UP)
        assert found[i].cost_usd == float(exact) / 1e6


def test_log_holds_runs_that_reached_a_model(spark, runs):
    rows = ql.log_rows(runs, cat.price_table(spark)).collect()
    assert len(rows) == 6
    first = next(r for r in rows if r.run_name.startswith("claude"))
    assert first.run_name == f"claude-sonnet-4-6_{int(START.replace(tzinfo=dt.timezone.utc).timestamp())}"
    assert (first.complexity, first.attempts, first.gold_table, first.dt) == ("simple", 1, "gold_state", START.date())


def test_log_is_appended_by_date(spark, runs, tmp_path):
    rows = ql.log_rows(runs, cat.price_table(spark))
    path = str(tmp_path / "log")
    append_run_log(rows, path)
    append_run_log(rows, path)
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    stored = read_run_log(spark, path, schema)
    assert stored.count() == 6  # the second time, all rows are there
    assert (tmp_path / "log" / "dt=2024-03-01").is_dir()
    plan = stored.filter("dt = date'2024-03-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_log_append_can_be_repeated(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "run_id long, v string, dt date"
    days = [dt.date(2024, 3, d) for d in (1, 2, 3)]
    first = spark.createDataFrame([(i, "a", days[i % 3]) for i in range(30)], schema)
    append_run_log(first, path)
    held = spark.read.schema(schema).parquet(path)
    again = new_log_rows(first.where("day(dt) = 2"), held)
    assert again.isEmpty()
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # only folders of dates that the new rows have are read
    # half of the rows are new; a run of another date is another row, and a row given twice counts once
    more = spark.createDataFrame([(i, "b", days[i % 3]) for i in range(15, 45)] + [(0, "c", days[1]), (0, "c", days[1])], schema)
    append_run_log(more, path)
    append_run_log(more, path)
    rows = spark.read.schema(schema).parquet(path).collect()
    assert len(rows) == 46 and sum(r.v == "a" for r in rows) == 30
    append_run_log(more, path, key=None)
    assert spark.read.schema(schema).parquet(path).count() == 78


def test_stream_logs_each_run_once(spark, folder, tmp_path):
    runs = star.model_runs(star.table(spark, folder, "events"))
    landing, log, marks = (str(tmp_path / n) for n in ("landing", "log", "marks"))
    schema = ", ".join(f"{n} {t}" for n, t in runs.dtypes)
    expected = ql.log_rows(runs, cat.price_table(spark))
    for half in (0, 1):
        runs.filter(f"run_id % 2 = {half}").coalesce(2).write.mode("append").parquet(landing)
        append_runs(read_runs(spark, landing, schema), log, marks).awaitTermination()
    append_runs(read_runs(spark, landing, schema), log, marks).awaitTermination()
    stored = spark.read.parquet(log).select(*expected.columns)
    assert stored.count() == expected.count()
    assert stored.exceptAll(expected).isEmpty()


def test_every_log_has_its_own_shared_checkpoint(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _checkpoint_for(spark, "/logs/a")
    else:
        first, second = (_checkpoint_for(spark, p) for p in ("/logs/a", "/logs/b"))
        assert first != _checkpoint_for(spark, "/logs/a", "/runs/b")
        assert first != second and first.startswith(root.rstrip("/") + "/run_log_stream/")


def test_benchmark_totals(spark, runs):
    prices = cat.price_table(spark)
    table = {r.run_id: r for r in bm.bench_runs(runs.filter("llm is not null"), prices).collect()}
    assert (table[6].ok, table[6].latency_ms, table[6].cost_usd) == (False, 0, 0.0)
    assert table[6].answer == "Erro: " + "x" * 80
    assert table[0].cost_usd == 0.00175 and table[0].answer == "SP lidera"
    found = by_id(bm.by_model(runs.filter("llm is not null"), prices), "llm")
    gpt = found["gpt-4o"]
    assert (gpt.family, gpt.run_count, gpt.ok_count, gpt.latency_sum, gpt.avg_latency_ok) == ("gpt", 5, 4, 3600, 900.0)
    assert (gpt.price_label, gpt.cost_sum) == ("$2.5/1M", 0.007)
    assert (found["mystery"].cost_sum, found["mystery"].price_label, found["mystery"].family) == (0.0, "-", "other")


def test_model_with_only_failures_has_no_latency(spark):
    only = spark.createDataFrame([run(1, ok=False, generation_error="e")], SCHEMA)
    row = bm.by_model(only, cat.price_table(spark)).first()
    assert (row.latency_sum, row.ok_count, row.avg_latency_ok) == (0, 0, None)


def test_grid_counts_missing_pairs(spark, runs):
    rows = bm.grid(["Qual região?", "Outra?"], ["gpt-4o", "qwen-qwq-32b"], runs).collect()
    assert {(r.question, r.llm): r.runs for r in rows} == {
        ("Qual região?", "gpt-4o"): 5,
        ("Qual região?", "qwen-qwq-32b"): 0,
        ("Outra?", "gpt-4o"): 0,
        ("Outra?", "qwen-qwq-32b"): 0,
    }


def test_answers_keep_the_first_run(spark):
    rows = [run(9, answer="late"), run(2, answer="a" * 300), run(5, llm="gpt-4o-mini", answer="mini")]
    rows += [run(1, question="not in the benchmark"), run(0, llm="mystery")]
    table = spark.createDataFrame(rows, SCHEMA)
    [row] = bm.answer_matrix(table, cat.price_table(spark), ["Qual região?"], cat.bench_models()).collect()
    assert row["gpt-4o"] == "a" * 180 and row["gpt-4o-mini"] == "mini" and row["qwen-qwq-32b"] is None


def test_cells_show_the_first_run(spark):
    rows = [run(9, answer="late"), run(2, answer="a" * 300), run(5, llm="qwen-qwq-32b", answer=None), run(4, llm="gpt-4o-mini", ok=False, generation_error="e" * 99)]
    rows += [run(1, question="not in the benchmark"), run(0, llm="mystery")]
    table = spark.createDataFrame(rows, SCHEMA)
    found = {r.llm: r for r in bm.cells(table, cat.price_table(spark), ["Qual região?"], cat.bench_models()).collect()}
    assert set(found) == {"gpt-4o", "gpt-4o-mini", "qwen-qwq-32b"}
    first, free, failed = found["gpt-4o"], found["qwen-qwq-32b"], found["gpt-4o-mini"]
    assert first.answer == "a" * 180 and first.cost_label == f"${first.cost_usd:.6f}" and first.price_label == "$2.5/1M"
    assert (free.answer, free.cost_usd, free.cost_label, free.price_label) == ("", 0.0, "Gratis", "Gratuito")
    assert (failed.ok, failed.answer, failed.sql, failed.latency_ms, failed.cost_label) == (False, "Erro: " + "e" * 80, "", 0, "Gratis")
    assert bm.cells(table.limit(0), cat.price_table(spark), ["Qual região?"], cat.bench_models()).collect() == []


def test_chat_positions_match_brute_force(spark):
    chat = [(c, t, "user", f"{c}/{t}") for c, turns in ((1, range(1000)), (2, [3]), (3, [5, 90, 7, 250])) for t in turns]
    frame = spark.createDataFrame(chat, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    expected = set()
    for conv in (1, 2, 3):
        turns = sorted((t for c, t, _, _ in chat if c == conv), reverse=True)
        expected |= {(conv, i + 1, t, "user", f"{conv}/{t}") for i, t in enumerate(turns)}
    for width in (7, 100, 10_000):
        assert {tuple(r) for r in ql.newest_first(frame, width).collect()} == expected


def test_large_chat_is_ranked_in_even_stretches(spark):
    # turns are times that lie very unevenly, many are equal, and one conversation holds a third of all messages
    turn = F.timestamp_seconds((F.col("id") * F.col("id") % 1009) * (F.col("id") % 7) * (F.col("id") % 7) * 977)
    chat = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).alias("conv_id"), turn.alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"),
    )
    found = ql.newest_first(chat, width=1_000)
    order = Window.partitionBy("conv_id").orderBy(F.desc("turn"), "role", "text")
    plain = chat.withColumn("position", F.row_number().over(order).cast("bigint")).select(found.columns)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    spread = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).alias("conv_id"), (F.col("id") * F.col("id")).alias("turn"), F.lit("r").alias("role"), F.lit("t").alias("text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in ql.newest_first(spread, width=250).groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_grounding_keeps_the_first_rows_of_a_big_group(spark):
    frame = spark.range(50_000).selectExpr("if(id < 40000, 1, id % 9 + 2) AS id", "id AS position", "id * 2 AS v")
    found = {r.id: r.rows_json for r in ql.grounding(frame, 3).collect()}
    assert found[1] == '[{"position":0,"v":0},{"position":1,"v":2},{"position":2,"v":4}]'
    assert len(found) == 10


def test_messages_without_turn_or_conversation_are_kept(spark):
    rows = [(1, 5, "user", "a"), (1, None, "user", "b"), (None, 3, "user", "c"), (1, 7, "user", "d"), (None, None, "user", "e")]
    chat = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.position, r.text) for r in ql.newest_first(chat, width=2).collect()}
    assert found == {(1, 1, "d"), (1, 2, "a"), (1, 3, "b"), (None, 1, "c"), (None, 2, "e")}


def test_fine_prices_are_exact(spark):
    cost = cost_micros(F.col("i"), F.col("o"), F.col("p"), F.col("q"))
    row = spark.sql("SELECT 1000000L i, 10L o, 0.075 p, CAST(NULL AS decimal(6,3)) q").select(cost.alias("c")).first()
    assert row.c == 75_000


def test_many_first_rows_are_right_and_cut_before_their_shuffle(spark):
    # one question has most rows, one none to cut, one no id; positions repeat, and some are missing
    frame = spark.range(150_000).selectExpr(
        "if(id % 10 < 7, 1, if(id % 10 = 7, 2, if(id % 10 = 8, NULL, id % 900 + 3))) AS id",
        "if(id % 50001 = 0, NULL, (id * 7919) % 120000) AS position", "id AS v",
    )
    n = 5_000
    plain = {}
    for row in frame.collect():
        plain.setdefault(row.id, []).append(((row.position is not None, row.position or 0, row.v), row))
    wanted = {k: [r.v for _, r in sorted(rows, key=lambda x: x[0])[:n]] for k, rows in plain.items()}
    assert {r.id: [x["v"] for x in json.loads(r.rows_json)] for r in ql.grounding(frame, n).collect()} == wanted
    left = {r.id: r["count"] for r in ql._up_to_cut(frame, n, "id").groupBy("id").count().collect()}
    assert n <= left[1] <= len(plain[1]) // 4 + 100 and left[2] == len(plain[2])
    plan = ql.grounding(frame, n)._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile_approx" in plan and "CartesianProduct" not in plan


def test_many_first_rows_of_few_rows_and_none(spark):
    rows = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (None, 1, 4)], "id long, position int, part int")
    found = {r.id: r.rows_json for r in ql.grounding(rows, 5_000).collect()}
    assert found == {1: '[{"position":1,"part":2},{"position":2,"part":3}]', None: '[{"position":1,"part":4}]'}
    assert ql.grounding(rows.limit(0), 5_000).collect() == []
