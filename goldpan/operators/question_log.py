"""Question-log jobs: screening, complexity, model choice, prompts, generated SQL, outcomes, cost and run log.

Most are column expressions over a table of questions or runs. Joins are with constant lookup tables, or between tables
already reduced to one row per run or stretch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan import catalog as cat
from goldpan.functions import text as tx
from goldpan.functions.bands import complexity as complexity_of
from goldpan.functions.measures import cost_label, cost_micros


# Outcomes of runs that called a model and ran its SQL.
RAN = ("answered", "interpretation_failed", "no_rows")

# Screening and routing


def with_screening(questions: DataFrame, text_col: str = "text") -> DataFrame:
    """Add reason, blocked and message. The first failed test gives the reason: sensitive word, DDL word, fewer than
    two words. Null text is too short. The whole text is searched.

    The lower-case text is bound as a lambda variable, so it is computed once even where the planner pushes a filter
    on the reason below this projection and would repeat the expression for every word.
    """
    text = F.col(text_col)

    def first_failure(lowered: Column) -> Column:
        return (
            F.when(tx.mentions_word(lowered, cat.SENSITIVE_WORDS), "sensitive")
            .when(tx.mentions_word(lowered, cat.DDL_WORDS), "ddl")
            .when(~tx.has_two_words(text), "too_short")
        )

    message = F.when(F.col("reason") == "too_short", cat.TOO_SHORT_MESSAGE).when(
        F.col("reason").isNotNull(), cat.BLOCKED_MESSAGE
    )
    return questions.withColumn("reason", F.transform(F.array(F.lower(text)), first_failure)[0]).withColumns(
        {"blocked": F.col("reason").isNotNull(), "message": message}
    )


def guardrail(questions: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """(id, blocked, reason, message) per question."""
    screened = with_screening(questions, text_col)
    return screened.select(F.col(id_col).alias("id"), "blocked", "reason", "message")


def complexity(questions: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """(id, words, complexity) per question."""
    counted = questions.select(F.col(id_col).alias("id"), tx.word_count(F.col(text_col)).alias("words"))
    return counted.withColumn("complexity", complexity_of(F.col("words")))


def with_complexity(questions: DataFrame, text_col: str = "text") -> DataFrame:
    """Add complexity. The word count is a column of its own, so the planner counts once for both limits."""
    counted = questions.withColumn("_words", tx.word_count(F.col(text_col)))
    return counted.withColumn("complexity", complexity_of(F.col("_words"))).drop("_words")


def _automatic_model(level: Column, providers: dict[str, bool]) -> Column:
    """The first route whose provider has a key and whose complexity fits; null if there is none."""
    choices = [
        F.lit(model) if needed is None else F.when(level == needed, model)
        for needed, provider, model in cat.ROUTES
        if providers.get(provider)
    ]
    return F.coalesce(*choices) if choices else F.lit(None).cast("string")


def route(
    questions: DataFrame,
    providers: dict[str, bool],
    override_col: str | None = None,
    text_col: str = "text",
    id_col: str = "id",
) -> DataFrame:
    """(id, complexity, llm) per question.

    A known override whose provider has a key wins; otherwise the model follows from the complexity and the
    providers with a key.
    """
    chosen = with_complexity(questions, text_col)
    automatic = _automatic_model(F.col("complexity"), providers)
    picks = cat.override_table(questions.sparkSession, providers) if override_col else None
    if picks is None:
        return chosen.select(F.col(id_col).alias("id"), "complexity", automatic.alias("llm"))
    chosen = chosen.join(picks.withColumnRenamed("override", "_pick"), F.col(override_col) == F.col("_pick"), "left")
    llm = F.coalesce(F.col("override_llm"), automatic)
    return chosen.select(F.col(id_col).alias("id"), "complexity", llm.alias("llm"))


# Prompts and generated SQL


def schema_text(columns: Sequence[str] = cat.GOLD_COLUMNS, table: str = cat.GOLD_TABLE) -> str:
    """Description of the gold table put in front of every question."""
    return f"Tabela {table}: {', '.join(columns)}. Apenas SELECT em Spark SQL, sempre com LIMIT."


def prompts(questions: DataFrame, schema: str, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """(id, prompt) for the questions that pass the screening, ready for offline inference."""
    allowed = with_screening(questions, text_col).filter(~F.col("blocked"))
    prompt = F.concat(F.lit(f"Responda só com SQL.\n{schema}\nPergunta: "), F.col(text_col), F.lit("\nSQL:"))
    return allowed.select(F.col(id_col).alias("id"), prompt.alias("prompt"))


def question_plan(
    questions: DataFrame, providers: dict[str, bool], schema: str, text_col: str = "text", id_col: str = "id"
) -> DataFrame:
    """(id, blocked, reason, words, complexity, llm, prompt): screening, complexity, model and prompt in one scan.

    A blocked question has no model and no prompt, and neither has an allowed one without a provider to ask.
    """
    planned = with_screening(questions, text_col).withColumn("words", tx.word_count(F.col(text_col)))
    planned = planned.withColumn("complexity", complexity_of(F.col("words")))
    planned = planned.withColumn("llm", F.when(~F.col("blocked"), _automatic_model(F.col("complexity"), providers)))
    prompt = F.concat(F.lit(f"Responda só com SQL.\n{schema}\nPergunta: "), F.col(text_col), F.lit("\nSQL:"))
    prompt = F.when(F.col("llm").isNotNull(), prompt)
    return planned.select(F.col(id_col).alias("id"), "blocked", "reason", "words", "complexity", "llm", prompt.alias("prompt"))


def interpretation_prompts(asked: DataFrame, results: DataFrame, n: int = 20) -> DataFrame:
    """(id, prompt): each question of ``asked`` (id, text) and its first ``n`` result rows, to be put into words.

    Questions without result rows have no prompt. Rows of other questions are dropped before they are ranked.
    """
    rows = grounding(results.join(asked.select("id"), "id", "left_semi"), n)
    prompt = F.concat(F.lit("Pergunta: "), F.col("text"), F.lit("\nDados: "), F.col("rows_json"), F.lit("\nResposta:"))
    return asked.join(rows, "id").select("id", prompt.alias("prompt"))


def grounding(results: DataFrame, n: int = 20, id_col: str = "id") -> DataFrame:
    """(id, rows_json): the first ``n`` result rows of each question by position, as one JSON text.

    Spark turns the rank filter into a per-task group limit before the shuffle, so a question with very many rows
    sends at most ``n`` per task, and each collected list has at most ``n`` rows. Spark does so up to a limit of its
    own; for larger ``n``, rows behind a quantile of their question's positions are left out first (see ``_up_to_cut``), which takes positions that are
    numbers, dates or times.
    """
    largest = int(results.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    fields = ["position", *[c for c in results.columns if c not in (id_col, "position")]]
    order = Window.partitionBy(id_col).orderBy(*fields)
    few = results if n <= largest else _up_to_cut(results, n, id_col)
    first = few.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n)
    rows = F.to_json(F.sort_array(F.collect_list(F.struct(*fields))))
    return first.groupBy(F.col(id_col).alias("id")).agg(rows.alias("rows_json"))


# Shares of a question's rows at which its positions are cut, and the accuracy of these quantiles: ranks are off by one in so many of the rows at most.
SHARES = tuple(2.0**-k for k in range(14, 0, -1))
ACCURACY = 100_000
# Only questions with more than one in this many of all rows are cut, so there are fewer of them than that.
LARGE_QUESTIONS = 100_000


def _up_to_cut(results: DataFrame, n: int, id_col: str) -> DataFrame:
    """The rows of ``results`` that may be among the first ``n`` of their question, without a shuffle of rows.

    A question with many rows is cut at the smallest share of them that holds ``n`` rows whatever the error of the quantile; about twice
    as many rows are left (or a 16,000th of the question, if that is more), and rows that tie with the cut or have no position. Nothing among the first ``n`` is left out.
    """
    # a struct compares null to null as equal: rows without a question are one
    question = F.struct(id_col)
    counts = results.groupBy(question.alias("_question")).agg(F.count("position").alias("_all"))
    least = F.greatest(F.lit(4 * n), F.floor(counts.agg(F.sum("_all").alias("rows")).scalar() / LARGE_QUESTIONS))
    large = F.broadcast(counts.where(F.col("_all") > least))
    # partial aggregates are sketches of bounded size, one a task and large question
    of_large = results.select(question.alias("_question"), "position").join(large, "_question")
    quantiles = of_large.groupBy("_question", "_all").agg(F.percentile_approx("position", F.array(*map(F.lit, SHARES)), F.lit(ACCURACY)).alias("_cuts"))
    wanted = F.array(*[F.lit(share - 1 / ACCURACY) * F.col("_all") >= n + 1 for share in SHARES])
    cut = F.try_element_at("_cuts", F.nullif(F.array_position(wanted, True), F.lit(0)).cast("int"))
    cuts = F.broadcast(quantiles.select("_question", cut.alias("_cut")))
    kept = results.withColumn("_question", question).join(cuts, "_question", "left")
    return kept.where("_cut IS NULL OR position IS NULL OR position <= _cut").select(results.columns)


def clean_sql(generated: DataFrame, sql_col: str = "generated", id_col: str = "id") -> DataFrame:
    """(id, sql): generated SQL without code fences and outer white space."""
    return generated.select(F.col(id_col).alias("id"), tx.strip_fences(F.col(sql_col)).alias("sql"))


# Outcomes, cost and log


def with_status(runs: DataFrame) -> DataFrame:
    """Add status: blocked, no_model, error, answered, interpretation_failed or no_rows."""
    status = (
        F.when(F.col("blocked_message").isNotNull(), "blocked")
        .when(F.col("llm").isNull(), "no_model")
        .when(F.col("generation_error").isNotNull(), "error")
        .when(F.coalesce("row_count", F.lit(0)) <= 0, "no_rows")
        .when(F.col("answer").isNull(), "interpretation_failed")
        .otherwise("answered")
    )
    return runs.withColumn("status", status)


def _message(longest: int | None = None) -> Column:
    """What the user sees. Blocked and error texts are cut to ``longest`` characters where one is given; the SQL error
    after an empty result is cut to 60."""
    status = F.col("status")
    cut = (lambda text: tx.prefix(text, longest)) if longest else (lambda text: text)
    sql_error = F.when(F.length("sql_error") > 0, F.concat(F.lit(" Erro: "), tx.prefix(F.col("sql_error"), 60)))
    return (
        F.when(status == "blocked", cut(F.col("blocked_message")))
        .when(status == "no_model", cat.NO_MODEL_MESSAGE)
        .when(status == "error", cut(F.concat(F.lit("Erro LLM: "), F.col("generation_error"))))
        .when(status == "no_rows", F.concat(F.lit(cat.NO_ROWS_MESSAGE), F.coalesce(sql_error, F.lit(""))))
        .when(status == "interpretation_failed", F.col("first_row"))
        .otherwise(tx.strip(F.col("answer")))
    )


def answer_status(runs: DataFrame, id_col: str = "run_id") -> DataFrame:
    """(id, status, message) per run, messages as they are drawn: at most 200 characters."""
    return with_status(runs).select(F.col(id_col).alias("id"), "status", _message(200).alias("message"))


def with_cost(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """Add tokens charged (defaults where a run reports none, plus the answer step by outcome) and ``cost_micros``.

    Runs that never reached a model (blocked, no model, failed generation) are charged nothing.
    """
    status = F.col("status")
    ran = status.isin(*RAN)
    extra = (
        F.when(status == "answered", F.coalesce("tokens_out_2", F.lit(cat.EXTRA_ANSWERED)))
        .when(status == "interpretation_failed", cat.EXTRA_INTERPRETATION_FAILED)
        .otherwise(cat.EXTRA_NO_ROWS)
    )
    tokens_in = F.coalesce("tokens_in", F.lit(cat.DEFAULT_TOKENS_IN))
    tokens_out = F.coalesce("tokens_out", F.lit(cat.DEFAULT_TOKENS_OUT)) + extra
    zero = F.lit(0).cast("bigint")
    return (
        with_status(runs)
        .join(prices, "llm", "left")
        .withColumn("tokens_in", F.when(ran, tokens_in.cast("bigint")).otherwise(zero))
        .withColumn("tokens_out", F.when(ran, tokens_out.cast("bigint")).otherwise(zero))
        .withColumn(
            "cost_micros",
            cost_micros(F.col("tokens_in"), F.col("tokens_out"), F.col("price_in"), F.col("price_out")),
        )
    )


def run_cost(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """(run_id, tokens_in, tokens_out, cost_usd), cost rounded to six decimals."""
    priced = with_cost(runs, prices)
    return priced.select("run_id", "tokens_in", "tokens_out", (F.col("cost_micros") / 1e6).alias("cost_usd"))


def answer_records(runs: DataFrame, prices: DataFrame, results: DataFrame, n: int = 5) -> DataFrame:
    """The full record of each run, one shape for every outcome; fields an outcome does not have are null.

    ``resultado`` holds the first ``n`` result rows as JSON. Results are cut to the runs that show any, then to ``n``
    rows per run, before they are joined, so both sides of the join have one row per run. Error texts are whole.
    """
    status, reached = F.col("status"), F.col("status").isin(*RAN)
    asked = status != "blocked"
    shown = with_status(runs).filter(status.isin("answered", "interpretation_failed")).select(F.col("run_id").alias("id"))
    preview = grounding(results.join(shown, "id", "left_semi"), n).select(F.col("id").alias("run_id"), "rows_json")
    outcome = with_complexity(with_cost(runs, prices), "question").withColumn("message", _message())
    record = {
        "guardrail": status == "blocked",
        "pergunta": F.col("question"),
        "resposta": F.when(status != "error", F.col("message")),
        "erro": F.when(status == "error", F.col("message")),
        "sql_gerado": F.when(reached, tx.strip_fences(F.col("generated"))),
        "sql_attempts": F.when(reached, F.col("attempts")),
        "llm": F.when(asked, F.col("llm")),
        "complexity": F.when(asked, F.col("complexity")),
        "tokens_input": F.when(reached, F.col("tokens_in")),
        "tokens_output": F.when(reached, F.col("tokens_out")),
        "custo_usd": F.when(reached, F.col("cost_micros") / 1e6),
        "custo_rotulo": F.when(reached, cost_label(F.col("cost_micros"))),
        "latencia_ms": F.when(asked, F.col("latency_ms")),
        "resultado": F.when(reached & (status != "no_rows"), F.col("rows_json")),
    }
    return outcome.join(preview, "run_id", "left").select("run_id", *[c.alias(n) for n, c in record.items()])


def log_rows(runs: DataFrame, prices: DataFrame, gold_table: str = cat.GOLD_TABLE) -> DataFrame:
    """One log row per run that reached an outcome with a model: parameters, metrics, tag and the date partition.

    Complexity comes from the question text. The run name is the model and the start in whole epoch seconds.
    """
    started = F.col("started")
    days = F.unix_date(started.cast("date")).cast("bigint")
    # Clock fields of a timestamp without zone do not depend on the session's time zone; casting it would.
    epoch = ((days * 24 + F.hour(started)) * 60 + F.minute(started)) * 60 + F.second(started)
    reached = with_cost(runs, prices).filter(F.col("status").isin(*RAN))
    logged = with_complexity(reached, "question")
    return logged.select(
        "run_id",
        F.concat_ws("_", "llm", epoch.cast("string")).alias("run_name"),
        "llm",
        "complexity",
        F.col("attempts").cast("int").alias("attempts"),
        "tokens_in",
        "tokens_out",
        (F.col("cost_micros") / 1e6).alias("cost_usd"),
        "latency_ms",
        F.lit(gold_table).alias("gold_table"),
        F.col("started").cast("date").alias("dt"),
    )


# Chat history


# Quantile cuts of a conversation that holds many messages: this many at most, found in blocks of CUT_BLOCK.
CUTS = 1023
CUT_BLOCK = 32
# A stretch holds at least this share of all messages, which bounds the number of large conversations, and that of their cuts.
STRETCHES = 100_000


def _stretch(turn: Column, cuts: Column) -> Column:
    """How many of the ascending ``cuts`` are at most ``turn``: first by every ``CUT_BLOCK``-th of them, then inside a block."""
    below = lambda part: F.size(F.filter(part, lambda cut: cut <= turn))
    coarse = F.filter(cuts, lambda _, i: i % CUT_BLOCK == 0)
    blocks = below(coarse)
    inside = F.slice(cuts, (blocks - 1) * CUT_BLOCK + 1, CUT_BLOCK)
    return F.when(blocks == 0, 0).otherwise((blocks - 1) * CUT_BLOCK + below(inside))


def newest_first(chat: DataFrame, width: int = 100_000) -> DataFrame:
    """(conv_id, position, turn, role, text): position 1 is the newest message of its conversation.

    ``turn`` may be a number, a date or a time. Equal turns are ordered by role, then text; messages without a turn come last, and
    those without a conversation form one.

    A conversation may hold a large share of all messages. One with more than ``width`` messages is ranked in stretches between
    quantiles of its own turns, however these lie, of about ``width`` messages each (or a ``CUTS``-th of the conversation, or one in ``STRETCHES`` of all
    messages, if that is more). The rank inside a stretch plus the number of messages in newer stretches is the exact position,
    whatever the quantiles are: they only matter for balance. Message text is shuffled once.
    """
    # a struct of nullable fields compares null to null as equal, and joins on it keep the partitioning of the windows
    conv = F.struct("conv_id")
    counts = chat.groupBy(conv.alias("conv")).agg(F.count(F.lit(1)).alias("messages"))
    width = F.greatest(F.lit(width), F.floor(counts.agg(F.sum("messages").alias("all")).scalar() / STRETCHES))
    # at most STRETCHES rows, with some 2 * STRETCHES cuts in all
    large = F.broadcast(counts.where(F.col("messages") > width).withColumn("every", F.greatest(F.lit(1), F.floor(F.lit(CUTS + 1) * width / F.col("messages")))))
    # partial aggregates are sketches of bounded size, a task and conversation each; only large conversations have any
    steps = F.array(*[F.lit((k + 1) / (CUTS + 1)) for k in range(CUTS)])
    of_large = chat.select(conv.alias("conv"), "turn").join(large, "conv")
    quantiles = of_large.groupBy("conv", "every").agg(F.percentile_approx("turn", steps, F.lit(10 * CUTS)).alias("cuts"))
    cuts = quantiles.select("conv", F.filter("cuts", lambda _, i: (i + 1) % F.col("every") == 0).alias("cuts"))

    dealt = chat.withColumn("conv", conv).join(F.broadcast(cuts), "conv", "left")
    place = F.struct("conv_id", F.when(F.col("turn").isNull(), -1).otherwise(F.coalesce(_stretch(F.col("turn"), F.col("cuts")), F.lit(0))).alias("stretch"))
    stretches = dealt.select("conv_id", "turn", "role", "text", place.alias("place"))
    sizes = stretches.groupBy("place").agg(F.count(F.lit(1)).alias("size"))
    newer = Window.partitionBy("place.conv_id").orderBy(F.desc("place.stretch")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("place", F.coalesce(F.sum("size").over(newer), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("place").orderBy(F.desc("turn"), "role", "text")
    ranked = stretches.withColumn("rank", F.row_number().over(inside))
    return ranked.join(offsets, "place").select(
        "conv_id", (F.col("rank") + F.col("skip")).cast("bigint").alias("position"), "turn", "role", "text"
    )
