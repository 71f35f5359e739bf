"""The registered jobs in plain SQL for an independent engine, to compare results with.

The SQL joins at order grain and aggregates once, unlike the jobs, and only shares the fixed lookup values.
"""

from __future__ import annotations

from goldpan import catalog as cat


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_quoted(v) for v in values) + "]"


def _round(expression: str, decimals: int) -> str:
    """Round half up on the decimal digits; rounding doubles differs between engines at ties."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {decimals}) AS DOUBLE)"


_CLASS = "CASE WHEN gdp >= 40000 THEN 'Rico' WHEN gdp >= 25000 THEN 'Médio' ELSE 'Baixa Renda' END"
_BAND = "CASE WHEN classe_economica IN ('Rico', 'Médio') THEN classe_economica ELSE 'Baixa Renda' END"

_LAYERS = f"""
lines AS (
  SELECT l_orderkey AS order_id, count(*) AS n_items, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS paid,
         min(l_linenumber) AS instalments, CAST(max(l_shipdate) AS DATE) AS delivered
  FROM lineitem GROUP BY l_orderkey),
facts AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS ordered, delivered,
         CAST(o_orderdate AS DATE) + 1800 AS promised, n_items, paid, instalments,
         CAST(datediff('day', CAST(o_orderdate AS DATE) + 1800, delivered) AS INTEGER) AS delay_days
  FROM orders JOIN lines ON o_orderkey = order_id WHERE o_orderstatus = 'F'),
seed AS (
  SELECT state_key, state, region, gdp, {_CLASS} AS income_class
  FROM (SELECT n_nationkey AS state_key, n_name AS state, r_name AS region,
               CAST(10000 + 2000 * ((n_nationkey * 7) % 25) AS DOUBLE) AS gdp
        FROM nation JOIN region ON n_regionkey = r_regionkey)),
scores AS (
  SELECT user_id AS customer_id, CAST(sum(least(5, 1 + floor(value / 50))) AS BIGINT) AS score_sum,
         count(*) AS score_count
  FROM events GROUP BY user_id),
enriched AS (
  SELECT f.*, f.delay_days > 0 AS is_late, f.instalments > 1 AS in_instalments, score_sum, score_count,
         state, region, gdp, income_class
  FROM facts f JOIN customer ON c_custkey = f.customer_id JOIN seed ON state_key = c_nationkey
  LEFT JOIN scores s ON s.customer_id = f.customer_id),
gold_unscaled AS (
  SELECT state AS customer_state, region AS regiao, gdp AS pib_per_capita, income_class AS classe_economica,
         count(*) AS total_pedidos,
         {_round("CAST(sum(paid) AS DOUBLE) / count(*)", 2)} AS ticket_medio,
         {_round("CAST(sum(n_items) AS DOUBLE) / count(*)", 2)} AS media_itens,
         {_round("CAST(sum(instalments) AS DOUBLE) / count(*)", 2)} AS media_parcelas,
         {_round("100.0 * CAST(count(*) FILTER (in_instalments) AS DOUBLE) / count(*)", 1)} AS pct_parcelados,
         {_round("CAST(sum(score_sum) AS DOUBLE) / sum(score_count)", 2)} AS satisfacao_media,
         {_round("100.0 * CAST(count(*) FILTER (is_late) AS DOUBLE) / count(delay_days)", 1)} AS pct_atrasados,
         {_round("avg(delay_days)", 1)} AS media_dias_atraso
  FROM enriched GROUP BY state, region, gdp, income_class),
gold AS (
  SELECT *, {_round("1000 * ticket_medio / nullif(pib_per_capita, 0)", 2)} AS ticket_por_pib FROM gold_unscaled)
"""

_REASON = (
    "CASE WHEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])({sensitive})([^\\p{{L}}\\p{{N}}_]|$)') "
    "THEN 'sensitive' WHEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])({ddl})([^\\p{{L}}\\p{{N}}_]|$)') "
    "THEN 'ddl' WHEN words < 2 THEN 'too_short' END"
).format(sensitive="|".join(cat.SENSITIVE_WORDS), ddl="|".join(cat.DDL_WORDS))
_SPACE = r"\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}"
_WORDS = rf"CAST(len(regexp_extract_all(text, '[^{_SPACE}]+')) AS INTEGER)"
_LEVEL = "CASE WHEN words <= 40 THEN 'simple' WHEN words <= 80 THEN 'medium' ELSE 'complex' END"


def _strip(expression: str) -> str:
    return f"regexp_replace({expression}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


_QUESTIONS = f"""
asked AS (
  SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, text, {_WORDS} AS words,
         CASE turn % 4 WHEN 1 THEN 'GPT-4o Mini' WHEN 2 THEN 'Gemini 1.5 Pro' WHEN 3 THEN 'unknown' END AS override
  FROM conversations)
"""

_PRICES = ", ".join(f"({_quoted(m)}, {pin}, {pout})" for _, m, _, pin, pout in cat.MODELS)
_BENCH = [m for m, _, _ in cat.BENCH_MODELS]
_LABELS = " ".join(f"WHEN {_quoted(m)} THEN {_quoted(label)}" for m, _, label in cat.BENCH_MODELS)

_RUNS = f"""
prices AS (
  SELECT llm, CAST(price_in AS DECIMAL(6,2)) AS price_in, CAST(price_out AS DECIMAL(6,2)) AS price_out
  FROM (VALUES {_PRICES}) v(llm, price_in, price_out)),
tokens AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(floor(value) AS BIGINT) AS whole FROM events),
runs AS (
  SELECT event_id AS run_id, ts AS started, event_type AS kind, props, user_id,
         {_list(cat.BENCH_QUESTIONS)}[user_id % 3 + 1] AS question, {_list(_BENCH)}[event_id % 7 + 1] AS llm,
         coalesce(nullif(k, 0), 300) AS ti, coalesce(nullif(whole, 0), 100) AS first_out,
         coalesce(nullif(k % 50, 0), 80) AS second_out,
         CAST(floor(value * 10) AS BIGINT) AS latency_ms,
         CASE event_type WHEN 'signup' THEN 'blocked' WHEN 'error' THEN 'error' WHEN 'view' THEN 'no_rows'
              WHEN 'click' THEN 'interpretation_failed' ELSE 'answered' END AS status
  FROM tokens),
charged AS (
  SELECT *, status IN ('answered', 'interpretation_failed', 'no_rows') AS ran,
         first_out + CASE status WHEN 'answered' THEN second_out WHEN 'no_rows' THEN 20 ELSE 50 END AS total_out
  FROM runs),
costed AS (
  SELECT c.*, CASE WHEN ran THEN ti ELSE 0 END AS tokens_in, CASE WHEN ran THEN total_out ELSE 0 END AS tokens_out,
         CASE WHEN ran THEN CAST(round(ti * price_in + total_out * price_out, 0) AS BIGINT) ELSE 0 END AS micros,
         kind <> 'error' AS ok,
         CASE WHEN kind <> 'error' THEN CAST(round(ti * price_in + first_out * price_out, 0) AS BIGINT) ELSE 0 END
           AS bench_micros,
         CASE WHEN kind <> 'error' THEN latency_ms ELSE 0 END AS bench_latency,
         CASE WHEN kind = 'error' THEN 'Erro: ' || substr('run failed with ' || props, 1, 80)
              WHEN kind = 'click' THEN '' ELSE 'resposta ' || props END AS bench_answer
  FROM charged c LEFT JOIN prices USING (llm))
"""


_MESSAGE = f"""
CASE status WHEN 'blocked' THEN {_quoted(cat.BLOCKED_MESSAGE)}
  WHEN 'error' THEN 'Erro LLM: run failed with ' || props
  WHEN 'no_rows' THEN {_quoted(cat.NO_ROWS_MESSAGE)}
    || CASE WHEN user_id % 2 = 0 THEN ' Erro: ' || substr(props, 1, 60) ELSE '' END
  WHEN 'interpretation_failed' THEN props ELSE 'resposta ' || props END
"""

_PREVIEW = """
preview AS (
  SELECT id, CAST(to_json(list({'position': position, 'part': part, 'quantity': quantity}
                               ORDER BY position, part, quantity)) AS VARCHAR) AS rows_json
  FROM (SELECT l_orderkey AS id, l_linenumber AS position, l_partkey AS part, CAST(l_quantity AS INTEGER) AS quantity,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS INTEGER)) AS n
        FROM lineitem)
  WHERE n <= 5 GROUP BY id)
"""

_RECORDS = f"""
SELECT run_id, status = 'blocked' AS guardrail, question AS pergunta,
       CASE WHEN status <> 'error' THEN {_MESSAGE} END AS resposta, CASE WHEN status = 'error' THEN {_MESSAGE} END AS erro,
       CASE WHEN ran THEN 'SELECT ' || chr(39) || props || chr(39) END AS sql_gerado,
       CASE WHEN ran THEN CASE WHEN status = 'no_rows' THEN 2 ELSE 1 END END AS sql_attempts,
       CASE WHEN status <> 'blocked' THEN llm END AS llm, CASE WHEN status <> 'blocked' THEN 'simple' END AS complexity,
       CASE WHEN ran THEN tokens_in END AS tokens_input, CASE WHEN ran THEN tokens_out END AS tokens_output,
       CASE WHEN ran THEN micros / 1e6 END AS custo_usd,
       CASE WHEN ran THEN CASE WHEN micros > 0 THEN printf('$%.6f', micros / 1e6) ELSE 'Gratuito' END END AS custo_rotulo,
       CASE WHEN status <> 'blocked' THEN latency_ms END AS latencia_ms,
       CASE WHEN ran AND status <> 'no_rows' THEN rows_json END AS resultado
FROM costed LEFT JOIN preview ON id = run_id
"""


def _mean(column: str) -> str:
    return _round(f"avg({column})", 6)


def _count(table: str) -> str:
    return f"SELECT '{table}' AS \"table\", count(*) AS \"rows\" FROM {table}"


def _check(table: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{test}' AS test, "
        f"CAST(({failures}) AS BIGINT) AS failures, ({failures}) = 0 AS passed"
    )


def _nulls(table: str, column: str) -> str:
    return _check(table, column, "not_null", f"SELECT count(*) FROM {table} WHERE {column} IS NULL")


def _lost(cause: str) -> str:
    """Delivered orders outside the enriched table; a line is an item and a payment at once."""
    lacks = (
        "CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL) THEN 'items' "
        "WHEN c_custkey IS NULL THEN 'customer' WHEN r_name IS NULL THEN 'state' END"
    )
    joined = (
        "orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region "
        "ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey"
    )
    count = f"SELECT count(*) FROM (SELECT {lacks} AS cause FROM {joined} WHERE o_orderstatus = 'F') WHERE cause = '{cause}'"
    return _check("silver_orders_enriched", cause, "lost", count)


def _repeats(table: str, columns: str) -> str:
    keys = f"SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1"
    return _check(table, columns, "unique", f"SELECT count(*) FROM ({keys})")


def _others(table: str, column: str, values: list[str]) -> str:
    wanted = ", ".join(_quoted(v) for v in values)
    return _check(
        table, column, "accepted_values", f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({wanted})"
    )


def _interpretation(n: int) -> str:
    return (
        f"WITH {_RUNS}, shown AS (SELECT id, CAST(to_json(list({{'position': position, 'event_type': event_type, "
        "'cents': cents} ORDER BY position)) AS VARCHAR) AS rows_json FROM (SELECT user_id AS id, event_id AS position, "
        "event_type, CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents, "
        f"row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n <= {n} GROUP BY id) "
        "SELECT id, 'Pergunta: ' || text || chr(10) || 'Dados: ' || rows_json || chr(10) || 'Resposta:' AS prompt "
        "FROM shown JOIN (SELECT user_id AS id, arg_min(question, run_id) AS text FROM runs GROUP BY user_id) USING (id)"
    )


def _from_gold(select: str) -> str:
    return f"WITH {_LAYERS} {select}"


def _weighted(select: str, group: str = "") -> str:
    return f"WITH {_LAYERS} SELECT {select} FROM enriched {group}"


_AVG_TICKET = _round("CAST(sum(paid) AS DOUBLE) / count(*)", 4) + " AS avg_ticket"
_DISPLAY = ", ".join(
    f'CAST(round(CAST({name} AS DECIMAL(18,2)), 1) AS DOUBLE) AS "{heading}"'
    if name not in ("customer_state", "regiao", "classe_economica", "total_pedidos")
    else f'{name} AS "{heading}"'
    for name, heading in cat.DISPLAY_COLUMNS
)
_SEVERITY = "CASE WHEN pct_late > 12 THEN 'danger' WHEN pct_late > 8 THEN 'warn' ELSE 'success' END AS severity"
_SCHEMA_TEXT = f"Tabela {cat.GOLD_TABLE}: {', '.join(cat.GOLD_COLUMNS)}. Apenas SELECT em Spark SQL, sempre com LIMIT."


def oracle_sql() -> dict[str, str]:
    """One statement per registered job."""
    weighted_late = _round("100.0 * CAST(count(*) FILTER (is_late) AS DOUBLE) / count(delay_days)", 6)
    answers = ", ".join(f"arg_min(substr(bench_answer, 1, 180), run_id) FILTER (llm = '{m}') AS \"{m}\"" for m in _BENCH)
    return {
        "bronze_counts": " UNION ALL ".join(
            _count(t) for t in ("customer", "events", "lineitem", "nation", "orders", "region")
        ),
        "gdp_seed": _from_gold("SELECT state, region, gdp, income_class FROM seed"),
        "silver_delivered": _from_gold(
            "SELECT o_orderkey AS order_id, o_custkey AS customer_id, ordered, delivered, promised, delay_days, "
            "delay_days > 0 AS is_late FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS ordered, delivered, "
            "CAST(o_orderdate AS DATE) + 1800 AS promised, CAST(datediff('day', CAST(o_orderdate AS DATE) + 1800, delivered) "
            "AS INTEGER) AS delay_days FROM orders LEFT JOIN lines ON o_orderkey = order_id WHERE o_orderstatus = 'F')"
        ),
        "silver_items": _from_gold("SELECT order_id, n_items, CAST(paid AS DECIMAL(20,2)) AS items_value FROM lines"),
        "silver_payments": _from_gold(
            "SELECT order_id, CAST(paid AS DECIMAL(20,2)) AS paid, instalments, instalments > 1 AS in_instalments "
            "FROM lines"
        ),
        "silver_reviews": _from_gold("SELECT customer_id, score_sum, score_count FROM scores"),
        "silver_orders_enriched": _from_gold(
            "SELECT order_id, customer_id, ordered, delivered, promised, delay_days, is_late, n_items, "
            "CAST(paid AS DECIMAL(20,2)) AS items_value, CAST(paid AS DECIMAL(20,2)) AS paid, instalments, "
            "in_instalments, score_sum, score_count, state, region, gdp, income_class FROM enriched"
        ),
        "gold_state": _from_gold("SELECT * FROM gold"),
        "gold_state_from_silver": _from_gold("SELECT * FROM gold"),
        "gold_class": _weighted(
            "income_class, count(*) AS orders, "
            + _round("CAST(sum(instalments) AS DOUBLE) / count(*)", 4)
            + " AS avg_instalments, "
            + _round("100.0 * CAST(count(*) FILTER (in_instalments) AS DOUBLE) / count(*)", 4)
            + f" AS pct_instalments, {_AVG_TICKET}",
            "GROUP BY income_class",
        ),
        "gold_kpis": _weighted(
            f"count(*) AS orders, {_AVG_TICKET}, "
            + _round("100.0 * CAST(count(*) FILTER (is_late) AS DOUBLE) / count(delay_days)", 4)
            + " AS pct_late, "
            + _round("CAST(sum(score_sum) AS DOUBLE) / sum(score_count)", 4)
            + " AS satisfaction"
        ),
        "gold_scan": _from_gold("SELECT * FROM gold ORDER BY total_pedidos DESC, customer_state"),
        "gold_with_fallback": _from_gold("SELECT *, 'snapshot' AS source, 'missing' AS reason FROM gold"),
        "gold_published": _from_gold("SELECT *, 'table' AS source, CAST(NULL AS VARCHAR) AS reason FROM gold"),
        "gold_display": _from_gold(f"SELECT {_DISPLAY}, {_BAND} AS class_band FROM gold"),
        "dashboard_kpis": _from_gold(
            f"SELECT CAST(sum(total_pedidos) AS BIGINT) AS orders, {_mean('ticket_medio')} AS ticket, "
            f"{_mean('pct_atrasados')} AS late, {_mean('satisfacao_media')} AS satisfaction FROM gold"
        ),
        "top_states": _from_gold(
            "SELECT customer_state AS state, total_pedidos AS orders FROM gold "
            "ORDER BY total_pedidos DESC, customer_state LIMIT 7"
        ),
        "scatter": _from_gold(
            f"SELECT customer_state AS state, pib_per_capita AS gdp, ticket_medio AS ticket, {_BAND} AS class_band FROM gold"
        ),
        "class_profile": _from_gold(
            ", classes AS (SELECT * FROM (VALUES ('Baixa Renda', 0), ('Médio', 1), ('Rico', 2)) v(income_class, position)) "
            f"SELECT income_class, position, {_mean('media_parcelas')} AS avg_instalments, "
            f"{_mean('pct_parcelados')} AS pct_instalments, {_round('avg(pct_parcelados) / 10', 6)} AS pct_scaled "
            "FROM classes LEFT JOIN gold ON classe_economica = income_class GROUP BY income_class, position"
        ),
        "region_late": _from_gold(
            f"SELECT region, pct_late, {_SEVERITY} FROM (SELECT regiao AS region, {_mean('pct_atrasados')} AS pct_late "
            "FROM gold GROUP BY regiao)"
        ),
        "q_region_late": _from_gold(
            f"SELECT region, pct_late, pct_late_weighted, {_SEVERITY} FROM (SELECT regiao AS region, "
            f"{_mean('pct_atrasados')} AS pct_late FROM gold GROUP BY regiao) JOIN (SELECT region, {weighted_late} AS "
            "pct_late_weighted FROM enriched GROUP BY region) USING (region) "
            "ORDER BY pct_late DESC, region LIMIT 1"
        ),
        "q_class_installments": _from_gold(
            "SELECT classe_economica AS income_class, " + f"{_mean('pct_parcelados')} AS pct_instalments, "
            f"{_mean('media_parcelas')} AS avg_instalments, "
            + _round(
                f"{_mean('pct_parcelados')} - (SELECT {_mean('pct_parcelados')} FROM gold WHERE classe_economica = 'Rico')",
                6,
            )
            + " AS diff_from_rich FROM gold GROUP BY classe_economica"
        ),
        "q_gdp_satisfaction": _from_gold(
            f"SELECT {_round('corr(pib_per_capita, satisfacao_media)', 6)} AS correlation, count(*) AS states FROM gold "
            "WHERE satisfacao_media IS NOT NULL"
        ),
        "q_top_delivery": _from_gold(
            "SELECT customer_state AS state, pct_atrasados AS pct_late, media_dias_atraso AS avg_delay_days FROM gold "
            "ORDER BY pct_atrasados, media_dias_atraso, customer_state LIMIT 3"
        ),
        "q_ticket_by_class": _from_gold(
            f"SELECT classe_economica AS income_class, {_mean('ticket_medio')} AS avg_ticket, "
            "min(ticket_medio) AS min_ticket, max(ticket_medio) AS max_ticket, count(*) AS states "
            "FROM gold GROUP BY classe_economica"
        ),
        "q_top_ticket": _from_gold(
            "SELECT customer_state AS state, ticket_medio AS ticket FROM gold "
            "ORDER BY ticket_medio DESC, customer_state LIMIT 1"
        ),
        "dq_report": " UNION ALL ".join(
            [
                _nulls("orders", "o_orderkey"),
                _nulls("orders", "o_custkey"),
                _nulls("orders", "o_orderdate"),
                _others("orders", "o_orderstatus", ["F", "O", "P"]),
                _nulls("customer", "c_custkey"),
                _nulls("customer", "c_nationkey"),
                _nulls("lineitem", "l_orderkey"),
                _nulls("lineitem", "l_extendedprice"),
                _others("events", "event_type", ["click", "error", "purchase", "signup", "view"]),
                _nulls("nation", "n_name"),
                _nulls("region", "r_name"),
                _repeats("orders", "o_orderkey"),
                _repeats("customer", "c_custkey"),
                _repeats("nation", "n_name"),
                _repeats("region", "r_regionkey"),
                _repeats("lineitem", "l_orderkey,l_linenumber"),
                *[_lost(cause) for cause in ("items", "payments", "customer", "state")],
            ]
        ),
        "guardrail": (
            f"SELECT id, reason IS NOT NULL AS blocked, reason, CASE WHEN reason = 'too_short' "
            f"THEN {_quoted(cat.TOO_SHORT_MESSAGE)} WHEN reason IS NOT NULL THEN {_quoted(cat.BLOCKED_MESSAGE)} END AS message "
            f"FROM (SELECT id, {_REASON} AS reason FROM (SELECT doc_id AS id, text, {_WORDS} AS words FROM documents))"
        ),
        "complexity": f"WITH {_QUESTIONS} SELECT id, words, {_LEVEL} AS complexity FROM asked",
        "routing": (
            f"WITH {_QUESTIONS} SELECT id, complexity, CASE WHEN override = 'GPT-4o Mini' THEN 'gpt-4o-mini' "
            "WHEN complexity = 'simple' THEN 'llama-3.1-8b-instant' "
            "WHEN complexity = 'medium' THEN 'llama-3.3-70b-versatile' ELSE 'claude-sonnet-4-6' END AS llm "
            f"FROM (SELECT id, override, {_LEVEL} AS complexity FROM asked)"
        ),
        "prompt_table": (
            f"WITH {_QUESTIONS} SELECT id, 'Responda só com SQL.' || chr(10) || {_quoted(_SCHEMA_TEXT)} || chr(10) || "
            f"'Pergunta: ' || text || chr(10) || 'SQL:' AS prompt FROM asked WHERE ({_REASON}) IS NULL"
        ),
        "question_plan": (
            f"SELECT id, blocked, reason, words, complexity, llm, CASE WHEN llm IS NOT NULL THEN 'Responda só com SQL.' "
            f"|| chr(10) || {_quoted(_SCHEMA_TEXT)} || chr(10) || 'Pergunta: ' || text || chr(10) || 'SQL:' END AS prompt "
            "FROM (SELECT *, CASE WHEN blocked THEN NULL WHEN complexity = 'simple' THEN 'llama-3.1-8b-instant' "
            "WHEN complexity = 'medium' THEN 'llama-3.3-70b-versatile' ELSE 'claude-sonnet-4-6' END AS llm "
            f"FROM (SELECT *, reason IS NOT NULL AS blocked, {_LEVEL} AS complexity FROM (SELECT *, {_REASON} AS reason "
            f"FROM (SELECT doc_id AS id, text, {_WORDS} AS words FROM documents))))"
        ),
        "interpretation_prompts": _interpretation(20),
        "interpretation_prompts_bench": _interpretation(10),
        "grounding_table": (
            "SELECT id, CAST(to_json(list({'position': position, 'event_type': event_type, 'cents': cents} "
            "ORDER BY position)) AS VARCHAR) AS rows_json FROM (SELECT user_id AS id, event_id AS position, event_type, "
            "CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents, "
            "row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n <= 20 GROUP BY id"
        ),
        "sql_clean": (
            f"WITH {_QUESTIONS} SELECT id, "
            + _strip(
                "regexp_replace(' ```sql' || chr(10) || 'SELECT ''' || text || '''' || chr(10) || '```' || chr(10) || chr(9), "
                "'```sql|```', '', 'g')"
            )
            + " AS sql FROM asked"
        ),
        "adhoc_sql": _from_gold(
            "SELECT regiao, count(*) AS states, CAST(sum(total_pedidos) AS BIGINT) AS orders, "
            "max(ticket_medio) AS best_ticket FROM gold GROUP BY regiao HAVING count(*) > 1 "
            "ORDER BY orders DESC, regiao LIMIT 20"
        ),
        "bounded_result": _from_gold(
            "SELECT order_id, CAST(paid AS DECIMAL(20,2)) AS paid, instalments, instalments > 1 AS in_instalments "
            "FROM lines ORDER BY paid DESC, order_id LIMIT 20"
        ),
        "answer_status": f"WITH {_RUNS} SELECT run_id AS id, status, CASE WHEN status IN ('blocked', 'error') "
        f"THEN substr({_MESSAGE}, 1, 200) ELSE {_MESSAGE} END AS message FROM costed",
        "run_cost": f"WITH {_RUNS} SELECT run_id, tokens_in, tokens_out, micros / 1e6 AS cost_usd FROM costed",
        "answer_records": f"WITH {_RUNS}, {_PREVIEW} {_RECORDS}",
        "run_log": (
            f"WITH {_RUNS} SELECT run_id, llm || '_' || CAST(epoch_us(started) // 1000000 AS VARCHAR) AS run_name, llm, "
            "'simple' AS complexity, CASE WHEN status = 'no_rows' THEN 2 ELSE 1 END AS attempts, tokens_in, tokens_out, "
            "micros / 1e6 AS cost_usd, latency_ms, 'gold_state' AS gold_table, CAST(started AS DATE) AS dt "
            "FROM costed WHERE ran"
        ),
        "chat_latest": (
            "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role, text) AS position, turn, role, text "
            "FROM conversations"
        ),
        "benchmark_grid": (
            f"WITH {_RUNS} SELECT question, llm, count(run_id) AS runs FROM (SELECT unnest({_list(cat.BENCH_QUESTIONS)}) "
            f"AS question) q CROSS JOIN (SELECT unnest({_list(_BENCH)}) AS llm) m LEFT JOIN runs USING (question, llm) "
            "GROUP BY question, llm"
        ),
        "benchmark_runs": (
            f"WITH {_RUNS} SELECT run_id, question, llm, ok, bench_latency AS latency_ms, bench_micros / 1e6 AS cost_usd, "
            "bench_answer AS answer FROM costed"
        ),
        "benchmark_by_model": (
            f"WITH {_RUNS} SELECT llm, CASE WHEN llm LIKE 'claude%' THEN 'claude' WHEN llm LIKE 'gpt%' THEN 'gpt' "
            "WHEN llm LIKE 'mistral%' THEN 'mistral' WHEN llm LIKE 'qwen%' THEN 'qwen' ELSE 'other' END AS family, "
            "CAST(sum(bench_latency) AS BIGINT) AS latency_sum, CAST(sum(bench_micros) AS BIGINT) / 1e6 AS cost_sum, "
            f"count(*) FILTER (ok) AS ok_count, count(*) AS run_count, CASE llm {_LABELS} END AS price_label, "
            + _round("CAST(sum(bench_latency) AS DOUBLE) / count(*) FILTER (ok)", 4)
            + " AS avg_latency_ok FROM costed GROUP BY llm"
        ),
        "benchmark_answers": f"WITH {_RUNS} SELECT question, {answers} FROM costed GROUP BY question",
        "benchmark_cells": (
            f"WITH {_RUNS} SELECT question, llm, ok, substr(bench_answer, 1, 180) AS answer, "
            "CASE WHEN ok THEN 'SELECT ' || chr(39) || props || chr(39) ELSE '' END AS sql, bench_latency AS latency_ms, "
            "bench_micros / 1e6 AS cost_usd, CASE WHEN bench_micros > 0 THEN printf('$%.6f', bench_micros / 1e6) ELSE 'Gratis' END "
            f"AS cost_label, CASE llm {_LABELS} END AS price_label FROM "
            "(SELECT *, row_number() OVER (PARTITION BY question, llm ORDER BY run_id) AS n FROM costed) WHERE n = 1"
        ),
    }
