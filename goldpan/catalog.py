"""Fixed lookup values: models, prices, routes, questions, words, classes, GDP.

Everything here is a small constant, so the price and override tables, at most one row per model, are marked for
broadcast. Tables read from storage never are: Spark decides on their size.
"""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GOLD_TABLE = "gold_state"

# Display name, model id, provider, USD per million input tokens, and output tokens.
MODELS = [
    ("Llama 3.1 8B (Gratis)", "llama-3.1-8b-instant", "groq", "0.00", "0.00"),
    ("Llama 3.3 70B (Gratis)", "llama-3.3-70b-versatile", "groq", "0.00", "0.00"),
    ("Mistral Saba 24B (Gratis)", "mistral-saba-24b", "groq", "0.00", "0.00"),
    ("Qwen QwQ 32B (Gratis)", "qwen-qwq-32b", "groq", "0.00", "0.00"),
    ("Claude Sonnet 4.6", "claude-sonnet-4-6", "anthropic", "3.00", "15.00"),
    ("GPT-4o Mini", "gpt-4o-mini", "openai", "0.15", "0.60"),
    ("GPT-4o", "gpt-4o", "openai", "2.50", "10.00"),
    ("Gemini 2.0 Flash", "gemini-2.0-flash", "gemini", "0.10", "0.40"),
    ("Gemini 1.5 Pro", "gemini-1.5-pro", "gemini", "1.25", "5.00"),
]

# Benchmark models in run order, the provider each needs, and its price label.
BENCH_MODELS = [
    ("llama-3.1-8b-instant", "groq", "Gratuito"),
    ("llama-3.3-70b-versatile", "groq", "Gratuito"),
    ("mistral-saba-24b", "groq", "Gratuito"),
    ("qwen-qwq-32b", "groq", "Gratuito"),
    ("claude-sonnet-4-6", "anthropic", "$3/1M"),
    ("gpt-4o-mini", "openai", "$0.15/1M"),
    ("gpt-4o", "openai", "$2.5/1M"),
]

# Routes in order of preference; a complexity of None matches every question.
ROUTES = [
    ("simple", "groq", "llama-3.1-8b-instant"),
    ("medium", "groq", "llama-3.3-70b-versatile"),
    (None, "anthropic", "claude-sonnet-4-6"),
    (None, "openai", "gpt-4o"),
    (None, "gemini", "gemini-2.0-flash"),
    (None, "groq", "llama-3.3-70b-versatile"),
]

# The benchmark questions and the suggested questions.
BENCH_QUESTIONS = [
    "Qual região tem maior taxa de atraso?",
    "Estados de baixa renda parcelam mais?",
    "Qual estado tem maior ticket médio?",
]
SUGGESTED_QUESTIONS = [
    "Qual região tem maior taxa de atraso?",
    "Estados de baixa renda parcelam mais?",
    "Qual a relação entre PIB e satisfação?",
    "Top 3 estados mais eficientes em entrega",
    "Compare ticket médio por classe econômica",
]

# Words that block a question, and the texts shown to the user.
SENSITIVE_WORDS = ["cpf", "cnpj", "senha", "password", "token", "secret"]
DDL_WORDS = ["drop", "delete", "truncate", "insert", "update", "alter"]
BLOCKED_MESSAGE = "Bloqueado: termo sensivel ou DDL."
TOO_SHORT_MESSAGE = "Pergunta muito curta."
FREE_LABEL = "Gratuito"
NO_ROWS_MESSAGE = "Nenhum dado encontrado."
NO_MODEL_MESSAGE = "Nenhum modelo disponível: configure a chave de um provedor."

# Longest question, in words, still simple and still medium.
SIMPLE_WORDS = 40
MEDIUM_WORDS = 80

# Tokens charged where a run reports none, and extra output tokens by outcome.
DEFAULT_TOKENS_IN = 300
DEFAULT_TOKENS_OUT = 100
EXTRA_ANSWERED = 80
EXTRA_INTERPRETATION_FAILED = 50
EXTRA_NO_ROWS = 20

# Income classes, poorest first, and the lowest GDP per head of each.
INCOME_CLASSES = [("Baixa Renda", None), ("Médio", 25000), ("Rico", 40000)]

# Late rates (percent) above which a region is in danger or to be watched.
LATE_DANGER = 12
LATE_WARN = 8

# Gold columns shown in the dashboard table and their headings.
DISPLAY_COLUMNS = [
    ("customer_state", "Estado"),
    ("regiao", "Região"),
    ("classe_economica", "Classe"),
    ("pib_per_capita", "PIB p/capita"),
    ("total_pedidos", "Pedidos"),
    ("ticket_medio", "Ticket Médio"),
    ("pct_parcelados", "% Parcelados"),
    ("satisfacao_media", "Satisfação"),
    ("pct_atrasados", "% Atraso"),
    ("ticket_por_pib", "Ticket/PIB"),
]

GOLD_SCHEMA = (
    "customer_state string, regiao string, pib_per_capita double, classe_economica string, "
    "total_pedidos bigint, ticket_medio double, media_itens double, media_parcelas double, "
    "pct_parcelados double, satisfacao_media double, pct_atrasados double, media_dias_atraso double, "
    "ticket_por_pib double"
)
GOLD_COLUMNS = [column.split()[0] for column in GOLD_SCHEMA.split(", ")]

# Public 2018 GDP per head (BRL) of each Brazilian state, with its region.
STATE_GDP = [
    ("SP", "Sudeste", 51559.3),
    ("RJ", "Sudeste", 43685.4),
    ("MG", "Sudeste", 30977.8),
    ("RS", "Sul", 41717.2),
    ("PR", "Sul", 40696.3),
    ("SC", "Sul", 46645.1),
    ("BA", "Nordeste", 18301.6),
    ("DF", "Centro-Oeste", 84209.9),
    ("GO", "Centro-Oeste", 30011.5),
    ("PE", "Nordeste", 19023.5),
    ("CE", "Nordeste", 15673.4),
    ("ES", "Sudeste", 37182.1),
    ("MA", "Nordeste", 11329.4),
    ("MT", "Centro-Oeste", 43415.2),
    ("MS", "Centro-Oeste", 35441.7),
    ("PB", "Nordeste", 15073.2),
    ("PI", "Nordeste", 13261.8),
    ("RN", "Nordeste", 17951.3),
    ("SE", "Nordeste", 17603.1),
    ("AL", "Nordeste", 14271.2),
    ("PA", "Norte", 17118.6),
    ("AM", "Norte", 22644.3),
    ("AC", "Norte", 16423.5),
    ("AP", "Norte", 17463.8),
    ("RO", "Norte", 23414.5),
    ("RR", "Norte", 21012.6),
    ("TO", "Norte", 23591.4),
]


def lookup(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant table. It goes in as Arrow, so it becomes a local relation of known size, instead of a Python-backed
    scan of unknown size."""
    target = StructType.fromDDL(schema)
    table = pa.Table.from_arrays([pa.array(column) for column in zip(*rows)], names=target.fieldNames())
    return spark.createDataFrame(table, target)


def price_table(spark: SparkSession) -> DataFrame:
    """(llm, price_in, price_out): USD per million tokens, one row per known model."""
    rows = [(model, Decimal(price_in), Decimal(price_out)) for _, model, _, price_in, price_out in MODELS]
    return F.broadcast(lookup(spark, rows, "llm string, price_in decimal(6,2), price_out decimal(6,2)"))


def override_table(spark: SparkSession, providers: dict[str, bool]) -> DataFrame | None:
    """(override, override_llm): the models a user may pick given the providers with a key; None if there are none."""
    rows = [(name, model) for name, model, provider, _, _ in MODELS if providers.get(provider)]
    return F.broadcast(lookup(spark, rows, "override string, override_llm string")) if rows else None


def bench_models(providers: dict[str, bool] | None = None) -> list[str]:
    """Benchmark model ids in run order, limited to the given providers."""
    return [m for m, provider, _ in BENCH_MODELS if providers is None or providers.get(provider)]
