"""Text expressions against plain Python on awkward inputs."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldpan import catalog as cat
from goldpan.functions import text as tx
from goldpan.operators import question_log as ql

SPACES = [chr(code) for code in (0x20, 0xa0, 0x1680, 0x2003, 0x2028, 0x202f, 0x205f, 0x3000, 0x1c, 0x1f, 0xb, 0x85, 0x9, 0xa, 0xd)]
SAMPLES = [
    "", " ", "cpf", "oi", "DROP TABLE x", "tokens demais", "senhação teste", "éalter x", "um Secreto", "a" + chr(0xA0) + "b c",
    "  padded \n", "```sql\nSELECT 1\n```", "meu CPF é 1", "password!", "x_token y", "token1 z", "to" + chr(0x212A) + "en abc",
    "um;delete", chr(0x130) + "nsert isto", chr(0x17F) + "enha nova", "update já", "fim secret", "1drop 2", "a-drop-b c",
] + [f"a{s}b" for s in SPACES] + [f"{s}a b{s}{s}" for s in SPACES]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")


def values(rows, column):
    return [r[column] for r in sorted(rows, key=lambda r: r["id"])]


def expected_reason(text):
    lowered = text.lower()
    for reason, words in (("sensitive", cat.SENSITIVE_WORDS), ("ddl", cat.DDL_WORDS)):
        if re.search(r"\b(" + "|".join(words) + r")\b", lowered):
            return reason
    return "too_short" if len(text.split()) < 2 else None


def check(spark, texts):
    rows = frame(spark, texts).select("id", tx.word_count(F.col("text")).alias("n"), tx.strip(F.col("text")).alias("s"))
    rows = rows.collect()
    assert values(rows, "n") == [len(t.split()) for t in texts]
    assert values(rows, "s") == [t.strip() for t in texts]
    screened = ql.guardrail(frame(spark, texts)).collect()
    assert values(screened, "reason") == [expected_reason(t) for t in texts]


def test_samples_match_python(spark):
    check(spark, SAMPLES)


WORDS = st.sampled_from(cat.SENSITIVE_WORDS + cat.DDL_WORDS + ["x", "é", "ção", "9", "_", "-", "A", "Ñ"])
TEXT = st.lists(st.one_of(WORDS, WORDS.map(str.upper), st.sampled_from(SPACES)), max_size=8).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=40, max_size=60))
def test_random_texts_match_python(spark, texts):
    check(spark, texts)


def test_null_text_is_too_short(spark):
    row = ql.guardrail(frame(spark, [None])).first()
    assert (row.blocked, row.reason, row.message) == (True, "too_short", cat.TOO_SHORT_MESSAGE)
    assert ql.complexity(frame(spark, [None])).first().words == 0


def test_messages(spark):
    rows = ql.guardrail(frame(spark, ["drop isto já", "oi", "bom dia"])).collect()
    assert values(rows, "message") == [cat.BLOCKED_MESSAGE, cat.TOO_SHORT_MESSAGE, None]
    assert values(rows, "blocked") == [True, True, False]


def test_words_far_into_a_long_text_are_found(spark):
    long = "palavra " * 200_000
    rows = ql.guardrail(frame(spark, [long + "senha", long, long + "truncate."])).collect()
    assert values(rows, "reason") == ["sensitive", None, "ddl"]


@pytest.mark.parametrize(
    "words, level", [(1, "simple"), (40, "simple"), (41, "medium"), (80, "medium"), (81, "complex")]
)
def test_complexity_limits(spark, words, level):
    assert ql.complexity(frame(spark, ["p " * words])).first()[1:] == (words, level)


def test_generated_sql_is_cleaned(spark):
    generated = frame(spark, ["```sql\nSELECT 1\n```", " SELECT 2 ", "```SELECT 3```\n\n", None])
    cleaned = ql.clean_sql(generated, "text").collect()
    assert values(cleaned, "sql") == ["SELECT 1", "SELECT 2", "SELECT 3", None]


def test_long_inner_space_is_kept_and_fast(spark):
    text = "a" + " " * 200_000 + "b"
    assert frame(spark, [text]).select(tx.strip(F.col("text"))).first()[0] == text


def test_only_allowed_questions_become_prompts(spark):
    rows = ql.prompts(frame(spark, ["qual estado vende mais?", "drop tudo agora", "oi"]), "S").collect()
    assert [(r.id, r.prompt) for r in rows] == [(0, "Responda só com SQL.\nS\nPergunta: qual estado vende mais?\nSQL:")]
