"""Physical plans: pruned scans, pushed filters, and the number of shuffles once nothing is small enough to broadcast."""

from __future__ import annotations

import re

import pytest

from goldpan.plans.registry import queries

QUERIES = queries()

# Shuffles per query with broadcasting off. Map-only jobs have none.
SHUFFLES = {
    "silver_items": 1,
    "silver_reviews": 1,
    "silver_delivered": 2,
    "guardrail": 0,
    "complexity": 0,
    "prompt_table": 0,
    "sql_clean": 0,
    "answer_status": 0,
    "grounding_table": 1,
}
NO_CROSS = ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "Scan ExistingRDD")


def plan(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plan as if every table were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_joins_and_no_python(large, folder, name):
    text = plan(large, folder, name)
    assert not [bad for bad in NO_CROSS if bad in text]


@pytest.mark.parametrize("name", SHUFFLES)
def test_shuffles(large, folder, name):
    assert len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepart", plan(large, folder, name))) == SHUFFLES[name]


def test_line_items_are_scanned_and_shuffled_once_for_gold(large, folder):
    text = plan(large, folder, "gold_state")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>", text)
    columns = sorted(schema for _, schema in scans)
    assert len(scans) == 6
    assert "l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_shipdate:timestamp_ntz" in columns
    assert "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz" in columns
    assert "EqualTo(o_orderstatus,F)" in text


def test_class_totals_skip_reviews_and_reuse_state_sums(large, folder):
    text = plan(large, folder, "gold_class")
    assert "events.parquet" not in text
    assert text.count("Exchange hashpartitioning") == plan(large, folder, "gold_state").count("Exchange hashpartitioning")


def test_top_k_needs_no_full_sort(spark, folder):
    for name in ("top_states", "q_top_delivery", "q_top_ticket", "bounded_result", "q_region_late"):
        assert "TakeOrderedAndProject" in plan(spark, folder, name)


def test_result_rows_are_limited_before_the_shuffle(spark, folder):
    text = plan(spark, folder, "grounding_table")
    partial, exchange = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning")
    assert partial > exchange and "Partial" in text[partial:]


def test_constant_tables_are_local_and_broadcast(spark, folder):
    text = plan(spark, folder, "run_cost")
    assert "BroadcastHashJoin" in text and "LocalTableScan" in text


def test_chat_text_is_read_and_shuffled_once(large, folder):
    text = plan(large, folder, "chat_latest")
    assert len(re.findall(r"ReadSchema: struct<[^>]*text:string", text)) == 1
    # the sort by text needs no exchange but that of its window; all others move turns, counts or cuts
    window = text.index("Window [row_number()")
    below = text[window : text.index("FileScan", window)]
    assert below.count("Exchange hashpartitioning(place") == 1 and below.count("Exchange") - below.count("BroadcastExchange") == 1
