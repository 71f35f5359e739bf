"""A refresh over bronze tables that are bucketed on the order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from goldpan.plans import medallion
from goldpan.sources import star_tables as star
from goldpan.sources.writers import write_bronze, write_bucketed_layer


def exchanges_on(frame, column):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if f"Exchange hashpartitioning({column}" in line]


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def bucketed(spark, folder, path):
    tables = star.bronze(spark, folder)
    return tables, tables | write_bronze({t: tables[t] for t in star.BUCKET_KEYS}, path, keys=star.BUCKET_KEYS, buckets=4)


def test_no_exchange_on_the_order(spark, folder, tmp_path, no_broadcast):
    tables, bronze = bucketed(spark, folder, str(tmp_path / "bronze"))
    plain, model = medallion.from_star_tables(tables), medallion.from_star_tables(bronze)
    assert exchanges_on(plain.per_order["line_facts"], "order_id") and exchanges_on(plain.facts, "order_id")
    assert not exchanges_on(model.per_order["line_facts"], "order_id")
    assert not exchanges_on(model.facts, "order_id") and not exchanges_on(model.facts, "l_orderkey") and not exchanges_on(model.facts, "o_orderkey")
    stored = model.stored(str(tmp_path / "lake"), buckets=4)
    for frame in (stored.facts, stored.delivered(), stored.enriched()):
        assert not exchanges_on(frame, "order_id")


def test_rows_equal_those_of_a_plain_refresh(spark, folder, tmp_path):
    tables, bronze = bucketed(spark, folder, str(tmp_path / "bronze"))
    plain = medallion.refresh(medallion.from_star_tables(tables), str(tmp_path / "plain"))
    made = medallion.refresh(medallion.from_star_tables(bronze), str(tmp_path / "made"), buckets=4)
    assert set(plain) == set(made)
    for name in plain:
        assert made[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(made[name]).isEmpty(), name
    again = spark.read.parquet(str(tmp_path / "made" / "line_facts"))
    assert again.count() == tables["lineitem"].select("l_orderkey").distinct().count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("goldpan_layer_")]


def test_a_key_that_fills_a_bucket_is_not_bucketed(spark, tmp_path):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    hot = write_bronze({"t": rows}, str(tmp_path / "hot"), keys={"t": "k"}, buckets=16)["t"]
    even = write_bronze({"t": rows.where("k <> 7")}, str(tmp_path / "even"), keys={"t": "k"}, buckets=16)["t"]
    assert exchanges_on(hot.groupBy("k").count(), "k") and not exchanges_on(even.groupBy("k").count(), "k")
    assert hot.count() == 30_000 and even.count() == 20_000 - rows.where("k = 7 AND v % 3 <> 0").count()


def test_bucketed_layer_is_replaced_and_takes_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (1, "a")], "k long, v string")
    write_bucketed_layer(rows, path, "k", 3)
    assert sorted(write_bucketed_layer(rows, path, "k", 3).collect(), key=str) == sorted(rows.collect(), key=str)
    assert write_bronze({"e": rows.limit(0)}, str(tmp_path), keys={"e": "k"}, buckets=3)["e"].collect() == []
