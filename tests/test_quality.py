"""Data-quality report and ad-hoc SQL."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from goldpan.operators import adhoc, quality


def test_report(spark):
    frame = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "a")], "k int, v string"
    )
    checks = [
        quality.not_null("t", "k"),
        quality.not_null("t", "v"),
        quality.accepted_values("t", "v", "a", "b"),
        quality.unique("t", "k"),
        quality.unique("t", "v"),
        quality.unique("t", "k", "v"),
        quality.not_null("empty", "k"),
        quality.unique("empty", "k"),
    ]
    report = quality.run_checks({"t": frame, "empty": frame.filter("false")}, checks)
    assert report.columns == ["table", "column", "test", "failures", "passed"]
    assert {(r.table, r["column"], r.test): (r.failures, r.passed) for r in report.collect()} == {
        ("t", "k", "not_null"): (2, False),
        ("t", "v", "not_null"): (1, False),
        ("t", "v", "accepted_values"): (1, False),
        ("t", "k", "unique"): (1, False),
        ("t", "v", "unique"): (1, False),
        ("t", "k,v", "unique"): (0, True),
        ("empty", "k", "not_null"): (0, True),
        ("empty", "k", "unique"): (0, True),
    }


@pytest.fixture(scope="module")
def view(spark):
    spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 3).alias("st")).createOrReplaceTempView("gold_v")
    return "gold_v"


def test_select_keeps_order_and_limit(spark, view):
    rows = adhoc.run_select(spark, f"SELECT n, st FROM {view} ORDER BY n DESC, st;", 5).collect()
    assert [r.n for r in rows] == [99, 98, 97, 96, 95]
    assert adhoc.run_select(spark, f"WITH w AS (SELECT * FROM {view}) SELECT * FROM w -- all").count() == 20


@pytest.mark.parametrize(
    "sql",
    [
        "DROP VIEW gold_v",
        "1) q; DROP VIEW gold_v; SELECT * FROM (SELECT 1",
        "SELECT 1; DROP VIEW gold_v",
        "CREATE OR REPLACE TEMP VIEW gold_v AS SELECT 1 AS n",
        "INSERT INTO gold_v VALUES (1, 2)",
        "SHOW TABLES",
        "SELECT no_such_column FROM gold_v",
        "SELECT 1 /* open",
        "SELECT TRANSFORM(n) USING 'cat' AS (x) FROM gold_v",
        "SELECT TRANSFORM(n) using/**/ 'cat' AS (x) FROM gold_v",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT `java_method` ('java.lang.System', 'exit', 0)",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`",
        "SELECT * FROM csv . `file:/etc/hostname`",
        "SELECT * FROM parquet /* a file */ . `/root/testdata/sf0.001/nation.parquet`",
        "SELECT * FROM parquet.`nation.parquet`",
        "SELECT (SELECT count(*) FROM parquet.`nation.parquet`) FROM gold_v",
        "SELECT n FROM gold_v WHERE n IN (SELECT n_nationkey FROM parquet.`nation.parquet`)",
        "WITH a AS (SELECT * FROM text.`/etc/hostname`) SELECT * FROM a",
        "SELECT * FROM IDENTIFIER('parquet.`/root/testdata/sf0.001/nation.parquet`')",
        "SELECT n FROM gold_v WHERE n IN (SELECT n_nationkey FROM IDENTIFIER('parquet.`nation.parquet`'))",
        "WITH a AS (SELECT * FROM IDENTIFIER('text.`/etc/hostname`')) SELECT * FROM a",
        "SELECT n FROM gold_v UNION ALL SELECT 1 FROM IDENTIFIER('text.`/etc/hostname`')",
        "SELECT * FROM IDENTIFIER('range')(3)",
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
        "SELECT (SELECT IDENTIFIER('java_method')('java.lang.System', 'getProperty', 'user.home')) FROM gold_v",
        "WITH a AS (SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'x') AS x) SELECT * FROM a",
        "SELECT n FROM gold_v UNION ALL SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'x')",
        "SELECT max(IDENTIFIER('n')) FROM gold_v",
        "SELECT n FROM gold_v LATERAL VIEW IDENTIFIER('explode')(array(n)) t AS e",
        "SELECT system.builtin.reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT n FROM gold_v ORDER BY reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT sum(reflect('java.lang.Integer', 'parseInt', '1')) OVER (PARTITION BY st) FROM gold_v",
        "SELECT input_file_name() FROM gold_v",
        "SELECT current_user",
        "SELECT current_database()",
        "SELECT raise_error('x')",
        "SELECT * FROM spark_catalog.default.gold_v",
        "SELECT * FROM gold_v VERSION AS OF 1",
        "TABLE no_such_view",
        "SELECT * FROM python_worker_logs()",
        "SELECT own_function(n) FROM gold_v",
        "",
    ],
)
def test_anything_but_one_query_is_refused(spark, view, sql):
    spark.udf.register("own_function", lambda n: n)
    frame, error = adhoc.try_select(spark, sql)
    assert frame is None and len(error) > 0
    with pytest.raises((PySparkException, adhoc.UnsafeQuery)):
        adhoc.run_select(spark, sql)
    assert spark.table(view).count() == 100


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT a.n FROM gold_v a JOIN gold_v b USING (n) WHERE a.st = 1",
        "SELECT transform(array(n), x -> x + 1) FROM gold_v",
        "SELECT `gold_v`.`n` FROM gold_v",
        "SELECT n FROM gold_v UNION ALL SELECT st FROM gold_v",
        "SELECT n, 'paid using card' AS note FROM gold_v",
        "WITH a AS (SELECT n FROM gold_v), b AS (SELECT n FROM a) SELECT * FROM b",
        "SELECT n FROM gold_v WHERE n IN (SELECT st FROM gold_v) AND EXISTS (SELECT 1 FROM gold_v v WHERE v.n = gold_v.n)",
        "SELECT 1) q UNION ALL SELECT n FROM (SELECT n FROM gold_v",
        "SELECT st, count(DISTINCT n) AS c, round(avg(n), 1) FROM gold_v GROUP BY st HAVING count(*) > 1 ORDER BY c DESC, 1 LIMIT 5 OFFSET 1",
        "SELECT n, rank() OVER w, sum(n) OVER (PARTITION BY st ROWS 1 PRECEDING) FROM gold_v WINDOW w AS (ORDER BY n)",
        "SELECT CASE WHEN n > 1 THEN 'a' ELSE 'b' END, cast(n AS double) / 2, substring('abc' FROM 1 FOR 2), n BETWEEN 1 AND 2 FROM gold_v",
        "SELECT st, n FROM gold_v GROUP BY GROUPING SETS ((st, n), (st))",
        "SELECT * FROM gold_v PIVOT (count(n) FOR st IN (0, 1))",
        "SELECT n, e FROM gold_v LATERAL VIEW explode(array(n, st)) t AS e",
        "SELECT * FROM VALUES (1, 2), (3, 4) AS t(a, b)",
        "WITH RECURSIVE r(k) AS (SELECT 1 UNION ALL SELECT k + 1 FROM r WHERE k < 5) SELECT * FROM r",
        "SELECT x.* FROM gold_v, LATERAL (SELECT gold_v.n + 1 AS k) x",
        "SELECT n FROM gold_v TABLESAMPLE (100 PERCENT)",
        "SELECT n FROM gold_v EXCEPT SELECT st FROM gold_v",
    ],
)
def test_any_single_query_runs_within_the_limit(spark, view, sql):
    frame, error = adhoc.try_select(spark, sql, 7)
    assert error == "" and 0 < frame.count() <= 7


def test_accepted_query_has_no_error(spark, view):
    frame, error = adhoc.try_select(spark, f"SELECT max(n) AS top FROM {view}")
    assert (frame.first().top, error) == (99, "")


def test_bounded_is_a_top_k(spark, view):
    frame = adhoc.bounded(spark.table(view), 3, F.desc("st"), "n")
    assert [r.n for r in frame.collect()] == [2, 5, 8]
    assert "TakeOrderedAndProject" in frame._jdf.queryExecution().executedPlan().toString()
