"""Sinks: layer files, catalog tables, bucketed bronze tables and the append-only run log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators.skew import hot_keys


# Any columnar format the session can read and write will do, such as a table format whose jars are installed.
COLUMNAR = "parquet"


def write_layer(frame: DataFrame, path: str, fmt: str = COLUMNAR) -> DataFrame:
    """Replace a stored layer table and read it back, which also cuts the lineage at durable files."""
    frame.write.mode("overwrite").format(fmt).save(path)
    return frame.sparkSession.read.format(fmt).load(path)


def write_bronze(
    tables: dict[str, DataFrame], folder: str, fmt: str = COLUMNAR, keys: dict[str, str] | None = None, buckets: int = 0
) -> dict[str, DataFrame]:
    """Store raw tables in columns, so text files are parsed once and later scans can prune columns.

    With ``buckets``, tables named in ``keys`` are bucketed on their key, so that grouping and joining on it need no exchange. A bucket is
    read by one task; where a key alone fills more than an average one, the table is stored without buckets, and grouping on the
    key combines map-side as usual.
    """
    out = {}
    for name, frame in tables.items():
        key, path = (keys or {}).get(name) if buckets else None, f"{folder}/{name}"
        # the sketch reports keys above about a thousandth of the rows only, and such keys fill a bucket of a thousand or more
        full = key and hot_keys(frame, key, max(1, frame.count() // min(buckets, 1000)))
        out[name] = write_layer(frame, path, fmt) if key is None or not full.isEmpty() else write_bucketed_layer(frame, path, key, buckets, fmt)
    return out


def write_bucketed_layer(frame: DataFrame, path: str, key: str, buckets: int, fmt: str = COLUMNAR) -> DataFrame:
    """Replace a stored layer table by one bucketed on ``key`` and read it back as such.

    Spark knows buckets by catalog tables only, so the files are read through an entry that is dropped at once; the returned frame goes on
    knowing the buckets, and readers of the path see plain files.
    """
    spark, table = frame.sparkSession, f"goldpan_layer_{uuid.uuid4().hex}"
    frame.write.mode("overwrite").format(fmt).option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    stored = spark.table(table)
    stored.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {table}")
    return stored


def publish(frame: DataFrame, table: str, fmt: str = COLUMNAR) -> DataFrame:
    """Replace a catalog table, such as the gold table that dashboards scan and ad-hoc SQL reads."""
    frame.write.mode("overwrite").format(fmt).saveAsTable(table)
    return frame.sparkSession.table(table)


def write_bucketed(frame: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Save a bronze table bucketed on ``key``. Tables with the same buckets join and group on it without a shuffle."""
    frame.write.mode("overwrite").format(COLUMNAR).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return frame.sparkSession.table(table)


def new_log_rows(rows: DataFrame, logged: DataFrame, key: str = "run_id") -> DataFrame:
    """The ``rows`` whose ``key`` and date ``logged`` does not hold, one of each key and date.

    Only the logged dates that ``rows`` touch are read: their folders are chosen at run time from the dates of ``rows``, which are
    at most one row per day.
    """
    days = rows.select("dt").distinct()
    touched = logged.select(key, "dt").join(F.broadcast(days), "dt", "left_semi")
    return rows.dropDuplicates([key, "dt"]).join(touched, [key, "dt"], "left_anti").select(rows.columns)


def append_run_log(rows: DataFrame, path: str, key: str | None = "run_id") -> None:
    """Append log rows, one folder per date. Rows that the log holds already, by ``key`` and date, are not appended again, so that a job
    that failed half-way can be run anew. Without a ``key``, all rows are appended.

    The rebalance hint lets adaptive execution merge small dates into few files and split a date that holds a large
    share of the rows over several tasks.
    """
    spark = rows.sparkSession
    if key is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
            rows = new_log_rows(rows, spark.read.schema(rows.schema).parquet(path), key)
        else:
            rows = rows.dropDuplicates([key, "dt"])
    rows.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(path)


def read_run_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The run log; filters on ``dt`` prune its folders."""
    return spark.read.schema(schema).parquet(path)
