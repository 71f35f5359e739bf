"""Gold rows from the catalog table, or from the last published snapshot, with their provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.catalog import GOLD_SCHEMA
from goldpan.sources.publication import published, readable


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A published gold snapshot, read with the gold schema."""
    return spark.read.schema(GOLD_SCHEMA).parquet(path)


def _live(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.table(table) if spark.catalog.tableExists(table) else None


def _marked(rows: DataFrame, source: str, reason: str | None) -> DataFrame:
    return rows.withColumns({"source": F.lit(source), "reason": F.lit(reason).cast("string")})


def gold_or_snapshot(spark: SparkSession, table: str, snapshot: DataFrame) -> DataFrame:
    """The gold table, or ``snapshot`` if the table is missing, unreadable or empty.

    ``source`` says which one it was, so old figures are never shown as live ones, and ``reason`` why the snapshot was
    taken: missing, unreadable or empty; null for the table.
    """
    live, reason = readable(lambda: _live(spark, table))
    return _marked(snapshot, "snapshot", reason) if live is None else _marked(live, "table", None)


def published_gold(spark: SparkSession, root: str, snapshot: DataFrame, name: str = "gold_state") -> DataFrame:
    """Gold of the current version below ``root``, else of the newest earlier one that can be read, else ``snapshot``.

    ``source`` is ``table`` for the current version and ``snapshot`` for anything older; ``reason`` says what was wrong with the
    current one.
    """
    rows, live, reason = published(spark, root, name)
    if rows is None:
        return _marked(snapshot, "snapshot", reason)
    return _marked(rows, "table" if live else "snapshot", reason)
