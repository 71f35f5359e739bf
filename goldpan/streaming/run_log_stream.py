"""Log runs as they arrive: the same projection as the batch run log, over a stream of run files."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from goldpan.catalog import price_table
from goldpan.operators.question_log import log_rows
from goldpan.session import shared_dir


def read_runs(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet run files that land in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _checkpoint_for(spark: SparkSession, path: str, source: str = "") -> str:
    """A checkpoint folder of its own for every log and source, on the storage the cluster shares."""
    return shared_dir(spark, "run_log_stream", sha256(f"{source}\n{path}".encode()).hexdigest())


def append_runs(runs: DataFrame, path: str, checkpoint: str | None = None, source: str = "") -> StreamingQuery:
    """Append one log row per run to ``path``, by date, and stop when the waiting files are done.

    The projection keeps no state. The file sink with a checkpoint writes every run exactly once, also after a
    restart. The checkpoint must lie on storage all executors share; by default under ``spark.checkpoint.dir``.
    Name the ``source`` where several streams feed one log, so that each has a checkpoint of its own.
    """
    spark = runs.sparkSession
    return (
        log_rows(runs, price_table(spark))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or _checkpoint_for(spark, path, source))
        .partitionBy("dt")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
