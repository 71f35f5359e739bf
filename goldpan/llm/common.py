"""What the operators share: stored tables in the shared folder, and connected components over links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``, or below the warehouse if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{root.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``frame`` to the shared folder, with the writer's ``options``, and read it back: cuts lineage, and survives lost executors."""
    path = shared_path(frame.sparkSession, label)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def forget(frame: DataFrame) -> None:
    """Delete the files of a ``stored`` frame, once what was made of it is stored itself; nothing may read it any more."""
    files, spark = frame.inputFiles(), frame.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in files}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def checked(frame: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored narrow ``frame`` marked for broadcast if it has at most ``rows`` rows; larger ones join by shuffle."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): for the nodes of ``links`` the smallest node that each reaches; that node itself has no row.

    Alternates two star contractions until no link changes: every node's larger neighbours are tied to the smallest node
    it knows. Each round is one grouping and one join by node, and the number of rounds grows with the logarithm of the
    longest chain. A hub of a large group is one row per task before the shuffle of the grouping; its join is left
    to the adaptive split of skewed partitions. Null ends are ignored.
    """
    spark = links.sparkSession
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v"))
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        # large star: larger neighbours of each node go to the smallest node known to it
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of each node, and the node, go to the smallest
        least = moved.groupBy("u").agg(F.min("v").alias("m"))
        tied = moved.join(least, "u")
        moved = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        edges = stored(moved.distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
