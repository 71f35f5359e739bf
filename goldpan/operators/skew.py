"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sketch sees keys that hold more than about a thousandth of the rows; adaptive skew splitting evens out the
# rest. It returns at most MAX_HOT_KEYS keys, so the list is bounded by construction whatever the size of the data.
MAX_HOT_KEYS = 1000
SKETCH_ITEMS = 4096
ROWS_PER_PART = 200_000
# Sketches of splits are first merged in this many groups, so that the last task merges no more than these.
SKETCH_GROUPS = 64


def hot_keys(frame: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """(key, _parts) of the values with more than ``rows_per_part`` rows and the number of parts that brings each
    down to about that size; at most ``MAX_HOT_KEYS`` rows.

    One pass with mergeable frequency sketches, merged as a tree: each task sends one sketch to the group of its split, and each group
    one to the last task. No key is shuffled.
    """
    split = frame.select(F.col(key).alias("item"), (F.spark_partition_id() % SKETCH_GROUPS).alias("group"))
    groups = split.groupBy("group").agg(F.expr(f"approx_top_k_accumulate(item, {SKETCH_ITEMS})").alias("sketch"))
    # a constant key, since a task without groups has no sketch to send on
    whole = groups.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"))
    top = whole.select(F.expr(f"approx_top_k_estimate(sketch, {MAX_HOT_KEYS})").alias("top"))
    return (
        top.select(F.inline("top"))
        .filter((F.col("count") > rows_per_part) & F.col("item").isNotNull())
        .select(F.col("item").alias(key), F.ceil(F.col("count") / rows_per_part).cast("int").alias("_parts"))
    )


def join_spreading_hot_keys(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: str,
    keys_seen: DataFrame,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Inner join of ``facts`` with ``dimension``, which is unique on ``key``.

    Fact rows of a hot key are spread over its parts by a hash of ``spread_by``, and the dimension row of that key is
    repeated once per part; other rows keep part 0. The join is exact whichever keys are called hot, so the sketch
    only affects balance. ``keys_seen`` is a narrow scan with the keys of ``facts``.
    """
    # A hint is safe here: hot_keys returns at most MAX_HOT_KEYS rows.
    hot = F.broadcast(hot_keys(keys_seen, key, rows_per_part))
    parts = F.coalesce("_parts", F.lit(1))
    part = F.pmod(F.xxhash64(spread_by), parts).cast("int")
    left = facts.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    copies = F.sequence(F.lit(0), parts - 1)
    right = dimension.join(hot, key, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return left.join(right, [key, "_part"]).drop("_part")
