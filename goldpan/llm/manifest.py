"""A content-addressed Merkle manifest of a table, and proofs for its rows by descent from the root.

Every row is a leaf. The leaves of a source, and then the roots of the sources, are combined sixteen at a time up to one root. Each
combination is stored once as a record: digest, and the digests it was made of. A proof needs nothing but these records. Requests
start at the root with the rank of their leaf, whose digits name the child to take at each record; the children not taken are
kept as the segments of the path, which the proof holds in reverse, from the leaf upwards. Requests below one record
travel as one row, so no step joins more rows than there are records, and the root is asked once, not once a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.llm.common import stored

FAN = 16
#: Records with equal digests (rows that repeat) are kept once per this remainder of their place, so that joins on them spread.
SHARDS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*fields: Column) -> Column:
    """SHA-256 over fields, each its length in bytes, a colon and its value, or a dash where it is null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: group, idx, n, leaf and the columns given; ``trees``: group, height, digest; ``store``: digest, shard, children, level."""

    leaves: DataFrame
    trees: DataFrame
    store: DataFrame


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``idx``, their place from 0 in their group in the given order, and ``n``, the size of the group.

    No task orders a whole group: rows are dealt by range, ties by their place in the input; a range is numbered in its task, and the
    counts of the ranges before are added.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("_tie")
    dealt = stored(dealt.withColumn("_place", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_place", 33)), "ranges")
    counts = dealt.groupBy(group, "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("n", F.sum("_n").over(whole)).drop("_n")
    placed = dealt.join(counts, [group, "_range"])
    return placed.withColumn("idx", F.col("_place") - F.col("_first") + F.col("_before")).drop("_place", "_range", "_first", "_before")


def build(leaves: DataFrame, label: str) -> Manifest:
    """The trees over ``leaves`` (group, idx, n, leaf, ...): a level is a grouping of the one below, a sixteenth of its rows.

    ``leaves`` is stored by the caller, since every level and the proofs read it.
    """
    nodes, roots, records, level = leaves.select("group", "idx", "n", F.col("leaf").alias("digest")), [], [], 0
    while True:
        # a group of one node left is done
        roots.append(nodes.where("n = 1").select("group", F.lit(level).alias("height"), "digest"))
        nodes = nodes.where("n > 1")
        level += 1
        parent = F.shiftright("idx", 4).alias("idx")
        made = nodes.groupBy("group", parent, ((F.col("n") + FAN - 1) / FAN).cast("long").alias("n"))
        made = made.agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("children"))
        made = stored(made.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), f"{label}-{level}")
        if made.isEmpty():
            break
        shard = F.pmod("idx", F.lit(SHARDS)).cast("int").alias("shard")
        records.append(made.groupBy("digest", shard).agg(F.first("children").alias("children")).withColumn("level", F.lit(level)))
        nodes = made.select("group", "idx", "digest", "n")
    trees = roots[0]
    for more in roots[1:]:
        trees = trees.union(more)
    trees = stored(trees, f"{label}-trees")
    empty = leaves.sparkSession.createDataFrame([], "digest string, shard int, children array<string>, level int")
    store = empty
    for more in records:
        store = store.union(more.select(empty.columns))
    return Manifest(leaves, trees, stored(store, f"{label}-store"))


def _segment(children: Column, at: Column) -> Column:
    """The children not taken: those before the one taken and those behind it, each as one text."""
    joined = lambda part: F.array_join(part, "")
    return F.struct(joined(F.slice(children, F.lit(1), at)).alias("before"), joined(F.slice(children, at + 2, F.lit(FAN))).alias("after"))


def descend(starts: DataFrame, store: DataFrame, requests: DataFrame, until: int, *kept: str) -> DataFrame:
    """(group, idx, digest, path, kept columns) at level ``until`` of all trees with requested leaves there.

    ``starts`` has group, height, digest, path and the columns to keep of each tree's root, ``requests`` group and idx of leaves. Trees lower than
    ``until`` give no row. The path holds one segment a level, the root's first.
    """
    top = starts.agg(F.max("height")).first()[0] or 0
    columns = ["group", "idx", "digest", "path", *kept]
    starts = starts.withColumn("idx", F.lit(0).cast("long"))
    here = starts.where(F.lit(False)).select(columns)
    for level in range(top, until - 1, -1):
        here = here.union(starts.where(F.col("height") == level).select(columns))
        if level == until:
            break
        opened = here.withColumn("shard", F.pmod("idx", F.lit(SHARDS)).cast("int"))
        opened = opened.join(store.where(F.col("level") == level).drop("level"), ["digest", "shard"])
        taken = opened.select("group", F.col("idx").alias("above"), "path", "children", *kept, F.posexplode("children").alias("at", "digest"))
        taken = taken.select(
            "group",
            (F.col("above") * FAN + F.col("at")).alias("idx"),
            "digest",
            F.concat("path", F.array(_segment(F.col("children"), F.col("at")))).alias("path"),
            *kept,
        )
        wanted = requests.select("group", F.shiftright("idx", 4 * (level - 1)).alias("idx")).distinct()
        here = taken.join(wanted, ["group", "idx"], "left_semi").select(columns)
        here = stored(here, f"descent-{level}")
    return here


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source", **more: Column) -> tuple[Manifest, Manifest]:
    """Trees of all sources, and the tree over their roots, whose only group is 0.

    A leaf is the digest of ``fields``. Per source, leaves ascend by id, then digest; null ids and the null source come first. ``more`` names
    further columns that the leaves carry. Rows that repeat are leaves of their own; further columns of ``docs`` are ignored.
    """
    rows = docs.select(F.struct(F.col(source_col).alias("source")).alias("group"), F.col(id_col).alias("doc_id"), digest(*map(F.col, fields)).alias("leaf"), *[c.alias(n) for n, c in more.items()])
    # stored first, since dealing by range reads its input twice
    lower = build(stored(numbered(stored(rows, "digests"), "group", "doc_id", "leaf"), "leaves"), "tree")
    roots = lower.trees.select(F.lit(0).alias("group"), F.col("group").alias("source"), F.col("digest").alias("leaf"), "height")
    return lower, build(stored(numbered(roots, "group", "source"), "sources"), "top")


def opened(lower: Manifest, upper: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves (group, idx; all by default) with subroot, root and ``path``, segments of siblings from the root down."""
    asked = lower.leaves if requests is None else requests
    trees = lower.trees.join(asked.select("group").distinct(), "group", "left_semi") if requests is not None else lower.trees
    sources = upper.leaves.select(F.col("source").alias("group"), "idx", "height").join(trees.select("group"), "group", "left_semi")
    none = F.array().cast("array<struct<before:string,after:string>>")
    start = upper.trees.select("group", "height", "digest", none.alias("path"))
    found = descend(start, upper.store, sources.select(F.lit(0).alias("group"), "idx"), 0)
    root = upper.trees.select(F.col("group").alias("top"), F.col("digest").alias("root"))
    found = found.withColumnRenamed("group", "top").join(sources, "idx").join(root, "top")
    starts = stored(found.select("group", "height", "digest", "path", F.col("digest").alias("subroot"), "root"), "subroots")
    kept = ["subroot", "root"]
    runs = descend(starts, lower.store, asked.select("group", "idx"), 1, *kept)
    columns = [c for c in lower.leaves.columns if c not in ("group", "idx", "n")]
    leaves = lower.leaves if requests is None else lower.leaves.join(requests.select("group", "idx").distinct(), ["group", "idx"], "left_semi")
    # leaves of a run join as one row, so that a path is moved once per run
    items = leaves.groupBy("group", F.shiftright("idx", 4).alias("idx")).agg(F.collect_list(F.struct((F.col("idx") % FAN).cast("int").alias("at"), *columns)).alias("items"))
    records = lower.store.where("level = 1").drop("level")
    last = runs.withColumn("shard", F.pmod("idx", F.lit(SHARDS)).cast("int")).join(records, ["digest", "shard"])
    last = last.join(items, ["group", "idx"]).select("path", "children", *kept, F.explode("items").alias("item"))
    # the digest that the descent reaches is the leaf's own
    last = last.where(F.get("children", F.col("item.at")) == F.col("item.leaf"))
    last = last.select("item.*", *kept, F.concat("path", F.array(_segment(F.col("children"), F.col("item.at")))).alias("path")).drop("at")
    lone = starts.where("height = 0").join(leaves.where("n = 1").drop("idx"), "group")
    return last.select(*columns, *kept, "path").union(lone.select(*columns, *kept, "path"))


def proven(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    proof_sha256 is the digest of all siblings from the leaf upwards; folded_root is computed from them and the leaf, or
    where the condition ``tampered`` holds, from the leaf as it would be had the A-Z of its text been lower-cased; verified says whether it is the root. Nulls are values
    of their own, rows that repeat are leaves of their own, an empty table gives an empty result, and further columns are ignored.
    """
    if tampered is None:
        tampered = F.lit(False)
    changed = [F.translate("text", _CAPITALS, _CAPITALS.lower()) if f == "text" else F.col(f) for f in FIELDS]
    lower, upper = manifest(docs, tampered=F.when(tampered, digest(*changed)))
    found = opened(lower, upper)
    proof = F.aggregate(F.reverse("path"), F.lit(""), lambda text, x: F.concat(text, x["before"], x["after"]))
    folded = F.aggregate(F.reverse("path"), F.coalesce("tampered", "leaf"), lambda own, x: F.sha2(F.concat(x["before"], own, x["after"]), 256))
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
