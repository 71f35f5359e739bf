"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Each permutation of the shingle values gives two signature values, the smallest and the largest, so that half as many
permutations are evaluated for a signature of the same length. Bands of the signature find candidates; exact sets decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.llm.common import checked, components, stored
from goldpan.llm.shingles import mix, shingles

PERMUTATIONS = 64
#: Signature values to a band: the minimum and the maximum of two permutations. A pair at a similarity of 0.8 shares no
#: band with a probability of (1 - 0.8**4)**32, below one in ten million.
BAND = 4
_RNG = np.random.default_rng(77)
_FACTOR = _RNG.integers(0, 1 << 63, (PERMUTATIONS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, (PERMUTATIONS, 1), dtype=np.uint64)
_BLOCK = 2048
#: Classes and shingles on either side of a block, about.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 20


def signature(values: np.ndarray) -> np.ndarray:
    """Minimum and maximum under every permutation, side by side."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(values), _BLOCK):
        moved = (values[None, at : at + _BLOCK] ^ _SHIFT) * _FACTOR
        np.minimum(low, moved.min(1), out=low)
        np.maximum(high, moved.max(1), out=high)
    return np.stack([low, high], 1).ravel()


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band of the signature; a key includes the number of its band."""
    rows = signature(values).reshape(-1, BAND)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for k in range(BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def described(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys and packed text; digest and keys are null where there are no words."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("packed", T.BinaryType()),
        ]
    )

    def describe(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            counts, digests, bands, packed = [], [], [], []
            for raw in batch.column(1):
                data = raw.as_py() or b""
                values = shingles(data, size)
                counts.append(len(values))
                digests.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                bands.append(band_keys(values) if len(values) else None)
                packed.append(pack(data) if len(values) else None)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary())]
            columns += [pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(describe, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets overlap in at least ``percent`` of their union."""
    left = texts.select(F.col("rep").alias("a"), F.col("packed").alias("pa"))
    right = texts.select(F.col("rep").alias("b"), F.col("packed").alias("pb"))
    kind = pairs.schema["a"].dataType

    def compare(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        last, known = None, None
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x = x.as_py()
                if x != last:
                    last, known = x, shingles(unpack(x), size)
                other = shingles(unpack(y.as_py()), size)
                both = len(np.intersect1d(known, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(known) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "pa", "pb")
    return joined.mapInArrow(compare, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def compared(group: pa.Table, size: int, percent: int) -> pa.Table:
    """Links (a, b) between the classes of the two sides of a block that are not connected yet.

    Exact overlaps of all sets at once: only shingles of several sets count for an overlap, as columns of a product.
    """
    unpack = zstandard.ZstdDecompressor().decompress
    sets = [shingles(unpack(x.as_py()), size) for x in group.column("packed")]
    left = np.array([x.as_py() for x in group.column("left")], bool)
    names, tree = np.unique(np.array(group.column("tree").to_pylist(), object), return_inverse=True)
    lengths = np.array([len(x) for x in sets])
    values, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), lengths)
    shared = often[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    both = np.zeros((left.sum(), (~left).sum()), np.float32)
    for at in range(0, int(column.max(initial=-1)) + 1, _BLOCK):
        part = (column >= at) & (column < at + _BLOCK)
        has = np.zeros((len(sets), _BLOCK), np.float32)
        has[row[part], column[part] - at] = 1
        both += has[left] @ has[~left].T
    total = lengths[left][:, None] + lengths[~left][None, :] - both
    linked = (100 * both >= percent * total) & (tree[left][:, None] != tree[~left][None, :])
    i, j = np.nonzero(linked)
    ends = np.unique(np.sort(np.stack([tree[left][i], tree[~left][j]], 1), 1), axis=0)
    kind = group.schema.field("tree").type
    return pa.table({"a": pa.array(names[ends[:, 0]].tolist(), kind), "b": pa.array(names[ends[:, 1]].tolist(), kind)})


def between_blocks(star: DataFrame, root: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among the classes around each hub ``a``: those not tied to the hub against all, in blocks of bounded size."""
    tied = root.select(F.col("node").alias("rep"), "root")
    group = star.select("a", F.col("b").alias("rep"), "n")
    group = group.union(star.groupBy("a").agg(F.max("m")).select("a", F.col("a").alias("rep"), F.col("max(m)")))
    group = group.join(tied, "rep", "left").withColumn("tree", F.coalesce("root", "rep")).drop("root")
    hubs = tied.select(F.col("rep").alias("a"), F.col("root").alias("hub_root"))
    group = group.join(hubs, "a", "left").withColumn("loose", F.col("tree") != F.coalesce("hub_root", "a")).drop("hub_root")
    parts = lambda when: F.greatest(
        F.ceil(F.count(F.when(when, 1)) / BLOCK_CLASSES), F.ceil(F.sum(F.when(when, F.col("n"))) / BLOCK_SHINGLES)
    ).cast("int")
    many = group.groupBy("a").agg(
        parts(F.col("loose")).alias("across"), parts(F.lit(True)).alias("down"), F.count(F.lit(1)).alias("members"), F.count_if("loose").alias("free")
    )
    group = group.join(many.where("free > 0 AND members > 2").select("a", "across", "down"), "a")
    cell = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), n).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    one = group.where("loose").select("a", cell(F.col("across"), 1).alias("i"), numbers(F.col("down")).alias("j"), "rep", "tree", F.lit(True).alias("left"))
    two = group.select("a", numbers(F.col("across")).alias("i"), cell(F.col("down"), 2).alias("j"), "rep", "tree", F.lit(False).alias("left"))
    cells = one.union(two).join(texts, "rep")
    kind = star.schema["a"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return cells.groupBy("a", "i", "j").applyInArrow(lambda group: compared(group, size, percent), schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents are linked if their shingle sets overlap in at least ``percent`` of the union; component_id is the smallest id
    that links reach, and the document with that id is kept. Null or wordless texts have no shingles and link with
    nothing. Rows that share an id are one document; rows without an id link with nothing (component_id null, kept true). Further columns of
    ``docs`` are ignored, and an empty table gives an empty result.

    Equal sets become one class first, so copies cost one row per task. In a bucket, every class is compared with
    the smallest one, the hub. Classes that do not link with their hub are then compared with all classes around it, block by
    block, so no pair of a bucket is lost and a group of near copies does not become all its pairs.
    """
    found = stored(described(docs, id_col, text_col, size), "signatures")
    classes = found.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    known = stored(
        found.drop("packed", "bands").join(classes, "digest", "left").select("doc_id", "n_shingles", "rep"), "classes"
    )
    reps = found.join(classes, (found.digest == classes.digest) & (found.doc_id == classes.rep))
    band = stored(reps.select(F.explode("bands").alias("band"), "rep", F.col("n_shingles").alias("n")), "bands")

    ends = band.groupBy("band").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("band", "a")
    ends = checked(stored(ends, "hubs"))
    star = band.join(ends, "band").where("a < rep").select("a", F.col("rep").alias("b"), "n").distinct()
    lengths = band.select(F.col("rep").alias("a"), F.col("n").alias("m")).distinct()
    star = stored(star.join(lengths, "a"), "pairs")
    several = checked(stored(star.select(F.col("a").alias("rep")).union(star.select("b")).distinct(), "classes"))
    texts = found.select("doc_id", "packed").join(several, F.col("doc_id") == F.col("rep"))
    texts = stored(texts.groupBy("rep").agg(F.first("packed").alias("packed")), "texts")
    close = star.where(f"100 * least(m, n) >= {percent} * greatest(m, n)").select("a", "b")
    links = stored(confirmed(close, texts, size, percent), "confirmed")
    more = stored(between_blocks(star, components(links, "a", "b"), texts, size, percent), "confirmed")
    shared = known.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    several_sets = known.join(shared, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    root = components(links.union(more).union(several_sets), "a", "b")

    component = F.coalesce("root", "rep", "doc_id")
    return known.join(root, known.rep == root.node, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
