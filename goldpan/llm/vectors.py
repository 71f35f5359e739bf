"""Near-duplicate vectors by binary codes of a random rotation.

A unit vector is rotated and kept as signs, with the correction factor between itself and its signs, and four bits a component for the times it
is on the other side of a comparison. Levels of one times signs of another, over the factor of the latter, estimate their cosine without bias, with a known spread.
Only codes are sent to where pairs meet; vectors follow for rows that have a pair there whose upper bound reaches the threshold, and those pairs are computed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from goldpan.llm.common import checked, components, stored

#: Classes that one bucket holds by chance, and the share of links at the threshold that no bucket may catch.
BUCKET, MISSED = 128, 1e-7
#: Rows on either side of a block of a large bucket.
BLOCK = 1024
#: Half of the levels that a component of a code has.
LEVELS = 8
#: Standard deviations of the estimate that the bounds allow for.
DEVIATIONS = 5.0


@lru_cache(maxsize=64)
def rotation(size: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(9000 + number).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def tables(rows: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket's key, and number of keys, for so many rows: chance buckets stay small, and links are caught."""
    same = 1 - math.acos(threshold) / math.pi
    bits = max(6, round(math.log2(max(2, rows) / BUCKET)))
    return bits, math.ceil(math.log(MISSED) / math.log(1 - same**bits))


def keys(unit: np.ndarray, bits: int, count: int) -> np.ndarray:
    """Bucket keys by the signs of rotated vectors; each key also tells its number."""
    size, out, columns, number = unit.shape[1], [], np.empty((len(unit), 0), bool), 1
    for k in range(count):
        while columns.shape[1] < bits:
            columns = np.hstack([columns, unit @ rotation(size, number) > 0])
            number += 1
        code = columns[:, :bits].astype(np.uint64) @ (np.uint64(1) << np.arange(bits, dtype=np.uint64))
        out.append((code * np.uint64(4096) + np.uint64(k)) ^ np.uint64(size << 50))
        columns = columns[:, bits:]
    return np.stack(out, 1).view(np.int64)


def coded(unit: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Codes of unit vectors, two components a byte, with the size of the largest component and the correction factor of each."""
    size = unit.shape[1]
    turned = unit @ rotation(size, 0)
    scale = np.abs(turned).max(1)
    level = np.clip(np.floor((turned / scale[:, None] + 1) * LEVELS), 0, 2 * LEVELS - 1).astype(np.uint8)
    level = np.pad(level, ((0, 0), (0, size % 2)))
    signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(size)
    return [row.tobytes() for row in level[:, ::2] << 4 | level[:, 1::2]], scale, np.einsum("ij,ij->i", turned, signs)


def upper(code: np.ndarray, size: int, scale: np.ndarray, factor: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bounds of the cosines between ``left`` and ``right`` rows, from their codes (a row of bytes each)."""
    level = np.stack([code >> 4, code & 15], 2).reshape(len(code), -1)[:, :size].astype(np.float32)
    signs = np.where(level >= LEVELS, 1, -1).astype(np.float32) / np.float32(math.sqrt(size))
    turned = (level + 0.5 - LEVELS) / LEVELS * scale[:, None].astype(np.float32)

    def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rounding = scale[a] ** 2 / (12 * LEVELS**2)  # a level is anywhere in a step of scale / LEVELS
        spread = np.sqrt((1 - np.minimum(1, factor[b] ** 2)) / max(1, size - 1) + rounding[:, None])
        return (turned[a] @ signs[b].T + DEVIATIONS * spread) / factor[b]

    # either row may be the one of the levels; both must admit the pair, or a pair would depend on the order of its rows
    return np.minimum(bound(left, right), bound(right, left).T)


def links(v: np.ndarray, bound: np.ndarray, known: np.ndarray, bucket: int, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of ``left`` and ``right`` rows link, and meet here for the first time: those that ``bound`` admits, by their exact cosine."""
    exact = v / np.abs(v).max(1)[:, None]
    exact /= np.linalg.norm(exact, axis=1)[:, None]
    i, j = np.nonzero(bound >= threshold)
    out = np.zeros(bound.shape, bool)
    for at in range(0, len(i), 1 << 16):
        a, b = left[i[at : at + (1 << 16)]], right[j[at : at + (1 << 16)]]
        close = (np.einsum("ij,ij->i", exact[a], exact[b]) >= threshold) & (a != b)
        first = np.argmax(known[a[close]] == known[b[close]], axis=1) if close.any() else np.empty(0, int)
        close[close] = known[a[close], first] == bucket
        out[i[at : at + (1 << 16)][close], j[at : at + (1 << 16)][close]] = True
    return out


def cells_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows, cell by cell: those with equal first three columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist(), len(at)]
        if held and len(at) and any(held[-1].column(c)[-1].as_py() != at[0, c] for c in range(3)):
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(cuts, cuts[1:]):
            held.append(batch.slice(start, end - start))
            if end < len(at):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def linked(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Links join vectors of one length whose cosine, in double precision, is at least ``threshold``. Vectors that are null or zero, or hold null or
    non-finite components, and rows without an id link with nothing (for the latter component_id is null). Ids may be of any type that has an order.
    Rows that repeat an id and a vector count as copies of each other; an id with several vectors has the links of all. Equal vectors become one class, so copies are
    counted and not compared. Further columns are ignored, and an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)), F.col("v")))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    bits, count = tables(rows.count(), threshold)
    kind = classes.schema["rep"].dataType
    arrow_kind = to_arrow_type(kind)
    described = T.StructType([*classes.schema.fields]).add("code", "binary").add("scale", "double").add("factor", "double").add("keys", T.ArrayType(T.LongType()))

    def describe(batches):
        for batch in batches:
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            flat, at = batch.column(0).flatten().to_numpy(), np.append(0, np.cumsum(sizes))
            scale, factor, found, code = np.zeros(len(sizes)), np.zeros(len(sizes)), np.zeros((len(sizes), count), np.int64), np.empty(len(sizes), object)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                unit = np.stack([flat[at[k] : at[k + 1]] for k in own])
                unit /= np.abs(unit).max(1)[:, None]
                unit /= np.linalg.norm(unit, axis=1)[:, None]
                found[own] = keys(unit, bits, count)
                code[own], scale[own], factor[own] = coded(unit)
            made = [pa.array(code.tolist(), pa.binary()), pa.array(scale), pa.array(factor), pa.array(found.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], described.fieldNames())

    codes = stored(classes.mapInArrow(describe, described), "codes")
    member = codes.select("rep", F.explode("keys").alias("bucket"), F.size("v").alias("size"), "code", "scale", "factor")
    large = codes.select(F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    member = member.join(checked(stored(large, "buckets"), 100_000), "bucket", "left")
    member = member.withColumn("parts", F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int"))
    member = member.withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = ["bucket", "i", "j"]
    member = member.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    member = member.select(*cell, "part", "rep", "size", "code", "scale", "factor")

    def bounds(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j, part = group["i"][0].as_py(), group["j"][0].as_py(), group["part"].to_numpy()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        code = np.frombuffer(b"".join(group["code"].to_pylist()), np.uint8).reshape(len(part), -1)
        return left, right, upper(code, group["size"][0].as_py(), group["scale"].to_numpy(), group["factor"].to_numpy(), left, right)

    def meet(batches):
        for group in cells_of(batches):
            if len(group) > 1:
                left, right, bound = bounds(group)
                near = (bound >= threshold) & (left[:, None] != right[None, :])
                own = np.zeros(len(group), bool)
                own[left[near.any(1)]] = own[right[near.any(0)]] = True
                yield from group.filter(pa.array(own)).combine_chunks().to_batches()

    met = member.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(meet, member.schema)
    same = ["rep", "code", "scale", "factor"]
    met = met.join(codes.select(*same, "copies", "v", "keys"), same).select(*member.columns, "copies", "v", "keys")
    result = T.StructType([T.StructField("rep", kind), T.StructField("links", T.LongType()), T.StructField("root", kind)])

    def compare(batches):
        for group in cells_of(batches):
            left, right, bound = bounds(group)
            v, known = (group[c].combine_chunks().flatten().to_numpy().reshape(len(group), -1) for c in ("v", "keys"))
            found = links(v, bound, known, group["bucket"][0].as_py(), left, right, threshold)
            copies, ids = group["copies"].to_numpy(), np.array([*group["rep"].to_pylist(), None], object)[:-1]
            total = np.zeros(len(group), np.int64)
            total[left] = found @ copies[right]
            if group["i"][0] != group["j"][0]:
                total[right] += copies[left] @ found
            ranked = np.argsort(ids)
            label, before = np.argsort(ranked), None
            while before is None or (label != before).any():
                before = label.copy()
                label[left] = np.minimum(label[left], np.where(found, label[right][None, :], len(group)).min(1, initial=len(group)))
                label[right] = np.minimum(label[right], np.where(found, label[left][:, None], len(group)).min(0, initial=len(group)))
            own = np.flatnonzero(total)
            columns = [pa.array(ids[own].tolist(), arrow_kind), pa.array(total[own]), pa.array(ids[ranked[label[own]]].tolist(), arrow_kind)]
            yield pa.RecordBatch.from_arrays(columns, result.fieldNames())

    found = stored(met.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(compare, result), "vector-links")
    root = components(found.where("rep <> root").select("rep", "root"), "rep", "root")
    total = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = codes.select("v", "rep", "copies")
    out = rows.join(classes, "v", "left").join(total, "rep", "left").join(root, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("root", "rep", "vec_id")
    return out.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
