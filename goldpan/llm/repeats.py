"""Removal of long byte strings that occur more than once, by prefix doubling over thinned suffix positions.

Doubling over every byte position would sort the corpus many times over. Every long string, however, holds a smallest 128-byte prefix among
those that start in it (by hash), and equal strings hold the same one at the same place. So only those positions, about one in 140 bytes, enter:

1. Their 128-byte prefixes are ranked (by doubling inside a task); unique ones are dropped.
2. Around the rest, the starts that a position stands for are taken in blocks. The *core* of a block is what all its strings share, its *span* all that
   they cover. A repeated span settles the block: all its strings repeat. A unique core settles it too: none does.
3. What is open is split into smaller blocks, whose cores are the pair of the old core's rank and the bytes added at growing
   offsets; pairs are ranked anew, until every core is unique or has grown to the full length.
"""

from __future__ import annotations

import uuid
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from goldpan.llm.common import forget, stored
from goldpan.operators.skew import hot_keys

PREFIX = 128
#: Rows of a key that are joined in one task; more are dealt over several.
ROWS_PER_PART = 20_000
#: Widths of the blocks of starts, from round to round.
WIDTHS = (69, 18, 5, 1)
_PIECE = 1 << 20
_TABLE = np.random.default_rng(5150).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_PLACE = np.uint64((1 << 24) - 1)


def prefix_values(data: np.ndarray) -> np.ndarray:
    """A value for the 128 bytes from each position on, by doubling the length seven times."""
    values, length, factor = _TABLE[data], 1, _BASE
    while length < PREFIX:
        values = values[:-length] * np.uint64(factor) + values[length:]
        factor, length = factor * factor % (1 << 64), 2 * length
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return values ^ (values >> np.uint64(29))


def positions(data: bytes, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions, and values of their prefixes, that hold the smallest prefix (of equal ones the first) of some ``least`` bytes."""
    raw, found, kept = np.frombuffer(data, np.uint8), [], []
    width = least - PREFIX + 1
    for at in range(0, max(0, len(raw) - least + 1), _PIECE):
        values = prefix_values(raw[at : at + _PIECE + least - 1])
        order = (values & ~_PLACE) | np.arange(len(values), dtype=np.uint64)
        length = 1
        while 2 * length <= width:
            order, length = np.minimum(order[:-length], order[length:]), 2 * length
        if width > length:
            order = np.minimum(order[: -(width - length)], order[width - length :])
        own = np.unique(order & _PLACE).astype(np.int64)
        found.append(own + at)
        kept.append(values[own])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(kept)[first]


def blocks(low: int, high: int, width: int) -> list[tuple[int, int]]:
    """(first, last) starts of the parts of a block."""
    return [(a, min(a + width - 1, high)) for a in range(low, high + 1, width)]


def joined(rows: DataFrame, other: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Inner join with ``other``, which is unique on ``keys``; rows of a frequent key are dealt over parts by a hash of ``spread``.

    A frequency sketch names at most a thousand hashes of keys, so their list is small enough for a broadcast at every size. The result does
    not depend on which keys it names.
    """
    hashed = F.xxhash64(*keys)
    hot = F.broadcast(hot_keys(rows.select(hashed.alias("hash")), "hash", ROWS_PER_PART))
    parts = F.coalesce("_parts", F.lit(1))
    left = rows.withColumn("hash", hashed).join(hot, "hash", "left").withColumn("part", F.pmod(F.xxhash64(*spread), parts).cast("int"))
    right = other.withColumn("hash", hashed).join(hot, "hash", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.drop("hash", "_parts").join(right.drop("hash", "_parts"), [*keys, "part"]).drop("part")


def settled(rows: DataFrame) -> DataFrame:
    """The rows that go on, with ``repeats``: wanted rows whose span repeats, and rows of cores that are open.

    ``rows`` have core, span, key and spot. Of a core that repeats while some wanted span of it does not, the latter are open; one row of each
    other span stays beside them to be compared with. Places are told apart by their hash, so both groupings are on plain longs.
    """
    place = F.xxhash64("key", "spot")
    spans = rows.groupBy("core", "span").agg(F.min(place).alias("one"), F.max(place).alias("other"), F.max(wanted()).alias("asked"))
    repeats = F.col("one") != F.col("other")
    cores = spans.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.max(~repeats & F.col("asked")).alias("open"))
    spans = joined(spans, cores, ["core"], ["span"]).withColumn("open", F.col("open") & (F.col("n") > 1)).withColumn("repeats", repeats)
    spans = spans.where("repeats OR open").select("core", "span", "one", "repeats", "open")
    found = joined(rows, spans, ["core", "span"], ["key", "spot"])
    again, compared = F.col("repeats") & wanted(), F.col("open") & (~F.col("repeats") | (place == F.col("one")))
    return found.where(again | compared).select(*rows.columns, again.alias("repeats"), compared.alias("compared"))


def spot(at, low: int, high: int, asked: bool):
    """Position (or array of them), block and whether an answer is wanted for it, in one long."""
    return at << 21 | low << 11 | high << 1 | asked


def wanted():
    return F.col("spot").bitwiseAND(F.lit(1)) == 1


def unspot(value):
    """Position, block and whether an answer is wanted, of a long or an array of them."""
    return value >> 21, value >> 11 & 1023, value >> 1 & 1023, value & 1


def runs(spots: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs of bytes that the blocks at ``spots`` cover."""
    at, low, high = spots >> 21, spots >> 11 & 1023, spots >> 1 & 1023
    order = np.argsort(at - high)
    start, reached = (at - high)[order], np.maximum.accumulate((at - low + least)[order])
    new = np.append(True, start[1:] > reached[:-1])[: len(start)]
    return start[new], reached[np.append(new[1:], True)[: len(start)]]


_ROWS = "core long, span long, key binary, spot long, before binary, after binary"
#: Bytes of remaining text in a batch of results.
_BATCH = 8 << 20


def digests(parts, number: int, seed: int) -> np.ndarray:
    """A digest of 64 bits of each of ``number`` parts."""
    return np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in parts), np.uint64, number).view(np.int64)


def sides(least: int):
    """A function on batches of (key, packed, items): the open blocks with the bytes around their cores, as far as the block's strings reach and the text goes."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        core, before, after, keys, spots = [], [], [], [], []

        def batch():
            key = pa.array(keys, pa.binary()).take(pa.array(np.repeat(np.arange(len(keys)), [len(x) for x in core])))
            made = [pa.array(np.concatenate(core)), pa.array(before, pa.binary()), pa.array(after, pa.binary()), key, pa.array(np.concatenate(spots))]
            return pa.RecordBatch.from_arrays(made, ["core", "before", "after", "key", "spot"])

        for rows in batches:
            for key, packed, items in zip(*rows.columns):
                data = unpack(packed.as_py())
                keys.append(key.as_py()), core.append(items.values.field("core").to_numpy()), spots.append(items.values.field("spot").to_numpy())
                at, low, high, _ = (x.tolist() for x in unspot(spots[-1]))
                before += [data[max(0, x - b) : x - a] for x, a, b in zip(at, low, high)]
                after += [data[x - b + least : x - a + least] for x, a, b in zip(at, low, high)]
                if len(before) > 5_000:
                    yield batch()
                    core, before, after, keys, spots = [], [], [], [], []
        if keys:
            yield batch()

    return run


def splitter(width: int, around):
    """A function on batches that ``around`` turns into (core, before, after, key, spot): the parts of each block, of at most ``width`` starts.

    The core of a part is a digest of the old core, the part's number, which says how many bytes are gained on either side, and those
    bytes. Its span is a digest of that and the bytes around, or of its place if they leave the text.
    """

    def run(batches):
        split = cache(blocks)
        for rows in around(batches):
            core, key, spots = rows.column("core").to_numpy().tobytes(), rows.column("key").to_pylist(), rows.column("spot").to_numpy()
            at, low, high, asked = unspot(spots)
            who, first, last, grown, spans, befores, afters = [], [], [], [], [], [], []
            each = zip(rows.column("before").to_pylist(), rows.column("after").to_pylist(), low.tolist(), high.tolist())
            for i, (before, after, a0, b0) in enumerate(each):
                if b0 - len(after) > a0 + len(before):
                    continue
                own = core[8 * i : 8 * i + 8]
                for number, (a, b) in enumerate(split(a0, b0, width)):
                    kept, right, reach = len(before) - (a - a0), b0 - b, b - a
                    if kept < 0 or len(after) < right:
                        continue
                    digest = xxhash.xxh3_128_digest(own + bytes((number,)) + before[kept:] + after[:right])
                    reach_left, reach_right = before[max(0, kept - reach) : kept], after[right : right + reach]
                    if len(reach_left) == reach == len(reach_right):
                        spans.append(xxhash.xxh3_64_digest(digest + reach_left + reach_right, 0))
                    else:
                        spans.append(xxhash.xxh3_64_digest(digest + key[i] + int(at[i]).to_bytes(8, "little"), 1))
                    who.append(i), first.append(a), last.append(b), grown.append(digest[:8]), befores.append(reach_left), afters.append(reach_right)
            if who:
                spot_ = spot(at[who], np.array(first), np.array(last), asked[who])
                made = [np.frombuffer(b"".join(x), np.int64) for x in (grown, spans)]
                made = [*map(pa.array, made), rows.column("key").take(pa.array(who)), pa.array(spot_), pa.array(befores, pa.binary()), pa.array(afters, pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["core", "span", "key", "spot", "before", "after"])

    return run


def cutter(least: int):
    """A function on batches of (doc_id, packed, spots): doc_id, size of the text, spans removed, and the bytes that remain."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for rows in batches:
            ids, sizes, starts, stops, kept, held, since = rows.column("doc_id"), [], [], [], [], 0, 0

            def batch():
                offsets = pa.array(np.cumsum([0, *map(len, starts)]), pa.int32())
                spans = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in (starts, stops)], ["start", "stop"])
                made = [ids.slice(since, len(sizes)), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, spans), pa.array(kept, pa.binary())]
                return pa.RecordBatch.from_arrays(made, ["doc_id", "n_bytes", "spans", "kept"])

            for number, (packed, spots) in enumerate(zip(rows.column("packed"), rows.column("spots"))):
                data = unpack(packed.as_py())
                start, stop = runs(np.empty(0, np.int64) if spots.values is None else spots.values.to_numpy(), least)
                left = b"".join([data[a:b] for a, b in zip([0, *stop.tolist()], [*start.tolist(), len(data)])]) if len(start) else data
                sizes.append(len(data)), starts.append(start), stops.append(stop), kept.append(left)
                held += len(left)
                if held > _BATCH:
                    yield batch()
                    sizes, starts, stops, kept, held, since = [], [], [], [], 0, number + 1
            if sizes:
                yield batch()

    return run


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text for every row of ``docs``: figures of what ``without_repeats`` cuts, and what remains.

    ``text`` is what remains as a string. Bytes that a cut within a character leaves behind show as U+FFFD there; the digest is of the bytes.
    """
    cut = without_repeats(docs, id_col, text_col, least)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    figures = [n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]
    return cut.select("doc_id", "n_bytes", *figures, F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400) -> DataFrame:
    """doc_id, n_bytes, spans (start and stop of each maximal run of bytes removed), kept (the bytes that remain) for every row of ``docs``.

    Removed is every byte of a string of ``least`` UTF-8 bytes that also starts elsewhere, in this or another row. Null texts are empty, rows with a
    repeated or null id are rows of their own, further columns are ignored, and an empty table gives an empty result. ``least`` is at least 2 * 128.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    keyed = keyed.withColumn("key", F.unhex(F.md5("text")))
    # one row per different text, compressed and bucketed, so that no later join shuffles text
    name = f"llm_texts_{uuid.uuid4().hex}"

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([press(x.as_py()) for x in batch.column(2)], pa.binary())], ["key", "doc_id", "packed"])

    schema = StructType([keyed.schema["key"], keyed.schema["doc_id"], StructField("packed", BinaryType())])
    texts = keyed.select("key", "doc_id", "text").mapInArrow(pack, schema)
    texts = texts.groupBy("key").agg(F.first("packed").alias("packed"), F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    texts.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").saveAsTable(name)
    texts = spark.table(name)
    reach = least - PREFIX  # starts that a position stands for reach so far before it

    def by_column(make, names):
        """A function on batches of (key, packed, more): the columns that ``make`` gives for each text behind its repeated key, in batches of some thousands."""

        def run(batches):
            unpack = zstandard.ZstdDecompressor().decompress
            keys, made = [], []

            def batch():
                sizes = [len(x[0]) for x in made]
                key = pa.array(keys, pa.binary()).take(pa.array(np.repeat(np.arange(len(keys)), sizes)))
                return pa.RecordBatch.from_arrays([key, *[pa.array(np.concatenate(x)) for x in zip(*made)]], ["key", *names])

            held = 0
            for rows in batches:
                for key, packed, *more in zip(*rows.columns):
                    keys.append(key.as_py())
                    made.append(make(keys[-1], unpack(packed.as_py()), *more))
                    held += len(made[-1][0])
                    if held > 20_000:
                        yield batch()
                        keys.clear(), made.clear()
                        held = 0
            if held:
                yield batch()

        return run

    def anchors(_, data):
        at, value = positions(data, least)
        return at, value.view(np.int64)

    found = texts.select("key", "packed").mapInArrow(by_column(anchors, ["at", "value"]), "key binary, at long, value long")
    found = stored(found, "positions")
    place = F.xxhash64("key", "at")
    again = found.groupBy("value").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("value")
    ats = joined(found, again, ["value"], ["key", "at"]).groupBy("key").agg(F.collect_list("at").alias("ats"))

    def first_blocks(key, data, ats):
        """Cores, spans and spots around positions; the core's digest is seeded with the number of its block, and a span that leaves the text is one of its own."""
        at, out = ats.values.to_numpy(), []
        for number, (low, high) in enumerate(blocks(0, reach, WIDTHS[0])):
            own = at[np.maximum(low, at + least - len(data)) <= np.minimum(high, at)]
            core = digests((data[x - low : x - high + least] for x in own.tolist()), len(own), number + 2)
            whole = (own >= high) & (own - low + least <= len(data))
            span = np.empty(len(own), np.int64)
            span[whole] = digests((data[x - high : x - low + least] for x in own[whole].tolist()), int(whole.sum()), 0)
            span[~whole] = digests((key + x.to_bytes(8, "little") for x in own[~whole].tolist()), int((~whole).sum()), 1)
            out.append((core, span, spot(own, low, high, True)))
        return [np.concatenate(x) for x in zip(*out)]

    names = ["core", "span", "key", "spot"]
    rows = texts.select("key", "packed").join(ats, "key").mapInArrow(by_column(first_blocks, ["core", "span", "spot"]), "key binary, core long, span long, spot long").select(*names)
    made = stored(rows, "blocks")
    forget(found)
    result = [stored(settled(made), "settled")]
    forget(made)

    open_ = result[0].where("compared").withColumn("spot", F.when(F.col("repeats"), F.col("spot") - 1).otherwise(F.col("spot")))
    by_text = open_.groupBy("key").agg(F.collect_list(F.struct("core", "spot")).alias("items"))
    current, around = texts.select("key", "packed").join(by_text, "key").select("key", "packed", "items"), sides(least)
    for width in WIDTHS[1:]:
        made = stored(current.mapInArrow(splitter(width, around), _ROWS), "blocks")
        result.append(stored(settled(made), "settled"))
        forget(made)
        asked = F.when(F.col("repeats"), F.col("spot") - 1).otherwise(F.col("spot"))
        current, around = result[-1].where("compared").select("core", "before", "after", "key", asked.alias("spot")), iter

    spans = result[0].where("repeats").select("key", "spot")
    for more in result[1:]:
        spans = spans.union(more.where("repeats").select("key", "spot"))
    spans = stored(spans.groupBy("key").agg(F.collect_list("spot").alias("spots")), "spans")
    for part in result:
        forget(part)

    # what is found once is cut; copies of one text repeat as a whole, or are too short for any string
    once = texts.where("copies = 1").join(spans, "key", "left").select("doc_id", "packed", "spots")
    schema = StructType([once.schema["doc_id"], *StructType.fromDDL("n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")])
    done = stored(once.mapInArrow(cutter(least), schema), "cut", compression="zstd")
    more = stored(texts.where("copies > 1").select("key"), "copies")
    # neither the packed texts nor the spots are read any more
    spark.sql(f"DROP TABLE {name}")
    forget(spans)
    size = F.octet_length("text").cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("stop")))
    spans = F.when(size >= least, whole).otherwise(F.array().cast(done.schema["spans"].dataType))
    kept = F.when(size >= least, F.lit(b"")).otherwise(F.col("text"))
    copies = keyed.select("doc_id", "key", size.alias("n_bytes"), spans.alias("spans"), kept.alias("kept"))
    return done.union(copies.join(more, "key", "left_semi").drop("key"))
