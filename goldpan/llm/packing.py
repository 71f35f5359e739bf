"""Best-fit packing of token sequences by bin completion over the lengths.

Pieces are at most ``capacity`` tokens long, so however large the corpus, there are no more than ``capacity`` different
lengths. The search therefore runs on counts by length: branch and bound fills the sequence of the largest length left
with each undominated filling, applies it as often as the counts allow, and prunes by wasted room. The first descent and
a best-fit packing are the first incumbents. Spark then deals pieces to the places of the plan by rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.llm.common import stored

#: Splits text before the merges of the byte-level vocabulary (fixed value).
PRE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SALTS = 1 << 16
#: Pieces of one length that one task ranks, about.
ROWS_PER_RANKING = 500
#: Nodes that branch and bound may visit; it then keeps the best plan found.
SEARCH_NODES = 4_000
#: Fillings that are kept for one largest length, and partial fillings looked at for them.
FILLINGS, FILLING_STEPS = 8, 1_000


def encoder(path: str):
    """text -> ids of the byte-level vocabulary file at ``path``, equal to the ids that its own library gives.

    The file's vocabulary is handed to a faster library. Special tokens in a text get their own ids.
    """
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    special = {t.content: i for i, t in own.get_added_tokens_decoder().items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
    ranks = {bytes(byte[c] for c in token): i for token, i in own.get_vocab().items() if token not in special}
    fast = tiktoken.Encoding("file", pat_str=PRE_SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: fast.encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, salt.

    A document is its ids and then ``end_id``; a null text is empty, so it is one piece with ``end_id`` alone. Documents
    of more than ``capacity`` ids are cut into pieces of ``capacity``, of which the first takes the remainder. Rows with a
    repeated or null id are documents of their own. Bytes that are not UTF-8 are read as replacement characters.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
        + [T.StructField("salt", T.IntegerType())]
    )

    def cut(batches):
        encode, seen = encoder(tokenizer), int(np.random.default_rng().integers(SALTS))
        for batch in batches:
            where, piece, start, length, crc = [], [], [], [], []
            for row, raw in enumerate(batch.column(1)):
                data = raw.as_py()
                ids = np.append(encode(data.decode("utf-8", "replace")) if data else np.empty(0, "<u4"), end_id).astype("<u4")
                at, number = 0, 0
                while at < len(ids):
                    end = at + ((len(ids) - at) % capacity or capacity)
                    where.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(ids[at:end].tobytes()))
                    at, number = end, number + 1
            salt = (np.arange(len(where)) + seen) % SALTS
            seen += len(where)
            columns = [batch.column(0).take(pa.array(where, pa.int64()))]
            columns += [pa.array(x, k) for x, k in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()), (salt, pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(cut, schema)


def fillings(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the lengths (ascending), least waste first, largest lengths first."""
    if counts.get(room):
        return [(room,)]  # one piece of just this size dominates all others
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = 0

    below = lambda room, top: bisect_left(lengths, min(room, top) + 1) - 1
    chosen: list[int] = []
    levels = [[room, below(room, room), False]]  # room left, next length to try, whether one fitted; a level for each chosen piece
    while levels:
        level = levels[-1]
        room, i, grown = level
        while i >= 0 and counts[lengths[i]] <= chosen.count(lengths[i]):
            i -= 1
        if i >= 0:
            x = lengths[i]
            steps += 1
            # an exact piece came first and dominates
            level[1:] = [-1 if counts.get(room) and x < room and chosen else i - 1, True]
            chosen.append(x)
            levels.append([room - x, below(room - x, x), False])
            continue
        if not grown and not (lengths and lengths[0] <= room and counts[lengths[0]] - chosen.count(lengths[0]) > 0):
            found.append((room, tuple(chosen)))
            if sum(not waste for waste, _ in found) >= FILLINGS:
                break
        levels.pop()
        if chosen:
            chosen.pop()
        if steps > FILLING_STEPS:
            break
    found.sort(key=lambda x: (x[0], len(x[1]), [-v for v in x[1]]))
    kept: list[tuple[int, ...]] = []
    for _, filling in found:
        if filling not in kept and not any(dominates(other, filling) for other in kept):
            kept.append(filling)
        if len(kept) == FILLINGS:
            break
    return kept


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the pieces of ``b`` fit into the places that those of ``a`` take."""
    if sum(b) > sum(a) or len(a) > len(b) or len(b) > 5:  # larger sets are kept rather than compared at length
        return False

    def place(left: tuple[int, ...], room: tuple[int, ...]) -> bool:
        if not left:
            return True
        return any(place(left[1:], room[:k] + (r - left[0],) + room[k + 1 :]) for k, r in enumerate(room) if r >= left[0])

    return place(b, a)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by falling length on counts: the largest piece that still fits goes in, many sequences at once."""
    left, plan = dict(counts), []
    while left:
        pattern: list[int] = []
        room = capacity
        ascending = sorted(left)
        while room:
            i = bisect_left(ascending, room + 1) - 1
            while i >= 0 and left[ascending[i]] <= pattern.count(ascending[i]):
                i -= 1
            if i < 0:
                break
            pattern.append(ascending[i])
            room -= ascending[i]
        times = min(left[x] // pattern.count(x) for x in set(pattern))
        take(left, pattern, times)
        plan.append((tuple(pattern), times))
    return plan


def take(left: dict[int, int], pattern, times: int) -> None:
    for x in pattern:
        left[x] -= times
        if not left[x]:
            del left[x]


def complete(counts: dict[int, int], capacity: int, nodes: int = SEARCH_NODES) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences): the best plan that bin completion finds within ``nodes``.

    Ends early when the plan meets the bound: no fewer sequences than the total length over the capacity, nor than pieces
    above half the capacity.
    """
    counts = {int(k): int(v) for k, v in counts.items() if v}
    if not counts:
        return []
    total = sum(k * v for k, v in counts.items())
    bound = max(-(-total // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
    used = lambda plan: sum(times for _, times in plan)
    best = best_fit(counts, capacity)

    def descend(left: dict[int, int], plan: list, waste: int) -> list:
        """Choices still open below this node: (filling, times) from the least waste on."""
        largest = max(left)
        rest = dict(left)
        take(rest, (largest,), 1)
        out = []
        for filling in fillings(sorted(rest), rest, capacity - largest):
            pattern = (largest, *filling)
            times = min(left[x] // pattern.count(x) for x in set(pattern))
            out.append((pattern, times, waste + times * (capacity - sum(pattern))))
        return out[::-1]

    left, plan, waste = dict(counts), [], 0
    stack = [(descend(left, plan, 0), 0)] if used(best) > bound else []
    while stack and nodes and used(best) > bound:
        choices, waste = stack[-1]
        allowed = (used(best) - 1) * capacity - total  # a better plan wastes no more
        while choices and choices[-1][2] > allowed:
            choices.pop()
        if not choices:
            stack.pop()
            if plan:
                pattern, times = plan.pop()
                for x in pattern:
                    left[x] = left.get(x, 0) + times
            continue
        pattern, times, waste = choices.pop()
        nodes -= 1
        take(left, pattern, times)
        plan.append((pattern, times))
        if left:
            stack.append((descend(left, plan, waste), waste))
            continue
        if used(plan) < used(best):
            best = list(plan)
        pattern, times = plan.pop()
        for x in pattern:
            left[x] = left.get(x, 0) + times
    return best


def places(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Per length, which ranks of its pieces go to which sequences: length, first, last, per_sequence, sequence, offset."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for x in sorted(set(pattern), reverse=True):
            n = pattern.count(x)
            first = taken.get(x, 0)
            taken[x] = first + n * times
            rows.append((x, first, taken[x] - 1, n, sequence, offset))
            offset += n * x
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "last", "per_sequence", "sequence", "at"], dtype="int64")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, nodes: int = SEARCH_NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece at its place in a sequence.

    ``docs`` may hold any further columns; an empty table gives an empty result. Sequences are numbered from 0, and offsets in
    one have no gaps. The driver sees one count per length, at most ``capacity`` of them, and the plan made from those.
    Ranks within a length are counted in salted groups, so a length that a third of all pieces share is still split.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = complete(counts, capacity, nodes)
    where = spark.createDataFrame(places(plan), "length long, first long, last long, per_sequence long, sequence long, at long")
    groups = min(SALTS, max(1, sum(counts.values()) // ROWS_PER_RANKING))
    cut = cut.withColumn("salt", F.col("salt") % groups)
    sizes = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = cut.withColumn("within", F.row_number().over(within) - 1).join(sizes, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    # bounded by the number of lengths: a plan step uses up a length or is one of few that backtracking left
    placed = ranked.alias("r").join(F.broadcast(where).alias("w"), F.expr("r.length = w.length AND rank BETWEEN first AND last"))
    local = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", F.col("r.length").alias("length"), "ids_crc32",
        (F.col("sequence") + F.floor(local / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("at") + (local % F.col("per_sequence")) * F.col("r.length")).alias("offset"),
    )
