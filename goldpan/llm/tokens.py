"""Token counts of whole texts; huge texts are counted in overlapping chunks that are spliced where both tokenizations agree.

The tokenizer lower-cases, drops white space, splits a text into words by a pattern and merges pairs inside a word. A text
beyond a limit is cut into chunks that reach over into their neighbours, so that one huge text is many rows. Where two
chunks overlap, a boundary with the same token before and the same token behind it (text span and id) in both is stable:

* Between two words it is a place where both scans start anew, and the pattern looks at nothing before its start.
* Inside a word, all pairs of neighbouring tokens left of it are pairs of the left chunk, the pair across it too, and those right
  of it are pairs of the right chunk. Where merges are ranked so that a part is always made before what it is part of, a
  sequence in which every two neighbours stay apart when merged alone is the tokenization of the whole.

Cuts are only made before characters that do not combine with what precedes, and boundaries near the end of a chunk do not count,
since what is cut there may be half of a special string. If no boundary of an overlap is stable, the text is cut again, into chunks and
overlaps eight times as long, until all agree or one chunk is left.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from goldpan.llm.common import stored

#: Characters of a chunk, and how far it reaches into its neighbours.
CHUNK, OVERLAP = 1 << 16, 1 << 10
WIDER = 8
#: A byte that no UTF-8 text holds stands for the end of a word.
END = b"\xff"
_KNOWN_WORDS = 400_000


def byte_names() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next free one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def ranked_merges(model: dict) -> dict[bytes, int]:
    """Every token's bytes with its rank: single bytes, bytes at the end of a word, then merges in their order.

    Raises ``ValueError`` if two merges make the same token, or one uses a part that a later one makes; splicing and counting by
    rank rest on neither.
    """
    names, suffix = byte_names(), model["end_of_word_suffix"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = {a + b: k for k, (a, b) in enumerate(merges)}
    if len(made) < len(merges) or any(made.get(x, -1) >= k for k, m in enumerate(merges) for x in m):
        raise ValueError("merges are not in the order in which tokens are made")

    def raw(token: str) -> bytes:
        last = token.endswith(suffix)
        return bytes(names[c] for c in token.removesuffix(suffix)) + (END if last else b"")

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + END: 256 + b for b in range(256) if b != END[0]}
    return ranks | {raw(token): 512 + k for token, k in made.items()}


class Counts:
    """Counts tokens of texts as the vocabulary file's library does.

    Words of Latin-1 characters, most of all text, are split here and their merges are counted once each; the other
    space-separated pieces go to the library. A space is a boundary whatever is around it: words and special strings
    hold none, and nothing combines with one.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        described = json.loads(self.library.to_str())
        self.special = [t["content"] for t in described["added_tokens"]]
        if any(" " in t for t in self.special):
            raise ValueError("special strings with a space are not supported")
        self.bpe = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranked_merges(described["model"]), special_tokens={})
        self.known: dict[bytes, int] = {}
        # the vocabulary's split pattern, with its classes spelled out for the 256 characters of Latin-1
        kinds = {chr(b): unicodedata.category(chr(b)) for b in range(256)}
        letters, digits = ("".join(c for c in kinds if kinds[c][0] == k) for k in "LN")
        blank = "\t\n\x0b\x0c\r \x85\xa0"
        escaped = [re.escape(x.encode("latin-1")) for x in (letters, digits, blank)]
        self.word = re.compile(b"'s|'t|'re|'ve|'m|'ll|'d|[%b]+|[%b]|[^%b%b%b]+" % (escaped[0], escaped[1], *escaped))
        self.lower = bytes(ord(chr(b).lower()) for b in range(256))

    def latin(self, raw: bytes) -> int:
        total = 0
        for word, n in Counter(self.word.findall(raw.translate(self.lower))).items():
            size = self.known.get(word)
            if size is None:
                if len(self.known) >= _KNOWN_WORDS:
                    self.known.clear()
                size = self.known[word] = len(self.bpe._encode_single_piece(word.decode("latin-1").encode() + END))
            total += n * size
        return total

    def count(self, text: str) -> int:
        if not any(s in text for s in self.special):
            try:
                return self.latin(text.encode("latin-1"))
            except UnicodeEncodeError:
                pass
        plain, other = [], []
        for piece in text.split(" "):
            simple = ord(max(piece, default=" ")) < 256 and not any(s in piece for s in self.special)
            (plain if simple else other).append(piece)
        odd = self.library.encode(" ".join(other), add_special_tokens=False)
        return self.latin(" ".join(plain).encode("latin-1")) + len(odd.ids)


def _apart(char: str) -> bool:
    """Whether ``char`` never combines with what precedes it when a text is normalised."""
    if char < "\u0300":
        return True
    # vowels and finals of syllables are letters, and join the one before
    return unicodedata.category(char)[0] not in "MC" and not "\u1100" <= char <= "\u11ff" and not "\ud7b0" <= char <= "\ud7ff"


def _next_apart(text: str, at: int) -> int:
    while at < len(text) and not _apart(text[at]):
        at += 1
    return min(at, len(text))


def chunks(text: str, chunk: int, overlap: int):
    """(start, stop, low, high): the text from start to stop is the chunk's own, from low to high is what it sees."""
    cuts = [0]
    while len(text) - cuts[-1] > chunk + 2 * overlap:
        cut = _next_apart(text, cuts[-1] + chunk)
        if cut >= len(text) - overlap:
            break
        cuts.append(cut)
    cuts.append(len(text))
    for start, stop in zip(cuts, cuts[1:]):
        low = _next_apart(text, start - overlap) if start else 0
        yield start, stop, min(low, start), _next_apart(text, stop + overlap)


Span = tuple[int, int, int]


def stable(left: list[Span], right: list[Span], low: int, high: int) -> tuple[int, int] | None:
    """Numbers (in ``left``, in ``right``) of the token behind a stable boundary between ``low`` and ``high``, or None.

    Tokens are (start, end, id) in the order of the text.
    """
    behind = {}
    for k in range(1, len(left)):
        before, after = left[k - 1], left[k]
        if before[0] >= low and after[1] <= high and before[1] <= after[0]:
            behind[before, after] = k
    for k in range(1, len(right)):
        found = behind.get((right[k - 1], right[k]))
        if found is not None:
            return found, k
    return None


_SPAN = "array<struct<s:long,e:long,id:long>>"
_CHUNK = "row long, no long, last boolean, start long, stop long, low long, part string"
_ENDS = f"row long, no long, last boolean, n long, low long, high long, head {_SPAN}, tail {_SPAN}"


def _batch(columns: list, schema: T.StructType) -> pa.RecordBatch:
    target = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)


def spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens, failed) for texts(row, text); failed where an overlap has no stable boundary, and the count is then void."""
    spark = texts.sparkSession
    chunk_type, ends_type = T.StructType.fromDDL(_CHUNK), T.StructType.fromDDL(_ENDS)
    cuts_type = T.StructType.fromDDL("row long, n long, failed boolean")

    def split(batches):
        for batch in batches:
            for row, raw in zip(*batch.columns):
                text = raw.as_py().decode("utf-8", "replace")
                bounds = list(chunks(text, chunk, overlap))
                for no, (start, stop, low, high) in enumerate(bounds):
                    last = no + 1 == len(bounds)
                    yield _batch([[row.as_py()], [no], [last], [start], [stop], [low], [text[low:high]]], chunk_type)

    def encode(batches):
        library = Tokenizer.from_file(path)
        margin = 8 + max((len(t.content) for t in library.get_added_tokens_decoder().values()), default=0)
        for batch in batches:
            for row, no, last, start, stop, low, part in zip(*(c.to_pylist() for c in batch.columns)):
                found = library.encode(part, add_special_tokens=False)
                spans = [{"s": s + low, "e": e + low, "id": i} for (s, e), i in zip(found.offsets, found.ids)]
                high = low + len(part)
                # the neighbours see as far as this: what they share starts and ends there
                head = [x for x in spans if x["s"] < start + overlap + margin] if no else []
                tail = [] if last else [x for x in spans if x["e"] > stop - overlap - margin]
                yield _batch([[row], [no], [last], [len(spans)], [low + margin], [high - margin], [head], [tail]], ends_type)

    def splice(batches):
        for batch in batches:
            deltas, failed = [], []
            for head, tail, low, high in zip(*(c.to_pylist() for c in batch.columns[1:])):
                left, right = ([(x["s"], x["e"], x["id"]) for x in side] for side in (tail, head))
                found = stable(left, right, low, high)
                failed.append(found is None)
                # tokens of the left chunk behind the boundary, and of the right chunk before it, count for the other
                deltas.append(0 if found is None else -(len(left) - found[0]) - found[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deltas, pa.int64()), pa.array(failed, pa.bool_())], ["row", "n", "failed"])

    # one row per chunk: a single text is encoded by as many tasks as it has chunks
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = texts.select("row", F.col("text").cast("binary")).mapInArrow(split, chunk_type).repartition(tasks, "row", "no")
    ends = stored(parts.mapInArrow(encode, ends_type), "chunk-ends")
    left = ends.where("NOT last").select("row", (F.col("no") + 1).alias("no"), "tail", "high")
    right = ends.where("no > 0").select("row", "no", "head", "low")
    cuts = left.join(right, ["row", "no"]).select("row", "head", "tail", "low", "high").mapInArrow(splice, cuts_type)
    counts = ends.select("row", "n", F.lit(False).alias("failed")).unionByName(cuts)
    return counts.groupBy("row").agg(F.sum("n").alias("n_tokens"), F.max("failed").alias("failed"))


def counted(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row of ``docs``.

    Tokens are those of the vocabulary file at ``path`` without added ones; its special strings inside a text are its special
    tokens. Null texts are empty and have none. Rows with a null or repeated id are rows of their own, further columns are ignored, an
    empty table gives an empty result, and bytes that are no UTF-8 count as replacement characters. Texts of more than
    ``chunk`` characters are counted in chunks; ``overlap`` is at most a quarter of ``chunk``.
    """
    if 4 * overlap > chunk:
        raise ValueError("an overlap is at most a quarter of a chunk")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    short_type = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches):
        counts = Counts(path)
        for batch in batches:
            found = [counts.count(x.as_py().decode("utf-8", "replace")) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], short_type.names)

    short = rows.where(F.length("text") <= chunk).select("doc_id", size, F.col("text").cast("binary"))
    result = short.mapInArrow(count, short_type)
    # few texts are huge; they are stored once, with a number each, as each round reads them
    huge = rows.where(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "doc_id", size, "text")
    huge = stored(huge, "huge-texts")
    todo = huge.select("row", "text")
    while not todo.isEmpty():
        found = stored(spliced(todo, path, chunk, overlap), "huge-counts")
        done = found.where("NOT failed").select("row", "n_tokens")
        result = result.union(huge.select("row", "doc_id", "n_bytes").join(done, "row").select(short_type.names))
        todo = todo.join(found.where("failed").select("row"), "row", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER
    return result.withColumn("over_limit", F.col("n_tokens") > limit)
