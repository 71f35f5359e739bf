"""Groups of spelling variants: words one edit apart, found by asymmetric chunks.

Of two words that one inserted, deleted or replaced code point tells apart, the shorter (or either of equal length) is cut into two disjoint chunks of
half its length. One edit touches one chunk at most, so the other stands in the longer word as a gram of the same length, at its own place or one
further on. Words therefore enter a join twice: with their two chunks, and with all grams that lie within a shift of one of a chunk of a word as long,
or one shorter. What meets is verified.

A chunk that a great many words share (one beginning, one ending) would compare all of them. Words that meet in such a chunk are keyed by
what is left when one code point is dropped or masked instead: there, at most one word per letter of the alphabet meets another.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.llm.common import stored

#: Runs of letters, as bytes of Latin-1; lower-casing bytes touches A-Z only, as wanted.
_RUN = re.compile(b"[a-z\xc0-\xff]+")
#: Words and their counts that a task holds before it sends them on.
_HELD = 200_000
#: A chunk in which more pairs than this meet is hot.
HOT_PAIRS = 4_000
#: Stands for the code point that two words differ in; no word holds it.
MASK = "*"


def spoiled(run: bytes, text_id: int, spoil: int) -> bytes:
    """The lower-cased ``run`` with one code point deleted where the checksum of the document's id (its checksum is ``text_id``) and the run asks for it."""
    own = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), text_id)
    if own % spoil:
        return run
    at = own % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, spoil: int = 97) -> DataFrame:
    """(word, n) of runs of letters, A-Z lower-cased, of at least ``shortest`` code points after one run in about ``spoil`` has lost a code point."""

    def count(batches):
        held = Counter()
        for batch in batches:
            for name, raw in zip(*batch.columns):
                # characters outside Latin-1 are in no run, as is what stands in for them
                text = (raw.as_py() or b"").decode("utf-8", "replace").encode("latin-1", "replace").lower()
                text_id = zlib.crc32(f"{name.as_py() or ''}:".encode())
                for run, n in Counter(_RUN.findall(text)).items():
                    word = spoiled(run, text_id, spoil)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) > _HELD:
                    yield batch_of(held)
                    held.clear()
        yield batch_of(held)

    def batch_of(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    found = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _keys(size: Column, chunk: int, gram: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), F.lit(chunk).alias("chunk"), gram.alias("gram"))


def chunk_keys(word: Column) -> Column:
    """The two chunks of a word, each with the word's length and its number."""
    size = F.length(word)
    half = F.floor(size / 2).cast("int")
    return F.array(_keys(size, 0, F.substring(word, 1, half)), _keys(size, 1, F.substring(word, half + 1, half)))


def gram_keys(word: Column) -> Column:
    """The grams of a word that may be a chunk of another one as long (same place) or one shorter (same place, or one further on).

    Its own length shares a chunk unshifted, since a replaced code point moves nothing.
    """
    size = F.length(word)
    half, less = F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")
    equal = [_keys(size, 0, F.substring(word, 1, half)), _keys(size, 1, F.substring(word, half + 1, half))]
    shorter = [_keys(size - 1, k, F.substring(word, k * less + 1 + shift, less)) for k in (0, 1) for shift in (0, 1)]
    return F.array_distinct(F.array(*equal, *shorter))


def _masked(word: Column) -> Column:
    """The word with each of its code points masked in turn: equal for two words that differ in that one."""
    at = F.sequence(F.lit(1), F.length(word))
    return F.transform(at, lambda k: F.concat(F.substring(word, 1, k - 1), F.lit(MASK), F.substring(word, k + 1, F.length(word))))


def _dropped(word: Column) -> Column:
    """The word with each of its code points left out in turn."""
    at = F.sequence(F.lit(1), F.length(word))
    return F.array_distinct(F.transform(at, lambda k: F.concat(F.substring(word, 1, k - 1), F.substring(word, k + 1, F.length(word)))))


def near_pairs(words: DataFrame, hot: int = HOT_PAIRS) -> DataFrame:
    """(a, b), each pair of words(word) one edit apart once: a is the shorter, or of equal length the smaller in code-point order.

    Words have at least two code points and do not hold ``MASK``.
    """
    short = stored(words.select(F.col("word").alias("a"), F.explode(chunk_keys(F.col("word"))).alias("key")), "chunks")
    long = stored(words.select(F.col("word").alias("b"), F.explode(gram_keys(F.col("word"))).alias("key")), "grams")
    left = short.groupBy("key").agg(F.count(F.lit(1)).alias("na"))
    right = long.groupBy("key").agg(F.count(F.lit(1)).alias("nb"))
    # every chunk of a word is a gram of it too; a key that holds nothing else pairs nothing
    shared = stored(left.join(right, "key").where("nb > 1").withColumn("hot", F.col("na") * F.col("nb") > hot), "keys")

    cool = shared.where("NOT hot").select("key")
    met = short.join(cool, "key").join(long, "key")
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    near = ordered & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    # the words in hot chunks, each pair of them by what is left without the code point that differs
    busy = shared.where("hot").select("key")
    few = short.join(busy, "key", "left_semi").select(F.col("a").alias("word")).distinct()
    many = long.join(busy, "key", "left_semi").select(F.col("b").alias("word")).distinct()
    masks = few.union(many).distinct().select("word", F.explode(_masked(F.col("word"))).alias("rest"))
    masks = stored(masks, "masks")
    replaced = masks.withColumnRenamed("word", "a").join(masks.withColumnRenamed("word", "b"), "rest").where("a < b").select("a", "b")
    inserted = many.select(F.col("word").alias("b"), F.explode(_dropped(F.col("word"))).alias("a")).join(few.withColumnRenamed("word", "a"), "a").select("a", "b")
    pairs = met.where(near).select("a", "b").union(replaced).union(inserted)
    return pairs.distinct()


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) for forms(word, form) without cycles: where the forms of each word end, by doubling the way in every round."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        # a word whose root has no form is done and is not joined again
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(further, "root")
        if moved.isEmpty():
            return now
        stay = now.join(further.select("root"), "root", "left_anti").select("word", "root")
        now = stored(moved.select("word", F.col("next").alias("root")).union(stay), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3, spoil: int = 97, hot: int = HOT_PAIRS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` of at least ``shortest`` code points that occurs ``least`` times.

    Two words are near if one code point inserted, deleted or replaced tells them apart. The form of a word is its most frequent near
    word (of equal ones the first in code-point order) if that is at least twice as frequent, else null; root is where forms lead. Of all runs, those whose checksum with the id of their document
    ``spoil`` divides have lost a code point. Null texts have no words, a null id counts as empty text, rows that repeat count again, further columns are
    ignored, and an empty table gives an empty result.
    """
    words = stored(word_counts(docs, id_col, text_col, shortest, spoil).where(F.col("n") >= least), "words")
    pairs = stored(near_pairs(words, hot), "near")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    known = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = known.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    found = words.join(best, "word", "left")
    good = -F.col("best.less") >= 2 * F.col("n")
    found = found.select(
        "word", F.when(good, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, -F.col("best.less")).alias("form_n")
    )
    found = stored(found, "forms")
    roots = followed(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
