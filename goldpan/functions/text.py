"""Text columns: word counts, trimming, whole-word search, code-fence removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) gives Unicode classes; the four separators below also split words but are not in Java's \s.
_SPACE = r"\s\x1c-\x1f"


def word_count(text: Column) -> Column:
    """Words between Unicode white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"(?U)[^{_SPACE}]+")), F.lit(0))


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends.

    The look-behind starts a trailing match only at the head of a run, so long inner runs stay linear.
    """
    return F.regexp_replace(text, rf"(?U)\A[{_SPACE}]++|(?<![{_SPACE}])[{_SPACE}]++\z", "")


def has_two_words(text: Column) -> Column:
    """True from the second word on. The search stops there, so long texts are not counted through."""
    return F.coalesce(text.rlike(rf"(?U)[^{_SPACE}][{_SPACE}]+[^{_SPACE}]"), F.lit(False))


def mentions_word(lowered: Column, words: Sequence[str]) -> Column:
    """True if any of ``words`` occurs as a whole word in lower-case text; null text mentions none.

    A plain substring test on the whole text goes first: it is far cheaper than the pattern, and few texts pass it.
    """
    anywhere = reduce(or_, [lowered.contains(word) for word in words])
    edge = r"[\p{L}\p{N}_]"
    whole = lowered.rlike(rf"(?<!{edge})(?:{'|'.join(words)})(?!{edge})")
    return F.coalesce(anywhere & whole, F.lit(False))


def strip_fences(sql: Column) -> Column:
    """Drop Markdown code fences from generated SQL, then trim it."""
    return strip(F.regexp_replace(sql, "```sql|```", ""))


def prefix(text: Column, length: int) -> Column:
    """The first ``length`` characters, for display."""
    return F.substring(text, 1, length)
