"""Prefix-target expansion of conversations, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and its text alone is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A turn is ROLE, its role, TEXT, its text, END. Escaped texts hold no "<" or "[", so they can't hold one of these.
ROLE, TEXT, END = "[ROLE]", "[TEXT]", "</s>"
#: Characters that control strings start with, and the escape character itself, which comes first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escaped(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column) -> Column:
    for plain, coded in ESCAPES[::-1]:
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """(conv_id, example, context, reply): one row per ``trained`` turn, numbered from 0 in a conversation.

    ``context`` + ``reply`` + END is the formatted example, and ``reply`` is what counts for the loss. Turns after the last trained one follow as one
    more example with a null reply, so that no turn is lost. Null texts and roles are empty; turns with one number are
    ordered by role and text, null numbers first; a null conversation is a conversation. Further columns are ignored.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text")).alias("one"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    head = lambda t: F.concat(F.lit(ROLE), escaped(t["role"]), F.lit(TEXT))
    rows = rows.withColumn("parts", F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("text"), (t["role"] == trained).alias("trained"))))
    rows = rows.withColumn("places", F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: F.element_at("parts", i)["trained"]))
    rows = rows.withColumn("places", F.when(F.element_at("parts", -1)["trained"], F.col("places")).otherwise(F.concat("places", F.array(F.size("parts") + 1))))
    rows = rows.select("conv_id", "parts", F.posexplode("places").alias("example", "place"))
    before = F.transform(F.slice("parts", F.lit(1), F.col("place") - 1), lambda p: F.concat(p["head"], p["text"], F.lit(END)))
    own = F.try_element_at("parts", "place")
    context = F.concat(F.array_join(before, ""), F.coalesce(own["head"], F.lit("")))
    return rows.select("conv_id", "example", context.alias("context"), own["text"].alias("reply"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its formatted examples alone: turns and their digest, the trained text and its digest, and size."""
    whole = F.concat("context", F.when(F.col("reply").isNull(), "").otherwise(F.concat("reply", F.lit(END))))
    rows = formatted.withColumn("whole", whole)
    rows = rows.groupBy("conv_id").agg(
        F.max_by("whole", "example").alias("last"),
        F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))).alias("replies"),
        F.sum(F.length("whole")).alias("formatted_chars"),
    )
    rows = rows.withColumn("parts", F.split("last", END, -1))
    rows = rows.withColumn("parts", F.slice("parts", F.lit(1), F.size("parts") - 1))
    plain = lambda p: F.concat(unescaped(F.substring_index(F.substr(p, F.lit(len(ROLE) + 1)), TEXT, 1)), F.lit("\n"), unescaped(F.substring_index(p, TEXT, -1)), F.lit("\n"))
    loss = F.array_join(F.transform("replies", lambda r: unescaped(r["reply"])), "")
    rows = rows.select("conv_id", F.size("parts").cast("long").alias("n_turns"), F.array_join(F.transform("parts", plain), "").alias("text"), loss.alias("loss"), "formatted_chars")
    return rows.select(
        "conv_id", "n_turns", F.sha2("text", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
