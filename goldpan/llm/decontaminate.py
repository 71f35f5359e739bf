"""Benchmark decontamination by template windows, in DataFrame functions only.

Numbers, units and names become typed placeholders, so that a question with other values still has the same template. Windows of
eight template words are hash-joined; in an occurrence, each value of the item must then stand for one value of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
#: Share of an item's distinct windows that a document must hold.
COVERAGE = 0.5
#: Consecutive windows of an item that count below that share, too: a passage of 20 words.
RUN = 13
#: Benchmark windows up to which their table is broadcast (about 20 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 500_000
#: Windows of a text that are one row while they are made: a task's memory follows this, not the length of texts.
STRETCH = 2_048
#: Units of measure.
UNITS = "km|cm|mm|kg|mg|ml|lbs?|miles?|metres?|meters?|litres?|liters?|grams?|hours?|minutes?|seconds?|days?|weeks?|years?|dollars?|euros?|percent|usd|eur"
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
#: Stands for the space inside a name of several words, which is one slot.
JOINED = "\ue003"
#: Between words: no point or comma with a digit on either side, so that a decimal or grouped number is one word. The run is not given back.
BETWEEN = rf"[^\p{{L}}\p{{Nd}}{NUMBER}-{JOINED}]++(?<![0-9][.,](?=[0-9]))"


def slots(text: Column) -> Column:
    """Text with numbers, then units behind numbers, then names (runs of capitalised words inside a sentence) led by a placeholder mark."""
    marked = F.regexp_replace(text, r"[0-9]+(?:[.,][0-9]+)*", f" {NUMBER}$0 ")
    marked = F.regexp_replace(marked, rf"({NUMBER}[0-9.,]+ +)((?i:{UNITS}))\b", f"$1{UNIT}$2")
    marked = F.when(text.rlike("[0-9]"), marked).otherwise(text)
    marked = F.regexp_replace(marked, r"\p{Lu}(?<=[a-zß-ÿ,;] .)\p{Ll}++(?: \p{Lu}\p{Ll}++)*+", f"{NAME}$0")
    # the first word of a name, or the one behind a space that was just replaced, before another capitalised word
    return F.regexp_replace(marked, rf"({NAME}\p{{L}}++|(?!^)\G\p{{L}}++) (?=\p{{Lu}}\p{{Ll}})", f"$1{JOINED}")


def tokens(text: Column) -> Column:
    """Lower-case words with their placeholder marks; everything that is not a letter, digit or mark separates."""
    words = F.split(F.lower(slots(text)), BETWEEN)
    return F.filter(words, lambda w: w != "")


def template(words: Column) -> Column:
    """Hash of every word, of its placeholder alone for marked words."""
    return F.transform(words, lambda w: F.when(w >= NUMBER, F.xxhash64(F.substring(w, 1, 1))).otherwise(F.xxhash64(w)))


def doubled(rows: DataFrame, name: str, join, longest: int) -> DataFrame:
    """``name``1 combined by ``join`` over 2, 4 and 8 neighbours in ``name``2 and so on, as far as ``longest`` asks for.

    Every step is a projection of its own, as Spark would evaluate what a single expression uses twice again and again.
    """
    for step in (x for x in (1, 2, 4) if 2 * x <= longest):
        rows = rows.withColumn(f"{name}{2 * step}", beside(F.col(f"{name}{step}"), F.col(f"{name}{step}"), step, join))
    return rows


def beside(left: Column, right: Column, step: int, join) -> Column:
    """Elements of ``left`` joined with those of ``right`` that are ``step`` places further on."""
    count = F.greatest(F.size(right) - step, F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), count), F.slice(right, F.lit(step + 1), count), join)


def spanned(name: str, length: int, join) -> Column:
    """What ``doubled`` made, combined over ``length`` neighbours."""
    parts = [x for x in (8, 4, 2, 1) if length & x]
    out, done = F.col(f"{name}{parts[0]}"), parts[0]
    for part in parts[1:]:
        out, done = beside(out, F.col(f"{name}{part}"), done, join), done + part
    return out


def stretches(rows: DataFrame, reach: int) -> DataFrame:
    """``rows`` with their ``words`` cut to ``STRETCH`` windows each, of up to ``reach`` words, the first at the place ``start`` of the text.

    Stretches overlap by what the last window of one needs. A row without words stays.
    """
    others = [c for c in rows.columns if c != "words"]
    # the outer form, here and below: Spark would push the test for rows without any below the tokens, and make them twice
    starts = F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(STRETCH)))
    rows = rows.select("*", starts.alias("start"))
    return rows.select(*others, "start", F.slice("words", F.col("start") + 1, F.lit(STRETCH + reach - 1)).alias("words"))


def windowed(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per window of ``words``, for each of ``lengths``: length, at, window, the words ``here``, and all columns but ``words``.

    A window is its template; one that placeholders make up by more than half is its exact words instead.
    """
    longest = max(lengths)
    mixed, added = (lambda a, b: F.xxhash64(a, b)), (lambda a, b: a + b)
    others = [c for c in rows.columns if c != "words"]
    rows = stretches(rows, longest)
    columns = rows.columns
    # stretches with few placeholders have no such windows, and nothing more is computed for them
    rows = rows.withColumn("many", F.size(F.filter("words", lambda w: w >= NUMBER)) > min(lengths) // 2)
    rows = rows.withColumn("t1", template(F.col("words")))
    rows = rows.withColumn("e1", F.when(F.col("many"), F.transform("words", lambda w: F.xxhash64(w, F.lit(1)))))
    rows = rows.withColumn("c1", F.when(F.col("many"), F.transform("words", lambda w: (w >= NUMBER).cast("int"))))
    for name, join in (("t", mixed), ("e", mixed), ("c", added)):
        rows = doubled(rows, name, join, longest)
    for n in lengths:
        rows = rows.withColumns({f"{name}_": spanned(name, n, join) for name, join in (("t", mixed), ("e", mixed), ("c", added))})
        # no lambda refers to a column from outside, which Spark would compute anew for each element
        exact = F.zip_with("e_", "c_", lambda e, c: F.when(c > n // 2, e))  # noqa: B023
        own = F.zip_with("t_", exact, lambda t, e: F.coalesce(e, t))
        keys = F.when(F.col("many"), own).otherwise(F.col("t_"))
        # shorter windows go on into the overlap, which the next stretch has, too
        rows = rows.withColumn(f"keys{n}", keys if n == longest else F.slice(keys, F.lit(1), F.lit(STRETCH)))
    if len(lengths) == 1:
        rows = rows.select(*columns, F.lit(longest).alias("length"), F.col(f"keys{longest}").alias("keys"))
    else:
        each = F.explode_outer(F.array(*[F.struct(F.lit(n).alias("length"), F.col(f"keys{n}").alias("keys")) for n in lengths]))
        rows = rows.select(*columns, each.alias("each")).select(*columns, "each.length", "each.keys")
    rows = rows.select(*columns, "length", F.posexplode_outer("keys").alias("at", "window"))
    # what is joined has a window's own words: the rows of a text that match are held at once, and would each hold all words
    here = F.slice("words", F.col("at") + 1, F.col("length"))
    return rows.select(*others, "length", (F.col("start") + F.col("at")).alias("at"), "window", here.alias("here"))


def marked(words: Column) -> Column:
    return F.filter(words, lambda w: w >= NUMBER)


def own_forms(texts: DataFrame) -> DataFrame:
    """(of, inner, words, length) of benchmark ``texts`` (of, text): each text as it stands, and as it reads inside a sentence.

    A first word with a capital is a name, or the start of one, where it follows other words, so the window at the start of a text has that form, too.
    """
    plain = texts.withColumn("words", tokens(F.col("text"))).withColumn("inner", F.lit(False))
    inner = plain.where(F.col("text").rlike(r"^[^\p{L}\p{Nd}]*\p{Lu}\p{Ll}") & (F.element_at("words", 1) < NUMBER))
    follows = tokens(F.concat(F.lit("a "), F.regexp_replace("text", r"^[^\p{L}\p{Nd}]+", "")))
    inner = inner.withColumns({"words": F.slice(follows, 2, F.greatest(F.size(follows) - 1, F.lit(0))), "inner": F.lit(True)})
    return plain.unionByName(inner).select("of", "inner", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("length"))


def own_windows(forms: DataFrame, lengths: list[int]) -> DataFrame:
    """(of, inner, item_at, item_window, item_length, light, item_slots) of benchmark ``forms``; of the inner form only what starts with the text."""
    found = windowed(forms.withColumnRenamed("length", "own"), lengths)
    found = found.where("window IS NOT NULL AND length = own AND (at = 0 OR NOT inner)")
    found = found.withColumn("item_slots", marked(F.col("here")))
    light = F.size("item_slots") <= F.floor(F.col("length") / 2)
    return found.select("of", "inner", F.col("at").alias("item_at"), F.col("window").alias("item_window"), F.col("length").alias("item_length"), light.alias("light"), "item_slots")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, windows, matched, share): the benchmark items that a document holds, whatever their values.

    Documents and items without words match nothing. An item of fewer words than a window is one window of its own length. Rows without an id
    are reported under a null id; rows with one id are one document. Repeated items match alike; of texts under one item id,
    that with the largest share is told. Windows made of placeholders mostly match by exact words. An occurrence is what
    matches in one text at one distance between text and item. In it, a number, unit or name of the item must stand for one
    value, else only windows with the item's own values count. The share is that of all windows, or that of the windows with
    fewer placeholders if it is larger; below ``COVERAGE``, an occurrence with ``RUN`` consecutive windows is reported as well. Further columns
    are ignored; empty tables give an empty result.
    """
    given = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).alias("item"), F.xxhash64(item_text).alias("of"), F.col(item_text).alias("text"))
    forms = own_forms(given.groupBy("of").agg(F.first("text").alias("text")))
    # at most eight lengths
    lengths = sorted((r["length"] for r in forms.select("length").distinct().collect() if r["length"] > 0), reverse=True) or [WINDOW]
    items = own_windows(forms, lengths)
    sizes = items.where("NOT inner").groupBy("of").agg(F.count(F.lit(1)).alias("all"), F.count_if("light").alias("few"))
    items = items.drop("inner")
    few = items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    # rows that share an id have occurrences of their own, told apart by their texts
    found = windowed(docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("row"), tokens(F.col(text_col)).alias("words")), lengths)
    hits = found.join(F.broadcast(items) if few else items, (F.col("window") == F.col("item_window")) & (F.col("length") == F.col("item_length")))
    hits = hits.select("key", "row", "of", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "light", "item_slots", marked(F.col("here")).alias("doc_slots"))
    seen = hits.groupBy("key", "row", "of", "shift").agg(F.collect_set(F.struct("item_at", "light", "item_slots", "doc_slots")).alias("hits"))
    seen = seen.withColumn("pairs", F.array_distinct(F.flatten(F.transform("hits", lambda h: F.arrays_zip(h["item_slots"].alias("item"), h["doc_slots"].alias("doc"))))))
    one_value = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"]))) == F.size("pairs")
    seen = seen.withColumn("hits", F.when(one_value, F.col("hits")).otherwise(F.filter("hits", lambda h: h["item_slots"] == h["doc_slots"])))
    seen = seen.withColumn("places", F.array_sort(F.array_distinct("hits.item_at")))
    run = F.exists(beside(F.col("places"), F.col("places"), RUN - 1, lambda a, b: b - a == RUN - 1), lambda x: x)
    seen = seen.withColumns({"run": run, "plain": F.transform(F.filter("hits", lambda h: h["light"]), lambda h: h["item_at"])})
    union = lambda name: F.size(F.array_distinct(F.flatten(F.collect_set(name)))).cast("long")
    seen = seen.groupBy("key", "of").agg(union("places").alias("in_all"), union("plain").alias("in_few"), F.max("run").alias("run"))
    of = lambda matched, windows: F.struct((F.col(matched) / F.col(windows)).alias("share"), F.col(windows).alias("windows"), F.col(matched).alias("matched"))
    # one row per text of a given benchmark
    out = seen.join(sizes, "of").withColumn("best", F.greatest(of("in_all", "all"), F.when(F.col("few") > 0, of("in_few", "few"))))
    out = out.where((F.col("best.share") >= COVERAGE) | F.col("run")).join(given.select("of", "item").distinct(), "of")
    out = out.groupBy(F.col("key").alias("doc_id"), F.col("item").alias("item_id")).agg(F.max("best").alias("best"))
    return out.select("doc_id", "item_id", "best.windows", "best.matched", "best.share")
