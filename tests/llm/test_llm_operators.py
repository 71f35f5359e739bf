"""Training-data operators against brute force, round trips and edge cases, on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldpan.llm import articles, chat, decontaminate, minhash, packing, pseudonyms, repeats, shingles, toxicity, vectors, warc
from goldpan.llm.common import components

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, piece int, packed string, at string"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and extra columns whose names operators use inside."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (None, "one two three four five six"), (7, long), (8, long), (9, "é漢<|endoftext|>'s  1")]
    return spark.createDataFrame([(i, t, 0, "x", None) for i, t in rows], DOCS)


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


# packing


def test_ids_equal_those_of_the_tokenizers_library(folder, spark):
    own, fast = Tokenizer.from_file(VOCABULARY), packing.encoder(VOCABULARY)
    rng = random.Random(4)
    parts = ["<|endoftext|>", "'s", "  ", "\n", "é", "١", "👍🏽", "‍", "12", " a", "\x00", "²"]
    odd = ["".join(rng.choice([*parts, chr(rng.randrange(1, 0xD7FF))]) for _ in range(40)) for _ in range(300)]
    read = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(200).collect()]
    for text in odd + read:
        assert fast(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_packing_places_every_piece_once(spark, odd_docs):
    own = Tokenizer.from_file(VOCABULARY)
    wanted = Counter()
    for doc, text in texts(odd_docs):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        number = 0
        while at < len(ids):
            end = at + ((len(ids) - at) % 1024 or 1024)
            wanted[(doc, number, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes()))] += 1
            at, number = end, number + 1
    rows = packing.pack(odd_docs, VOCABULARY).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(odd_docs.limit(0), VOCABULARY).collect() == []


def test_plan_is_optimal_where_brute_force_can_tell():
    def optimum(items, capacity):
        best = [len(items)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for j, room in enumerate(bins):
                if room >= items[k]:
                    go(k + 1, bins[:j] + [room - items[k]] + bins[j + 1 :])
            go(k + 1, [*bins, capacity - items[k]])

        go(0, [])
        return best[0]

    rng = random.Random(1)
    for _ in range(40):
        items = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        plan = packing.complete(Counter(items), 20)
        assert Counter(x for pattern, n in plan for x in pattern for _ in range(n)) == Counter(items)
        assert sum(n for _, n in plan) == optimum(items, 20)
    assert packing.complete({}, 10) == []


def test_plans_of_very_many_short_pieces():
    assert packing.complete({1: 5000}, 1024) == [((1,) * 1024, 4), ((1,) * 904, 1)]
    for counts in ({1: 3000, 700: 3}, {1: 1500, 2: 900, 1023: 2}):
        plan = packing.complete(counts, 1024)
        assert {k: sum(p.count(k) * n for p, n in plan) for k in counts} == counts and all(sum(p) <= 1024 for p, _ in plan)
    assert len(packing.fillings([1], {1: 3000}, 1023)[0]) == 1023


# near duplicates


def brute_components(docs, size, percent):
    sets, parent = {}, {}
    for doc, text in docs:
        w = words_of(text)
        grams = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
        sets[doc], parent[doc] = grams, doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_min_max_hashing_equals_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for family in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(3, 150))]
        docs += [" ".join(mutated(rng, base, rng.randint(0, max(1, len(base) // 9)))) for _ in range(rng.randint(1, 25))]
    docs = list(enumerate([*docs, None, "", "  ", "A b C d", "a B c D", "one two"]))
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for doc, (n, root) in brute_components(docs, 4, 80).items():
        assert found[doc] == (n, root, doc == root)


def test_near_duplicates_of_odd_rows(odd_docs):
    rows = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd_docs).collect())
    assert rows == Counter({(1, 1, True): 1, (2, 2, True): 1, (3, 3, True): 1, (4, 4, True): 1, (5, 4, False): 2, (None, None, True): 1, (7, 7, True): 1, (8, 7, False): 1, (9, 9, True): 1})
    assert minhash.near_duplicates(odd_docs.limit(0)).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    base = shingles.mix(np.arange(1000, dtype=np.uint64))
    other = np.concatenate([base[:800], shingles.mix(rng.integers(10**6, 10**9, 200).astype(np.uint64))])
    same = (minhash.signature(base) == minhash.signature(other)).mean()
    assert abs(same - 800 / 1200) < 0.15


def test_components_of_a_chain(spark):
    chain = spark.range(1, 200).select((F.col("id") * 7 % 211).alias("a"), ((F.col("id") + 1) * 7 % 211).alias("b"))
    roots = {r.node: r.root for r in components(chain, "a", "b").collect()}
    assert set(roots.values()) == {min(7 * k % 211 for k in range(1, 201))} and len(roots) == 199


# decontamination


def test_other_values_are_still_caught(spark):
    item = "a train leaves the old station with 12 wagons and 12 guests and meets Maria after 30 km of slow travel"
    docs = [
        (1, "Intro. " + item.upper() + " Outro."),
        (2, item.replace("12", "47").replace("30", "95").replace("Maria", "Peter")),
        (3, item.replace("12 guests", "13 guests")),  # one value of the item has become two
        (4, "nothing of the kind is said in this text which is quite long all the same"),
        (5, None), (6, ""), (None, item),
    ]
    benchmark = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "short one", 0)], "item_id long, text string, key int")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("window", F.lit(1))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, benchmark).collect()}
    assert found == {(1, 1), (2, 1), (None, 1)}
    assert decontaminate.contaminated(frame.limit(0), benchmark).collect() == []
    assert decontaminate.contaminated(frame, benchmark.limit(0)).collect() == []


def test_values_are_compared_within_one_occurrence(spark):
    item = "a train leaves the old station with 12 wagons and 12 guests and meets Maria after 30 km of slow travel"
    twice = "the price of the box is 5 dollars and the price of the box is 7 dollars so what is the sum of both"
    other = lambda n, km: item.replace("12", n).replace("30", km)
    docs = [
        (1, f"First: {item}. Then: {other('47', '95')}."), (2, f"First: {other('3', '8')}. Then: {other('47', '95')}."), (3, twice), (4, other("30", "30")),
        (5, item), (5, other("47", "95")), (6, item.replace("12 guests", "13 guests")), (7, other("47", "95").replace("old station", "old and cold station")),
    ]
    benchmark = spark.createDataFrame([(1, item), (2, twice)], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 1), (2, 1), (3, 2), (4, 1), (5, 1), (7, 1)]


def test_items_of_every_kind_are_caught(spark):
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(80)]
    items = [
        (1, "What is 12 times 7?"), (2, "Sort 9 4 7 1 3 8 2 6 0 5 11 14 13 12 and add 2"), (None, "an item without any id of its own has words enough"), (4, " ".join(words)),
        (5, "7"), (6, "the sum of 3 apples and 4 pears and 5 plums is 12 so what is 3 4 5 12 6 7 8 9 10 11 13 14 15 16 17 18 of it"), (7, "!"),
    ]
    docs = [
        (1, "They asked What is 12 times 7? and left"), (2, "Then: sort 9 4 7 1 3 8 2 6 0 5 11 14 13 12 and add 2."), (3, "x " + items[2][1]), (4, "intro " + " ".join(words[30:52]) + " outro"),
        (5, "what is 15 times 30"), (6, "there are 8 9 5 3 1 2 4 6 0 10 11 of them"), (8, "intro " + " ".join(words[30:42]) + " outro"), (9, "!"), (10, ""),
        (11, "the sum of 30 apples and 40 pears and 50 plums is 120 so what is 30 40 50 120 60 70 80 90 100 110 130 140 150 160 170 180 of it"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    assert found == {(1, 1), (1, 5), (2, 2), (2, 5), (3, None), (4, 4), (5, 1), (11, 6)}


def test_decimals_grouped_numbers_and_long_names_are_one_slot(spark):
    words = lambda t: spark.range(1).select(decontaminate.tokens(F.lit(t)).alias("w")).first().w
    number, unit, name, joined = decontaminate.NUMBER, decontaminate.UNIT, decontaminate.NAME, decontaminate.JOINED
    assert words("3.5 km, 1,200. (0.25) .5 7,x") == [number + "3.5", unit + "km", number + "1,200", number + "0.25", number + "5", number + "7", "x"]
    assert words("from New York City to Paris, Old York. End") == ["from", name + joined.join(["new", "york", "city"]), "to", name + "paris", name + joined.join(["old", "york"]), "end"]
    speed = "a car drives at a speed of 3.5 km per hour for 2.5 hours how far does it go"
    travel = "a letter from New York takes two days"
    first = "New York has so many bridges that nobody counts them"
    docs = [
        (1, "x " + speed.replace("3.5", "4.2").replace("2.5", "7.1") + " y"), (2, "x " + speed.replace("3.5", "1,200").replace("2.5", "40")), (3, travel.replace("New York", "Paris")),
        (4, travel.replace("New York", "Rio Grande Valley")), (5, "they say New York has so many bridges that nobody counts them"), (6, "they say Paris has so many bridges that nobody counts them"),
        (7, speed.replace("3.5 km per", "per 3.5")), (8, first), (9, "say that " + first.replace("many ", "")),
    ]
    benchmark = spark.createDataFrame([(1, speed), (2, travel), (3, first)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    assert found == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (8, 3)}


def test_a_long_text_full_of_an_item_fits_in_memory(spark):
    item = "every morning the old baker carries seven warm loaves of dark bread to the small harbour where sailors wait"
    docs = spark.createDataFrame([(1, " ".join([item] * 2_500)), (2, "no such words are in here at all")], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.windows, r.matched) for r in found] == [(1, 1, 12, 12)]


def test_no_window_is_lost_or_doubled_between_stretches(spark, monkeypatch):
    text = " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" if k % 5 else str(k) for k in range(100))
    docs = spark.createDataFrame([(1, text), (2, text[:30]), (3, ""), (4, None), (5, "5 6 7 8 9 10 11 12 13 14 15 16 17")], "key long, text string").select("key", decontaminate.tokens(F.col("text")).alias("words"))
    found = lambda: [tuple(r) for r in decontaminate.windowed(docs, [8, 5, 1]).where("window IS NOT NULL").select("key", "length", "at", "window", "here").orderBy("key", "length", "at").collect()]
    whole = found()
    words = {r.key: r.words or [] for r in docs.collect()}
    assert [(k, n, at, here) for k, n, at, _, here in whole] == [(k, n, at, w[at : at + n]) for k, w in sorted(words.items()) for n in (1, 5, 8) for at in range(len(w) - n + 1)]
    monkeypatch.setattr(decontaminate, "STRETCH", 7)
    assert found() == whole
    cut = decontaminate.stretches(docs, 8)
    assert cut.agg(F.max(F.size("words"))).first()[0] == 14 and {r.key for r in cut.collect()} == {1, 2, 3, 4, 5}


def test_benchmark_passages_are_found_as_by_brute_force(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = {}
    for r in items.collect():
        w = split(r.text)
        for k in range(len(w) - 7):
            grams.setdefault(tuple(w[k : k + 8]), set()).add(r.item_id)
    wanted = {(r.doc_id, i) for r in docs.collect() for w in [split(r.text)] for k in range(len(w) - 7) for i in grams.get(tuple(w[k : k + 8]), ())}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == wanted


# personal data


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark):
    rng = random.Random(3)
    cards = []
    while len(cards) < 60:
        number = "".join(rng.choice("0123456789") for _ in range(16))
        cards.append(number)
    rows = [(k, f"pay {c} or {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} on 20{k % 100:02d}-02-{k % 28 + 1:02d}") for k, c in enumerate(cards)]
    rows += [(100, None), (101, ""), (102, "no data, just 3.14 and v1.2.3 or 2024-02-30"), (103, "a.b1@mail.example.com 1.2.3.4 +1 (555) 010-9999 999.1.1.1"), (104, "x " * 100_000 + "1.2.3.4")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("kept"))
    out = {r.doc_id: r for r in pseudonyms.pseudonymise(frame, "key", count="changed").collect()}
    seen = {}
    for k, c in enumerate(cards):
        plain, spaced, day = re.fullmatch(r"pay (\d{16}) or ([\d ]{19}) on (\d{4}-\d{2}-\d{2})", out[k].text).groups()
        assert plain == spaced.replace(" ", "") and luhn(plain) == luhn(c) and (plain == c) == (not luhn(c))
        assert seen.setdefault(plain, c) == c
    assert out[100].text is None and out[101].text == "" and out[102].text == rows[62][1] and out[102].changed == 0
    mail, ip, phone, bad = re.fullmatch(r"(\S+) (\S+) (\+\d \(\d{3}\) \d{3}-\d{4}) (\S+)", out[103].text).groups()
    assert mail.endswith("@mail.example.com") and len(mail) == 21 and mail != "a.b1@mail.example.com" and bad == "999.1.1.1"
    assert all(0 <= int(x) <= 255 for x in ip.split(".")) and ip != "1.2.3.4" and phone != "+1 (555) 010-9999"
    assert out[104].text.endswith(ip) and out[0].n == "kept"
    assert pseudonyms.pseudonymise(frame.limit(0), "key").collect() == []


def test_usual_forms_of_personal_data_are_replaced(spark):
    forms = {
        "JSMITH@corp.com": r"[A-Z]{6}@corp\.com", "John.Smith7@corp.com": r"[A-Z][a-z0-9]{3}\.[A-Z][a-z0-9]{5}@corp\.com", "(555) 123-4567": r"\(\d{3}\) \d{3}-\d{4}",
        "555-123-4567": r"\d{3}-\d{3}-\d{4}", "030 12345678": r"\d{3} \d{8}", "12/03/2024": r"[01]\d/[0-3]\d/(19|20)\d\d", "25/12/2024": r"[0-3]\d/[01]\d/(19|20)\d\d",
        "3.12.1980": r"[1-3]?\d\.1?\d\.(19|20)\d\d", "2024/02/29": r"(19|20)\d\d/[01]\d/[0-3]\d",
    }
    same = ["31.02.2024", "v1.2.2000", "1.2.3", "13/13/2024", "123-4567"]
    frame = spark.createDataFrame([(v, f"a {v}, b {v}.") for v in [*forms, *same]], "value string, text string")
    for r in pseudonyms.pseudonymise(frame, "key", count="changed").collect():
        one, two = re.fullmatch(r"a (.*), b (.*)\.", r.text).groups()
        assert one == two and r.changed == (0 if r.value in same else 2), r
        assert one == r.value if r.value in same else re.fullmatch(forms[r.value], one) and one != r.value, r


def test_feistel_is_a_permutation(spark):
    all_of = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    out = all_of.select(pseudonyms.permuted(F.col("v"), F.lit(3), F.lit("k"), "x").alias("p")).collect()
    assert sorted(r.p for r in out) == [f"{k:03d}" for k in range(1000)]


# repeats


def brute_repeats(docs, least):
    where = Counter(data[k : k + least] for _, data in docs for k in range(len(data) - least + 1))
    out = Counter()
    for doc, data in docs:
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - least + 1):
            if where[data[k : k + least]] > 1:
                gone[k : k + least] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[(doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_runs_of_blocks_are_merged():
    rng = random.Random(9)
    for _ in range(200):
        spots = [repeats.spot(rng.randrange(300, 5000), low := rng.randrange(200), rng.randrange(low, 273), True) for _ in range(rng.randrange(12))]
        gone = np.zeros(7000, bool)
        for at, low, high, _ in map(repeats.unspot, spots):
            gone[at - high : at - low + 400] = True
        start, stop = repeats.runs(np.array(spots, np.int64), 400)
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        assert start.tolist() == edges[::2].tolist() and stop.tolist() == edges[1::2].tolist()


def test_frequent_keys_are_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "ROWS_PER_PART", 50)
    rows = spark.range(2000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id") % 40 + 100).alias("core"), F.col("id").alias("span"), F.lit(None).cast("long").alias("x"))
    other = spark.range(300).select(F.col("id").alias("core"), (F.col("id") * 2).alias("y"))
    out = repeats.joined(rows, other, ["core"], ["span"])
    assert sorted(map(tuple, out.select("core", "span", "x", "y").collect())) == sorted(map(tuple, rows.join(other, "core").select("core", "span", "x", "y").collect()))
    # the hot key is more than one group of the join
    parts = rows.select(F.xxhash64("core").alias("hash")).transform(lambda f: repeats.hot_keys(f, "hash", 50)).orderBy(F.desc("_parts")).collect()
    assert parts[0]["_parts"] == 18 and len(parts) <= 41


@pytest.mark.parametrize("rows_per_part", [3, 20_000])
def test_repeats_equal_brute_force(spark, odd_docs, rows_per_part, monkeypatch):
    monkeypatch.setattr(repeats, "ROWS_PER_PART", rows_per_part)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, other = noise(900), noise(420)
    rows = [(1, noise(500) + passage + noise(300)), (2, passage[:650] + noise(200) + other), (3, noise(50) + passage[250:]), (4, other[1:] + noise(30)), (5, other), (6, "ab" * 900),
            (7, noise(399)), (8, noise(1000)), (9, passage[:398]), (10, None), (11, ""), (12, other), (None, other), (13, "line of text\n" * 90 + noise(100)), (13, noise(2000))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1))
    out = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removed(frame).collect())
    assert out == brute_repeats([(i, (t or "").encode()) for i, t in rows], 400)
    assert repeats.removed(frame.limit(0)).collect() == []


def test_texts_without_repeats_are_returned(spark):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    passage, copy, short = noise(410), noise(700), noise(90)
    # (5) and (6) share all but the first byte of their 3-byte characters before the passage
    rows = [("1", "x" + noise(100) + "y" + passage + "z" + noise(50)), ("2", passage + "w"), ("3", copy), ("3", copy), (None, short), ("4", short), ("5", "v\u20ac" + copy[:450]), ("6", "v\u30ac" + copy[:450] + "u"), ("7", None), ("8", noise(600))]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    found = repeats.without_repeats(frame).collect()
    assert len(found) == len(rows)
    texts = {doc: (text or "").encode() for doc, text in rows}
    for row in found:
        data, spans = texts[row.doc_id], [(x.start, x.stop) for x in row.spans]
        assert row.n_bytes == len(data)
        assert bytes(row.kept) == b"".join(data[a:b] for a, b in zip([0, *(x[1] for x in spans)], [*(x[0] for x in spans), len(data)]))
    out = {row.doc_id: row for row in repeats.removed(frame).collect()}
    assert out["1"].text == rows[0][1].replace(passage, "") and out["2"].text == "w"
    assert out["3"].text == "" and out[None].text == out["4"].text == short
    # the last two bytes of the characters are equal, too, and go with the passage; what is left of them is no character
    assert out["5"].n_removed == out["6"].n_removed == 452 and out["5"].text == "v\ufffd" and out["6"].text == "v\ufffdu"
    assert out["7"].text == "" and out["8"].text == rows[-1][1]
    assert all(out[doc].kept_sha256 == hashlib.sha256(out[doc].text.encode()).hexdigest() for doc in "123478")


# archives


def test_archives_round_trip(spark):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a", big), (2, None, big), (3, "http://c\r\nX: 1", "small"), (4, "http://d", "small"), (5, "u", None), (6, "u", ""), (None, "u", big), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 90), (2, "again", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("value", F.lit(1))
    found = Counter(tuple(r) for r in warc.archived(pages).collect())
    wanted = Counter()
    for i, _, text in rows:
        data = (text or "").encode()
        revisit = text == big and i != 2
        wanted[(i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None)] += 1
    assert found == wanted
    assert warc.archived(pages.limit(0)).collect() == []


def test_a_cut_stream_is_an_error():
    import gzip

    data = gzip.compress(b"WARC/1.1\r\nContent-Length: 10\r\n\r\n123")
    with pytest.raises(ValueError):
        list(warc.split_stream(data))


# vectors


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for family in range(60):
        base = rng.standard_normal(64)
        rows += [base + rng.standard_normal(64) * rng.choice([0.05, 0.1, 0.3]) for _ in range(rng.integers(1, 9))]
    rows = [x.astype(np.float32) for x in rows]
    rows += [rows[0], rows[0]]
    data = [(k, [float(v) for v in x]) for k, x in enumerate(rows)]
    n = len(data)
    odd = [(n, None), (n + 1, [0.0] * 64), (n + 2, [float("nan")] * 64), (n + 3, []), (n + 4, [1.0, None]), (n + 5, [1.0, 2.0]), (n + 6, [2.0, 4.0]), (None, data[0][1])]
    frame = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.linked(frame).collect()}
    x = np.array(rows, float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    label = np.arange(n)
    for _ in range(n):
        label = np.minimum(label, np.where(close, label[None, :], n).min(1))
    caught = sum(found[k][0] for k in range(n))
    assert caught == close.sum()
    assert [found[k] for k in range(n)] == [(close[k].sum(), label[k], label[k] == k) for k in range(n)]
    for k in range(n, n + 5):
        assert found[k] == (0, k, True)
    assert found[n + 5] == (1, n + 5, True) and found[n + 6] == (1, n + 5, False) and found[None] == (0, None, True)
    assert vectors.linked(frame.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["short", "decimal(20,0)", "string"])
def test_vectors_take_ids_of_any_type_and_large_buckets(spark, monkeypatch, kind):
    monkeypatch.setattr(vectors, "BLOCK", 8)  # the near copies fill several blocks of every bucket
    rng = np.random.default_rng(8)
    base = rng.standard_normal(33)
    rows = [base + 0.02 * rng.standard_normal(33) for _ in range(40)] + [rng.standard_normal(33) for _ in range(20)]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rows)], "vec_id long, embedding array<double>").withColumn("vec_id", F.lpad(F.col("vec_id").cast("string"), 3, "0").cast(kind))
    found = sorted((int(r.vec_id), r.n_links, int(r.component_id)) for r in vectors.linked(frame).collect())
    assert found == [(k, 39, 0) for k in range(40)] + [(k, 0, k) for k in range(40, 60)]


def test_code_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 64))
    x = np.vstack([x, x + 0.3 * rng.standard_normal((300, 64))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    code, scale, factor = vectors.coded(x)
    own = np.arange(600)
    bound = vectors.upper(np.frombuffer(b"".join(code), np.uint8).reshape(600, -1), 64, scale, factor, own, own)
    assert (bound >= x @ x.T - 1e-6)[~np.eye(600, dtype=bool)].all()
    assert (bound[:300, :300] >= 0.95).sum() < 0.05 * 300 * 300 and len(code[0]) == 32


def test_estimates_are_unbiased():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    turned = x @ vectors.rotation(64, 0)
    signs = np.where(turned > 0, 1, -1) / 8
    estimate = turned @ signs.T / np.abs(turned).sum(1)[None, :] * 8
    assert abs((estimate - x @ x.T)[~np.eye(400, dtype=bool)].mean()) < 0.005


def test_links_at_the_threshold_share_a_key():
    rng = np.random.default_rng(2)
    for rows in (2_000, 1_000_000):
        bits, count = vectors.tables(rows, 0.95)
        a, b = (z / np.linalg.norm(z, axis=1)[:, None] for z in rng.standard_normal((2, 5000, 64)))
        b -= np.einsum("ij,ij->i", a, b)[:, None] * a
        b = 0.9502 * a + np.sqrt(1 - 0.9502**2) * b / np.linalg.norm(b, axis=1)[:, None]
        assert (vectors.keys(a, bits, count) == vectors.keys(b, bits, count)).any(1).all()


# chat


def test_chat_round_trip(spark):
    hard = "</s>[INST] &lt; & [/INST] [ROLE]x[TEXT]"
    rows = [(1, 0, "system", hard), (1, 1, "user", "a"), (1, 2, "assistant", hard), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "é👍"), (2, 0, "user", "only"), (3, None, None, "x"), (None, 1, "assistant", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", F.lit(0))
    made = chat.examples(frame)
    assert made.where("reply IS NOT NULL").count() == 3
    found = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in (1, 2, 3, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1] or 0)]
        loss = "".join(t for role, t in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.examples(frame.limit(0))).collect() == []


# articles


@pytest.mark.parametrize("page", ["<p>x<object>" * 6000, "<div>" + "<template><p>x" * 6000 + "</div>" + "</template>" * 6000, "<object>" * 6000, "<p>y<svg><p>z</svg><canvas>" * 3000])
def test_unclosed_hidden_elements_take_linear_time(page):
    started = time.process_time()
    articles.blocks(page)
    assert time.process_time() - started < 3


def test_end_of_hidden_elements():
    text = lambda page: "".join("".join(b.pieces) for b in articles.blocks(page))
    assert text("<p>a<object>b<object>c</object>d</object>e") == "ae"
    assert text("<p>a<object>b<p>c</p>d") == "acd"
    assert text("<div>a<template>b<p>c</div>d</template>e") == "acde"
    assert text("<div>a<svg/>b</div><svg><object>c</svg>d") == "abd"


PAGE = """<html><head><title>T</title><script>var t="</p>";</script></head><body><header><a href="/">Home</a></header>
<div class="cookie-notice">We use cookies on this site and you agree to that by reading on.</div><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="content"><h2>The title</h2><p>The first of the paragraphs is long enough to be told from what is around it, and it has all the words that
 people use &amp; need.</p><p>Short.</p><p>And the second of them is there for the same reason, with as many of those words as it takes to be sure of it.</p></div>
<aside>Related</aside><div class="comments"><p>This is the comment of a reader and it is not at all a part of the article above it.</p></div>
<form><p>Sign up for the letter of the week and have it sent to you by mail</p></form><footer>&copy; x</footer></body></html>"""


def test_article_rules():
    text = articles.main_text(PAGE)
    lines = text.split("\n")
    assert len(lines) >= 3 and lines[-3].startswith("The first of") and "use & need." in lines[-3] and lines[-2] == "Short." and lines[-1].startswith("And the second")
    assert not any(x in text for x in ("cookies", "Home", "comment", "Related", "letter", "©"))
    assert articles.main_text("") == "" and articles.main_text("<p>") == ""


def test_no_text_is_lost_behind_unclosed_elements_or_class_names():
    long = "This is a paragraph of the article and it has all of the words that one would look for in such a text as this one is."
    hidden = ("<head><title>T</title>", "<head><script>'<p>'</script><meta x></head>", '<svg viewBox="0"/>', "<math/>", "<div><button>Go</div>", "<p><select><option>A</p>", "<div><object data=x></div>")
    hidden += ("<button>Go", "<button>A</button>", "<svg><svg/><text>A</text></svg>", "<div><object><object>A</object>A</object></div>")
    for start in hidden:
        assert articles.main_text(f"<html>{start}<body><p>{long}</p><p>{long}<button>A</button></p></body></html>") == f"{long}\n{long}", start
    for mark in ('class="content no-sidebar"', 'id="main" class="page-header-fixed"', 'class="has-sidebar"', 'class="page sidebar"'):
        assert articles.main_text(f"<body><div {mark}><article><p>{long}</p></article></div></body>") == long, mark
        assert articles.main_text(f"<body><div {mark}><p>{long}</p></div></body>") == long, mark
    assert articles.main_text(f'<body><p>{long}</p><div class="comments"><article><p>A {long}</p></article></div><div class="sidebar"><p>B {long}</p></div></body>') == long


def test_article_elements_are_taken_whole(spark, folder):
    import html

    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r.page_id: r.text for r in articles.extract(pages.withColumn("text", F.lit("old"))).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert found[r.page_id] == "\n".join(x for x in parts if x)
    odd = spark.createDataFrame([(1, None), (None, ""), (3, "plain")], "page_id long, html string")
    assert {r.page_id: r.text for r in articles.extract(odd).collect()}[1] == ""
    assert articles.extract(odd.limit(0)).collect() == []


# toxicity


def test_held_out_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = lambda i: F.crc32(i.cast("string").cast("binary")) % 4 == 2
    model = toxicity.train(docs.select("doc_id", "text"), labels, lambda i: ~out(i))
    held = docs.select("doc_id", "text").join(labels, "doc_id").where(out(F.col("doc_id")))
    rows = toxicity.score(held, model).collect()
    hit = sum(r.score >= 0.3 for r in rows if r.toxic)
    assert hit / sum(r.toxic for r in rows) > 0.9 and hit / sum(r.score >= 0.3 for r in rows) > 0.9


def test_training_gathers_no_words_on_the_driver(spark, monkeypatch):
    rng = random.Random(4)
    words = lambda k: [f"w{rng.randrange(60)}" for _ in range(20)] + ["women"] * (k % 3 == 0) + ["idiot"] * (k % 2)
    texts = [" ".join(words(k)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    expected = toxicity.fit([toxicity.word_counts(t) for t in texts], [k % 2 for k in range(60)])
    # both take the words of all texts in memory
    monkeypatch.setattr(toxicity, "fit", None)
    monkeypatch.setattr(toxicity, "informative", None)
    model = toxicity.train(docs, labels, lambda i: i >= 0)
    assert model.index == expected.index
    assert np.allclose(model.weights, expected.weights) and np.isclose(model.bias, expected.bias)
    one_kind = toxicity.train(docs, labels.withColumn("toxic", F.lit(0)), lambda i: i >= 0)
    assert not one_kind.index


def test_group_terms_do_not_sway_the_score():
    rng = random.Random(2)
    filler = lambda: [f"w{rng.randrange(60)}" for _ in range(20)]
    texts, labels = [], []
    for k in range(400):
        toxic = k % 2
        group = "women" if rng.random() < (0.9 if toxic else 0.1) else "men"
        texts.append(Counter([*filler(), group, *(["idiot"] if toxic and rng.random() < 0.6 else [])]))
        labels.append(toxic)
    gap = {}
    for penalty in (0.0, 50.0):
        model = toxicity.fit(texts, labels, penalty)
        gap[penalty] = abs(model.score("all women here") - model.score("all men here"))
    assert gap[50.0] < 0.1 < gap[0.0]


def test_scores_of_odd_rows(spark, odd_docs):
    model = toxicity.fit([Counter(["bad"]), Counter(["good"])] * 5, [1, 0] * 5)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(odd_docs.limit(0), model).collect() == []
    assert toxicity.fit([], []).score("x") == 0.5
