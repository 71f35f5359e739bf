"""Spelling variants, Merkle proofs and token counts against brute force, SQL and the tokenizer's own library."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldpan.llm import manifest, pseudonyms, queries, reference_sql, spelling, tokens
from tests.test_oracle import duck, rows_by_name, types_by_name

DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, n int, idx int, row int"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, null ids and sources, and extra columns whose names operators use inside."""
    long = " ".join(f"word{'abcdefgh'[i % 8]}letters{'xyz'[i % 3]}" for i in range(20_000))
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", "a"), (5, "Same text", "en", "b"), (5, "Same text", "en", "b")]
    rows += [(None, "no Id", "en", "a"), (None, "no Id either", "en", None), (7, long, "en", "a"), (-8, "é漢<|endoftext|>'s  1", "de", "")]
    rows += [(100 + i, f"Text number {i}", "en", "c") for i in range(40)]
    return spark.createDataFrame([(i, t, l, s, None if t is None else len(t), "x", 0, 0, 0) for i, t, l, s in rows], DOCS)


@pytest.mark.parametrize("name", reference_sql.oracle_sql())
def test_registered_queries_match_sql(spark, folder, name):
    frame = queries.queries()[name](spark, folder)
    found, result = [tuple(r) for r in frame.collect()], duck(folder).sql(reference_sql.oracle_sql()[name])
    assert types_by_name(frame.columns, [t for _, t in frame.dtypes]) == types_by_name(result.columns, [str(t) for t in result.types])
    assert found and rows_by_name(frame.columns, found) == rows_by_name(result.columns, result.fetchall())


# spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(docs, spoil):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    close = {w: [x for x in n if near(w, x)] for w in n}
    form = {w: min(x, key=lambda y: (-n[y], y)) if x and max(n[y] for y in x) >= 2 * n[w] else None for w, x in close.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(close[w]), n.get(form[w])) for w in n}


@pytest.mark.parametrize("hot", [spelling.HOT_PAIRS, 3])
def test_spelling_variants_equal_brute_force(spark, hot):
    rng = random.Random(11)
    letters = "abcdeßÉ÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 12))) for _ in range(30)] + ["aaaaa", "aaaaaa", "aaaaaaa", "shared" * 3]
    words = []
    for w in base:
        words += [w] * rng.randrange(3, 60)
        for _ in range(4):
            k = rng.randrange(len(w))
            other = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            words += [other] * rng.randrange(2, 12)
    rng.shuffle(words)
    docs = [(i, " ".join(w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words[i::40]) + " x漢y") for i in range(40)]
    docs += [(None, "shared" * 3 + " null id"), (3, None), (4, "")]
    found = spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), spoil=7, hot=hot)
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()} == brute_variants(docs, 7)


def test_near_words_where_one_beginning_is_shared_by_all(spark):
    # every word has the same first half: one chunk holds all of them
    words = [f"commonstart{a}{b}{c}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"]
    words += [w[:-1] for w in words[::5]]
    frame = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
    found = {(r.a, r.b) for r in spelling.near_pairs(frame, hot=50).collect()}
    unique = sorted(set(words))
    expected = {tuple(sorted((a, b), key=lambda w: (len(w), w))) for k, a in enumerate(unique) for b in unique[k + 1 :] if near(a, b)}
    assert found == expected and len(expected) > 1000


def test_spelling_of_odd_rows(odd_docs):
    found = {r.word: r for r in spelling.variants(odd_docs).collect()}
    assert 38 <= found["number"].n <= 40
    assert sum(r.n for w, r in found.items() if "letter" in w) > 19_000
    assert spelling.variants(odd_docs.limit(0)).collect() == []
    assert spelling.variants(odd_docs.where("text IS NULL")).collect() == []


# manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    """(root, proof of each leaf as levels of (before, after))."""
    paths, nodes, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for k, at in enumerate(place):
            run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
            paths[k].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
            place[k] = at // 16
        nodes = [sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute_proofs(rows):
    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    none_first = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((none_first(r.doc_id), leaf((r.doc_id, r.source, r.lang, r.n_chars, r.text)), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: x[:2])
        trees[s] = brute_tree([x[1] for x in groups[s]])
    root, tops = brute_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, own, r), path in zip(groups[s], trees[s][1]):
            path = path + top
            folded = own
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                low = None if r.text is None else r.text.translate({c: c + 32 for c in range(65, 91)})
                folded = leaf((r.doc_id, r.source, r.lang, r.n_chars, low))
            for before, after in path:
                folded = sha(before + folded + after)
            out.append((r.doc_id, own, trees[s][0], root, sha("".join(b + a for b, a in path)), folded, folded == root))
    return out


def proofs(docs):
    return manifest.proven(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_proofs_equal_brute_force(spark, odd_docs):
    wide = spark.range(700).selectExpr(
        "id AS doc_id", "concat('Text ', id % 50) AS text", "'en' AS lang", "if(id % 3 = 0, 'hot', concat('s', id % 40)) AS source", "id AS n_chars"
    )
    for docs in (odd_docs, wide, odd_docs.where("doc_id = 1"), odd_docs.where("source = 'a'")):
        found = [tuple(r) for r in proofs(docs).collect()]
        assert sorted(found, key=key) == sorted(brute_proofs(docs.collect()), key=key)
    assert {r.verified for r in proofs(wide).collect()} == {True, False}
    assert proofs(odd_docs.limit(0)).collect() == []


def test_many_equal_rows_and_some_requests(spark):
    docs = spark.range(600).selectExpr("if(id < 400, 7L, id) AS doc_id", "'same' AS text", "'en' AS lang", "'one' AS source", "4L AS n_chars")
    assert sorted((tuple(r) for r in proofs(docs).collect()), key=key) == sorted(brute_proofs(docs.collect()), key=key)
    lower, upper = manifest.manifest(docs)
    asked = lower.leaves.where("idx IN (3, 17, 599)").select("group", "idx")
    found = manifest.opened(lower, upper, asked).collect()
    assert sorted(r.doc_id for r in found) == [7, 7, 599]
    for r in found:
        folded = r.leaf
        for part in reversed(r.path):
            folded = sha(part["before"] + folded + part["after"])
        assert folded == r.root


# token counts


def test_token_counts_equal_the_library(spark, odd_docs):
    library, counts = Tokenizer.from_file(queries.WORD_VOCABULARY), tokens.Counts(queries.WORD_VOCABULARY)
    own = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    for c in map(chr, range(256)):
        for text in (c, f"a{c}b", c + c, f"1{c}!'{c}s", f" {c} ", f"A'{c}LL"):
            assert counts.count(text) == own(text), (c, text)
    found = tokens.counted(odd_docs, queries.WORD_VOCABULARY).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == Counter((r.doc_id, own(r.text or "")) for r in odd_docs.collect())
    assert {r.doc_id: r.over_limit for r in found if r.doc_id in (1, 7)} == {1: False, 7: True}
    assert next(r.n_bytes for r in found if r.doc_id == -8) == len("é漢<|endoftext|>'s  1".encode())
    assert tokens.counted(odd_docs.limit(0), queries.WORD_VOCABULARY).collect() == []


def test_huge_texts_are_spliced_exactly(spark):
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "'s", "'RE", "'", "!!'ll", " ", "\n", "é", "é", "漢字", "ひ", "İ", "Σ", "ß", " ", "1", "²", "٣", "ͅ", "ㅏ", "가", "가", "the", "<|endof"]
    kinds = [
        lambda n: "".join(rng.choice(parts) for _ in range(n)),
        lambda n: "".join(rng.choice("etaoinshrdlu") for _ in range(3 * n)),
        lambda n: "a" * 3 * n,  # a period: chunks never agree until one sees the whole run
        lambda n: "".join(rng.choice("!.,'-#") for _ in range(2 * n)),
        lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n)),
        lambda n: "".join(rng.choice("ְ̣́ͅ") for _ in range(3 * n)),  # marks only: no place to cut
        lambda n: " ".join(rng.choice(["don't", "hello", "wörld", "12", "x<|endoftext|>y"]) for _ in range(n)),
    ]
    rows = [(i, kinds[i % 7](rng.randrange(100, 2500))) for i in range(70)]
    library = Tokenizer.from_file(queries.WORD_VOCABULARY)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in tokens.counted(docs, queries.WORD_VOCABULARY, chunk=600, overlap=150).collect()}
    assert found == {i: len(library.encode(text, add_special_tokens=False).ids) for i, text in rows}


def test_boundaries_count_only_if_both_sides_agree():
    left = [(0, 2, 7), (2, 4, 8), (4, 6, 9), (6, 9, 1)]
    right = [(1, 2, 5), (2, 4, 8), (4, 6, 9), (6, 7, 2)]
    assert tokens.stable(left, right, 0, 9) == (2, 2)
    assert tokens.stable(left, right, 3, 9) is None and tokens.stable(left, right, 0, 5) is None
    assert tokens.stable([(0, 2, 7), (1, 2, 8)], [(0, 2, 7), (1, 2, 8)], 0, 9) is None  # parts of one character


# pseudonyms


def test_short_users_keep_their_length_and_long_runs_are_fast(spark):
    users = list("abcdefghijklmnopqrstuvwxyz") + ["ab", "zz"]
    run = "x" * 1_000_000
    docs = spark.createDataFrame([(u, f"mail {u}@b.com") for u in users] + [("run", run)], "id string, text string")
    start = time.perf_counter()
    found = {r.id: r.text for r in pseudonyms.pseudonymise(docs, "k").collect()}
    assert time.perf_counter() - start < 60 and found["run"] == run
    names = {u: re.fullmatch(r"mail ([a-z0-9]+)@b\.com", found[u]).group(1) for u in users}
    assert all(len(names[u]) == len(u) for u in users) and len(set(names.values())) == len(users)
