"""A toxicity classifier that identity terms cannot sway: swapped sentences must score alike.

Logistic regression over words and word beginnings. Each training text that names a group gets a twin with another
group in its place, and the training loss adds the squared difference of both scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.llm.common import stored

#: Interchangeable identity terms, by kind.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("gay", "lesbian", "straight", "trans", "bisexual"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist"), ("muslims", "jews", "christians", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("immigrants", "refugees", "foreigners", "natives"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("muslime", "juden", "christen"), ("femmes", "hommes"), ("musulmans", "juifs", "chrétiens"),
    ("mujeres", "hombres"), ("musulmanes", "judíos", "cristianos"),
)
_KIND = {term: kind for kind in IDENTITY for term in kind}
_WORD = re.compile(r"[^\W\d_]+")
#: Bounds of what the driver fits: labelled texts (the first by hash of the id), and features.
SAMPLE_ROWS, FEATURES = 8_000, 4_096
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3


def word_counts(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def features(word: str) -> list[str]:
    return [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]


def swapped(counts: Counter) -> Counter | None:
    """The text with every identity term replaced by the next of its kind; None if it names no group."""
    terms = [w for w in counts if w in _KIND]
    if not terms:
        return None
    twin = Counter({w: n for w, n in counts.items() if w not in _KIND})
    for w in terms:
        kind = _KIND[w]
        twin[kind[(kind.index(w) + 1) % len(kind)]] += counts[w]
    return twin


class Classifier:
    """Weights by feature; a text's features are their counts per hundred words, at most 1 each."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, bias: float):
        self.index, self.weights, self.bias = index, weights, bias
        self._of: dict[str, tuple[int, ...]] = {}

    def columns(self, word: str) -> tuple[int, ...]:
        found = self._of.get(word)
        if found is None:
            if len(self._of) > 500_000:
                self._of.clear()
            found = self._of[word] = tuple(self.index[f] for f in features(word) if f in self.index)
        return found

    def values(self, counts: Counter) -> dict[int, float]:
        out: dict[int, float] = {}
        for word, n in counts.items():
            for k in self.columns(word):
                out[k] = out.get(k, 0) + n
        scale = max(1.0, counts.total() / 100)
        return {k: min(1.0, n / scale) for k, n in out.items()}

    def score(self, text: str) -> float:
        z = self.bias + sum(self.weights[k] * v for k, v in self.values(word_counts(text)).items())
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))


def gain(a: int, b: int, ones: int, zeros: int) -> float:
    """How well a feature in ``a`` of the toxic and ``b`` of the other texts tells them (likelihood ratio)."""
    xlog = lambda x: x * math.log(x) if x > 0 else 0.0
    return xlog(a) + xlog(b) + xlog(ones - a) + xlog(zeros - b) - xlog(a + b) - xlog(ones + zeros - a - b)


def telling(a: int, b: int, ones: int, zeros: int) -> bool:
    return a > 2 and a * zeros > b * ones


def named(known: list[str], limit: int) -> list[str]:
    """All identity terms, for the penalty to act on, then the ``known`` features, best first."""
    return [*_KIND, *(f for f in known if f not in _KIND)][:limit]


def informative(texts: list[Counter], toxic: list[int], limit: int) -> list[str]:
    """The features that tell toxic texts best, of texts held in memory."""
    here, there = Counter(), Counter()
    for counts, label in zip(texts, toxic):
        (here if label else there).update({f for w in counts for f in features(w)})
    ones, zeros = sum(toxic), len(toxic) - sum(toxic)
    known = {f: gain(n, there[f], ones, zeros) for f, n in here.items() if telling(n, there[f], ones, zeros)}
    return named(sorted(known, key=lambda f: (-known[f], f)), limit)


class Cells:
    """Values by row and feature number, laid flat."""

    def __init__(self, lengths: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.rows = np.repeat(np.arange(len(lengths)), lengths)
        self.columns, self.values, self.n = columns.astype(int), values.astype(float), len(lengths)

    @classmethod
    def of(cls, rows: list[dict[int, float]]) -> Cells:
        columns, values = ([x for row in rows for x in part(row)] for part in (dict.keys, dict.values))
        return cls(np.array([len(x) for x in rows], int), np.array(columns), np.array(values))


def twin_gap(model: Classifier, counts: Counter) -> dict[int, float] | None:
    """The difference between the values of a text and of its twin; None if it names no group."""
    twin = swapped(counts)
    if not twin:
        return None
    gap = Counter(model.values(counts))
    gap.subtract(model.values(twin))
    return dict(gap)


def constant(toxic: list[int]) -> Classifier:
    """For labels of one kind at most: the share of toxic ones, one half if there are none."""
    rate = min(0.999, max(0.001, sum(toxic) / len(toxic))) if len(toxic) else 0.5
    return Classifier({}, np.zeros(0), math.log(rate / (1 - rate)))


def fitted(model: Classifier, texts: Cells, twins: Cells, toxic: np.ndarray, penalty: float = 1.0, steps: int = 400) -> Classifier:
    """Train the weights of ``model`` on the values of texts and on the gaps to their twins."""
    r, c, v, tr, tc, tv = texts.rows, texts.columns, texts.values, twins.rows, twins.columns, twins.values
    y, w, b = np.array(toxic, float), model.weights, -2.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(r, v * w[c], len(y)), -30, 30)))
        slope = np.bincount(c, v * (p - y)[r], len(w)) / len(y) + 1e-4 * w
        if twins.n:
            gap = np.bincount(tr, tv * w[tc], twins.n)
            slope += penalty * 2 * np.bincount(tc, tv * gap[tr], len(w)) / twins.n
        slope = np.append(slope, (p - y).mean())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        b -= move[-1]
    model.bias = float(b)
    return model


def fit(texts: list[Counter], toxic: list[int], penalty: float = 1.0, limit: int = FEATURES, steps: int = 400) -> Classifier:
    """Train on word counts and labels. Without labels of both kinds the score is the share of toxic ones, one half if none."""
    if len(set(toxic)) < 2:
        return constant(toxic)
    names = informative(texts, toxic, limit)
    model = Classifier({f: k for k, f in enumerate(names)}, np.zeros(len(names)), 0.0)
    gaps = [gap for x in texts if (gap := twin_gap(model, x)) is not None]
    return fitted(model, Cells.of([model.values(x) for x in texts]), Cells.of(gaps), toxic, penalty, steps)


def train(docs: DataFrame, labels: DataFrame, usable, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on at most ``rows`` labelled documents, the first by hash of the id among those ``usable`` (a condition on the id).

    Null ids, labels and texts are left out, and of a repeated id one label counts, the larger.
    """
    kept = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    kept = kept.where(usable(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    kept = kept.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    # ``kept`` has at most ``rows`` rows; their texts may be long, and stay where they are
    sample = texts.join(F.broadcast(kept), "id").select("id", (F.col("toxic") > 0).cast("int").alias("toxic"), F.col("text").cast("binary").alias("text"))
    sample = stored(sample, "labelled")
    ones, zeros = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not ones or not zeros:
        return constant([1] * ones + [0] * zeros)

    def words(raw) -> Counter:
        return word_counts(raw.as_py().decode("utf-8", "replace"))

    def occurrences(batches):
        here, there = Counter(), Counter()

        def batch():
            names = list(here | there)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([x[f] for f in names], pa.int64()) for x in (here, there))], ["feature", "a", "b"])

        for part in batches:
            for label, raw in zip(*part.columns):
                (here if label.as_py() else there).update({f for w in words(raw) for f in features(w)})
                if len(here) + len(there) > 200_000:
                    yield batch()
                    here.clear(), there.clear()
        yield batch()

    def gains(batches):
        for part in batches:
            found = [gain(a.as_py(), b.as_py(), ones, zeros) for a, b in zip(part.column(1), part.column(2))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["feature", "gain"])

    counts = sample.select("toxic", "text").mapInArrow(occurrences, "feature string, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    known = counts.where((F.col("a") > 2) & (F.col("a") * zeros > F.col("b") * ones)).mapInArrow(gains, "feature string, gain double")
    known = known.orderBy(F.desc("gain"), "feature").limit(FEATURES)
    names = named([r.feature for r in known.select("feature").collect()], FEATURES)
    model = Classifier({f: k for k, f in enumerate(names)}, np.zeros(len(names)), 0.0)

    def numbers(batches):
        for part in batches:
            values, gaps = [], []
            for raw in part.column(1):
                own = words(raw)
                values.append(model.values(own))
                gaps.append(twin_gap(model, own))
            lists = [[list(x) for x in values], [list(x.values()) for x in values]]
            lists += [[None if x is None else list(x) for x in gaps], [None if x is None else list(x.values()) for x in gaps]]
            kinds = [pa.list_(pa.int32()), pa.list_(pa.float64())] * 2
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, lists, kinds)], ["toxic", "at", "value", "gap_at", "gap"])

    # what the driver takes is bounded by ``rows`` times the number of features, whatever the length of the texts
    found = sample.orderBy("id").select("toxic", "text").mapInArrow(numbers, "toxic int, at array<int>, value array<double>, gap_at array<int>, gap array<double>").toArrow()
    twins = found.filter(pc.is_valid(found["gap_at"]))

    def cells(part: pa.Table, at: str, value: str) -> Cells:
        flat = [part[x].combine_chunks().flatten().to_numpy(zero_copy_only=False) for x in (at, value)]
        return Cells(pc.list_value_length(part[at]).to_numpy(), *flat)

    return fitted(model, cells(found, "at", "value"), cells(twins, "gap_at", "gap"), found["toxic"].to_numpy())


def score(docs: DataFrame, model: Classifier, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of the whole text; null and empty texts score as texts without words."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            found = [model.score(t.as_py() or "") for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], schema=pa.schema([*batch.schema, pa.field(name, pa.float64())]))

    return docs.mapInArrow(run, schema)
