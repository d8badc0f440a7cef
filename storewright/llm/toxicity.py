"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models (logistic
regression with an L1 penalty) on the distinct words of a text and the
beginnings of its words; the model of a category also sees the probabilities of the categories before it. While
training, those are out-of-fold: each fold's rows get them from a model that
did not see the fold. The decision threshold of the last category is the one
with the best F1 on its own out-of-fold probabilities.

The chain is fitted in one task on at most ``sample_rows`` labelled ids, those
with the smallest hash, and a model looks at the ``features`` words
that differ most between its classes; these bounds are the only ones. Every
document is scored with all its words.

Defined results: a null or empty text has no words and is judged by the
intercepts; labels that are null, and ids that are null or not in the table,
are not learned from; of several labels of an id the larger counts, of several
texts the one with the smallest hash is learned from; with no labelled row, or
only one class, a category has probability 0 or 1 throughout and the last one's
threshold accepts nothing; repeated rows are scored each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from storewright.llm.workers import releasing

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
NOTHING = 2.0  # a threshold that no probability reaches


@dataclass(frozen=True)
class ChainSpec:
    """The chain: category -> label expression (true, false or null), in order."""

    categories: dict[str, str]
    sample_rows: int = 10_000
    features: int = 600
    min_docs: int = 5
    folds: int = 3
    penalty: float = 5e-5
    iterations: int = 250


@dataclass(frozen=True)
class LinearModel:
    intercept: float
    weights: dict[str, float]
    earlier: tuple[float, ...]  # weights of the earlier categories' probabilities

    def probability(self, words: set[str], before: list[float]) -> float:
        get = self.weights
        z = self.intercept + sum(get[w] for w in words & get.keys())
        z += sum(a * b for a, b in zip(self.earlier, before, strict=True))
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


@dataclass(frozen=True)
class Chain:
    models: tuple[LinearModel, ...]
    threshold: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """A row per text, a column per category; each model is given those before it."""
        found = []
        for text in texts:
            words, before = words_of(text.as_py()), []
            for model in self.models:
                before.append(model.probability(words, before))
            found.append(before)
        return np.array(found, float).reshape(-1, len(self.models))


def words_of(text: str | None) -> set[str]:
    """Distinct lower-cased words, and their beginnings of some lengths, marked: inflected words share those."""
    words = set(WORD.findall((text or "").lower()))
    beginnings = {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}
    return words | beginnings


class Vocabulary:
    """Words as numbers: the sets of ten thousand texts as strings would fill a worker's memory."""

    def __init__(self):
        self.numbers: dict[str, int] = {}

    def encode(self, words: set[str]) -> np.ndarray:
        numbers = self.numbers
        return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)

    def names(self) -> np.ndarray:
        return np.array(list(self.numbers), object)


def telling_words(rows: list[np.ndarray], y: np.ndarray, names: np.ndarray, spec: ChainSpec) -> np.ndarray:
    """Words whose share of texts differs most between the classes, measured in standard errors; ties by name."""

    def texts_with(label: bool) -> np.ndarray:
        own = [r for r, mark in zip(rows, y, strict=True) if bool(mark) == label]
        return np.bincount(np.concatenate([np.zeros(0, np.int32), *own]), minlength=len(names)).astype(float)

    a, b = texts_with(True), texts_with(False)
    n1, n0 = max(1.0, y.sum()), max(1.0, len(y) - y.sum())
    some = np.flatnonzero(a + b >= spec.min_docs)
    a, b = a[some], b[some]
    p = (a + b + 1) / (n1 + n0 + 2)
    z = np.abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    by_name = np.argsort(names[some], kind="stable")
    best = by_name[np.argsort(-z[by_name], kind="stable")]
    return some[best[: spec.features]]


def fit_linear(
    sets: list[np.ndarray], before: np.ndarray, y: np.ndarray, names: np.ndarray, spec: ChainSpec
) -> tuple[LinearModel, np.ndarray]:
    """The model, and its weights by word number. Accelerated proximal gradient steps on the sparse rows; the intercept is not penalized."""
    chosen = telling_words(sets, y, names, spec)
    place = np.full(len(names), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    rows = [np.sort(of[of >= 0]) for of in (place[s] for s in sets)]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([np.zeros(0, np.int32), *rows])
    n, d, e = len(rows), len(chosen), before.shape[1]
    # Columns are centred, which keeps frequent words from slowing the steps down.
    mean = np.concatenate((np.bincount(column, minlength=d) / n, before.mean(axis=0)))

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, w[column], n) + before @ w[d : d + e] + w[-1] - mean @ w[:-1]

    def back(r: np.ndarray) -> np.ndarray:
        own = np.concatenate((np.bincount(column, r[row], d), before.T @ r))
        return np.append(own - mean * r.sum(), r.sum()) / n

    v = np.ones(d + e + 1)
    for _ in range(30):
        v = back(times(v))
        size = np.linalg.norm(v)
        v /= size
    step, w, t = 4 / (1.05 * size), np.zeros(d + e + 1), 1.0
    look = w
    for _ in range(spec.iterations):
        gradient = back(1 / (1 + np.exp(-np.clip(times(look), -700, 700))) - y)
        new = look - step * gradient
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * spec.penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, w = new + (last - 1) / t * (new - w), new
    weights = {name: float(x) for name, x in zip(names[chosen], w[:d], strict=True) if x}
    by_number = np.zeros(len(names))
    by_number[chosen] = w[:d]
    return LinearModel(float(w[-1] - mean @ w[:-1]), weights, tuple(map(float, w[d : d + e]))), by_number


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where F1 is best: midway between the least accepted probability and the next."""
    if not y.any() or y.all():
        return NOTHING
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    below = np.append(p[1:], 0.0)
    f1 = np.where(p > below, 2 * hits / (np.arange(1, len(p) + 1) + y.sum()), -1.0)
    at = int(f1.argmax())
    return float((p[at] + below[at]) / 2)


def train(sets: list[np.ndarray], names: np.ndarray, labels: np.ndarray, folds: np.ndarray, spec: ChainSpec) -> Chain:
    """sets: the numbers of each text's words; names: the words; labels: one column per category."""
    models, before = [], np.zeros((len(sets), 0))
    for category in range(labels.shape[1]):
        y = labels[:, category]
        models.append(fit_linear(sets, before, y, names, spec)[0])
        held = np.zeros(len(sets))
        for fold in np.unique(folds):
            rest, own = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            if not len(rest):
                rest = own
            model, weights = fit_linear([sets[i] for i in rest], before[rest], y[rest], names, spec)
            z = model.intercept + np.array([weights[sets[i]].sum() for i in own]) + before[own] @ np.array(model.earlier)
            held[own] = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        before = np.column_stack((before, held))
    return Chain(tuple(models), best_threshold(before[:, -1], labels[:, -1]))


def labelled_sample(docs: DataFrame, labels: DataFrame, spec: ChainSpec) -> DataFrame:
    """At most ``sample_rows`` labelled ids, a row each, with text, fold and labels."""
    known = labels.filter(F.col("doc_id").isNotNull())
    marks = known.groupBy("doc_id").agg(
        *[F.max(F.expr(rule).cast("double")).alias(f"is_{name}") for name, rule in spec.categories.items()]
    ).dropna()
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(spec.sample_rows)
    # Of a bounded number of rows, each of a few numbers.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")
    # One row of each id, so ids that repeat neither take the sample beyond its bound nor push others out of it.
    own = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    rows = rows.groupBy("doc_id", *[f"is_{name}" for name in spec.categories]).agg(own)
    return rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(spec.folds)))


def fit_chain(docs: DataFrame, labels: DataFrame, spec: ChainSpec) -> Chain:
    names = [f"is_{name}" for name in spec.categories]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, marks, folds, vocabulary = [], [], [], Vocabulary()
        for batch in batches:
            sets.extend(vocabulary.encode(words_of(t.as_py())) for t in batch.column("text"))
            marks.append(np.column_stack([batch.column(n).to_numpy() for n in names]))
            folds.append(batch.column("fold").to_numpy())
        if not sets:
            return
        chain = train(sets, vocabulary.names(), np.concatenate(marks), np.concatenate(folds), spec)
        told = {
            "threshold": chain.threshold,
            "models": [[m.intercept, m.weights, m.earlier] for m in chain.models],
        }
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(told)])], ["chain"])

    sample = labelled_sample(docs, labels, spec).coalesce(1).sortWithinPartitions("doc_id")
    found = sample.mapInArrow(releasing(fit), "chain string").first()
    if found is None:
        return Chain(tuple(LinearModel(-700.0, {}, (0.0,) * i) for i in range(len(names))), NOTHING)
    told = json.loads(found["chain"])
    return Chain(tuple(LinearModel(i, w, tuple(e)) for i, w, e in told["models"]), told["threshold"])


def score_chain(docs: DataFrame, chain: Chain, spec: ChainSpec) -> DataFrame:
    """The rows of docs with p_<category> for each category and the boolean ``toxic`` at their end."""
    added = [f"p_{name}" for name in spec.categories] + ["toxic"]
    kept = [c for c in docs.columns if c not in added]
    at = kept.index("text")
    fields = [StructField(n, DoubleType()) for n in added[:-1]] + [StructField(added[-1], BooleanType())]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.probabilities(batch.column(at))
            more = [pa.array(p[:, i]) for i in range(len(chain.models))]
            more.append(pa.array(p[:, -1] >= chain.threshold, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*kept, *added])

    rows = docs.select(*kept)
    return rows.mapInArrow(releasing(score), StructType([*rows.schema.fields, *fields]))


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of docs that the chain does not find toxic; all columns as they are, whatever their names."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(chain.probabilities(batch.column(at))[:, -1] < chain.threshold, pa.bool_()))

    return docs.mapInArrow(releasing(keep), docs.schema)
