"""Toxicity classifier, regularised by counterfactual identity terms.

A logistic model over which words and word beginnings a text holds. For every
training sentence with identity terms, copies are made in which each such term
is replaced by another of its group; the model pays for the squared difference
between the two scores, so that naming a group does not by itself move a score.

The model is fitted on at most ``2 * TRAIN_ROWS`` labelled documents outside
the held-out fold (a bound that does not grow with the corpus). Features are
counted and chosen by a Spark aggregate over those rows; the fit is on the
chosen features only. Scoring is a map over all whole texts.

Defined results: a null text is an empty one and gets the score without
features; with labels of one class only, or none, the score is the smoothed
share of label 1. Repeated rows give repeated results; an empty table gives no
rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import slices
from devpulse.llm.labels import held_out, training_rows, training_texts
from devpulse.plans.staging import stage_table

TRAIN_ROWS = 8192
FEATURES = 2048
LEAST_ROWS = 2
PREFIXES = (4, 5, 6)
RIDGE, PAIR_PENALTY, STEPS = 2e-4, 1.0, 300
TABLE_CHUNKS = 300_000
_WORD = re.compile(r"\w+")

#: Terms that may replace each other in a counterfactual sentence.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("blind", "deaf", "disabled", "autistic"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "inländer", "flüchtlinge"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "immigrés", "réfugiés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "inmigrantes", "refugiados"),
)


def word_features(word: str) -> list[int]:
    """The numbers of a lower-cased word's features: the word and its beginnings."""
    named = [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in named]


def features(text: str | None) -> set[int]:
    words = set(_WORD.findall((text or "").lower()))
    return {f for w in words for f in word_features(w)}


def counterfactuals(text: str | None, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> list[str]:
    """Copies of a text in which all identity terms of a group are swapped for the group's next terms."""
    place = {w: (g, i) for g in groups for i, w in enumerate(g)}
    words = _WORD.findall((text or "").lower())
    met = [place[w] for w in dict.fromkeys(words) if w in place]
    if not met:
        return []
    copies = max(len(g) for g, _ in met) - 1

    def swapped(shift: int):
        def other(m: re.Match) -> str:
            w = m.group().lower()
            if w not in place:
                return m.group()
            g, i = place[w]
            return g[(i + shift) % len(g)]
        return _WORD.sub(other, text)

    return [swapped(s) for s in range(1, copies + 1)]


@dataclass(frozen=True)
class ToxicModel:
    start: float
    features: np.ndarray
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        at = _positions(features(text), self.features)
        return _sigmoid(self.start + self.weights[at].sum())


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _positions(found: Iterable[int], chosen: np.ndarray) -> np.ndarray:
    """Where the found features stand in the sorted ``chosen``; others are left out."""
    found = np.array(sorted(found), np.int64)
    if not len(chosen) or not len(found):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
    return at[chosen[at] == found]


class _Rows:
    """0/1 (or signed) rows of a sparse matrix by their positions."""

    def __init__(self, rows: Sequence[np.ndarray], width: int, values: Sequence[np.ndarray] | None = None):
        self.width, self.n = width, len(rows)
        self.column = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.value = np.concatenate([*values, np.empty(0)]) if values is not None else np.ones(len(self.column))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column] * self.value, minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=g[self.row] * self.value, minlength=self.width)


def fit(labels: np.ndarray, rows: Sequence[np.ndarray], pairs: Sequence[tuple[np.ndarray, np.ndarray]], width: int,
        pair_penalty: float = PAIR_PENALTY) -> tuple[float, np.ndarray]:
    """Start and weights of the penalised logistic model, by Adam on all rows.

    ``pairs`` are the positions of a sentence and of its counterfactual.
    """
    x = _Rows(rows, width)
    only = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in pairs]
    d = _Rows([np.r_[a, b] for a, b in only], width, [np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in only])
    y = labels.astype(float)
    start, w = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(width)
    scale = np.where(y == 1, np.sqrt(max(1, (len(y) - y.sum()) / max(1, y.sum()))), 1)  # toxic rows are the rarer
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        error = scale * (_sigmoid(start + x.dot(w)) - y)
        grad = x.back(error) / x.n + RIDGE * w
        if d.n:
            grad += 2 * pair_penalty * d.back(d.dot(w)) / d.n
        grad = np.r_[grad, error.mean()]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, start = w - move[:-1], start - move[-1]
    return start, w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
          groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> ToxicModel:
    chosen = training_rows(labels, label, TRAIN_ROWS, key)

    def extract(batches):
        for batch in slices(batches, 1):
            texts = batch.column(1).to_pylist()
            own = [sorted(features(t)) for t in texts]
            other = [[sorted(features(c)) for c in counterfactuals(t, groups)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.list_(pa.int64())), pa.array(other, pa.list_(pa.list_(pa.int64())))],
                ["label", "own", "other"])

    rows = (training_texts(docs.select(key, F.col(text).cast("string").alias("_text")), chosen, key, "_text")
            .mapInArrow(extract, "label int, own array<long>, other array<array<long>>"))
    rows = stage_table(rows, "toxicity-training")
    ones, total = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if ones in (0, total):
        return ToxicModel(float(np.log((ones + 1) / (total - ones + 1))), np.empty(0, np.int64), np.empty(0))
    # The strongest features by the square root of their likelihood ratio against the label's share.
    base = ones / total
    every = rows.select("label", F.explode("own").alias("f")).groupBy("f").agg(
        F.count("*").alias("n"), F.sum("label").alias("k"))
    share = (F.col("k") + base) / (F.col("n") + 1)
    gain = F.col("n") * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))
    named = (every.where(F.col("n") >= LEAST_ROWS).orderBy(F.desc(gain), "f").limit(FEATURES)
             .select("f").toArrow()["f"].to_numpy())
    named = np.sort(named)

    def place(batches):
        for batch in batches:
            own = [_positions(f, named) for f in batch.column(1).to_pylist()]
            other = [[_positions(f, named) for f in fs] for fs in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.list_(pa.int64())), pa.array(other, pa.list_(pa.list_(pa.int64())))],
                ["label", "own", "other"])

    table = rows.mapInArrow(place, rows.schema).toArrow()
    own = [np.array(r, np.int64) for r in table["own"].to_pylist()]
    pairs = [(a, np.array(b, np.int64)) for a, bs in zip(own, table["other"].to_pylist()) for b in bs]
    start, weights = fit(table["label"].to_numpy(), own, pairs, len(named))
    return ToxicModel(start, named, weights)


def _scored(docs: DataFrame, model: ToxicModel, key: str, text: str) -> DataFrame:
    """The columns ``key, score``."""
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))

    def run(batches):
        known: dict[str, tuple[int, ...]] = {}
        for batch in slices(batches, 1):
            out = []
            for t in batch.column(1).to_pylist():
                chunks = set((t or "").lower().split())
                if len(known) > TABLE_CHUNKS:
                    known.clear()
                for c in chunks.difference(known):
                    known[c] = tuple({f for w in _WORD.findall(c) for f in word_features(w) if f in weight})
                hit = {f for c in chunks for f in known[c]}
                out.append(float(_sigmoid(model.start + sum(map(weight.__getitem__, sorted(hit))))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["key", "score"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])
    return (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("key", key))


def scores(docs: DataFrame, labels: DataFrame, threshold: float, label: str = "toxic", key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` for every row."""
    model = train(docs, labels, label, key, text)
    return _scored(docs, model, key, text).select(
        key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float, label: str = "toxic", key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The rows that are not rejected, with their own columns: the text rides through the scoring map."""
    model = train(docs, labels, label, key, text)
    names = docs.columns
    own = docs.select(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names))).alias("row"))
    own = own.select("row", F.col(f"row.c{names.index(text)}").alias("_text"))
    kept = _scored(own, model, "row", "_text").where(F.col("score") < threshold)
    return kept.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)))
