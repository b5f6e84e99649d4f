"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown over the statistics of labelled documents. Every path
from a root is a rule, a conjunction of bounds on statistics; a lasso-penalised
logistic regression over the rules keeps few of them. The rules kept are
compiled into one Spark column expression, so scoring is a projection over the
whole texts: no Python, no shuffle.

The models are fitted on at most ``2 * TRAIN_ROWS`` labelled documents outside
the held-out fold (a bound that does not grow with the corpus); scoring reads
every text whole. Key, language, source and labels never enter a score.

Defined results: a null text is an empty one and is scored by its statistics;
with labels of one class only, or none, the score is the smoothed share of
label 1. Repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.llm.labels import held_out, training_rows, training_texts
from devpulse.plans.staging import stage_table

TRAIN_ROWS = 10_000
TREES, DEPTH = 24, 3
LASSO = 1e-3


def _share_of(text: str, others: str) -> Column:
    """Share of the characters left when those of the class ``others`` are taken out."""
    return F.char_length(F.regexp_replace(text, others, "")) / F.greatest(F.char_length(text), F.lit(1))


def statistics(df: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``df`` with the statistics of its text as doubles, and their names."""
    df = (df.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
          .withColumn("_words", F.filter(F.split("_text", r"\s+"), lambda w: w != ""))
          .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: F.trim(line) != "")))
    words, lines = F.greatest(F.size("_words"), F.lit(1)), F.greatest(F.size("_lines"), F.lit(1))
    repeats = F.size(F.filter(F.transform("_words", lambda w, i: (i > 0) & (w == F.get("_words", i - 1))), lambda x: x))
    made = {
        "chars": F.char_length("_text"),
        "words": F.size("_words"),
        "word_length": F.char_length("_text") / words,
        "distinct_words": F.size(F.array_distinct("_words")) / words,
        "repeated_words": repeats / words,
        "distinct_lines": F.size(F.array_distinct("_lines")) / lines,
        "line_words": F.size("_words") / lines,
        "upper": _share_of("_text", r"[^\p{Lu}]+"),
        "digits": _share_of("_text", r"[^\p{N}]+"),
        "symbols": _share_of("_text", r"[\p{L}\p{N}\s]+"),
        "stops": _share_of("_text", r"[^.?]+"),
        "bars": _share_of("_text", r"[^|]+"),
    }
    names = [f"_stat_{n}" for n in made]
    return df.withColumns({f"_stat_{n}": c.cast("double") for n, c in made.items()}).drop("_words", "_lines", "_text"), names


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds, ``(statistic, low, high)``: low < statistic <= high."""
    bounds: tuple[tuple[str, float, float], ...]

    def condition(self) -> str:
        parts = []
        for name, low, high in self.bounds:
            parts += [f"{name} > {low!r}D"] if low > -math.inf else []
            parts += [f"{name} <= {high!r}D"] if high < math.inf else []
        return " AND ".join(parts)


def tree_rules(model, names: list[str]) -> list[Rule]:
    """The distinct paths from the roots of a forest's trees to each of their nodes."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            found[Rule(tuple((n, *b) for n, b in sorted(bounds.items())))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = names[split.featureIndex()], split.threshold()
        low, high = bounds.get(name, (-math.inf, math.inf))
        walk(node.leftChild(), bounds | {name: (low, min(high, at))})
        walk(node.rightChild(), bounds | {name: (max(low, at), high)})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


@dataclass(frozen=True)
class RuleModel:
    """A score in the log-odds: a start value and weighted rules."""
    start: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        terms = [f"{self.start!r}D", *(f"CASE WHEN {r.condition()} THEN {w!r}D ELSE 0D END" for r, w in self.rules)]
        return 1 / (1 + F.exp(-F.expr(" + ".join(terms))))


def fit(rows: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleModel:
    """A rule model from the statistics ``names`` and the 0/1 column ``label``."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, total = counts.get(1, 0), sum(counts.values())
    if ones in (0, total):
        return RuleModel(math.log((ones + 1) / (total - ones + 1)), ())
    points = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("features", "label").coalesce(2)  # bounded rows
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=1, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=2).fit(points)
    rules = tree_rules(forest, names)
    if not rules:
        return RuleModel(math.log((ones + 1) / (total - ones + 1)), ())
    fired = rows.select("label", F.array(*(F.expr(r.condition()).cast("double") for r in rules)).alias("fired"))
    table = fired.select("label", array_to_vector("fired").alias("features")).coalesce(2).cache()  # bounded rows
    line = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(table)
    table.unpersist()
    kept = tuple((r, float(w)) for r, w in zip(rules, line.coefficients) if w)
    return RuleModel(float(line.intercept), kept)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
          text: str = "text") -> RuleModel:
    chosen = training_rows(labels, label, TRAIN_ROWS, key)
    rows, names = statistics(training_texts(docs, chosen, key, text), text)
    return fit(stage_table(rows.select("label", *names), "quality-training"), names)


def scores(docs: DataFrame, labels: DataFrame, threshold: float, label: str = "quality", key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` for every row."""
    model = train(docs, labels, label, key, text)
    rows, _ = statistics(docs.select(key, text), text)
    return (rows.select(key, held_out(key).alias("held_out"), model.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float, label: str = "quality", key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows that are not rejected, with their own columns."""
    model = train(docs, labels, label, key, text)
    names = docs.columns
    own = docs.select(*(F.col(c).alias(f"_own{i}") for i, c in enumerate(names)))
    rows, _ = statistics(own, f"_own{names.index(text)}")
    # rand keeps the filter above the statistics: pushed below, it would hold a copy of their expressions
    # for every rule and compute each many times a row.
    return (rows.withColumn("_score", model.score() + 0 * F.rand(0)).where(F.col("_score") >= threshold)
            .select(*(F.col(f"_own{i}").alias(c) for i, c in enumerate(names))))
