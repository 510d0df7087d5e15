"""A quality classifier as a sparse ensemble of rules.

Statistics of a text are Column expressions. On a bounded sample of labelled documents, small boosted trees are grown on
the statistics; every path from a root to a node is a rule, a conjunction of comparisons. A logistic regression with an L1 penalty
weights the rules, most of them with zero, and the rest are compiled into one Column expression, so that scoring is a
scan of the documents without any Python.

Edge cases: a null or blank text has zero statistics and a score as any other; without labels, or with labels of one class only, the score
is one constant; rows with one id are scored each for itself; ids without a label are only scored; an empty table gives
an empty result; other columns (language, source and ids among them) never enter a score. Ties between thresholds go to the
statistic that is listed first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.labelled import fold, labelled, training_ids
from pagemill.llm.line_cleaning import SPACE, SYMBOLS, without, words_of
from pagemill.llm.registry import query
from pagemill.session import table

#: Labelled documents of each class that are learned from, at most.
SAMPLE = 8_000
TREES, DEPTH, BINS, RATE, LEAST_ROWS = 30, 3, 24, 0.3, 15
#: Penalties tried, as shares of the least that leaves no rule.
PENALTIES = (0.2, 0.1, 0.05, 0.02, 0.01, 0.005)
#: A document with a lower score is rejected.
THRESHOLD = 0.3

STATISTICS = ("words", "word_length", "symbols", "pipes", "capitals", "digits", "exclamations", "stops", "distinct", "again", "line_words", "repeated_lines", "closed_lines", "letters")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` replaced by the statistics."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("text", text).withColumn("words_", words_of(F.col("text")))
    rows = rows.withColumn("lines_", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")))
    rows = rows.withColumn("solid_", F.char_length(without(F.col("text"), SPACE)).cast("double"))
    left = lambda pattern: F.char_length(F.regexp_replace("text", pattern, "")).cast("double")
    whole, words, lines, solid = F.char_length("text").cast("double"), F.size("words_").cast("double"), F.size("lines_").cast("double"), F.col("solid_")
    share = lambda part, of: F.when(of > 0, part / of).otherwise(0.0)
    values = {
        "words": F.log1p(words),
        "word_length": share(solid, words),
        "symbols": share(whole - F.char_length(without(F.col("text"), SYMBOLS)), solid),
        "pipes": share(whole - F.char_length(F.replace("text", F.lit("|"), F.lit(""))), words),
        "capitals": share(left("[^\\p{Lu}]+"), solid),
        "digits": share(left("[^0-9]+"), solid),
        "exclamations": share(left("[^!?]+"), words),
        "stops": share(left("[^.,;:]+"), words),
        "distinct": share(F.size(F.array_distinct("words_")).cast("double"), words),
        "again": share(F.size(F.filter("words_", lambda w, i: (i > 0) & (w == F.get("words_", i - 1)))).cast("double"), words),
        "line_words": share(words, lines),
        "repeated_lines": share(lines - F.size(F.array_distinct("lines_")), lines),
        "closed_lines": share(F.size(F.filter("lines_", lambda x: x.rlike("[.!?]\\s*$"))).cast("double"), lines),
        "letters": share(left("[^\\p{L}]+"), solid),
    }
    own = [c for c in docs.columns if c != "text"]
    return rows.select(*own, *[values[n].alias(n) for n in STATISTICS])


@dataclass(frozen=True)
class Rule:
    #: (statistic, whether above, threshold), all of them.
    tests: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for at, above, limit in self.tests:
            out &= (x[:, at] > limit) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for at, above, limit in self.tests:
            test = F.col(STATISTICS[at]) > F.lit(limit)
            out = out & (test if above else ~test)
        return out


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of boosted trees with the logistic loss."""
    limits = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    bins = np.stack([np.searchsorted(limits[k], x[:, k], side="left") for k in range(x.shape[1])], 1)
    score, rules = np.zeros(len(y)), {}

    def grow(rows: np.ndarray, tests: tuple, depth: int, step: np.ndarray, weight: np.ndarray) -> None:
        if tests:
            rules.setdefault(Rule(tests), None)
        best = (1e-6, -1, -1)
        if depth and len(rows) >= 2 * LEAST_ROWS:
            g, h = step[rows], weight[rows]
            whole = g.sum() ** 2 / (h.sum() + 1.0)
            for k, cuts in enumerate(limits):
                if not len(cuts):
                    continue
                n, sg, sh = (np.bincount(bins[rows, k], weights=w, minlength=len(cuts) + 1).cumsum()[:-1] for w in (np.ones(len(rows)), g, h))
                gain = sg**2 / (sh + 1.0) + (g.sum() - sg) ** 2 / (h.sum() - sh + 1.0) - whole
                gain[(n < LEAST_ROWS) | (n > len(rows) - LEAST_ROWS)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], k, at)
        if best[1] < 0:
            score[rows] += RATE * step[rows].sum() / (weight[rows].sum() + 1.0)
            return
        _, k, at = best
        above = bins[rows, k] > at
        for side in (False, True):
            grow(rows[above == side], (*tests, (k, side, float(limits[k][at]))), depth - 1, step, weight)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grow(np.arange(len(y)), (), DEPTH, y - p, p * (1 - p))
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, start: tuple[np.ndarray, float], steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-penalised logistic regression, by accelerated proximal steps."""
    w, b = start
    v, c, t = w.copy(), b, 1.0
    size = 4.0 / (np.linalg.norm(z, 2) ** 2 / len(y) + 1.0)
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        step = v - size * (z.T @ error) / len(y)
        new, intercept = np.sign(step) * np.maximum(np.abs(step) - size * penalty, 0), c - size * error.mean()
        t, last = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, c = new + (last - 1) / t * (new - w), intercept + (last - 1) / t * (intercept - b)
        w, b = new, intercept
    return w, b


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + sum(w * r.holds(x) for r, w in zip(self.rules, self.weights)))))


def learn(x: np.ndarray, y: np.ndarray, test: np.ndarray, weight: float = 1.0) -> RuleEnsemble:
    """The ensemble of rules with the least loss on the rows of ``test``. ``weight``: how many documents a row of class 1 stands for, against one of class 0."""
    if len(y) == 0 or y.min() == y.max():
        return RuleEnsemble([], [], 0.0 if len(y) == 0 else (4.0 if y[0] else -4.0))
    if test.all() or not test.any() or y[~test].min() == y[~test].max():
        test = np.zeros(len(y), bool)
    rules = tree_rules(x[~test], y[~test])
    z = np.stack([r.holds(x) for r in rules], 1).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    mean = z[~test].mean(0)
    scale = np.maximum(z[~test].std(0), 0.05)
    z = (z - mean) / scale
    top = np.abs(z[~test].T @ (y[~test] - y[~test].mean())).max() / (~test).sum() if rules else 0.0
    found, best = (np.zeros(len(rules)), 0.0), None
    check = test if test.any() else ~test
    for share in PENALTIES:
        found = lasso(z[~test], y[~test], share * top, found)
        p = np.clip(1 / (1 + np.exp(-(z[check] @ found[0] + found[1]))), 1e-4, 1 - 1e-4)
        loss = -(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)).mean()
        if best is None or loss < best[0] - 1e-3:
            best = (loss, found[0] / scale, found[1] - (found[0] / scale * mean).sum())
    _, weights, intercept = best
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return RuleEnsemble([rules[i] for i in used], [float(weights[i]) for i in used], float(intercept + math.log(weight)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> RuleEnsemble:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label); ``sample`` documents of a class at most reach the driver, as numbers."""
    ids = training_ids(labels, label, sample)
    rows = statistics(labelled(docs.select("doc_id", "text"), ids)).orderBy("doc_id").toPandas()
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    every = {r["label"]: r["n"] for r in labels.filter(fold(F.col("doc_id")) != 0).groupBy(F.col(label).cast("int").alias("label")).agg(F.countDistinct("doc_id").alias("n")).collect() if r["label"] is not None}
    shares = [min(1.0, counts.get(k, 0) / every[k]) if every.get(k) else 1.0 for k in (0, 1)]
    weight = shares[0] / shares[1] if min(shares) > 0 else 1.0
    return learn(rows[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)), rows["label"].to_numpy(float), rows["test"].to_numpy(bool), weight)


def scored(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without their text, with held_out, score and predicted."""
    score = model.score()
    return statistics(docs).withColumn("score", score).withColumn("held_out", fold(F.col("doc_id")) == 0).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop(*STATISTICS)


def accepted(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, as they are."""
    names = docs.columns
    rows = statistics(docs.select(F.struct(*names).alias("row"), F.col("text")))
    # Rejected rows drop out by an outer explode: a filter would be pushed below the statistics and repeat them for every rule.
    kept = F.when(model.score() >= threshold, F.array("row"))
    return rows.select(F.explode_outer(kept).alias("kept")).filter("kept is not null").select("kept.*")


@query()
def op1_rule_ensemble(spark, folder):
    """Quality of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scored(docs, fit(docs, table(spark, folder, "labels"))).select("doc_id", "held_out", "score", "predicted")
