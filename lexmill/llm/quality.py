"""Quality classifier: a sparse ensemble of rules over text statistics.

Bagged trees are grown on the statistics of labelled texts; every path from a root is a rule, a conjunction of bounds. A
logistic regression with a lasso penalty weighs the rules, and those that keep a weight are compiled into a Spark column
expression. At most about ``FIT_ROWS`` labelled rows are used, spread evenly by a hash of the id; fewer are all used. A tree grows on at
most ``TREE_ROWS`` of them, drawn with replacement; the regression takes them all.
Labels, ids, languages and sources are never inputs of a score.

Edge cases: a null id is scored like any other, has no label, and its ``held_out`` is null; a null text is empty, and its statistics are zeros, for which the rules hold like for any other; the
longest text is read whole; null labels are not learned from; without labelled rows of both kinds every score is
the base rate; repeated rows are scored each on its own; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import text_or_empty
from lexmill.llm.toxicity import labelled

#: Most labelled rows that a fit uses, and most of them that one tree draws.
FIT_ROWS, TREE_ROWS = 20_000, 4_000
#: A text is good from this score on.
THRESHOLD = 0.3
#: The trees, and the bounds a feature is tried at.
TREES, DEPTH, LEAST_LEAF, BOUNDS = 40, 3, 12, 32
#: Most rules that enter the regression; penalty and steps of the lasso.
MOST_RULES = 400
PENALTY = 1e-3
LASSO_STEPS = 600

STATISTICS = (
    "chars", "words", "word_length", "symbols", "symbol_runs", "pipes", "capitals", "digits", "adjacent_repeats",
    "distinct_words", "distinct_triples", "repeated_lines", "line_words", "long_words", "ended_lines", "high_bytes",
)

_RUNS = re.compile(r"[^\w\s]{2,}")
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def statistics_of(text: str) -> tuple[float, ...]:
    """The statistics of a text, in the order of ``STATISTICS``; shares are within 0 and 1."""
    bytes_of = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n_chars, n_words, n_lines = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    letters, capitals, digits = bytes_of[_LETTERS].sum(), bytes_of[65:91].sum(), bytes_of[48:58].sum()
    blanks, high = bytes_of[[9, 10, 11, 12, 13, 32]].sum(), bytes_of[128:].sum()
    symbols = bytes_of[:128].sum() - letters - digits - blanks
    triples = zip(words, words[1:], words[2:])
    return (
        math.log1p(len(text)),
        math.log1p(len(words)),
        sum(map(len, words)) / n_words,
        symbols / n_chars,
        len(_RUNS.findall(text)) / n_words,
        bytes_of[124] / n_words,
        capitals / max(1, letters),
        digits / n_chars,
        sum(map(eq, words, words[1:])) / n_words,
        len(set(words)) / n_words,
        len(set(triples)) / max(1, len(words) - 2),
        1 - len(set(lines)) / n_lines,
        math.log1p(n_words / n_lines),
        sum(len(word) > 20 for word in words) / n_words,
        sum(line.rstrip()[-1] in ".!?" for line in lines) / n_lines,
        high / max(1, bytes_of.sum()),
    )


def statistics(text: Column) -> Column:
    """A struct of the statistics of a text column; a null text counts as empty."""

    @F.pandas_udf(", ".join(f"{name} double" for name in STATISTICS))
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = np.array([statistics_of(text) for text in texts], np.float64).reshape(-1, len(STATISTICS))
            yield pd.DataFrame(values, columns=list(STATISTICS))

    return measured(F.coalesce(text.cast("string"), F.lit("")))


#: A bound of a rule: (statistic, whether it must be over the bound, bound). A rule is a sorted tuple of them.
Bound = tuple[int, bool, float]
Rule = tuple[Bound, ...]


def _best_split(values: np.ndarray, labels: np.ndarray, weights: np.ndarray, tried: np.ndarray) -> tuple | None:
    """The (statistic, bound) with the least weighted Gini impurity among quantile bounds."""
    best = None
    for column in tried:
        held = values[:, column]
        bounds = np.unique(np.quantile(held, np.linspace(0.02, 0.98, BOUNDS)))
        for bound in bounds:
            over = held > bound
            n_over = int(over.sum())
            if min(n_over, len(held) - n_over) < LEAST_LEAF:
                continue
            impurity = 0.0
            for side in (over, ~over):
                total = weights[side].sum()
                share = (weights[side] * labels[side]).sum() / total
                impurity += total * share * (1 - share)
            if best is None or impurity < best[0]:
                best = (impurity, int(column), float(bound))
    return best and best[1:]


def _grow(values, labels, weights, draw: np.random.Generator, path: Rule, found: set[Rule]) -> None:
    """Grow a tree downwards; every node below the root is a rule."""
    if path:
        found.add(tuple(sorted(path)))
    if len(path) == DEPTH or len(labels) < 2 * LEAST_LEAF or labels.min() == labels.max():
        return
    tried = draw.choice(values.shape[1], size=max(4, values.shape[1] // 3), replace=False)
    split = _best_split(values, labels, weights, tried)
    if split is None:
        return
    column, bound = split
    over = values[:, column] > bound
    for side, is_over in ((over, True), (~over, False)):
        _grow(values[side], labels[side], weights[side], draw, (*path, (column, is_over, bound)), found)


def holds(rule: Rule, values: np.ndarray) -> np.ndarray:
    return reduce(and_, [(values[:, c] > b) == over for c, over, b in rule], np.ones(len(values), bool))


def tree_rules(values: np.ndarray, labels: np.ndarray, seed: int = 0) -> list[Rule]:
    """The paths of bagged trees over balanced classes, without rules that hold for the same rows."""
    draw, found = np.random.default_rng(seed), set()
    weights = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    size = min(len(labels), TREE_ROWS)
    for _ in range(TREES):
        rows = draw.integers(0, len(labels), size)
        _grow(values[rows], labels[rows], weights[rows], draw, (), found)
    distinct: dict[bytes, Rule] = {}
    for rule in sorted(found, key=lambda rule: (len(rule), rule)):
        held = holds(rule, values)
        if 0 < held.sum() < len(held):
            distinct.setdefault(np.packbits(held).tobytes(), rule)
    rules = list(distinct.values())
    covers = [holds(rule, values) for rule in rules]
    spread = [abs(labels[held].mean() - labels.mean()) * math.sqrt(held.sum()) for held in covers]
    return [rules[place] for place in np.argsort(spread)[::-1][:MOST_RULES]]


def lasso_logistic(design: np.ndarray, labels: np.ndarray, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """Intercept and sparse weights by accelerated proximal gradient steps."""
    design = design.astype(np.float64)
    n_rows = len(labels)
    lipschitz = 0.25 * (np.linalg.norm(design, 2) ** 2 / n_rows + 1)
    weights, intercept = np.zeros(design.shape[1]), math.log((labels.sum() + 0.5) / (n_rows - labels.sum() + 0.5))
    ahead, ahead_at, momentum = weights, intercept, 1.0
    for _ in range(LASSO_STEPS):
        error = 1 / (1 + np.exp(-(design @ ahead + ahead_at))) - labels
        moved = ahead - design.T @ error / n_rows / lipschitz
        updated = np.sign(moved) * np.maximum(np.abs(moved) - penalty / lipschitz, 0)
        updated_at = ahead_at - error.mean() / lipschitz
        following = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / following
        ahead, ahead_at = updated + push * (updated - weights), updated_at + push * (updated_at - intercept)
        weights, intercept, momentum = updated, updated_at, following
    return float(intercept), weights


@dataclass
class QualityModel:
    """Weighted rules; the score is the chance of label 1."""

    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, of: Column) -> Column:
        """The rules compiled into a column expression over a struct of `statistics`."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            bounds = [of[STATISTICS[c]] > b if over else of[STATISTICS[c]] <= b for c, over, b in rule]
            total = total + F.when(reduce(and_, bounds), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score_values(self, values: np.ndarray) -> np.ndarray:
        """The same score of rows of statistics in numpy."""
        total = self.intercept + sum((holds(rule, values) * weight for rule, weight in self.rules), np.zeros(len(values)))
        return 1 / (1 + np.exp(-total))


def fit_values(values: np.ndarray, labels: np.ndarray) -> QualityModel:
    if not len(labels) or labels.min() == labels.max():
        good = float(labels.sum())
        return QualityModel(math.log((good + 0.5) / (len(labels) - good + 0.5)))
    rules = tree_rules(values, labels)
    if not rules:
        return QualityModel(math.log(labels.mean() / (1 - labels.mean())))
    intercept, weights = lasso_logistic(np.stack([holds(rule, values) for rule in rules], 1), labels)
    return QualityModel(intercept, [(rule, float(weight)) for rule, weight in zip(rules, weights) if weight])


def fit(docs: DataFrame, labels: DataFrame, learned: Column, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Learn the rules from ``labels(doc_id, quality)`` where ``learned`` holds."""
    rows = labelled(docs, labels, "quality", learned, fit_rows).filter("label in (0, 1)")
    points = rows.select(statistics(F.col("text")).alias("of"), "label").select("of.*", "label").toPandas()
    points = points.sort_values([*STATISTICS, "label"])  # the same fit whatever order the rows come in
    return fit_values(points[list(STATISTICS)].to_numpy(np.float64), points["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of each text."""
    measured = docs.select(F.col(id_col).alias("doc_id"), statistics(text_or_empty(text_col)).alias("of"))
    scored = measured.select("doc_id", model.score(F.col("of")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is good; nested meanwhile, so no column can clash."""
    measured = docs.select(F.struct("*").alias("row"), statistics(F.col(text_col)).alias("of"))
    return measured.filter(model.score(F.col("of")) >= THRESHOLD).select("row.*")
