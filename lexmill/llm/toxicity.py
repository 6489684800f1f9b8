"""Toxicity of texts by a weighted lexicon, matched by Aho-Corasick after folding.

Folding lower-cases, maps homoglyphs and digit substitutions to plain letters inside words, and turns everything else into single
blanks. Lexicon entries are whole words or word beginnings; exception phrases around a word take its hit back. The score is
a logistic function of the weighted hits by length, so one slur in a long text weighs less than in a short one.

The lexicon is learned: from labelled texts, entries are words and word beginnings that toxic texts hold far more often
than clean ones. At most about ``FIT_ROWS`` labelled rows are used, spread evenly by a hash of the id; fewer are all used. An entry
must be in ``LEAST_TEXTS`` toxic texts, or in one of 500 toxic texts where that is more.
The score of a text depends on its words alone. Edge cases: a null id is scored like any other, has no label, and its ``held_out`` is null; a null text is empty and gets the score of no hits; labels that
are null are not learned from; without labelled rows of both kinds every score is the base rate; repeated rows are
scored each on its own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lexmill.llm.common import checkpointed, text_or_empty

#: Most labelled rows that a fit uses.
FIT_ROWS = 20_000
#: A text is toxic from this score on.
THRESHOLD = 0.3
#: Entries of a lexicon; least toxic texts that hold an entry; least odds against clean texts; lengths of word beginnings.
LEXICON_ENTRIES = 4_000
LEAST_TEXTS = 5
LEAST_LOG_ODDS = 2.0
PREFIX_LENGTHS = range(4, 9)
#: Rates enter the logistic function as log(1 + rate * RATE_SCALE).
RATE_SCALE = 200.0

#: Characters that stand for others. Letters of other scripts first, then digits and signs within words.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "ӏ": "l", "ո": "n", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "κ": "k", "ı": "i",
    "ⅼ": "l", "ａ": "a", "ｅ": "e", "ｉ": "i", "ｏ": "o", "ｕ": "u",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
#: Phrases in which a word of the lexicon is harmless, folded.
EXCEPTIONS = (
    "trash can", "trash bag", "trash bin", "trash talk show", "class clown fish", "clown fish", "circus clown", "sore loser rule",
    "pond scum", "soap scum", "idiot proof", "idiot light", "scum villain",
)

_FOLD = str.maketrans(HOMOGLYPHS)
_SUBSTITUTE = str.maketrans(SUBSTITUTIONS)
_SIGNS = f"[{re.escape(''.join(SUBSTITUTIONS))}]"
_MARKS = re.escape("".join(sign for sign in SUBSTITUTIONS if not sign.isalnum()))
#: A maximal run of letters, digits and stand-ins. Possessive, so that a run of any length is read once.
_RUN = re.compile(rf"(?:[^\W_]++|[{_MARKS}]++)++")
_MARK = re.compile(f"[{_MARKS}]")
#: All stand-ins in a row and the letters that follow them.
_UNIT = re.compile(rf"(?<!{_SIGNS}){_SIGNS}++[^\W\d_]++")
_SIGNS_HERE = re.compile(rf"{_SIGNS}*+")
#: Whether folding has anything to map: cheap searches, as most texts have neither.
_STAND_IN = re.compile(rf"{_SIGNS}[^\W\d_]")
_FOREIGN = re.compile(f"[{''.join(HOMOGLYPHS)}]")
_OTHERS = re.compile(r"[^\w ]+|[\d_]+")


def _plain(match: re.Match) -> str:
    """A run with its masked words mapped, in one pass.

    A masked word is letters and digits, one or more units, and the stand-ins behind the last. It begins where the one before ends, or
    behind a mark that no letter follows, and takes in every unit that begins before the next mark.
    """
    run = match[0]
    if not _STAND_IN.search(run):
        return run
    units = [unit.span() for unit in _UNIT.finditer(run)]
    done, start, at = [], 0, 0
    while at < len(units):
        mark = _MARK.search(run, start)
        reach = mark.start() if mark else len(run)
        if units[at][0] > reach:
            done.append(run[start : reach + 1])
            start = reach + 1
            continue
        while at + 1 < len(units) and units[at + 1][0] <= reach:
            at += 1
        while at + 1 < len(units) and units[at + 1][0] == units[at][1]:
            at += 1
        end = _SIGNS_HERE.match(run, units[at][1]).end()
        done.append(run[start:end].translate(_SUBSTITUTE))
        start, at = end, at + 1
    return "".join([*done, run[start:]])


def fold(text: str) -> str:
    """``text`` as lower-case words between single blanks, with a blank at both ends."""
    lowered = text.lower()
    if not lowered.isascii() and _FOREIGN.search(lowered):
        lowered = lowered.translate(_FOLD)
    if _STAND_IN.search(lowered):
        lowered = _RUN.sub(_plain, lowered)
    return f" {' '.join(_OTHERS.sub(' ', lowered).split())} "


def entries_of(folded: str) -> set[str]:
    """The candidates in a text: ``" word "`` for a whole word, ``" begin"`` for a beginning."""
    found = set()
    for word in set(folded.split()):
        if len(word) > 2:
            found.add(f" {word} ")
            found.update(f" {word[:length]}" for length in PREFIX_LENGTHS if length < len(word))
    return found


@dataclass
class ToxicityModel:
    """A lexicon of folded entries with weights, and the logistic function over the rate of weighted hits."""

    weights: dict[str, float]
    intercept: float
    slope: float
    exceptions: tuple[str, ...] = field(default=EXCEPTIONS)

    @cached_property
    def _automaton(self) -> ahocorasick.Automaton | None:
        """Entries and exception phrases in one automaton; a value is (entry length, weight, is an exception)."""
        if not self.weights:
            return None
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight, False))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
        machine.make_automaton()
        return machine

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "_automaton"}

    def hits(self, folded: str) -> dict[int, float]:
        """The greatest weight of the entries at each word, by the word's position; words of exception phrases are out."""
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if self._automaton is not None:
            for last, (length, weight, is_exception) in self._automaton.iter(folded):
                start = last - length + 1
                if is_exception:
                    spared.append((start, last))
                else:
                    found[start] = max(weight, found.get(start, 0.0))
        for start, stop in spared:
            for position in [at for at in found if start <= at < stop]:
                del found[position]
        return found

    def rate(self, text: str) -> float:
        folded = fold(text)
        return sum(self.hits(folded).values()) / max(20, folded.count(" ") - 1)

    def score_text(self, text: str) -> float:
        return 1 / (1 + math.exp(-(self.intercept + self.slope * math.log1p(self.rate(text) * RATE_SCALE))))

    def score(self, text: Column) -> Column:
        """The score of a text column, null texts as empty ones; it grows with likeness to label 1."""

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([self.score_text(text) for text in texts], dtype="float64")

        return scores(F.coalesce(text.cast("string"), F.lit("")))


def labelled(docs: DataFrame, labels: DataFrame, label: str, learned: Column, most: int) -> DataFrame:
    """``(text, label)`` of at most about ``most`` labelled rows for which ``learned`` holds, evenly by a hash of the id."""
    usable = labels.filter(learned & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    usable = usable.groupBy("doc_id").agg(F.min("label").alias("label"))  # of labels that disagree the lower one
    share = min(1.0, most / max(1, usable.count()))
    # the whole hash as a number within 0 and 1: the share may be far below a millionth
    drawn = usable.filter(F.xxhash64("doc_id").cast("double") / F.lit(2.0**64) + F.lit(0.5) <= F.lit(share))
    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    return texts.join(F.broadcast(drawn), "doc_id").select("text", "label")


def entry_counts(rows: DataFrame) -> DataFrame:
    """``(entry, toxic, clean)``: how many texts of each kind hold each candidate entry, counted within tasks first."""
    schema = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()  # bounded by the rows of a fit
        for batch in batches:
            for text, kind in zip(batch.column("text"), batch.column("label").to_pylist()):
                counts[1 - kind].update(entries_of(fold(text.as_py())))
        entries = list(counts[0] | counts[1])
        for start in range(0, len(entries), 50_000):
            part = entries[start : start + 50_000]
            yield pa.RecordBatch.from_pydict(
                {"entry": part, "toxic": [counts[0][e] for e in part], "clean": [counts[1][e] for e in part]}, schema
            )

    partial = rows.select("text", "label").mapInArrow(count, from_arrow_schema(schema))
    return partial.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _logistic(feature: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a small ridge."""
    design = np.stack([np.ones_like(feature), feature], 1)
    beta = np.zeros(2)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = design.T @ (design * (chance * (1 - chance))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, design.T @ (label - chance) - 1e-2 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, learned: Column, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn lexicon, weights and threshold from ``labels(doc_id, toxic)`` where ``learned`` holds."""
    rows = checkpointed(labelled(docs, labels, "toxic", learned, fit_rows).filter("label in (0, 1)"))
    kinds = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel({}, math.log((toxic + 0.5) / (clean + 0.5)), 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    least = max(LEAST_TEXTS, toxic // 500)
    best = entry_counts(rows).filter(F.col("toxic") >= least).withColumn("odds", odds)
    best = best.filter(F.col("odds") >= LEAST_LOG_ODDS).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry")
    weights = {row["entry"]: row["odds"] for row in best.limit(LEXICON_ENTRIES).collect()}
    model = ToxicityModel(weights, 0.0, 0.0)

    @F.pandas_udf("double")
    def rates(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.rate(text) for text in texts], dtype="float64")

    points = rows.select(rates("text").alias("rate"), "label").toPandas()
    model.intercept, model.slope = _logistic(
        np.log1p(points["rate"].to_numpy() * RATE_SCALE), points["label"].to_numpy(np.float64)
    )
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of each text."""
    scored = docs.select(F.col(id_col).alias("doc_id"), model.score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
