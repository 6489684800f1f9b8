from __future__ import annotations

import random
import re
import time

from lexmill.llm import toxicity as tox
from pyspark.sql import functions as F

CLEAN = "the river ran past the mill and over the stones until it met the sea".split()


def brute_rate(model: tox.ToxicityModel, text: str) -> float:
    folded = tox.fold(text)
    total, position = 0.0, 0
    for word in folded.split():
        weights = [w for e, w in model.weights.items() if f" {word} ".startswith(e)]
        spared = any(
            found.start() <= position < found.end() - 1
            for phrase in model.exceptions
            for found in re.finditer(f"(?= {phrase} )", folded)
            for found in [re.compile(f" {phrase} ").match(folded, found.start())]
        )
        total += 0.0 if spared or not weights else max(weights)
        position += len(word) + 1
    return total / max(20, len(folded.split()))


def invented(draw: random.Random, toxic: bool) -> str:
    words = [draw.choice(CLEAN) for _ in range(draw.randrange(20, 80))]
    if toxic:
        for _ in range(1 + len(words) // 15):
            words.insert(draw.randrange(len(words)), draw.choice(["Idiot!", "m0ron", "ѕcum", "worthless,"]))
    return " ".join(words)


def test_folding():
    assert tox.fold("An 1D10T, а M0RON & $cum; 2024 x!! ok_go") == " an idiot a moron scum x ok go "
    assert tox.fold("") == "  "


def test_masked_words_equal_their_expression():
    """The one-pass rule against the expression that says what a masked word is, which takes cubic time."""
    signs = tox._SIGNS
    masked = re.compile(rf"[^\W_]*(?:{signs}+[^\W\d_]+)+{signs}*")
    draw = random.Random(5)
    for _ in range(60_000):
        text = "".join(draw.choices("ab0146!@2_ ²é", k=draw.randrange(16)))
        wanted = masked.sub(lambda match: match[0].translate(tox._SUBSTITUTE), text)
        assert tox._RUN.sub(tox._plain, text) == wanted, text


def test_long_runs_fold_in_linear_time():
    started = time.perf_counter()
    for run in ("1", "!", "1!", "a1", "12", "@", "a", "1a2!"):
        assert len(tox.fold(f"a4b {run * 1_000_000} a4b")) > 8
    assert time.perf_counter() - started < 30


def test_each_substitution_is_folded():
    for stand_in, letter in tox.SUBSTITUTIONS.items():
        assert tox.fold(f"dis{stand_in}usting {stand_in}ad 2{stand_in}") == f" dis{letter}usting {letter}ad "


def test_automaton_equals_brute_force():
    model = tox.ToxicityModel({" idiot ": 2.0, " idio": 1.0, " trash ": 1.5, " scu": 0.5}, -3.0, 1.0)
    draw = random.Random(1)
    words = ["idiot", "idiotic", "trash", "can", "bin", "scum", "pond", "proof", "river", "tr4sh"]
    for _ in range(500):
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(40)))
        assert abs(model.rate(text) - brute_rate(model, text)) < 1e-12


def test_learns_held_out_texts(spark):
    draw = random.Random(4)
    rows = [(n, invented(draw, n % 3 == 0), int(n % 3 == 0)) for n in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "y"), (900, "", "z")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows] + [(900, None), (0, 1)], "doc_id long, toxic int")
    model = tox.fit(docs, labels, F.col("doc_id") < 300)
    got = {r.doc_id: r for r in tox.score(docs, model).collect()}
    wrong = [i for i, _, kind in rows[300:] if got[i].predicted != kind]
    assert len(wrong) <= 2
    assert got[900].score == got[None].score < 0.3
    assert tox.score(docs.limit(0), model).collect() == []


def test_a_text_is_read_to_its_end(spark):
    model = tox.ToxicityModel({" idiot ": 5.0}, -3.0, 1.0)
    assert model.rate("river " * 50_000 + "idiot " * 5_000) > 0


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    (row,) = tox.score(docs, tox.fit(docs, labels, F.lit(True))).collect()
    assert 0 <= row.score <= 1


def test_labelled_rows_are_drawn_in_any_share(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    labels = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    drawn = {most: tox.labelled(docs, labels, "toxic", F.lit(True), most).count() for most in (0.0001, 600, 3000, 6000, 9000)}
    assert drawn[0.0001] <= 1 and 500 < drawn[600] < 700 and 2800 < drawn[3000] < 3200 and drawn[6000] == drawn[9000] == 6000
