from __future__ import annotations

import random

import numpy as np
import pytest
from lexmill.llm import quality as ql
from pyspark.sql import functions as F

WORDS = "the river ran past mill and over stones until it met sea under bridge".split()


def invented(draw: random.Random, good: bool) -> str:
    if good:
        return "\n".join(" ".join(draw.choice(WORDS) for _ in range(draw.randrange(5, 15))).capitalize() + "." for _ in range(5))
    kind = draw.randrange(3)
    if kind == 0:
        return " ".join([draw.choice(WORDS)] * draw.randrange(20, 60))
    if kind == 1:
        return " ".join(draw.choice(WORDS) + draw.choice(["###", "&&&", "$$$"]) for _ in range(40))
    return " | ".join(draw.choice(WORDS) for _ in range(40))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    return [(n, invented(draw, n % 4 != 0), int(n % 4 != 0)) for n in range(600)]


def test_rules_generalise_and_compile_to_the_same_score(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows] + [(None, None, "y", 2), (700, "", "z", 3)], "doc_id long, text string, of string, label int")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows] + [(700, None), (1, 1)], "doc_id long, quality int")
    model = ql.fit(docs, labels, F.col("doc_id") < 400)
    got = {r.doc_id: r for r in ql.score(docs, model).collect()}
    wrong = [i for i, _, kind in rows[400:] if got[i].predicted != kind]
    assert len(wrong) <= 3
    values = np.array([ql.statistics_of(t) for _, t, _ in rows])
    assert np.allclose([got[i].score for i, _, _ in rows], model.score_values(values))
    assert got[700].score == got[None].score and 0 <= got[700].score <= 1
    kept = ql.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    assert ql.score(docs.limit(0), model).collect() == []


def test_statistics_of_odd_texts():
    assert all(np.isfinite(ql.statistics_of(text)).all() for text in ("", " ", "\n\n", "🙂", "a" * 500_000, "x " * 100_000))
    by_name = dict(zip(ql.STATISTICS, ql.statistics_of("Ab ab ab | 12!!\nAb ab ab | 12!!")))
    assert by_name["repeated_lines"] == 0.5 and by_name["adjacent_repeats"] == 2 / 10 and by_name["pipes"] == 0.2


def test_lasso_drops_useless_rules():
    draw = np.random.default_rng(0)
    design = draw.random((800, 20)) < 0.5
    labels = (design[:, 3] ^ (draw.random(800) < 0.05)).astype(float)
    _, weights = ql.lasso_logistic(design, labels, 0.02)
    assert weights[3] > 1 and np.count_nonzero(weights) <= 3


def test_one_kind_of_label(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    (row,) = ql.score(docs, ql.fit(docs, labels, F.lit(True))).collect()
    assert row.predicted == 1
