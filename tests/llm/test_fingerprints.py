from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from lexmill.llm import fingerprints as fp


def jaccard(left: str, right: str) -> float:
    a, b = Counter(fp.pieces(left)), Counter(fp.pieces(right))
    union = sum((a | b).values())
    return 1.0 if not union else sum((a & b).values()) / union


def invented(draw: random.Random, paragraphs: int) -> str:
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    return "\n".join(" ".join(draw.choice(words) for _ in range(draw.randrange(1, 40))) + "." for _ in range(paragraphs))


def test_peeling_gives_the_exact_difference_at_any_size():
    draw = random.Random(2)
    texts = [invented(draw, n) for n in (0, 1, 2, 5, 50, 400, 3000)] + ["", "a. a. a. b."]
    others = texts[1:] + texts[:1]
    got = fp.likeness([fp.piece_digests(t) for t in texts], [fp.piece_digests(t) for t in others])
    assert got == pytest.approx([jaccard(a, b) for a, b in zip(texts, others)], abs=1e-12)


def test_recovered_digests_are_the_differing_ones():
    left, right = fp.piece_digests("one. two. three."), fp.piece_digests("two. three. four.")
    sides = []
    for digests in (left, right):
        sketch = fp.Sketch(1, 24)
        sketch.add(digests, np.zeros(len(digests), np.int64))
        sides.append(sketch)
    found, _, signs, clear = (sides[0] - sides[1]).peel()
    assert clear.all()
    by_sign = {int(s): int(d) for d, s in zip(found, signs)}
    assert by_sign == {1: int(fp.piece_digests("one.")[0]), -1: int(fp.piece_digests("four.")[0])}


@pytest.mark.parametrize("bucket_rows", [1, 3, 1000])
def test_next_text_follows_the_ids(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fp, "BUCKET_ROWS", bucket_rows)
    draw = random.Random(7)
    rows = [(i * 3 - 9, invented(draw, draw.randrange(4)), "x") for i in range(40)] + [(100, "long " * 9000, "x")]
    rows += [(5, None, "x"), (5, "tie", "x"), (5, "tie", "x"), (None, "no id", "x")]
    draw.shuffle(rows)
    got = fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, n_chars string")).collect()
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (-(2**63) if r[0] is None else r[0], r[1]))
    expected = []
    for place, (doc_id, text) in enumerate(order):
        after = order[(place + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        expected.append((doc_id, len(text), digest, round(jaccard(text, edited), 9), round(jaccard(text, after), 9)))
    key = lambda row: tuple(str(part) for part in row)
    mine = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(mine, key=key) == sorted(expected, key=key)
    same = {r.fingerprint for r in got if r.doc_id == 5 and r.n_chars == 3}
    assert len(same) == 1


def test_empty_and_single_row_tables(spark):
    schema = "doc_id long, text string"
    assert fp.fingerprints(spark.createDataFrame([], schema)).collect() == []
    (row,) = fp.fingerprints(spark.createDataFrame([(1, "abc. def.")], schema)).collect()
    assert row.near_next == 1.0
