from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from lexmill.llm import spelling

SCHEMA = "doc_id long, text string"


def plain_words(rows: list[tuple]) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:n] + b[n + 1 :] == a for n in range(len(b)))


def plain(words: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * words[w] else None
    found = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        found.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(found)


def edited(draw: random.Random, word: str) -> str:
    at, letter = draw.randrange(len(word)), draw.choice("abcdeéÿàß")
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def made(seed: int, stems: int, shared: str) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for number in range(stems):
        stem = shared + "".join(draw.choice("abcdeéÿàß") for _ in range(draw.randrange(4, 9)))
        words = [stem] * draw.choice([2, 30, 400])
        for _ in range(draw.randrange(12)):
            variant = edited(draw, stem)
            words += [variant] * draw.choice([2, 3, 40])
            words += [edited(draw, variant)] * 2
        draw.shuffle(words)
        rows += [(len(rows) + n, " ".join(words[n::3]) + "×÷ 12 Über-") for n in range(3)]
    return rows


@pytest.mark.parametrize("crowd, shared", [(64, ""), (3, "pre"), (1, "")])
def test_equals_brute_force(spark, monkeypatch, crowd, shared):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    rows = made(crowd, 40, shared)
    got = spelling.group_variants(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == plain(plain_words(rows))


def test_pairs_and_their_places(spark):
    """Every single edit of a word of each length, at each place."""
    words = set()
    for length in range(7, 13):
        word = "qwertzuiopas"[:length]
        words |= {word} | {word[:n] + word[n + 1 :] for n in range(length)} | {word[:n] + "ÿ" + word[n + 1 :] for n in range(length)}
        words |= {word[:n] + "é" + word[n:] for n in range(length + 1)}
    words = {w: 2 for w in words if len(w) >= 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    wanted = {tuple(sorted((a, b))) for a in words for b in words if one_edit(a, b)}
    got = [tuple(sorted((row.a, row.b))) for row in spelling.near_pairs(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted


def test_odd_rows(spark):
    rows = [(None, "Wörterbuch wörterbuch"), (1, None), (2, ""), (3, "WÖRTERBUCH ÄÖÜäöüÄÖÜäöü"), (3, "WÖRTERBUCH ÄÖÜäöüÄÖÜäöü")]
    rows += [(4, "x" * 300_000 + " " + "langes_" * 50_000)]
    schema = "doc_id long, text string, word int, n int"
    frame = spark.createDataFrame([(*row, 1, 2) for row in rows], schema)
    assert sorted(map(tuple, spelling.group_variants(frame).collect())) == plain(plain_words(rows))
    assert spelling.group_variants(spark.createDataFrame([], SCHEMA)).collect() == []
