from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from lexmill.llm import packing as pk
from tokenizers import Tokenizer

CAPACITIES = [
    pk.Capacity(tokens=40, documents=40, attention=1600),
    pk.Capacity(tokens=40, documents=3, attention=1600),
    pk.Capacity(tokens=40, documents=40, attention=500),
    pk.Capacity(tokens=40, documents=5, attention=900, rule="dot", weights=(1.0, 0.5, 0.5)),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(pk.VOCABULARY_PATH)


def one_at_a_time(lengths: list[int], capacity: pk.Capacity) -> int:
    """Best fit, piece by piece."""
    bins: list[list[int]] = []
    for length in sorted(lengths, reverse=True):
        left = np.array([(capacity.tokens - sum(b), capacity.documents - len(b), capacity.attention - sum(x * x for x in b)) for b in bins])
        left = left.reshape(-1, 3)
        fits = np.flatnonzero((left[:, 0] >= length) & (left[:, 1] >= 1) & (left[:, 2] >= length * length))
        if len(fits):
            bins[fits[np.argmax(capacity.scores(length, left[fits]))]].append(length)
        else:
            bins.append([length])
    return len(bins)


def check_sequences(rows: list, capacity: pk.Capacity) -> int:
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for spans in held.values():
        spans.sort()
        end = 0
        for offset, length in spans:
            assert offset == end
            end += length
        assert end <= capacity.tokens and len(spans) <= capacity.documents
        assert sum(length * length for _, length in spans) <= capacity.attention
    return len(held)


@pytest.mark.parametrize("capacity", CAPACITIES)
def test_plan_keeps_every_capacity_and_uses_as_few_sequences_as_one_at_a_time(capacity):
    draw = random.Random(2)
    for _ in range(25):
        lengths = [draw.randrange(1, capacity.longest + 1) if draw.random() < 0.6 else draw.choice([1, 2, 7]) for _ in range(draw.randrange(120))]
        histogram = Counter(lengths)
        rows = [
            (first + n, offset, length)
            for length, _, count, first, offset in pk.plan(histogram, capacity).tolist()
            for n in range(count)
        ]
        assert Counter(length for _, _, length in rows) == histogram
        used = check_sequences(rows, capacity)
        if capacity.rule == "norm":
            assert used <= one_at_a_time(lengths, capacity) + 1


def test_ids_equal_the_library(library):
    draw = random.Random(5)
    alphabet = "aB É  \x1c\x1f中\t\n\xa0🙂Σς'sre12½éİ"
    alphabet += "".join(map(chr, range(0xA0, 0x100))) + "Ññ<|>!?0"
    coder = pk.vocabulary(pk.VOCABULARY_PATH)
    for _ in range(6000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(25)))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_documents(spark, library):
    draw = random.Random(7)
    texts = [" ".join(draw.choice(["tea", "Ox,", "river"]) for _ in range(draw.choice([3, 3, 200, 2046, 2047, 5000]))) for _ in range(60)]
    texts += [None, "", "  \n", "tea"]
    rows = [(n, text, "x") for n, text in enumerate(texts)] + [(None, "tea", "y"), (0, texts[0], "z")]
    got = pk.pack(spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(5)).collect()
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got], pk.Capacity())
    wanted = []
    for doc_id, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for number, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            wanted.append((doc_id, number, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(wanted, key=repr)
    tokens = sum(row[3] for row in wanted)
    assert len({r.sequence_id for r in got}) <= one_at_a_time([row[3] for row in wanted], pk.Capacity()) + 1
    assert tokens == sum(r.length for r in got)
    assert pk.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ids_equal_the_library_on_any_characters(library):
    coder = pk.vocabulary(pk.VOCABULARY_PATH)
    narrow = [chr(code) for code in range(256)]
    wide = narrow + list("ΣσςİıŒœŠ’“—…中文한̧́ ﻿😀ﬁſ")
    draw = random.Random(3)
    texts = [around.replace("x", one) for one in narrow for around in ("x", "axb", "xxx", "a' x's")]
    texts += ["".join(draw.choice(kind) for _ in range(draw.randrange(25))) + end for kind in (narrow, wide) for end in ("", " 'LL can'T <| <|x") for _ in range(800)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids, text


def test_memos_compute_what_they_lack_one_at_a_time(library):
    """Words and runs that no memo has, also when both generations are full and when they are too long for a memo."""
    coder = pk.WordVocabulary(pk.VOCABULARY_PATH, memos=(3, 3))
    words = [f"eauouon{n} Καλη{n}" for n in range(20)] + ["x" * 100, "ξ" * 100]
    for text in [*words, " ".join(words), *words]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(coder._words) <= 3 and len(coder._memo) <= 3
    asked = []
    memo = pk.Memo(lambda word: asked.append(word) or word.encode(), 2, longest=5)
    assert [memo[word] for word in ["a", "a", "b", "c", "a", "longer", "longer"]] == [b"a", b"a", b"b", b"c", b"a", b"longer", b"longer"]
    assert asked == ["a", "b", "c", "longer", "longer"]
