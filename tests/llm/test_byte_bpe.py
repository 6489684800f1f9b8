from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from lexmill.llm import byte_bpe as bb

ALPHABET = "ab cde  \n\t\r\x0b\x1c\x1f\x85\xa0 'sre'll12½²éßñ中文🙂👩‍👧 ́٣Ⅷ<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    coder = bb.codec(bb.RANKS_PATH)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder._ranks, special_tokens={}
    )


def ids(text: str) -> list[int]:
    return np.frombuffer(bb.codec(bb.RANKS_PATH).encode(text), "<u4").tolist()


def test_ids_equal_the_library(library):
    draw = random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choice(ALPHABET) for _ in range(draw.randrange(14)))
        assert ids(text) == library.encode_ordinary(text)
        assert bb.codec(bb.RANKS_PATH).decode(bb.codec(bb.RANKS_PATH).encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["", "a" * 30000, "x y " * 9000, " lead", "trail ", "two  blanks\n\nlines \n x"])
def test_long_and_irregular_texts(library, text):
    assert ids(text) == library.encode_ordinary(text)


def test_memo_generations_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(bb, "MEMO_ENTRIES", 5)
    coder = bb.ByteCodec(bb.RANKS_PATH)
    text = " ".join(f"word{n % 17} zq{n % 5}" for n in range(300))
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_short_unknown_words_merge_together(library, monkeypatch):
    """Words of one batch that are no tokens are merged at once; only long ones go through the heap."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgéß中xyzaaa") for _ in range(draw.randrange(2, 40))) for _ in range(3000)]
    words += ["a" * n for n in (47, 48, 49, 200)]
    coder, alone, merge = bb.ByteCodec(bb.RANKS_PATH), [], bb.ByteCodec.merge
    monkeypatch.setattr(bb.ByteCodec, "merge", lambda self, raw: alone.append(raw) or merge(self, raw))
    texts = [" ".join(words[start : start + 300]) for start in range(0, len(words), 300)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in coder.encode_all(texts)]
    assert got == [library.encode_ordinary(text) for text in texts]
    assert alone and all(len(raw) > bb.TOGETHER_BYTES for raw in alone)


def test_a_vocabulary_without_all_bytes_uses_the_heap(tmp_path):
    path = tmp_path / "few.tiktoken"
    path.write_text("YQ== 0\nYg== 1\nYWI= 2\n")  # a, b, ab
    coder = bb.ByteCodec(str(path))
    assert np.frombuffer(coder.encode("abba ab".replace(" ", "")), "<u4").tolist() == [2, 1, 0, 2]


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = [f"key{n}".encode() for n in range(1000)]
    table = bb.PerfectHash(keys)
    assert sorted(table.find(key) for key in keys) == list(range(1000))
    assert all(table.find(f"other{n}".encode()) == -1 for n in range(1000))
    assert bb.PerfectHash([b"one"]).find(b"one") == 0


def test_rows(spark, library):
    rows = [(1, "hello world", 5), (2, None, 6), (None, "hello world", 7), (1, "hello world", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    encoded = bb.encode(frame)
    got = {row.doc_id: row for row in bb.decode(encoded).collect()}
    assert len(got) == 3 and bytes(got[1].decoded) == b"hello world" and got[2].n_tokens == 0
    wanted = hashlib.sha256(np.array(library.encode_ordinary("hello world"), "<u4").tobytes()).hexdigest()
    both = {row.doc_id: row for row in bb.round_trip(frame).collect()}
    assert both[1].ids_sha256 == wanted and both[1].decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    assert bb.encode(frame.limit(0)).collect() == []
