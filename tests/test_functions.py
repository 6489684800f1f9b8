"""Scalar functions against plain restatements."""

from __future__ import annotations

import hashlib
import time
import random

import pytest
from pyspark.sql import functions as F

from lexmill.functions import hashing
from lexmill.functions import text as tx
from lexmill.functions.normalize import normalize

SPACE = " \t\n\v\f\r"


def normalized_by_hand(text):
    """The normaliser, stated character by character."""
    if text is None:
        return ""
    text = text[1:] if text.startswith("﻿") else text
    text = text.replace("\r\n", "\n").replace("\r", "\n").replace("\t", " ")
    for old, new in {"‘": "'", "’": "'", "“": '"', "”": '"'}.items():
        text = text.replace(old, new)
    text = text.replace("–", "-").replace("—", " - ").replace("…", "...")
    runs, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and (text[end] in SPACE) == (text[at] in SPACE):
            end += 1
        run = text[at:end]
        runs.append(("\n" if "\n" in run else " ") if run[0] in SPACE else run)
        at = end
    return "".join(runs).strip(" \n")


def test_normalizer_on_random_strings(spark):
    draw = random.Random(7)
    pieces = [*" \t\n\r\v\f", "\r\n", "﻿", "‘", "’", "“", "”", "–", "—"]
    pieces += ["…", " ", "\u0085", "a", "b", "é", "😀", "▁", "-", ".", "\x00", "\x1c"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    texts += [None, "", "   ", "﻿﻿x", " ﻿x", "a \n \n b", "\r\r\n\n"]
    rows = spark.createDataFrame([(text,) for text in texts], "t string").select("t", normalize(F.col("t")).alias("n"))
    wrong = [(row["t"], row["n"]) for row in rows.collect() if row["n"] != normalized_by_hand(row["t"])]
    assert wrong == []


def fnv_by_hand(octets):
    state = 1469598103934665603
    for byte in octets:
        state = ((state ^ byte) * 1099511628211) % (1 << 64)
    return state


def test_hashes(spark):
    keys = ["", "a", "shard-000000.txt\t12\n", "é😀", "x" * 300] + [f"k{index}" for index in range(200)]
    frame = spark.createDataFrame([(key,) for key in keys], "k string").select(
        "k",
        hashing.fnv_checksum(F.col("k")).alias("fnv"),
        hashing.fnv_unit_interval(F.col("k")).alias("fnv_unit"),
        hashing.unit_interval(F.col("k")).alias("unit"),
    )
    for row in frame.collect():
        state = fnv_by_hand(row["k"].encode())
        assert row["fnv"] == f"fnv1a64:{state:x}"
        assert row["fnv_unit"] == pytest.approx(state / (2**64 - 1), rel=1e-12)
        assert row["unit"] == int(hashlib.md5(row["k"].encode()).hexdigest()[:13], 16) / 2**52


def test_hex(spark):
    frame = spark.createDataFrame([("",), ("aé😀",), ("\n",)], "t string").withColumn("h", tx.encode_hex(F.col("t")))
    for row in frame.withColumn("back", tx.decode_hex(F.col("h"))).collect():
        assert row["h"] == row["t"].encode().hex() and row["back"] == row["t"]
    for bad in ("abc", "zz"):
        with pytest.raises(Exception, match="malformed hex"):
            spark.createDataFrame([(bad,)], "h string").select(tx.decode_hex(F.col("h"))).collect()


def test_visible(spark):
    cases = {"▁The": "[ws]The", "â–\u0081x": "[ws]x", "â–x": "[ws]x", "a\nb\r\t": "a\\nb\\r\\t"}
    cases |= {"\x00\x1f\x7f": "\\x00\\x1f\\x7f", "é": "é"}
    rows = spark.createDataFrame([(text,) for text in cases], "t string").select("t", tx.visible(F.col("t")).alias("v"))
    assert {row["t"]: row["v"] for row in rows.collect()} == cases


def test_lines_paths_and_kinds(spark):
    texts = ["", "a", "a\n", "a\n\nb\r\n", "x\ry\n z "]
    rows = spark.createDataFrame([(text,) for text in texts], "t string").select(
        tx.text_lines(F.col("t")).alias("all"), tx.normalized_lines(F.col("t")).alias("kept")
    )
    assert [(row["all"], row["kept"]) for row in rows.collect()] == [
        ([], []),
        (["a"], ["a"]),
        (["a"], ["a"]),
        (["a", "", "b"], ["a", "b"]),
        (["x\ry", " z "], ["x\ny", "z"]),
    ]
    paths = spark.createDataFrame([("a/supplemental-x.txt",), ("supplemental-/x.txt",)], "p string")
    kinds = [row[0] for row in paths.select(tx.corpus_kind(F.col("p"))).collect()]
    assert kinds == ["supplemental_corpus_text", "parquet_corpus_text"]
    named = spark.range(1).select(
        tx.shard_name(F.lit(7)),
        tx.example_label(F.lit("e1"), F.lit("input")),
        tx.parse_corpus_kind(F.lit("other")),
        tx.ratio(F.lit(1), F.lit(0)),
        tx.utc_text(F.lit("2024-01-02 03:04:05").cast("timestamp")),
    )
    assert tuple(named.first()) == ("shard-000007.txt", "e1.input", None, 0.0, "2024-01-02T03:04:05Z")


def test_long_strings_are_hashed_in_little_time(spark):
    # an expression that steps from byte to byte is too slow for these 30 MB; one string is longer than what is folded at once
    keys = ["é" * 200_000, "", None] + ["x" * length for length in range(9_900, 10_000)] * 30
    frame = spark.createDataFrame([(key,) for key in keys], "k string").repartition(4)
    started = time.monotonic()
    found = dict(frame.select("k", hashing.fnv_checksum(F.col("k")).alias("fnv")).distinct().collect())
    assert time.monotonic() - started < 20
    for key in (keys[0], "", "x" * 9_900, "x" * 9_999):
        assert found[key] == f"fnv1a64:{fnv_by_hand(key.encode()):x}"
    assert found[None] == found[""] and len(found) == 103
