from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from lexmill.llm import exact_dedup, fuse_filter

SCHEMA = "doc_id long, text string"
BLANKS = " \t\n\x0b\x0c\r"


def normal(text: str | None) -> str:
    return "".join(c for c in text or "" if c not in BLANKS)


def plain(batch: list[tuple], snapshot: list[tuple] = ()) -> list[tuple]:
    """Each row of the batch with the best row of all that are equal to it."""
    groups: dict = {}
    for doc_id, text in [*batch, *snapshot]:
        groups.setdefault(normal(text), []).append((-len(text or ""), doc_id is None, doc_id))
    found = []
    for doc_id, text in batch:
        group = groups[normal(text)]
        keep = min(group, key=lambda row: (row[0], row[1], row[2] or 0))[2]
        found.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(found, key=repr)


def rows_of(frame) -> list[tuple]:
    assert frame.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, frame.collect()), key=repr)


def invented(draw: random.Random, count: int, first: int = 0) -> list[tuple]:
    words = ["alpha", "beta", "É", " ", "\n", " ", "\x1f", "中"]
    return [(first + n, "".join(draw.choices(words, k=draw.randrange(4)))) for n in range(count)]


def test_halves_equal_brute_force(spark):
    rows = invented(random.Random(1), 300)
    rows += [(900, None), (901, ""), (902, " \n"), (None, "no id"), (None, "no id"), (903, "no id"), (None, "alone")]
    rows += [rows[5], rows[5], (904, "x" * 500_000), (905, "x " * 500_000), (-3, "x" * 500_000)]
    assert rows_of(exact_dedup.deduplicate_halves(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)


@pytest.mark.parametrize("shard_keys", [1 << 18, 16])
def test_batch_against_a_snapshot(spark, monkeypatch, shard_keys):
    """A snapshot that is smaller than the batch, as large, larger, and of one row; small shards make many filters and parts."""
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", shard_keys)
    draw = random.Random(shard_keys)
    batch = invented(draw, 120) + [(n + 500, f"own {n}") for n in range(100)] + [(None, "own 3"), (7, None)]
    for size in (1, 40, 400):
        snapshot = invented(draw, size, 5000) + [(9000 + n, f"own  {n}") for n in range(0, size, 9)]
        frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (batch, snapshot)]
        assert rows_of(exact_dedup.deduplicate(*frames)) == plain(batch, snapshot)


def test_empty_batch_snapshot_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b"), (2, "ab")], SCHEMA)
    assert exact_dedup.deduplicate(empty, some).collect() == exact_dedup.deduplicate_halves(empty).collect() == []
    wanted = plain([(1, "a b"), (2, "ab")])
    assert rows_of(exact_dedup.deduplicate(some, empty)) == rows_of(exact_dedup.deduplicate(some)) == wanted
    clash = some.selectExpr("doc_id", "text", "1 as key", "2 as shard", "'x' as text_sha256", "3 as n_chars", "4 as newer", "5 as salt")
    assert rows_of(exact_dedup.deduplicate_halves(clash)) == rows_of(exact_dedup.deduplicate(clash, clash.limit(0))) == wanted


def test_a_batch_far_larger_than_the_snapshot_is_cut(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 50)
    seen = []
    original = exact_dedup.screen
    monkeypatch.setattr(exact_dedup, "screen", lambda *given: seen.append(given[2:]) or original(*given))
    batch = [(n, f"text {n}") for n in range(1000)]
    frames = spark.createDataFrame(batch, SCHEMA), spark.createDataFrame([(5000, "text 3")], SCHEMA)
    assert rows_of(exact_dedup.deduplicate(*frames)) == plain(batch, [(5000, "text 3")])
    assert seen == [(1, 20)]


def test_filter_holds_every_key_and_few_others():
    draw = np.random.default_rng(4)
    for size in (0, 1, 2, 3, 100, 50_000):
        keys = draw.integers(0, 2**63, size, dtype=np.uint64)
        made = fuse_filter.build(np.concatenate([keys, keys[: size // 2]]))
        assert fuse_filter.contains(made, keys).all()
        others = draw.integers(2**63, 2**64, 20_000, dtype=np.uint64)
        assert fuse_filter.contains(made, others).mean() < 0.01


def test_texts_with_one_digest_are_an_error(spark):
    texts = exact_dedup.normalised(spark.createDataFrame([(1, "a"), (2, "a "), (3, "b")], SCHEMA))
    digests = exact_dedup.digests(spark.createDataFrame([(1, "a")], SCHEMA)).select("text_sha256")
    exact_dedup.check_bytes(texts, digests)
    import pyspark.sql.functions as F

    forged = texts.withColumn("normal", F.when(F.col("doc_id") == 3, "b").otherwise(F.col("normal")))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("one"))
        with pytest.raises(RuntimeError, match="share"):
            exact_dedup.check_bytes(forged, spark.createDataFrame([("one",)], "text_sha256 string"))
