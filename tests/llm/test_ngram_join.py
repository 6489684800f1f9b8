from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from lexmill.llm import ngram_join

SCHEMA = "doc_id long, text string"


def plain_set(text: str | None) -> frozenset:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[n : n + 5]) for n in range(max(1, len(words) - 4)))


def plain(rows: list[tuple]) -> list[tuple]:
    sets = [plain_set(row[1]) for row in rows]
    root = list(range(len(rows)))

    def find(n: int) -> int:
        while root[n] != n:
            n = root[n]
        return n

    for n in range(len(rows)):
        for m in range(n):
            common = len(sets[n] & sets[m])
            if common and 100 * common >= 80 * (len(sets[n]) + len(sets[m]) - common):
                root[find(n)] = find(m)
    least: dict = {}
    for n, row in enumerate(rows):
        if row[0] is not None:
            least[find(n)] = min(row[0], least.get(find(n), row[0]))
    return sorted(((row[0], len(sets[n]), least.get(find(n))) for n, row in enumerate(rows)), key=repr)


def joined(spark, rows: list[tuple]) -> list[tuple]:
    frame = ngram_join.join_similar(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert frame.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, frame.collect()), key=repr)


def words(draw: random.Random, n: int) -> list[str]:
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


def near_copies(draw: random.Random) -> list[str]:
    """Families at all similarities around the threshold, sizes down to one shingle."""
    texts = []
    for _ in range(25):
        base = words(draw, draw.choice([1, 4, 5, 6, 9, 14, 40, 120, 300]))
        texts.append(" ".join(base))
        for _ in range(draw.randrange(6)):
            copy = list(base)
            for _ in range(draw.randrange(5)):
                copy[draw.randrange(len(copy))] = "edit" + str(draw.randrange(50))
            copy += words(draw, draw.choice([0, 0, 1, len(base) // 5, len(base) // 4]))
            texts.append(" ".join(copy).replace("w1", draw.choice(["w1", "W1"])))
    return texts


def test_shingle_sets_equal_the_plain_rule():
    draw = random.Random(3)
    for _ in range(500):
        text = "".join(draw.choice("aB É  \x1f中 \t\n\x0b🙂") for _ in range(draw.randrange(60)))
        wanted = {xxhash.xxh64_intdigest(one.encode(), 42) for one in plain_set(text)}
        assert ngram_join.shingle_set(text.encode()).tolist() == sorted(wanted)


@pytest.mark.parametrize("group, mixings, slice_queries", [(32, 3, 512), (2, 1, 2)])
def test_equals_brute_force(spark, monkeypatch, group, mixings, slice_queries):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "MIXINGS", mixings)
    monkeypatch.setattr(ngram_join, "SLICE_QUERIES", slice_queries)
    rows = [(n * 3 - 50, text) for n, text in enumerate(near_copies(random.Random(group)))]
    assert joined(spark, rows) == plain(rows)


def test_shared_passages_without_similarity(spark):
    """Texts put together from a few passages: every shingle is in many texts, few texts are similar."""
    draw = random.Random(5)
    passages = [" ".join(words(draw, 30)) for _ in range(14)]
    texts = [" ".join(draw.sample(passages, 5)) for _ in range(220)]
    texts += [" ".join([*text.split()[:-3], "own", "end"]) for text in texts[:20]]
    rows = list(enumerate(texts))
    assert joined(spark, rows) == plain(rows)


def test_crowd_around_its_origin(spark):
    """Copies with up to six edits; many are similar to the origin only."""
    draw = random.Random(8)
    base = words(draw, 150)
    texts = [" ".join(base)]
    for n in range(300):
        copy = list(base)
        for edit in range(draw.randrange(7)):
            copy[draw.randrange(150)] = f"own{n}x{edit}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    assert joined(spark, rows) == plain(rows)


def test_crowd_of_near_copies_is_not_paired(spark):
    draw = random.Random(6)
    base = words(draw, 200)
    texts = []
    for n in range(400):
        copy = list(base)
        copy[draw.randrange(200)] = f"own{n}"
        texts.append(" ".join(copy))
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows, raw = ngram_join._classes(frame, "doc_id", "text")
    classes = rows.groupBy("class").agg({"doc_id": "min"}).toDF("class", "least_id")
    sets = ngram_join.candidate_sets(raw, classes)
    ranked = ngram_join._ranked(sets)
    assert sets.count() == ranked.count() == 400
    groups = ngram_join._grouped(ranked, ngram_join._links_within(sets, ranked))
    assert groups.select("component").distinct().count() == 1
    assert ngram_join._links_across(sets, groups).count() == 0


def test_shared_tokens_move_once(spark):
    """The count of the tokens and the join with it read the same shuffle."""
    sets = spark.createDataFrame([(1, [5, 6, 7]), (2, [6, 7, 8]), (3, [7]), (4, [9]), (5, [])], "id long, hashes array<long>")
    frame = ngram_join._shared_tokens(sets.repartition(2)).select("id", "token", "n")
    assert sorted(map(tuple, frame.collect())) == [(1, 6, 2), (1, 7, 3), (2, 6, 2), (2, 7, 3), (3, 7, 3)]
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert [("ReusedExchange" in line) for line in plan.splitlines() if "Exchange hashpartitioning(token" in line] == [False, True]


def test_odd_rows(spark):
    long = " ".join(f"x{n}" for n in range(60_000))
    texts = ["", None, " \n", "one", "ONE", "one two", "a b c d e", "a b c d e", "a b c d e f", long, long + " more", long]
    rows = list(enumerate(texts)) + [(None, "one"), (None, None), (1, "one two"), (1, "one two"), (9, "a b c d e")]
    assert joined(spark, rows) == plain(rows)
    clash = spark.createDataFrame([(5, "p q r s t u", 1, "x", 2)], "doc_id long, text string, size int, class string, token int")
    assert [tuple(r) for r in ngram_join.join_similar(clash).collect()] == [(5, 2, 5)]
    assert ngram_join.join_similar(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bounds_lose_nothing():
    """The screen's prefix and its least number of shared tokens, by counting, for sets at the threshold."""
    draw = random.Random(1)
    for _ in range(3000):
        common = draw.randrange(1, 60)
        left_own, right_own = draw.randrange(16), draw.randrange(16)
        if not ngram_join.similar(common, common + left_own, common + right_own):
            continue
        tokens = draw.sample(range(1000), common + left_own + right_own)
        left = np.sort(tokens[: common + left_own])
        right = np.sort(tokens[:common] + tokens[common + left_own :])
        kept = [one[: ngram_join._screened(len(one), ngram_join.SPARE)] for one in (left, right)]
        for one in (left, right):
            least = -(-(-(-80 * len(one) // 100)) * ngram_join.SPARE // 100)
            assert len(set(kept[0]) & set(kept[1])) >= least
