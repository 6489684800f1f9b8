from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from lexmill.llm import components, simhash


def plain_fingerprint(text: str) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[n : n + 3]) for n in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], ids: list) -> list:
    root = list(range(len(prints)))

    def find(n: int) -> int:
        while root[n] != n:
            n = root[n]
        return n

    for n, left in enumerate(prints):
        for m in range(n):
            if (left ^ prints[m]).bit_count() <= 2:
                root[find(n)] = find(m)
    least: dict = {}
    for n, doc_id in enumerate(ids):
        if doc_id is not None:
            least[find(n)] = min(doc_id, least.get(find(n), doc_id))
    return [least.get(find(n)) for n in range(len(ids))]


def test_fingerprints_equal_the_plain_rule():
    draw = random.Random(3)
    alphabet = "aB É  \x1f中 \t\n\x0b🙂"
    for _ in range(500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(40)))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    long = " ".join(draw.choice("abcdefg") for _ in range(150_000))
    assert simhash.fingerprint(long.encode()) == plain_fingerprint(long)


@pytest.mark.parametrize("crowd", [2, 48])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    draw = random.Random(8)
    prints = [0, 2**64 - 1, 2**63]
    for _ in range(12):
        seed = draw.getrandbits(64)
        prints.append(seed)
        for _ in range(draw.randrange(12)):
            seed ^= 1 << draw.randrange(64) | (1 << draw.randrange(64) if draw.random() < 0.7 else 0)
            prints.append(seed ^ (0b111 if draw.random() < 0.3 else 0))
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    got = dict(components.component_labels(simhash.links(frame)).collect())
    labels = [got.get(p, p) for p in signed]
    assert labels == brute_components(prints, signed)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(n, n + 1) for n in range(200)]
    star = [(1000, n) for n in range(1001, 1300)]
    edges = chain + star + [(5, 5), (7, 6), (2000, 1999)] + chain[:20]
    random.Random(1).shuffle(edges)
    got = dict(components.component_labels(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[n] == 0 for n in range(201)) and all(got[n] == 1000 for n in range(1000, 1300))
    assert got[2000] == 1999 and len(got) == 201 + 300 + 2


def test_documents(spark):
    draw = random.Random(6)
    texts = []
    for _ in range(30):
        words = [draw.choice(["alpha", "beta", "gamma", "delta", "omega", "pi"]) + str(draw.randrange(9)) for _ in range(200)]
        texts.append(" ".join(words))
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = "edit"
            texts.append(" ".join(words))
    texts += ["", None, " \n", "one", "ONE", "one two"]
    rows = [(n * 7 - 20, text, "x") for n, text in enumerate(texts)] + [(None, "one", "y"), (1, texts[0], "z"), (1, texts[0], "z")]
    draw.shuffle(rows)
    got = simhash.group_by_simhash(spark.createDataFrame(rows, "doc_id long, text string, print string")).collect()
    prints = [plain_fingerprint(text or "") for _, text, _ in rows]
    expected = zip((r[0] for r in rows), (f"{p:016x}" for p in prints), brute_components(prints, [r[0] for r in rows]))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert simhash.group_by_simhash(spark.createDataFrame([], "doc_id long, text string")).collect() == []
