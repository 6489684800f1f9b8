from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from lexmill.llm import lm_score as lm


def brute_log_prob(model: lm.WindowModel, text: str) -> float:
    """Token by token, with the whole distribution written out."""
    ids = model.ids()
    tokens = [ids[word] for word in lm.words_of(text)]
    total = 0.0
    for place, token in enumerate(tokens):
        hidden = model.table[lm._BIAS, : lm.HIDDEN].astype(float)
        for number, offset in enumerate(lm.PLACES):
            at = place + offset
            seen = tokens[at] if 0 <= at < len(tokens) else lm.PAD
            hidden = hidden + model.table[number * (lm.TOKENS + 1) + seen, : lm.HIDDEN]
        hidden = np.tanh(hidden)

        def chances(rows: np.ndarray) -> np.ndarray:
            logits = rows[:, : lm.HIDDEN] @ hidden + rows[:, lm.HIDDEN]
            odds = np.exp(logits - logits.max())
            return odds / odds.sum()

        group, member = divmod(token, lm.GROUP_SIZE)
        total += np.log(chances(model.table[lm._GROUP : lm._BIAS])[group] * chances(model.outputs[group])[member])
    return total


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(1)
    nouns, verbs = [f"noun{n}" for n in range(8)], [f"verb{n}" for n in range(8)]
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(draw.randrange(10, 40)):
            noun = draw.randrange(8)
            parts += ["the", nouns[noun], verbs[noun], "."]
        texts.append(" ".join(parts))
    return texts


@pytest.fixture(scope="module")
def model(spark, corpus):
    frame = spark.createDataFrame([(t, "x") for t in corpus], "text string, word string").repartition(3)
    return lm.fit(frame, rounds=3)


def test_counts(spark, corpus):
    frame = spark.createDataFrame([(t,) for t in corpus], "text string").repartition(3)
    assert dict(lm.word_counts(frame).collect()) == Counter(w for t in corpus for w in lm.words_of(t))


def test_scores_equal_brute_force(spark, model, corpus):
    rows = [(1, corpus[0], 0), (2, None, 0), (None, "the unknownword .", 0), (3, " \n", 0), (1, corpus[0], 0)]
    rows.append((4, "the noun1 verb1 . " * 15_000, 0))
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), model).collect()}
    for doc_id, text, _ in rows[:4]:
        assert got[doc_id].log_prob == pytest.approx(brute_log_prob(model, text or ""), rel=1e-4, abs=1e-6)
    assert (got[2].n_tokens, got[2].log_prob, got[2].mean_log_prob) == (0, 0.0, None)
    assert got[4].n_tokens == 60_000
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_training_uses_both_sides(spark, model, corpus):
    counts = Counter(w for t in corpus for w in lm.words_of(t))
    total = sum(counts.values())
    unigram = sum(n * np.log(n / total) for n in counts.values()) / total
    fresh = ["the noun2 verb2 . the noun5 verb5 . the noun0 verb0 ."]
    wrong = ["noun2 the . verb5 verb2 the noun5 . . the verb0 noun0"]
    frame = spark.createDataFrame([(1, fresh[0]), (2, wrong[0])], "doc_id long, text string")
    got = {r.doc_id: r.mean_log_prob for r in lm.score(frame, model).collect()}
    assert got[1] > unigram + 0.3 and got[1] > got[2] + 1


def test_empty_corpus(spark):
    frame = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in lm.fit_and_score(frame).collect()] == [(1, 0, 0.0, None)]
    assert lm.fit_and_score(frame.limit(0)).collect() == []


def test_each_rare_word_has_its_own_probability(spark):
    frequent = " ".join(f"w{n}" for n in range(lm.WORDS))
    rare = {f"rare{n}": 1 + n % 4 for n in range(3000)}
    texts = [frequent] * 6 + [" ".join(word for word, n in rare.items() for _ in range(n))]
    model = lm.fit(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), rounds=0)
    buckets: dict = {}
    for word, n in rare.items():
        buckets.setdefault(model.ids()[word], []).append(n)
    asked = ["w1 rare2 w2 rare3 rare3", "rare0", "never w1 rare7", "w1 w2"]
    got = {r.doc_id: r.log_prob for r in lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for number, text in enumerate(asked):
        others = [w for w in text.split() if not w.startswith("w")]
        shares = sum(np.log(rare.get(w, 1) / (sum(buckets.get(model.ids()[w], [])) + 1)) for w in others)
        assert got[number] == pytest.approx(brute_log_prob(model, text) + shares, rel=1e-4)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_the_rounds_cover_every_position_once(spark, monkeypatch, corpus, rounds):
    masks = [lm.in_round(corpus[0], 500, number, rounds) for number in range(rounds)]
    assert (np.sum(masks, 0) == 1).all() and all(mask.sum() > 500 / rounds / 2 for mask in masks)
    met, step = [], lm.Trainer.step
    monkeypatch.setattr(lm.Trainer, "step", lambda self, flat, at: met.append(len(at)) or step(self, flat, at))
    model = lm.fit(spark.createDataFrame([(t,) for t in corpus], "text string"), rounds=0)
    for number in range(rounds):
        trainer = lm.Trainer(model)
        sequences = [[model.ids()[w] for w in lm.words_of(t)] for t in corpus]
        parts = [lm.in_round(t, len(s), number, rounds) for t, s in zip(corpus, sequences)]
        lm._learn(trainer, sequences, parts, np.random.default_rng(number))
    assert sum(met) == sum(len(lm.words_of(t)) for t in corpus)


def test_a_round_reads_the_stored_ids(spark, corpus):
    """Ids are made once; a round over them, without the texts, trains as one over the words does."""
    frame = spark.createDataFrame([(t,) for t in [*corpus, "", "İ unknown"]], "text string").coalesce(1)
    model = lm.fit(frame, rounds=0)
    tokens = lm.token_ids(frame, model)
    ids, rows = model.ids(), tokens.collect()
    assert [np.frombuffer(row.ids, np.uint16).tolist() for row in rows] == [
        [ids[word] for word in lm.words_of(row.text)] for row in frame.collect()
    ]
    trainer, texts = lm.Trainer(model), [row.text for row in frame.collect()]
    sequences = [[ids[word] for word in lm.words_of(text)] for text in texts]
    parts = [lm.in_round(text, len(one), 0, 2) for text, one in zip(texts, sequences)]
    draw, start, size = np.random.default_rng([0, 0]), 0, 0
    for n, one in enumerate(sequences):
        size += len(one)
        if size >= lm.BATCH * 2 or n + 1 == len(sequences):
            lm._learn(trainer, sequences[start : n + 1], parts[start : n + 1], draw)
            start, size = n + 1, 0
    got = lm._round(tokens.select("hash", "ids"), model, 0, 2)
    # a step divides by the size of the gradients, so where they cancel out, rounding decides
    assert np.isclose(got.table, trainer.model.table, rtol=1e-3, atol=1e-4).mean() > 0.98
    assert np.abs(got.table - model.table).max() > 0.1


def test_a_step_equals_plain_gradients(spark, corpus):
    model = lm.fit(spark.createDataFrame([(t,) for t in corpus], "text string"), rounds=0)
    ids, rows, trainer = model.ids(), lm.ROWS, lm.Trainer(model)
    flat, positions, _ = lm._windows([[ids[w] for w in lm.words_of(t)] for t in [*corpus[:4], "noun1 unknown", ""]])
    gradients, met = np.zeros((rows, lm.HIDDEN + 1)), np.zeros(rows)
    table = model.table.astype(float)
    for at in positions:
        places = [flat[at + offset] + number * (lm.TOKENS + 1) for number, offset in enumerate(lm.PLACES)]
        hidden = np.tanh(table[[*places, lm._BIAS], : lm.HIDDEN].sum(0))
        group, back = flat[at] // lm.GROUP_SIZE, np.zeros(lm.HIDDEN)
        first = lm._OUT + group * lm.GROUP_SIZE
        for wanted, part in ((lm._GROUP + group, slice(lm._GROUP, lm._BIAS)), (lm._OUT + flat[at], slice(first, first + lm.GROUP_SIZE))):
            logits = table[part] @ np.append(hidden, 1)
            miss = np.exp(logits) / np.exp(logits).sum()
            miss[wanted - part.start] -= 1
            gradients[part] += np.outer(miss, np.append(hidden, 1))
            back += miss @ table[part, : lm.HIDDEN]
            met[wanted] += 1
        np.add.at(gradients[:, : lm.HIDDEN], [*places, lm._BIAS], back * (1 - hidden**2))
        np.add.at(met, places, 1)
    met[lm._BIAS] = 1
    trainer.step(flat, positions)
    moved = lm.STEP * gradients / np.sqrt(1e-6 + (gradients**2).mean(1))[:, None]
    np.testing.assert_array_equal(trainer.met, met)
    large = np.sqrt((gradients**2).mean(1)) > 1e-4
    np.testing.assert_allclose((table - trainer.model.table)[large], moved[large], rtol=5e-3, atol=5e-4)


@pytest.mark.parametrize("longest", [1, 8, 9, 300])
def test_sums_of_runs(longest):
    draw = np.random.default_rng(longest)
    rows = draw.normal(size=(400, 5))
    counts = draw.integers(1, longest + 1, 60)
    order = draw.integers(0, len(rows), counts.sum())
    wanted = [rows[part].sum(0) for part in np.split(order, np.cumsum(counts)[:-1])]
    np.testing.assert_allclose(lm._sums(rows, order, counts), wanted)


def test_masks_of_many_texts_at_once(corpus):
    texts, lengths = [*corpus[:5], "", corpus[0]], [40, 1, 7, 300, 0, 0, 40]
    got = lm._masked([zlib.crc32(text.encode()) for text in texts], lengths, 1, 3)
    assert got.tolist() == [mask for text, n in zip(texts, lengths) for mask in lm.in_round(text, n, 1, 3).tolist()]


@pytest.mark.parametrize("scale", [1, 300])
def test_large_logits_do_not_overflow(scale):
    """Logits are shifted only where their bound asks for it."""
    table = np.random.default_rng(4).normal(0, 0.1, (lm.ROWS, lm.HIDDEN + 1)).astype(np.float32)
    table[: lm._OUT, lm.HIDDEN] = 0
    table[lm._OUT : lm._BIAS] *= scale
    model = lm.WindowModel([f"w{n}" for n in range(lm.WORDS)], table, np.zeros(lm.BUCKETS), None)
    assert (lm._largest_logit(table) < lm.SAFE_LOGIT) == (scale == 1)
    flat, positions, _ = lm._windows([[model.ids()[word] for word in "w1 w2 other w3000 w7 more".split()]])
    got = lm.log_probabilities(model, flat, positions).sum()
    assert np.isfinite(got) and (scale > 1 or got == pytest.approx(brute_log_prob(model, "w1 w2 other w3000 w7 more"), rel=1e-4))
    trainer = lm.Trainer(model)
    trainer.step(flat, positions)
    assert np.isfinite(trainer.model.table).all()


def test_words_are_cut_as_python_cuts_them(monkeypatch):
    draw = random.Random(9)
    characters = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0   　​aBzÉßİΣς.,1中😀"
    texts = ["", " ", "\x1f", "a", " a ", *("".join(draw.choice(characters) for _ in range(draw.randrange(30))) for _ in range(3000))]
    words, counts = lm._cut(texts)
    assert words.to_pylist() == [word for text in texts for word in lm.words_of(text)]
    assert counts.tolist() == [len(lm.words_of(text)) for text in texts]
    monkeypatch.setattr(lm, "CUT_BYTES", 60)
    batch = pa.RecordBatch.from_pydict({"text": [*texts, "x" * 500, "y"]})
    parts = list(lm._parts(batch, 0, 50))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist() and len(parts) > 60
    assert lm._cut([])[1].tolist() == []


@pytest.mark.parametrize("known", [0, 5000, 100_000])
def test_scores_are_the_same_whatever_the_tasks_know(spark, monkeypatch, known):
    """Counts that the tasks hold and counts that are joined give one score, and few words are joined when many are known."""
    draw = random.Random(4)
    texts = ["", " \xa0", None, "never\x85w3", *(" ".join(f"w{min(draw.randrange(7000), int(draw.paretovariate(0.1)))}" for _ in range(500)) for _ in range(60))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    counts = Counter(word for text in texts for word in lm.words_of(text or ""))
    monkeypatch.setattr(lm, "KNOWN_WORDS", known)
    model = lm.fit(frame, rounds=0)
    assert len(model.known) <= known and all(counts[word] == n for word, n in model.known.items())
    assert len(model.known) > lm.WORDS or not known
    encoded = lm._encoded(lm._numbered(frame, "doc_id", "text"), model).collect()
    held = {*model.known, *model.words}
    assert {row.doc_id: row.rest.split() for row in encoded} == {
        doc_id: [word for word in lm.words_of(text or "") if word not in held] for doc_id, text in enumerate(texts)
    }
    got = {row.doc_id: row.log_prob for row in lm.score(frame, model).collect()}
    ids = model.ids()
    for doc_id, text in enumerate(texts[:10]):
        others = [word for word in lm.words_of(text or "") if word not in model.words]
        shares = sum(np.log(counts[word] / (model.bucket_counts[ids[word] - lm.WORDS] + 1)) for word in others)
        assert got[doc_id] == pytest.approx(brute_log_prob(model, text or "") + shares, rel=1e-4)
    both = {row.doc_id: row.log_prob for row in lm.fit_and_score(frame).collect()}
    apart = {row.doc_id: row.log_prob for row in lm.score(frame, lm.fit(frame)).collect()}
    assert both == pytest.approx(apart, rel=1e-3)
