"""Index, mix, sampling, vocabulary and artifacts on a small source tree."""

from __future__ import annotations

import json
import random
import sys
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from lexmill import session
from lexmill.config import TrainingConfig, WriteOptions
from lexmill.functions import hashing
from lexmill.functions.normalize import normalize
from lexmill.operators import corpus, evaluate, mix, sampling, stats, subword_model, vocab_training
from lexmill.operators.merge_plan import merge_order
from lexmill.operators.subword_model import SubwordModel, segment_word
from lexmill.plans.artifacts import write_artifacts
from lexmill.plans.index import ensure_corpus_index
from lexmill.plans.progress import progress
from lexmill.plans.training import build_input, select_lines, train_vocabulary
from lexmill.sources.snapshots import Snapshots
from lexmill.sources.text_lines import scan_lines

SHARD = "Neutral prose makes the vocabulary cover plain language.\r\nThe record keeps its doubt where evidence is thin.\n"
SUPPLEMENT = "Spoken phrasing stays concise, literal and calm.\n"
SENTENCE = "Too little was measured to tell, and the answer stays open."


def record(example_id, split, asked, answered):
    fields = {"example_id": example_id, "normalized_input": asked, "output_text": answered}
    return json.dumps(fields | ({"split": split} if split else {}), ensure_ascii=False)


@pytest.fixture
def source(tmp_path):
    lines = {
        "base_training": [
            record("b1", "Train", "Write prose.", "An estuary is where river water meets the sea."),
            record("b2", "Test", "Write prose.", "A held-out river text with the word é😀."),
        ],
        "contextualization": [
            record("c1", "", "Source one reports a claim.", "The claim is tied to “one” source."),
            record("c2", "Validation", "Held-out input.", "Held-out output."),
        ],
        "custom_verbalization": [record("v1", "Train", "Confidence is low.", "Low confidence, so keep the doubt.\nSecond line.")],
        "small_supervised": [record("s1", "Train", "Solve this equation.", "I cannot answer that."), "{broken"],
    }
    for name, records in lines.items():
        path = tmp_path / "exports" / name / f"{name}.jsonl"
        path.parent.mkdir(parents=True)
        path.write_text("\n".join(records) + "\n", encoding="utf-8")
    (tmp_path / "corpus").mkdir()
    (tmp_path / "corpus" / "shard-000000.txt").write_bytes(SHARD.encode())
    (tmp_path / "corpus" / "supplemental-talk.txt").write_bytes(SUPPLEMENT.encode())
    (tmp_path / "dataset").mkdir()
    (tmp_path / "dataset" / "raw.parquet").write_text("placeholder")
    return tmp_path


def train(spark, source, **settings):
    config = TrainingConfig(**({"vocab_size": 400} | settings))
    roots = (str(source), str(source / "dataset"), str(source / "corpus"), str(source / "index"))
    return train_vocabulary(spark, *roots, config), config, roots


def test_training_run_end_to_end(spark, source, tmp_path):
    result, config, roots = train(spark, source)
    manifest = result.manifest.first()
    assert manifest["learned_vocab_size"] == 400
    assert manifest["held_out_text_count"] == 3
    assert manifest["special_tokens"] == {"<unk>": 0, "<bos>": 1, "<eos>": 2, "<pad>": 3}
    assert manifest["unknown_token_count"] == 0 and manifest["byte_fallback_token_count"] > 0
    assert manifest["training_text_count"] >= manifest["guaranteed_training_text_count"] > 0
    assert result.lineage.count() == 7
    lineage = {row["relative_path"]: row for row in result.lineage.collect()}
    supervised = lineage["exports/small_supervised/small_supervised.jsonl"]
    assert (supervised["record_count"], supervised["text_count"], supervised["repeated_count"]) == (2, 1, 2)
    assert lineage["exports/contextualization/contextualization.jsonl"]["text_count"] == 2
    assert lineage["supplemental-talk.txt"]["text_count"] == 1
    inventory = lineage[str(source / "dataset")]
    assert (inventory["record_count"], inventory["character_count"]) == (1, len("placeholder"))
    samples = result.samples.collect()
    assert samples[2]["category"] == "source" and any(row["token_pieces"][0].startswith("[ws]") for row in samples)
    assert all(row["decoded_text"] == row["normalized_text"] for row in samples)

    options = WriteOptions(str(tmp_path / "out"))
    write_artifacts(result, config, options, *roots[2:])
    loaded = SubwordModel.load(spark, f"{options.manifests}/model")
    assert loaded.pieces == result.model.pieces and loaded.vocab_size == 400
    report = "\n".join(row["value"] for row in spark.read.text(f"{options.reports}/training").collect())
    assert "unknown token count: `0`" in report and "are taken whole" in report
    vocab = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(f"{options.manifests}/vocab")
    assert vocab.columns == ["id", "kind", "label", "piece_hex", "visible_piece"] and vocab.count() == 400
    stored = json.loads(spark.read.text(f"{options.manifests}/manifest").first()["value"])
    assert stored["learned_vocab_size"] == 400
    kinds = {row["kind"] for row in spark.read.json(f"{options.manifests}/sources").collect()}
    assert {"parquet_corpus_text", "supplemental_corpus_text", "corpus_inventory"} <= kinds
    assert json.loads(spark.read.text(f"{options.manifests}/config").first()["value"])["vocab_size"] == 400

    # a second run is the same, and reuses the index
    again, _, _ = train(spark, source)
    assert again.index.reused_existing and not result.index.reused_existing
    assert again.model.pieces == result.model.pieces and again.manifest.first() == manifest


def test_guaranteed_lines_survive_a_tiny_cap(spark, source):
    for mode in ("bernoulli", "exact"):
        config = TrainingConfig(vocab_size=400, sample_cap=1, sample_mode=mode)
        roots = (str(source), str(source / "dataset"), str(source / "corpus"))
        index = ensure_corpus_index(spark, roots[2], str(source / "index")).index
        training = build_input(spark, *roots, index, config)
        budget = training.budget.first()
        assert (budget["budget"], budget["rate"]) == (0, 0.0)
        kept = Counter(row["kind"] for row in select_lines(training, config).collect())
        assert kept["supplemental_corpus_text"] == 1 and kept["parquet_corpus_text"] == 0 and kept["base_training"] == 1


def test_zero_weight_keeps_every_shard_line(spark, source):
    config = TrainingConfig(vocab_size=400, sample_cap=1, parquet_corpus_weight=0)
    index = ensure_corpus_index(spark, str(source / "corpus"), str(source / "index")).index
    training = build_input(spark, str(source), str(source / "dataset"), str(source / "corpus"), index, config)
    kept = Counter(row["kind"] for row in select_lines(training, config).collect())
    assert kept["parquet_corpus_text"] == 2


def test_index_is_reused_refreshed_and_equal_to_a_full_scan(spark, source):
    root, path = str(source / "corpus"), str(source / "index")
    first = ensure_corpus_index(spark, root, path)
    assert not first.reused_existing and first.file_count == 2
    assert ensure_corpus_index(spark, root, path).reused_existing
    shard = source / "corpus" / "shard-000000.txt"
    shard.write_bytes(SHARD.encode() + b"\nA new line.\n")
    (source / "corpus" / "empty.txt").write_bytes(b"\n")
    third = ensure_corpus_index(spark, root, path)
    assert not third.reused_existing and (third.file_count, third.rescanned_count) == (3, 2)
    rows = {row["relative_path"]: row for row in third.index.collect()}
    assert (rows["shard-000000.txt"]["record_count"], rows["shard-000000.txt"]["text_count"]) == (4, 3)
    assert (rows["empty.txt"]["record_count"], rows["empty.txt"]["text_count"]) == (1, 0)
    full = ensure_corpus_index(spark, root, str(source / "other"), reuse=False)
    assert {tuple(row) for row in full.index.collect()} == {tuple(row) for row in third.index.collect()}
    (source / "corpus" / "empty.txt").unlink()
    gone = ensure_corpus_index(spark, root, path)
    assert "file list changed" in gone.reason and gone.file_count == 2
    assert "root does not match" in ensure_corpus_index(spark, str(source), path).reason
    with pytest.raises(FileNotFoundError):
        ensure_corpus_index(spark, str(source / "nowhere"), path)


def test_progress_rows_of_a_training_and_of_one_that_fails(spark, source, tmp_path):
    _, _, roots = train(spark, source)
    rows = progress(spark, f"{roots[-1]}/progress").orderBy("seq").collect()
    finished = [row["phase"] for row in rows if row["state"] == "finished"]
    assert finished == ["index", "sources", "words", "merges", "manifest"]
    assert any(row["phase"].startswith("merges ") and row["state"] == "running" for row in rows)
    assert rows[-1]["files"] == 2 and rows[-1]["scanned"] > 0 and rows[-1]["selected"] > 0
    broken = str(tmp_path / "broken")
    with pytest.raises(ValueError, match="no room"):
        train_vocabulary(spark, *roots, TrainingConfig(vocab_size=270), broken)
    last = progress(spark, broken).orderBy("seq").collect()[-1]
    assert (last["phase"], last["state"]) == ("merges", "failed") and "no room" in last["last_error"]


def test_index_of_texts_equals_index_of_their_lines(spark):
    """Any way to group lines into texts and blocks gives one checksum, that of the plain polynomial."""
    import hashlib

    lines = [f"line {n} \t x" if n % 7 else "" for n in range(200)]
    found = set()
    for size, block in ((1, 4096), (3, 2), (50, 1), (200, 4096)):
        groups = [lines[n : n + size] for n in range(0, 200, size)]
        rows = [("f.txt", n, "\n".join(group) + "\n") for n, group in enumerate(groups)]
        texts = spark.createDataFrame(rows, "relative_path string, row_index long, text string").repartition(3)
        found |= {tuple(row) for row in stats.corpus_index(stats.measured_texts(texts, block)).collect()}
    raw = spark.createDataFrame([("f.txt", n // 60, n, line) for n, line in enumerate(lines)], "relative_path string, block long, position long, raw string")
    found |= {tuple(row) for row in stats.corpus_index(stats.measured_lines(raw)).collect()}
    values = [0, 0]
    for line in lines:
        digest = hashlib.md5(hashlib.md5(line.encode()).hexdigest().encode()).hexdigest()
        for place, modulus in enumerate(hashing.ROLLING_MODULI):
            values[place] = (values[place] * hashing.ROLLING_BASE + int(digest[:15], 16)) % modulus
    (row,) = found
    assert row[2] == 200 and row[-1] == f"rolling62:{values[0] << 31 | values[1]:x}"


def test_index_reads_the_texts_once(spark, tmp_path):
    spark.createDataFrame([("f.txt", 1, "a\nb")], "relative_path string, row_index long, text string").write.parquet(str(tmp_path / "t"))
    index = stats.corpus_index(stats.measured_texts(spark.read.parquet(str(tmp_path / "t")), 4096))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_a_crash_before_the_pointer_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    table = Snapshots(spark, path)
    assert table.current is None and table.read() is None
    assert table.write(spark.range(3)) == 0 and table.read().count() == 3

    def crash(self, version):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "_point", crash)
        with pytest.raises(RuntimeError):
            table.write(spark.range(5))
    assert table.current == 0 and table.read().count() == 3
    assert table.write(spark.range(7)) == 2 and table.read().count() == 7
    old = table.read()
    assert table.write(spark.range(8)) == 3 and old.count() == 7 and table.read().count() == 8
    assert table.write(spark.range(9)) == 4
    assert sorted(p.name for p in (tmp_path / "table" / "versions").iterdir()) == ["3", "4"]


def test_checksum_follows_line_order_only(spark):
    def checksum(lines, partitions):
        rows = [("f.txt", index // 3, index, line) for index, line in enumerate(lines)]
        frame = spark.createDataFrame(rows, "relative_path string, block long, position long, raw string")
        return stats.corpus_index(stats.measured_lines(frame.repartition(partitions))).first()["checksum"]

    lines = [f"line {index}" for index in range(20)]
    assert checksum(lines, 1) == checksum(lines, 7)
    assert checksum(lines, 1) != checksum([lines[1], lines[0], *lines[2:]], 1)


def test_line_numbers_over_many_splits(spark, tmp_path):
    texts = ["" if index % 7 == 0 else f" line {index} " for index in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(texts) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        lines = scan_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 3
        numbered = corpus.numbered_file_lines(lines).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    expected = [text.strip() for text in texts if text.strip()]
    assert [(row["line_no"], row["text"]) for row in numbered] == list(enumerate(expected, start=1))


def lines_frame(spark, count):
    rows = [("a.txt", index, "parquet_corpus_text", 1, f"text {index % 50}") for index in range(count)]
    rows += [("supplemental-b.txt", 1, "supplemental_corpus_text", 1, "kept")]
    return spark.createDataFrame(rows, "relative_path string, line_no long, kind string, weight int, text string")


def test_samples_do_not_depend_on_partitions(spark):
    lines = lines_frame(spark, 3000)
    totals = spark.createDataFrame([(3000, 1)], "shard_text_count long, guaranteed_text_count long")
    budget = sampling.sample_budget(totals, 901)
    assert budget.first()["budget"] == 900
    chosen = [
        {tuple(row) for row in sampling.bounded_sample(lines.repartition(parts), budget).collect()} for parts in (1, 7)
    ]
    assert chosen[0] == chosen[1] and 780 < len(chosen[0]) < 1020
    by_fnv = sampling.bounded_sample(lines, budget, "fnv").count()
    assert 780 < by_fnv < 1020
    for wanted in (0, 1, 900, 2999, 3000, 5000):
        kept = sampling.exact_sample(lines.repartition(3), sampling.sample_budget(totals, wanted + 1))
        assert kept.filter("kind = 'parquet_corpus_text'").count() == min(wanted, 3000)
        assert kept.filter("kind <> 'parquet_corpus_text'").count() == 1


def test_step_tables_are_deleted_once_they_are_replaced(spark):
    steps = session.StepTables(spark)
    first = steps.write(spark.range(10).toDF("n"))
    second = steps.write(first.selectExpr("n + 1 AS n"))
    root = Path(urlparse(steps._root).path)
    steps.keep(second)
    assert [path.name for path in root.iterdir() if not path.name.startswith(".")] == ["1"]
    assert second.agg({"n": "sum"}).first()[0] == 55
    steps.clear()
    assert not root.exists()


@pytest.mark.parametrize("weight", [0, 1, 2])
def test_both_modes_read_the_budget_by_weight(spark, weight):
    lines = lines_frame(spark, 2000)
    totals = spark.createDataFrame([(2000 * weight, 1)], "shard_text_count long, guaranteed_text_count long")
    budget = sampling.sample_budget(totals, 1001)
    shard = "kind = 'parquet_corpus_text'"
    share = 2000 if weight == 0 else 1000 // weight
    assert sampling.exact_sample(lines, budget).filter(shard).count() == share
    assert abs(sampling.bounded_sample(lines, budget).filter(shard).count() - share) <= (0 if weight == 0 else 100)


def test_hash_and_mode_have_to_go_together():
    for bad in ({"sample_hash": "crc"}, {"sample_hash": "fnv", "sample_mode": "exact"}):
        with pytest.raises(ValueError):
            TrainingConfig(**bad)


def test_weights_split_routing_and_repetition(spark):
    rows = [("exports/base_training/base_training.jsonl", "Train", "in", "out", "e1", 1)]
    rows += [("exports/contextualization/contextualization.jsonl", split, "in", "out", "e2", 2) for split in ("test", "Test")]
    records = spark.createDataFrame(
        rows, "relative_path string, split string, normalized_input string, output_text string, example_id string, record_hash long"
    )
    config = TrainingConfig(vocab_size=400, base_training_output_weight=0)
    texts = mix.export_texts(records, mix.export_rules(spark, config))
    kept = {(row["source_label"], row["weight"]) for row in mix.training_mix(texts).collect()}
    assert kept == {("e1.output", 0), ("e2.input", 1), ("e2.output", 2)}
    assert mix.repeat_weighted(mix.training_mix(texts)).count() == 3
    assert {row["source_label"] for row in mix.held_out_texts(texts).collect()} == {"e2.input", "e2.output"}
    lineage = {row["kind"]: row for row in mix.export_lineage(records, texts, mix.export_rules(spark, config)).collect()}
    assert (lineage["base_training"]["text_count"], lineage["base_training"]["repeated_count"]) == (1, 0)
    assert lineage["small_supervised"]["record_count"] == 0


def merged_by_hand(words, pieces, max_length):
    """One merge at a time, counting again after each."""
    words = [(list(word), freq) for word, freq in words.items()]
    known = {ch for symbols, _ in words for ch in symbols}
    target, merges = len(known) + pieces, []
    while len(known) < target:
        counts = Counter()
        for symbols, freq in words:
            for pair in zip(symbols, symbols[1:]):
                counts[pair] += freq
        counts = {pair: count for pair, count in counts.items() if len("".join(pair)) <= max_length}
        if not counts:
            break
        best = min(counts, key=lambda pair: merge_order(pair, counts[pair]))
        merges.append((*best, counts[best]))
        known.add("".join(best))
        for symbols, _ in words:
            at = 0
            while at + 1 < len(symbols):
                if (symbols[at], symbols[at + 1]) == best:
                    symbols[at : at + 2] = ["".join(best)]
                at += 1
    return merges


@pytest.mark.parametrize(("seed", "candidates", "max_length"), [(1, 200, 24), (2, 3, 24), (3, 40, 4)])
def test_batched_merges_equal_one_at_a_time(spark, seed, candidates, max_length):
    draw = random.Random(seed)
    letters = ["▁ab.$", "▁abcdefg\\", "▁é😀|(a"][seed - 1]
    words = Counter()
    for _ in range(120):
        words["".join(draw.choice(letters) for _ in range(draw.randint(1, 9)))] += draw.randint(1, 40)
    letters_seen = len(set("".join(words)) | {"▁"})
    size = vocab_training.FIRST_FREE_ID + letters_seen + 30
    config = TrainingConfig(vocab_size=size, candidates_per_round=candidates, max_piece_length=max_length)
    results = []
    for partitions in (1, 5) if seed == 1 else (2,):
        frame = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(partitions)
        trained = vocab_training.train_merges(frame, config)
        results.append([merge[1:3] + merge[4:] for merge in trained.merges])
        assert trained.rounds < len(trained.merges) or candidates < 10
    assert all(result == merged_by_hand(words, 30, max_length) for result in results)


@pytest.mark.parametrize(
    ("seed", "share", "replayed", "pieces", "max_length"),
    [(4, 1.0, 3, 24, 24), (5, 1.0, 100, 24, 24), (6, 0.3, 1, 12, 3)],
)
def test_rounds_by_the_pair_index_equal_one_at_a_time(spark, monkeypatch, seed, share, replayed, pieces, max_length):
    """Few letters make repeated symbols and pieces of several derivations, whose pairs the index holds under older ones."""
    if seed == 5:
        # too many words for a broadcast by their number alone: what is looked up is written and counted
        monkeypatch.setattr(vocab_training, "BROADCAST_LIMIT_BYTES", 64)
    draw = random.Random(seed)
    words = Counter()
    for _ in range(150):
        words["▁" + "".join(draw.choice("aab'\\c") for _ in range(draw.randint(0, 12)))] += draw.randint(1, 30)
    letters_seen = len(set("".join(words)))
    config = TrainingConfig(
        vocab_size=vocab_training.FIRST_FREE_ID + letters_seen + pieces, candidates_per_round=50, max_piece_length=max_length
    )
    frame = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(3)
    trained = vocab_training.train_merges(frame, config, sparse_share=share, replayed=replayed)
    assert [merge[1:3] + merge[4:] for merge in trained.merges] == merged_by_hand(words, pieces, max_length)
    assert trained.indexed_rounds >= 1 and trained.index_builds >= 1
    assert replayed == 100 or trained.index_builds >= trained.indexed_rounds // replayed


def test_phases_on_frequent_runs_equal_one_at_a_time(spark, monkeypatch):
    """Phases of a few merges on runs of frequent pairs; rare letters between them make many words and few runs."""
    for name, value in (("PHASE_MERGES", 5), ("PHASE_GROWTH", 0), ("SPARE_PAIRS", 1)):
        monkeypatch.setattr(vocab_training, name, value)
    sizes = []

    class Seen(vocab_training.WordTables):
        def __init__(self, symbols, *steering):
            sizes.append(symbols.count())
            super().__init__(symbols, *steering)

    monkeypatch.setattr(vocab_training, "WordTables", Seen)
    draw = random.Random(8)
    words = Counter()
    for _ in range(300):
        rare = "".join(draw.choice("qxzé😀$") for _ in range(3))
        words["▁" + draw.choice(["aab", "abab", "ab\\", "aaaa"]) + rare + draw.choice(["ba", "aaa", ""])] += draw.randint(1, 30)
    letters_seen = len(set("".join(words)))
    config = TrainingConfig(vocab_size=vocab_training.FIRST_FREE_ID + letters_seen + 17)
    trained = vocab_training.train_merges(spark.createDataFrame(list(words.items()), "word string, freq long").repartition(3), config)
    assert [merge[1:3] + merge[4:] for merge in trained.merges] == merged_by_hand(words, 17, 24)
    assert len(sizes) > 2 and max(sizes[:2]) < 20 < len(words) / 5
    # the end of all pairs is found through phases as well
    few = {"▁ab": 3, "▁abc": 2, "▁q": 9}
    full = vocab_training.train_merges(spark.createDataFrame(list(few.items()), "word string, freq long"), TrainingConfig(vocab_size=1000))
    assert [merge[1:3] + merge[4:] for merge in full.merges] == merged_by_hand(Counter(few), 100, 24)


def test_frequent_runs_are_cut_and_counted(spark):
    words = spark.createDataFrame([("a b c", 2), ("x a b", 3), ("b c a b", 4), ("x", 5), ("c x", 6)], "symbols string, freq long").coalesce(1)
    counts = {tuple(row) for row in vocab_training.adjacent_counts(words).collect()}
    assert counts == {("a", "b", 9), ("b", "c", 6), ("x", "a", 3), ("c", "a", 4), ("c", "x", 6)}
    assert vocab_training.phase_pairs(words, 24, 3) == ({("a", "b"), ("b", "c"), ("c", "x")}, 5)
    assert vocab_training.phase_pairs(words, 24, 2) == ({("a", "b")}, 7)
    assert vocab_training.phase_pairs(words, 1, 2)[1] == 1
    runs = {tuple(row) for row in vocab_training.frequent_runs(words, {("a", "b"), ("b", "c")}).collect()}
    assert runs == {("a b c", 2), ("a b", 7), ("b c", 4)}


def test_pair_index_holds_each_pair_of_a_word_once(spark):
    words = spark.createDataFrame([(1, "a b a b"), (2, "b a"), (3, "ab c")], "id long, symbols string")
    held = sorted(tuple(row) for row in vocab_training.pair_index(words).select("id", "pair").collect())
    assert held == [(1, "a b"), (1, "b a"), (2, "b a"), (3, "ab c")]


@pytest.fixture(scope="module")
def small_model(spark):
    text = "the then there this that thing other another the the of often on one once\n" * 3
    lines = spark.createDataFrame([(line, 1) for line in text.splitlines()], "text string, weight int")
    words = vocab_training.word_frequency(lines)
    trained = vocab_training.train_merges(words, TrainingConfig(vocab_size=300))
    return SubwordModel.from_training(spark, trained)


def test_round_trip_of_any_text(spark, small_model):
    texts = ["the other", "", None, "  ", "a\nb\n\nc", "<0x41> <unk>", "▁ ▁x x▁", "é😀 漢字", "the—then …", "\x00\x1f"]
    draw = random.Random(5)
    alphabet = ["the", " ", "\n", "o", "▁", "é", "😀", "<0x0A>", "﻿", "\t", "\x7f", "x"]
    texts += ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 20))) for _ in range(500)]
    frame = spark.createDataFrame([(text,) for text in texts], "t string").select(
        normalize(F.col("t")).alias("n"), small_model.encode(F.col("t")).alias("ids")
    )
    checked = frame.withColumn("d", small_model.decode(F.col("ids"))).withColumn("unk", small_model.unknown_count(F.col("ids")))
    for row in checked.collect():
        assert row["d"] == row["n"] and row["unk"] == 0 and (row["ids"] != []) == (row["n"] != "")


def test_evaluation_by_distinct_words_equals_encoding_the_texts(spark, small_model):
    texts = ["the other  thing the", "", None, "a▁b ▁ the", "▁", "one\n\non ce\n", " \n ", "é😀 the\tthe", "the other  thing the"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    ids = F.col("ids")
    encoded = frame.select("text", small_model.encode(F.col("text")).alias("ids")).select(
        F.size(ids).alias("tokens"), small_model.byte_fallback_count(ids).alias("fallback"), small_model.unknown_count(ids).alias("unknown")
    )
    expected = encoded.agg(F.sum("tokens"), F.sum("fallback"), F.sum("unknown")).first()
    found = evaluate.evaluate_held_out(small_model, frame).first()
    assert tuple(expected) == (found["held_out_token_count"], found["byte_fallback_token_count"], found["unknown_token_count"])
    assert found["held_out_text_count"] == len(texts)
    assert found["held_out_character_count"] == sum(len((text or "").encode()) for text in texts)
    nothing = evaluate.evaluate_held_out(small_model, frame.filter("false")).first()
    assert (nothing["held_out_text_count"], nothing["average_characters_per_token"]) == (0, 0)


def test_describe_and_tables(spark, small_model):
    ids = spark.createDataFrame([([0, 3, 4 + 0x41],)], "ids array<int>")
    assert ids.select(small_model.describe(F.col("ids"))).first()[0] == ["<unk>", "<pad>", "<0x41>"]
    assert ids.select(small_model.byte_fallback_count(F.col("ids"))).first()[0] == 1
    for bad in (-1, small_model.vocab_size):
        with pytest.raises(Exception, match="unknown token id"):
            spark.createDataFrame([([bad],)], "ids array<int>").select(small_model.describe(F.col("ids"))).collect()
    assert small_model.special_map().first()[0] == {"<unk>": 0, "<bos>": 1, "<eos>": 2, "<pad>": 3}
    sizes = vocab_training.vocab_sizes(small_model.vocab).first()
    assert (sizes["vocab_size"], sizes["special_count"]) == (small_model.vocab_size, 4)
    rows = small_model.vocab_rows().collect()
    assert [row["id"] for row in rows] == list(range(len(rows)))
    assert (rows[0]["kind"], rows[0]["visible_piece"], rows[4]["label"]) == ("special", "<unk>", "piece_4")
    assert any(row["visible_piece"].startswith("[ws]th") for row in rows)


def ranks_in_order(model):
    return sorted(model._ranks.items(), key=lambda entry: entry[1])


def test_written_vocabulary_loads_back(spark, small_model, tmp_path):
    small_model.save_text(str(tmp_path))
    loaded = SubwordModel.load_text(spark, str(tmp_path))
    assert (loaded.pieces, loaded.special_tokens) == (small_model.pieces, small_model.special_tokens)
    assert ranks_in_order(loaded) == ranks_in_order(small_model)
    texts = ["the other thing", "", "é😀 on  one\nonce", "▁ there\tthen", None]
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    ids = frame.select(small_model.encode(F.col("t")).alias("mine"), loaded.encode(F.col("t")).alias("theirs"))
    assert all(row["mine"] == row["theirs"] for row in ids.collect())


def test_a_piece_of_two_derivations_keeps_both_ranks(spark, tmp_path):
    """``abc`` is a + bc first and ab + c later; the vocabulary names it once, the merges have both."""
    merges = [(0, "b", "c", "bc", 9), (1, "a", "bc", "abc", 8), (2, "a", "b", "ab", 7), (3, "ab", "c", "abc", 2)]
    trained = vocab_training.Training(merges, ["▁", "a", "b", "c"], 1)
    SubwordModel.from_training(spark, trained).save_text(str(tmp_path))
    loaded = SubwordModel.load_text(spark, str(tmp_path))
    assert ranks_in_order(loaded) == [(("b", "c"), 0), (("a", "bc"), 1), (("a", "b"), 2), (("ab", "c"), 3)]
    assert loaded.merges.orderBy("rank").first()["count"] == 9


@pytest.mark.parametrize(
    ("part", "at", "line", "problem"),
    [
        ("vocab", 5, "4\tpiece\tpiece_4\t3c3\t<0x00>", "malformed hex payload"),
        ("vocab", 5, "4\tpiece\tpiece_4\tzz\t<0x00>", "malformed hex payload"),
        ("vocab", 5, "9999\tpiece\tpiece_4\t3c\t<", "without gaps"),
        ("vocab", 5, "4\tother\tpiece_4\t3c\t<", "unknown kind"),
        ("vocab", 5, "4\tpiece\tpiece_4", "wrong number of fields"),
        ("vocab", 5, "x\tpiece\tpiece_4\t3c\t<", "bad number"),
        ("merges", 1, "70\t74\t68\t5", "merge ranks"),
        ("merges", 1, "0\t71\t7a\t5", "vocabulary lacks"),
    ],
)
def test_a_damaged_vocabulary_is_an_error(spark, small_model, tmp_path, part, at, line, problem):
    small_model.save_text(str(tmp_path / "good"))
    for name in ("vocab", "merges"):
        lines = next((tmp_path / "good" / name).glob("part-*")).read_text(encoding="utf-8").split("\n")
        if name == part:
            lines[at] = line
        (tmp_path / "bad" / name).mkdir(parents=True)
        (tmp_path / "bad" / name / "part-0.csv").write_text("\n".join(lines), encoding="utf-8")
    with pytest.raises(Exception, match=problem):
        SubwordModel.load_text(spark, str(tmp_path / "bad"))


def test_decode_of_odd_ids(spark, small_model):
    rows = [([4 + 0xC3, 4 + 0xA9, 4 + 0x41],), ([4 + 0xC3, 4 + 0x41],), ([0, None, 4 + 0x41],), ([],), (None,), ([4 + 0x42],)]
    frame = spark.createDataFrame(rows, "ids array<int>").coalesce(1)
    decoded = [row[0] for row in frame.select(small_model.decode(F.col("ids"))).collect()]
    assert decoded == ["éA", "\ufffdA", "⁇ A", "", None, "B"]
    empty = spark.createDataFrame([([],), (None,)], "ids array<int>").coalesce(1)
    assert [row[0] for row in empty.select(small_model.decode(F.col("ids"))).collect()] == ["", None]
    for bad in (-1, small_model.vocab_size):
        with pytest.raises(Exception, match="(?i)index|bound"):
            spark.createDataFrame([([bad],)], "ids array<int>").select(small_model.decode(F.col("ids"))).collect()


def test_word_memory_is_small(monkeypatch):
    monkeypatch.setattr(subword_model, "WORD_CACHE_SIZE", 3)
    ids = subword_model.WordIds(lambda word: list(map(ord, word)))
    long = "x" * (subword_model.WORD_CACHE_LENGTH + 1)
    for word in ("a", "bc", long, "d", "bc", "e", "a"):
        assert ids[word] == b"".join(ord(ch).to_bytes(4, "little") for ch in word)
        assert len(ids) <= 3 and long not in ids
    # a full memory of the longest words, as objects of this process
    assert 200_000 * (sys.getsizeof("é" * 64) + sys.getsizeof(b"x" * 4 * 64) + 110) < 120e6


def test_long_words_segment_quickly_and_leftmost_first():
    ranks = {("a", "a"): 0, ("aa", "aa"): 1, ("b", "a"): 2}
    assert segment_word("aaaaa", ranks) == ["aaaa", "a"]
    assert segment_word("baab", ranks) == ["b", "aa", "b"]
    assert "".join(segment_word("ab" * 100_000, ranks)) == "ab" * 100_000


def test_alphabet_must_fit(spark):
    words = spark.createDataFrame([("▁abc", 1)], "word string, freq long")
    with pytest.raises(ValueError, match="no room"):
        vocab_training.train_merges(words, TrainingConfig(vocab_size=262))
    full = vocab_training.train_merges(words, TrainingConfig(vocab_size=1000))
    assert [merge[3] for merge in full.merges] and len(full.merges) == 3
    with pytest.raises(ValueError):
        TrainingConfig(vocab_size=4)
