"""Parquet ingest: column choice, failure isolation, resume, shards, streaming."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.config import IngestConfig
from lexmill.operators import sharding
from lexmill.plans.progress import progress
from lexmill.plans.ingest import export_text, file_log, load_corpus, run_ingest
from lexmill.sources import files, parquet_text
from lexmill.streaming.ingest_stream import start_ingest_stream

EXPECTED = [
    "First sample from raw text.",
    "Second sample from raw text.",
    "Third sample from raw text.",
    "Fourth sample from raw text.",
    "Nested content one.",
    "Nested content two.",
]


def write_parquet(path, column, texts, row_group_size=2):
    path.parent.mkdir(parents=True, exist_ok=True)
    table = pa.table({"source_id": [f"source-{index}" for index in range(len(texts))], column: texts})
    pq.write_table(table, path, row_group_size=row_group_size)


@pytest.fixture
def dataset(tmp_path):
    root = tmp_path / "data set"
    write_parquet(root / "a.parquet", "raw_text", [" First sample from raw text. ", *EXPECTED[1:4]])
    write_parquet(root / "nested" / "b.parquet", "content", EXPECTED[4:])
    (root / "bad.parquet").write_text("not parquet")
    (root / "ignored.PARQUET").write_text("the extension is case-sensitive")
    return root


def in_order(spark, out):
    rows = load_corpus(spark, str(out)).orderBy("relative_path", "row_index").collect()
    return [row["text"] for row in rows]


def config_of(dataset, out, **settings):
    return IngestConfig(str(dataset), str(out), batch_rows=1, shard_bytes=64, **settings)


def test_listing_is_sorted_case_sensitive_and_optionally_flat(spark, dataset):
    listed = files.list_parquet(spark, str(dataset)).orderBy("relative_path").collect()
    assert [row["relative_path"] for row in listed] == ["a.parquet", "bad.parquet", "nested/b.parquet"]
    assert listed[1]["input_bytes"] == len("not parquet")
    flat = files.list_parquet(spark, str(dataset), recursive=False)
    assert sorted(row["relative_path"] for row in flat.collect()) == ["a.parquet", "bad.parquet"]
    assert files.first_files(files.list_parquet(spark, str(dataset)), 2).count() == 2
    with pytest.raises(FileNotFoundError):
        files.list_parquet(spark, str(dataset / "missing"))


@pytest.mark.parametrize(
    ("columns", "settings", "expected"),
    [
        ({"content": ["x"], "text": ["x"]}, {}, "text"),
        ({"raw_text": [1], "content": ["x"]}, {}, "content"),
        ({"my_body": ["x"], "html_text": ["x"]}, {}, "my_body"),
        ({"Text": ["x"], "TEXT": ["x"]}, {}, None),
        ({"title": ["x"]}, {}, None),
        ({"title": ["x"], "text": ["x"]}, {"text_column": "title"}, "title"),
        ({"text": ["x"]}, {"text_column": "title"}, None),
        ({"title": [1]}, {"text_column": "title"}, None),
        ({"notes": ["x"], "other": ["x"]}, {"candidates": ("other", "notes")}, "other"),
    ],
)
def test_text_column_choice(spark, tmp_path, columns, settings, expected):
    pq.write_table(pa.table(columns), tmp_path / "f.parquet")
    footers = parquet_text.probe_footers(files.list_parquet(spark, str(tmp_path)))
    row = parquet_text.choose_text_column(footers, **settings).first()
    assert row["text_column"] == expected
    assert (row["note"] is None) == (expected is not None)


def test_large_strings_count_as_text_and_duplicates_are_ambiguous(spark, tmp_path):
    pq.write_table(pa.table({"text": pa.array(["x"], pa.large_string())}), tmp_path / "large.parquet")
    twice = pa.table([pa.array(["x"]), pa.array(["y"]), pa.array(["z"])], names=["text", "text", "content"])
    pq.write_table(twice, tmp_path / "twice.parquet")
    footers = parquet_text.probe_footers(files.list_parquet(spark, str(tmp_path)))
    chosen = {row["relative_path"]: row["text_column"] for row in parquet_text.choose_text_column(footers).collect()}
    assert chosen == {"large.parquet": "text", "twice.parquet": "content"}


def test_interrupted_run_resumes_without_loss_or_duplicates(spark, dataset, tmp_path):
    out = tmp_path / "out"
    first = run_ingest(spark, config_of(dataset, out, max_batches=2))
    assert first.interrupted and not first.resumed
    assert in_order(spark, out) == EXPECTED[:2] and first.total_rows_processed == 2
    second = run_ingest(spark, config_of(dataset, out))
    assert second.completed and second.resumed
    assert (second.completed_file_count, second.skipped_file_count) == (2, 1)
    assert second.total_rows_processed == 6 and second.total_text_rows_written == 6
    assert second.total_text_bytes_written == sum(len(text) + 1 for text in EXPECTED)
    assert second.shard_count >= 2
    assert in_order(spark, out) == EXPECTED
    report = "\n".join(row["value"] for row in spark.read.text(f"{out}/report").collect())
    assert "raw_text" in report and "content" in report and "bad.parquet" in report
    # a resumed run packs on where the last one stopped: as one run over everything
    single = tmp_path / "single"
    run_ingest(spark, config_of(dataset, single))
    shards = [
        {(row["relative_path"], row["row_index"], row["shard_id"]) for row in load_corpus(spark, str(place)).collect()}
        for place in (out, single)
    ]
    assert shards[0] == shards[1]


def test_batch_bound_resumes_inside_a_file_until_all_is_there(spark, tmp_path):
    root, out = tmp_path / "data", tmp_path / "out"
    texts = [f"text {index}" for index in range(95)]
    write_parquet(root / "one.parquet", "text", texts[:90], row_group_size=17)
    write_parquet(root / "two.parquet", "text", texts[90:])
    settings = {"batch_rows": 10, "shard_bytes": 200}
    seen = []
    for _ in range(4):
        result = run_ingest(spark, IngestConfig(str(root), str(out), max_batches=3, **settings))
        seen.append((result.total_rows_processed, result.completed))
    assert seen == [(30, False), (60, False), (90, False), (95, True)]
    assert in_order(spark, out) == texts
    single = tmp_path / "single"
    run_ingest(spark, IngestConfig(str(root), str(single), **settings))
    places = [{tuple(row) for row in load_corpus(spark, str(o)).drop("run").collect()} for o in (out, single)]
    assert places[0] == places[1]


def test_a_file_that_fails_in_a_later_run_is_dropped_whole(spark, tmp_path):
    root, out = tmp_path / "data", tmp_path / "out"
    texts = [f"line {index} of a file that will be damaged" for index in range(4000)]
    write_parquet(root / "torn.parquet", "text", texts, row_group_size=1000)
    write_parquet(root / "whole.parquet", "text", ["kept"])
    run_ingest(spark, IngestConfig(str(root), str(out), batch_rows=100, max_batches=5))
    assert load_corpus(spark, str(out)).count() == 500
    data = bytearray((root / "torn.parquet").read_bytes())
    quarter = len(data) // 4
    data[quarter : 3 * quarter] = b"\xff" * (2 * quarter)
    (root / "torn.parquet").write_bytes(bytes(data))
    result = run_ingest(spark, IngestConfig(str(root), str(out), batch_rows=100))
    assert in_order(spark, out) == ["kept"] and result.total_text_rows_written == 1
    assert (result.completed_file_count, result.skipped_file_count) == (1, 1)


def test_reported_rows_are_the_rows_in_the_corpus_when_a_file_breaks_during_the_run(spark, tmp_path, monkeypatch):
    """The file breaks after its footer was read and before its rows are: there is no later pass that could lose rows."""
    root, out = tmp_path / "data", tmp_path / "out"
    for name in ("a", "b"):
        write_parquet(root / f"{name}.parquet", "text", [f"{name} {index}" for index in range(4000)], row_group_size=1000)
    scan = parquet_text.scan_text

    def breaking(*args, **settings):
        data = bytearray((root / "b.parquet").read_bytes())
        data[len(data) // 4 : len(data) // 2] = b"\xff" * (len(data) // 2 - len(data) // 4)
        (root / "b.parquet").write_bytes(bytes(data))
        return scan(*args, **settings)

    monkeypatch.setattr(parquet_text, "scan_text", breaking)
    result = run_ingest(spark, IngestConfig(str(root), str(out), batch_rows=100))
    assert (result.completed_file_count, result.skipped_file_count) == (1, 1)
    assert result.total_text_rows_written == load_corpus(spark, str(out)).count() == 4000


def test_history_that_cannot_be_read_is_an_error(spark, dataset, tmp_path):
    out = tmp_path / "out"
    run_ingest(spark, config_of(dataset, out))
    for part in (out / "run_metrics").rglob("*.parquet"):
        part.write_bytes(b"not parquet at all, but long enough to be opened")
    with pytest.raises(Exception):
        run_ingest(spark, config_of(dataset, out))


def test_uncommitted_run_is_overwritten(spark, dataset, tmp_path):
    out = tmp_path / "out"
    run_ingest(spark, config_of(dataset, out, max_files=1))
    stray = spark.createDataFrame([("a.parquet", 0, 0, "stray")], "relative_path string, row_index long, batch_no long, text string")
    stray.write.parquet(f"{out}/corpus/run=1")
    assert in_order(spark, out) == EXPECTED[:4]
    result = run_ingest(spark, config_of(dataset, out))
    assert result.completed and in_order(spark, out) == EXPECTED


def test_resume_refuses_changed_files_and_accepts_new_ones(spark, dataset, tmp_path):
    out = tmp_path / "out"
    run_ingest(spark, config_of(dataset, out))
    write_parquet(dataset / "c.parquet", "text", ["Late text."])
    assert run_ingest(spark, config_of(dataset, out)).completed_file_count == 3
    assert in_order(spark, out)[4] == "Late text."
    write_parquet(dataset / "a.parquet", "raw_text", ["other", "content", "now"])
    with pytest.raises(ValueError, match="does not match"):
        run_ingest(spark, config_of(dataset, out))
    fresh = run_ingest(spark, config_of(dataset, out, resume=False))
    assert not fresh.resumed and fresh.total_rows_processed == 6


def test_strict_mode_stops_at_a_bad_file(spark, dataset, tmp_path):
    with pytest.raises(RuntimeError, match="bad.parquet"):
        run_ingest(spark, config_of(dataset, tmp_path / "out", stop_on_file_error=True))


def test_file_damaged_behind_its_footer_is_skipped_whole(spark, tmp_path):
    root = tmp_path / "data"
    write_parquet(root / "good.parquet", "text", ["kept one", "kept two"])
    texts = [f"line {index} of a file that is damaged in the middle" for index in range(4000)]
    write_parquet(root / "torn.parquet", "text", texts, row_group_size=1000)
    data = bytearray((root / "torn.parquet").read_bytes())
    quarter = len(data) // 4
    data[quarter : 3 * quarter] = b"\xff" * (2 * quarter)
    (root / "torn.parquet").write_bytes(bytes(data))
    out = tmp_path / "out"
    result = run_ingest(spark, IngestConfig(str(root), str(out), batch_rows=100, shard_bytes=1 << 20))
    assert (result.completed_file_count, result.skipped_file_count) == (1, 1)
    assert in_order(spark, out) == ["kept one", "kept two"]
    note = file_log(spark, str(out)).filter("relative_path = 'torn.parquet'").first()["note"]
    assert "of 4000 rows" in note


def test_stream_ingests_each_file_once(spark, dataset, tmp_path):
    out, checkpoint = tmp_path / "out", str(tmp_path / "checkpoint")
    config = config_of(dataset, out)
    query = start_ingest_stream(spark, config, checkpoint, files_per_batch=1)
    query.awaitTermination(180)
    assert query.exception() is None
    assert in_order(spark, out) == EXPECTED
    write_parquet(dataset / "z.parquet", "text", ["Added later."])
    start_ingest_stream(spark, config, checkpoint, files_per_batch=1).awaitTermination(180)
    assert in_order(spark, out) == [*EXPECTED, "Added later."]
    assert file_log(spark, str(out)).count() == 4


def test_progress_rows_of_a_stream_and_of_a_run_that_fails(spark, dataset, tmp_path):
    out = tmp_path / "out"
    start_ingest_stream(spark, config_of(dataset, out), str(tmp_path / "checkpoint"), files_per_batch=2).awaitTermination(180)
    rows = progress(spark, f"{out}/progress").orderBy("run", "seq").collect()
    by_run = {}
    for row in rows:
        by_run.setdefault(row["run"], []).append(row)
    assert len(by_run) == 2 and all("-stream-" in run for run in by_run)
    for own in by_run.values():
        states = [(row["phase"], row["state"]) for row in own]
        assert states == [("ingest", "started"), *[(name, "running") for name in ("read", "pack", "commit")], ("ingest", "finished")]
    assert sum(own[-1]["scanned"] for own in by_run.values()) == len(EXPECTED)
    assert sum(own[-1]["files"] for own in by_run.values()) == 3

    failing = tmp_path / "failing"
    with pytest.raises(RuntimeError):
        run_ingest(spark, config_of(dataset, failing, stop_on_file_error=True))
    last = progress(spark, f"{failing}/progress").orderBy("seq").collect()[-1]
    assert (last["phase"], last["state"]) == ("ingest", "failed") and "bad.parquet" in last["last_error"]
    assert progress(spark, str(tmp_path / "nothing")).count() == 0


def test_stream_refuses_bounds_that_would_lose_files(spark, dataset, tmp_path):
    for bound in ({"max_batches": 2}, {"max_files": 1}):
        with pytest.raises(ValueError, match="files_per_batch"):
            start_ingest_stream(spark, config_of(dataset, tmp_path / "out", **bound), str(tmp_path / "checkpoint"))


def test_streams_go_on_after_batch_runs_and_other_streams(spark, tmp_path):
    root, out = tmp_path / "data", tmp_path / "out"
    config = IngestConfig(str(root), str(out), batch_rows=50, shard_bytes=500)
    expected = []

    def add(name, count):
        texts = [f"{name} {index:03d}" for index in range(count)]
        write_parquet(root / f"{name}.parquet", "text", texts)
        expected.extend(texts)

    for name, count in (("a", 300), ("b", 107)):
        add(name, count)
        run_ingest(spark, config)
    start_ingest_stream(spark, config, str(tmp_path / "one")).awaitTermination(180)
    assert in_order(spark, out) == expected and len(expected) == 407
    add("c", 100)
    start_ingest_stream(spark, config, str(tmp_path / "one")).awaitTermination(180)
    add("d", 5)
    start_ingest_stream(spark, config, str(tmp_path / "two")).awaitTermination(180)
    assert in_order(spark, out) == expected
    assert run_ingest(spark, config).total_rows_processed == 512


def test_text_export_holds_every_line_under_its_shard(spark, dataset, tmp_path):
    out, target = tmp_path / "out", tmp_path / "text"
    run_ingest(spark, config_of(dataset, out))
    export_text(spark, str(out), str(target))
    lines = spark.read.text(str(target))
    assert Counter(row["value"] for row in lines.collect()) == Counter(EXPECTED)
    names = {path.name for path in target.iterdir() if path.is_dir()}
    assert "shard=shard-000000.txt" in names and len(names) >= 2


def greedy(sizes, limit, shard=0, filled=0):
    """One-at-a-time packing."""
    placed = []
    for size in sizes:
        if filled and filled + size > limit:
            shard, filled = shard + 1, 0
        filled += size
        placed.append(shard)
    return placed


@pytest.mark.parametrize(
    ("segment", "opened", "rows_of_segment", "fan"),
    [(2, 0, 65536, 64), (2, 37, 65536, 2), (3, 0, 10, 2), (7, 12, 65536, 3), (1024, 5, 7, 3), (1024, 0, 1, 4)],
)
def test_shard_assignment_equals_sequential_packing(spark, segment, opened, rows_of_segment, fan):
    import random

    draw = random.Random(segment * 100 + opened)
    sizes = [draw.choice([1, 2, 3, 30, 60, 99, 100, 101, 450, draw.randint(1, 120)]) for _ in range(400)]
    places = sorted((f"f{draw.randint(0, 5)}", index) for index in range(len(sizes)))
    rows = [(path, index, 1, 1, size) for (path, index), size in zip(places, sizes, strict=True)]
    batches = spark.createDataFrame(rows, "relative_path string, batch_no long, rows long, text_rows long, text_bytes long")
    done = sharding.assign_shards(batches, 100, 3, opened, segment, rows_of_segment, fan)
    got = {(row["relative_path"], row["batch_no"]): row["shard_id"] for row in done.collect()}
    expected = greedy(sizes, 100, 3, opened)
    assert [got[place] for place in places] == expected


def test_passages_compose_as_packing_does():
    """Any grouping of stretches into blocks leads every shard that may be open before them to the same state."""
    import random

    draw = random.Random(21)
    for _ in range(300):
        limit = draw.choice([5, 20, 60])
        sizes = [draw.choice([1, 1, 2, 7, limit, 2 * limit]) for _ in range(draw.randrange(3, 40))]
        starts = [100 + sum(sizes[:n]) for n in range(len(sizes))]
        rows = pd.DataFrame({"start_bytes": starts, "text_bytes": sizes})
        cuts = sorted({0, len(sizes), *draw.choices(range(len(sizes)), k=3)})
        parts = [sharding.Passage(sharding.Passage.through(rows[a:b], limit), limit) for a, b in zip(cuts, cuts[1:])]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.then(part)
        late = parts[-1]
        for part in reversed(parts[:-1]):
            late = part.then(late)
        for open_start in range(100 - 2 * limit, 100):
            shard, filled = 0, 100 - open_start
            last = open_start
            for at, size in zip(starts, sizes):
                if filled + size > limit:
                    shard, filled, last = shard + 1, 0, at
                filled += size
            state = (open_start, 0)
            for part in parts:
                state = part.enter(*state)
            assert state == whole.enter(open_start, 0) == late.enter(open_start, 0) == (last, shard)


def test_many_tiny_batches_in_one_byte_segment(spark):
    """Two million batches of a few bytes: bounded segments, and nothing for each of them at the driver."""
    count, limit = 2_000_000, 100_000
    sizes = F.pmod(F.xxhash64("id"), F.lit(3)).cast("long") + 1
    batches = spark.range(count).select(
        F.lit("f").alias("relative_path"), F.col("id").alias("batch_no"), F.lit(1).cast("long").alias("rows"),
        F.lit(1).cast("long").alias("text_rows"), sizes.alias("text_bytes"),
    )
    done = sharding.assign_shards(batches, limit, segment_batches=65536, fan=4)
    found = done.groupBy("shard_id").agg(F.min("batch_no").alias("first"), F.sum("text_bytes").alias("bytes")).collect()
    ordered = [row["text_bytes"] for row in batches.select("batch_no", "text_bytes").orderBy("batch_no").collect()]
    firsts, filled = [0], 0
    for number, size in enumerate(ordered):
        if filled + size > limit:
            firsts.append(number)
            filled = 0
        filled += size
    assert sorted(row["first"] for row in found) == firsts and all(row["bytes"] <= limit for row in found)


def test_configuration_is_checked():
    for bad in ({"batch_rows": 0}, {"shard_bytes": 0}, {"max_files": -1}):
        with pytest.raises(ValueError):
            IngestConfig("in", "out", **bad)


def test_columns_are_pruned_to_the_text(spark, dataset):
    chosen = parquet_text.choose_text_column(parquet_text.probe_footers(files.list_parquet(spark, str(dataset))))
    scan = parquet_text.scan_text(spark, str(dataset), chosen).select(F.col("text"))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "struct<raw_text:string" in plan and "struct<content:string" in plan and "source_id" not in plan
