"""Parquet ingest: discover, pick columns, normalise, pack into shards, record, report; resumable.

A run reads its files once. It writes the normalised texts to ``corpus/run=N``, takes batch sizes and row counts from
what was written, packs the batches into shards (``batches/run=N``), logs every file (``ingest_files/run=N``) and commits
by writing ``run_metrics/run=N``. A run that dies before that is overwritten by the next one, so no text is lost or
doubled. The unit of resuming is the batch: a run bounded by ``max_batches`` may stop inside a file, and the next
one goes on there. A file that fails, also in a later run, is left out whole. One writer at a time works on an output.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.config import IngestConfig
from lexmill.functions.normalize import normalize
from lexmill.functions.text import shard_name, utc_text
from lexmill.operators import sharding, stats
from lexmill.plans.progress import RUNNING, ProgressLog
from lexmill.session import broadcast_if_small, cut_lineage, spread_scan
from lexmill.sources import files as listing
from lexmill.sources import parquet_text

RUN_SCHEMA = (
    "first_run int, status string, resumed_run_count int, batches long, last_shard long, open_bytes long, "
    "discovery_checksum string, finished_utc string, last_error string, stream_id string, stream_batch long"
)
CORPUS_SCHEMA = "relative_path string, row_index long, batch_no long, text string, run int"
# Fixed value: refusal to resume over a changed file set.
MISMATCH = "Resume checkpoint does not match the current Parquet discovery set."


@dataclass(frozen=True)
class IngestResult:
    resumed: bool
    completed: bool
    interrupted: bool
    discovered_file_count: int
    completed_file_count: int
    skipped_file_count: int
    total_rows_processed: int
    total_text_rows_written: int
    total_text_bytes_written: int
    shard_count: int
    output_root: str


def run_history(spark: SparkSession, output_root: str) -> DataFrame | None:
    """Committed runs since the last fresh start, one row each."""
    runs = listing.stored_table(spark, f"{output_root}/run_metrics")
    if runs is None:
        return None
    return runs.filter(F.col("run") >= runs.agg(F.max_by("first_run", "run")).scalar())


def file_log(spark: SparkSession, output_root: str) -> DataFrame | None:
    """Last status record of each file over the committed runs."""
    log, runs = listing.stored_table(spark, f"{output_root}/ingest_files"), run_history(spark, output_root)
    if log is None or runs is None:
        return None
    # one row for each run
    committed = log.join(F.broadcast(runs.select("run")), "run", "left_semi")
    return stats.latest_records(committed.withColumnRenamed("run", "seq"))


def shard_batches(spark: SparkSession, output_root: str) -> DataFrame:
    """``(run, relative_path, batch_no, shard_id, ...)`` of the committed batches whose file has not failed since."""
    log, runs = file_log(spark, output_root), run_history(spark, output_root)
    if log is None or runs is None:
        raise FileNotFoundError(f"no committed ingest run under {output_root}")
    packed = spark.read.parquet(f"{output_root}/batches").join(F.broadcast(runs.select("run")), "run", "left_semi")
    failed = log.filter(F.col("status") == stats.SKIPPED).select("relative_path")
    return packed.join(broadcast_if_small(failed, 256), "relative_path", "left_anti")


def load_corpus(spark: SparkSession, output_root: str) -> DataFrame:
    """The committed corpus: ``(relative_path, row_index, text, run, shard_id)``.

    The shard comes from the batch table, which is broadcast while it is small.
    """
    shards = shard_batches(spark, output_root).select("run", "relative_path", "batch_no", "shard_id")
    texts = spark.read.schema(CORPUS_SCHEMA).parquet(f"{output_root}/corpus").filter("text <> ''")
    placed = texts.join(broadcast_if_small(shards, 256), ["run", "relative_path", "batch_no"])
    return placed.select("relative_path", "row_index", "text", "run", "shard_id")


def within_batches(chosen: DataFrame, batch_rows: int, max_batches: int) -> DataFrame:
    """Add ``end_batch`` to files with a ``start_batch``: the first ``max_batches`` batches of all in (path, batch) order.

    A bound of 0 takes everything. Files that the bound does not reach are left out; unreadable ones count no batch.
    Works on the file list.
    """
    total = F.when(F.col("note").isNull(), F.ceil(F.col("footer_rows") / F.lit(batch_rows))).otherwise(0).cast("long")
    counted = chosen.withColumn("file_batches", total)
    if max_batches == 0:
        return counted.withColumn("end_batch", F.col("file_batches"))
    before = W.orderBy("relative_path").rowsBetween(W.unboundedPreceding, -1)
    waiting = F.col("file_batches") - F.col("start_batch")
    room = F.lit(max_batches) - F.coalesce(F.sum(waiting).over(before), F.lit(0))
    bounded = counted.withColumn("_room", room).filter("_room > 0")
    return bounded.withColumn("end_batch", F.col("start_batch") + F.least("_room", waiting)).drop("_room")


def ingest_files(
    spark: SparkSession,
    config: IngestConfig,
    files: DataFrame,
    run: int,
    first_run: int,
    fingerprint: str = "",
    stream: tuple[str, int] = ("", -1),
) -> bool:
    """`_ingest_files` with rows about its phases in ``progress`` of the output, also if it fails."""
    label = f"run-{run}" if stream[1] < 0 else f"run-{run}-stream-{stream[0]}-{stream[1]}"
    log = ProgressLog(spark, f"{config.output_root}/progress", f"{label}-{uuid.uuid4().hex[:8]}")
    with log.phase("ingest"):
        return _ingest_files(spark, config, files, run, first_run, fingerprint, stream, log)


def _ingest_files(
    spark: SparkSession,
    config: IngestConfig,
    files: DataFrame,
    run: int,
    first_run: int,
    fingerprint: str,
    stream: tuple[str, int],
    log: ProgressLog,
) -> bool:
    """Ingest the listed files as run ``run`` and commit it; true when all of their batches were taken.

    ``files`` may carry ``start_batch``, where an earlier run stopped in a file.
    """
    out, history = config.output_root, file_log(spark, config.output_root) if run > first_run else None
    if "start_batch" not in files.columns:
        files = files.withColumn("start_batch", F.lit(0).cast("long"))
    probed = parquet_text.choose_text_column(
        parquet_text.probe_footers(files.drop("start_batch")), config.text_column, config.candidate_columns
    )
    chosen = cut_lineage(probed.join(files.select("relative_path", "start_batch"), "relative_path"))
    taken = cut_lineage(within_batches(chosen, config.batch_rows, config.max_batches))
    log.write("read", RUNNING, files=taken.count())
    if config.stop_on_file_error:
        bad = taken.filter("note is not null").orderBy("relative_path").first()
        if bad is not None:
            raise RuntimeError(f"{bad['relative_path']}: {bad['note']}")
    scan = parquet_text.scan_text(spark, config.parquet_root, taken, skip_corrupt=not config.stop_on_file_error)
    if config.max_batches or history is not None:
        # a list of files, which the driver has held already
        spans = F.broadcast(taken.select("relative_path", "start_batch", "end_batch"))
        batch = sharding.block_of(F.col("row_index"), config.batch_rows)
        inside = (batch >= F.col("start_batch")) & (batch < F.col("end_batch"))
        scan = scan.join(spans, "relative_path").filter(inside).drop("start_batch", "end_batch")
    texts = spread_scan(scan, "row_index").withColumn("text", normalize(F.col("text")))
    numbered = texts.withColumn("batch_no", sharding.block_of(F.col("row_index"), config.batch_rows))
    here = f"{out}/corpus/run={run}"
    numbered.select("relative_path", "row_index", "batch_no", "text").write.mode("overwrite").parquet(here)

    # everything from here on is about the rows that were written
    written = spark.read.schema(CORPUS_SCHEMA).parquet(here)
    batches = cut_lineage(sharding.batch_sizes(written, config.batch_rows))
    counted = batches.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("text_rows"), F.lit(0))).first()
    log.write("pack", RUNNING, scanned=counted[0], selected=counted[1])
    records = cut_lineage(_file_records(taken, batches, history, config.batch_rows))
    good = records.filter(F.col("status") != stats.SKIPPED).select("relative_path")
    first_shard, open_bytes = _open_shard(spark, out, run, first_run)
    kept = batches.join(good, "relative_path", "left_semi")
    assigned = cut_lineage(sharding.assign_shards(kept, config.shard_bytes, first_shard, open_bytes))
    assigned.write.mode("overwrite").parquet(f"{out}/batches/run={run}")
    records.coalesce(1).write.mode("overwrite").parquet(f"{out}/ingest_files/run={run}")

    log.write("commit", RUNNING)
    unfinished = records.filter(F.col("status") == stats.PARTIAL).limit(1).count()
    all_taken = not unfinished and taken.count() == chosen.count()
    _commit(
        spark, config, run, first_run, all_taken, batches, assigned, (first_shard, open_bytes), records, fingerprint, stream
    )
    return all_taken


def _file_records(taken: DataFrame, batches: DataFrame, history: DataFrame | None, batch_rows: int) -> DataFrame:
    """A status row for each file; counts add to those of the runs that took earlier batches of it.

    A file must give the rows between its first and its last batch of this run; else it is skipped whole.
    """
    read = batches.groupBy("relative_path").agg(
        F.sum("rows").alias("rows_processed"),
        F.sum("text_rows").alias("text_rows_written"),
        F.sum("text_bytes").alias("text_bytes_written"),
    )
    rows_due = F.least("footer_rows", F.col("end_batch") * batch_rows) - F.col("start_batch") * batch_rows
    records = stats.status_records(taken.withColumn("footer_rows", rows_due), read)
    ends = taken.select("relative_path", "end_batch", "file_batches")
    records = records.join(ends, "relative_path").withColumn("next_batch", F.col("end_batch"))
    unfinished = (F.col("status") == stats.COMPLETED) & (F.col("end_batch") < F.col("file_batches"))
    records = records.withColumn("status", F.when(unfinished, stats.PARTIAL).otherwise(F.col("status")))
    records = records.drop("end_batch", "file_batches")
    if history is None:
        return records
    counts = ("rows_processed", "text_rows_written", "text_bytes_written")
    earlier = history.filter(F.col("status") == stats.PARTIAL)
    earlier = earlier.select("relative_path", *[F.col(name).alias(f"_{name}") for name in counts])
    joined = records.join(earlier, "relative_path", "left")
    kept = F.col("status") != stats.SKIPPED
    for name in counts:
        joined = joined.withColumn(name, F.when(kept, F.col(name) + F.coalesce(f"_{name}", F.lit(0))).otherwise(0))
    return joined.select(*records.columns)


def _open_shard(spark: SparkSession, output_root: str, run: int, first_run: int) -> tuple[int, int]:
    """The shard the last committed run before this one left open, and the bytes in it."""
    runs = run_history(spark, output_root) if run > first_run else None
    if runs is None:
        return 0, 0
    last = runs.filter(F.col("run") < run).orderBy(F.desc("run")).first()
    return (last["last_shard"], last["open_bytes"]) if last else (0, 0)


def _commit(
    spark, config, run, first_run, all_taken, batches, assigned, opened, records, fingerprint, stream
) -> None:
    last = assigned.groupBy("shard_id").agg(F.sum("text_bytes").alias("filled")).orderBy(F.desc("shard_id")).first()
    last_shard, filled = (last["shard_id"], last["filled"]) if last else opened
    if last and last_shard == opened[0]:
        filled += opened[1]
    error = records.filter("status = 'skipped'").agg(F.max_by("note", "relative_path")).first()[0]
    row = (
        first_run,
        "completed" if all_taken else "interrupted",
        run - first_run,
        batches.count(),
        last_shard,
        filled,
        fingerprint,
        "",
        error or "",
        *stream,
    )
    metrics = spark.createDataFrame([row], RUN_SCHEMA).withColumn("finished_utc", utc_text())
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{config.output_root}/run_metrics/run={run}")


def waiting_files(found: DataFrame, done: DataFrame | None) -> DataFrame:
    """The files of ``found`` that are not done yet, with the batch to go on at; changed files are refused."""
    if done is None:
        return found.withColumn("start_batch", F.lit(0).cast("long"))
    known = done.select("relative_path", F.col("input_bytes").alias("_bytes"), "status", "next_batch")
    joined = cut_lineage(found.join(known, "relative_path", "left"))
    if joined.filter("_bytes <> input_bytes").limit(1).count():
        raise ValueError(MISMATCH)
    left = joined.filter(F.col("status").isNull() | (F.col("status") == stats.PARTIAL))
    return left.withColumn("start_batch", F.coalesce("next_batch", F.lit(0))).drop("_bytes", "status", "next_batch")


def next_run(spark: SparkSession, output_root: str) -> tuple[int, int | None]:
    """The number of the next run, and the first run since the last fresh start if there is one."""
    history = run_history(spark, output_root)
    if history is None:
        return 0, None
    last = history.agg(F.max("run").alias("run"), F.max("first_run").alias("first_run")).first()
    return last["run"] + 1, last["first_run"]


def run_ingest(spark: SparkSession, config: IngestConfig) -> IngestResult:
    """One ingest run over the files and batches not done yet, then manifest and report."""
    found = cut_lineage(listing.list_parquet(spark, config.parquet_root, config.recursive))
    fingerprint = listing.discovery_fingerprint(found).first()["checksum"]
    done = file_log(spark, config.output_root)
    resumed = config.resume and done is not None
    run, started = next_run(spark, config.output_root)
    # a fresh start leaves the earlier runs behind; they stay visible until it commits
    first_run = started if resumed else run
    if resumed and done.join(found, "relative_path", "left_anti").limit(1).count():
        raise ValueError(MISMATCH)
    waiting = waiting_files(found, done if resumed else None)
    selected = listing.first_files(waiting, config.max_files)
    ingested = ingest_files(spark, config, selected, run, first_run, fingerprint)
    left_over = config.max_files > 0 and waiting.limit(config.max_files + 1).count() > config.max_files
    return report(spark, config, found, resumed, ingested and not left_over)


def report(
    spark: SparkSession, config: IngestConfig, found: DataFrame, resumed: bool, completed: bool
) -> IngestResult:
    """Write manifest and report over all committed runs."""
    out = config.output_root
    records = cut_lineage(file_log(spark, out))
    totals = stats.run_totals(records)
    columns = stats.text_columns_used(records).select(F.array_join("detected_text_columns", ",")).scalar()
    last_run = run_history(spark, out).agg(F.max_by(F.struct("*"), "run").alias("last")).select("last.*")
    discovered = found.count()
    shards = cut_lineage(
        shard_batches(spark, out)
        .groupBy("shard_id")
        .agg(F.sum("text_rows").alias("text_rows"))
        .withColumn("shard_name", shard_name(F.col("shard_id")))
    )
    summary = cut_lineage(
        totals.select(
            F.lit(config.parquet_root).alias("parquet_root"),
            F.lit(out).alias("output_root"),
            F.lit("completed" if completed else "interrupted").alias("status"),
            F.lit(config.resume).alias("resume_enabled"),
            F.lit(discovered).alias("discovered_file_count"),
            "*",
            last_run.select("discovery_checksum").scalar().alias("discovery_checksum"),
            last_run.select("finished_utc").scalar().alias("last_successful_flush_utc"),
            last_run.select("resumed_run_count").scalar().alias("resumed_run_count"),
            F.lit(shards.count()).alias("output_shard_count"),
            columns.alias("detected_text_columns"),
        )
    )
    listed = stats.file_statuses(found, records)
    summary.coalesce(1).write.mode("overwrite").json(f"{out}/manifest/summary")
    listed.orderBy("relative_path").write.mode("overwrite").json(f"{out}/manifest/files")
    shards.orderBy("shard_id").write.mode("overwrite").json(f"{out}/manifest/shards")
    report_lines(summary, shards, records).write.mode("overwrite").text(f"{out}/report")
    row = summary.first()
    return IngestResult(
        resumed=resumed,
        completed=completed,
        interrupted=not completed,
        discovered_file_count=discovered,
        completed_file_count=row["completed_file_count"],
        skipped_file_count=row["skipped_file_count"],
        total_rows_processed=row["total_rows_processed"],
        total_text_rows_written=row["total_text_rows_written"],
        total_text_bytes_written=row["total_text_bytes_written"],
        shard_count=row["output_shard_count"],
        output_root=out,
    )


def report_lines(summary: DataFrame, shards: DataFrame, records: DataFrame) -> DataFrame:
    """The report as an ordered one-column DataFrame: run facts, shards, skipped files with reasons."""
    facts = F.array(
        *[
            F.concat(F.lit(f"- {name.replace('_', ' ')}: `"), F.col(name).cast("string"), F.lit("`"))
            for name in summary.columns
        ]
    )
    head = summary.select(F.lit(1).alias("part"), F.posexplode(facts).alias("place", "value"))
    head = head.select("part", F.format_string("%03d", "place").alias("place"), "value")
    shard_part = shards.select(
        F.lit(3).alias("part"), F.col("shard_name").alias("place"), F.concat(F.lit("- `"), "shard_name", F.lit("`"))
    )
    skipped = records.filter("status = 'skipped'").select(
        F.lit(5).alias("part"),
        F.col("relative_path").alias("place"),
        F.concat(F.lit("- `"), "relative_path", F.lit("` reason=`"), "note", F.lit("`")),
    )
    titles = summary.sparkSession.createDataFrame(
        [(0, "", "# Ingest run"), (2, "", "## Shards"), (4, "", "## Skipped files")],
        "part int, place string, value string",
    )
    return titles.union(head).union(shard_part).union(skipped).orderBy("part", "place").select("value")


def export_text(spark: SparkSession, output_root: str, target: str) -> None:
    """Write the corpus as text, one folder for each shard, lines in (path, row) order.

    The rows are ranged over shard and position, so a large shard is several files, in order.
    """
    corpus = load_corpus(spark, output_root)
    ordered = corpus.repartitionByRange("shard_id", "relative_path", "row_index").sortWithinPartitions(
        "shard_id", "relative_path", "row_index"
    )
    named = ordered.select(shard_name(F.col("shard_id")).alias("shard"), F.col("text").alias("value"))
    named.write.mode("overwrite").partitionBy("shard").option("lineSep", "\n").text(target)
