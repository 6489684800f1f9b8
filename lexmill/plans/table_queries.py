"""The registered queries: every operator run over the given tables.

Roles of the tables: the Parquet files themselves are ingest input; ``documents`` (a file for each
``source``) is the shard corpus, ``benchmark`` a supplemental corpus file, ``conversations`` the
reviewed exports (a user turn and the assistant turn after it), ``pages`` awkward raw text.
"""

from __future__ import annotations

import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import IngestConfig, TrainingConfig, WriteOptions
from lexmill.functions import hashing, text as tx
from lexmill.functions.normalize import normalize, null_to_empty
from lexmill.operators import corpus, evaluate, mix, ordering, sampling, sharding, stats, vocab_training
from lexmill.operators.subword_model import SubwordModel
from lexmill.plans import index as corpus_index
from lexmill.plans import ingest
from lexmill.plans.artifacts import write_artifacts
from lexmill.plans.training import train_vocabulary
from lexmill.session import cut_lineage, ensure_checkpoint_dir, spread_scan
from lexmill.sources import exports, files, parquet_text, text_lines
from lexmill.sources.snapshots import Snapshots
from lexmill.streaming.ingest_stream import forget_last_commit, start_ingest_stream

#: Rows of a batch and bytes of a shard in the queries; the second makes segments of eight shards.
BATCH_ROWS = 64
SHARD_BYTES = 65536
SEGMENT_SHARDS = 8
#: The sampling cap of the queries, in lines for each document.
CAP_LINES_PER_DOCUMENT = 5
#: Vocabulary of the queries that encode.
VOCAB_SIZE = 512
#: New pieces of the merge query.
MERGE_PIECES = 48
#: Documents of a file and rows of a row group in the query that counts row groups.
FILE_IDS, GROUP_ROWS = 1000, 64
#: New pieces of the training run whose artifacts are read back.
RUN_PIECES = 8

CONFIG = TrainingConfig(vocab_size=VOCAB_SIZE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table whose texts are worked on, over all cores; the first column is its key."""
    return spread_scan(table(spark, sf_dir, name).select(*columns), columns[0])


# Tables in their roles


def corpus_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(relative_path, row_index, text)``, normalised as ingest leaves it."""
    documents = texts_of(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        F.concat("source", F.lit(".txt")).alias("relative_path"), F.col("doc_id").alias("row_index"), "text"
    )
    supplemental = table(spark, sf_dir, "benchmark").select(
        F.lit("supplemental-benchmark.txt").alias("relative_path"), F.col("item_id").alias("row_index"), "text"
    )
    return documents.unionByName(supplemental).withColumn("text", normalize(F.col("text")))


def export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn that follows it, as a record of one of the four exports."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("normalized_input"))
    answered = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output_text")
    )
    digest = F.md5(F.encode(F.col("conv_id").cast("string"), "UTF-8"))
    draw = F.conv(F.substring(digest, 1, 2), 16, 10).cast("int")
    part = F.conv(F.substring(digest, 3, 2), 16, 10).cast("int")
    paths = F.array(*[F.lit(path) for path in mix.EXPORT_PATHS])
    return (
        asked.join(answered, ["conv_id", "turn"], "left")
        .select(
            F.element_at(paths, F.pmod(draw, F.lit(4)) + 1).alias("relative_path"),
            F.when(part < 26, "Test").when(part < 52, "Validation").otherwise("Train").alias("split"),
            null_to_empty(F.col("normalized_input")).alias("normalized_input"),
            null_to_empty(F.col("output_text")).alias("output_text"),
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("example_id"),
        )
        .withColumn(
            "record_hash", mix.record_hash_of("split", "normalized_input", "output_text", "example_id")
        )
    )


def export_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.export_texts(export_records(spark, sf_dir), mix.export_rules(spark, CONFIG))


def index_of_texts(texts: DataFrame) -> DataFrame:
    return stats.corpus_index(stats.measured_texts(texts, corpus.BLOCK_TEXTS))


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_notes(index_of_texts(corpus_texts(spark, sf_dir)))


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, rules = export_records(spark, sf_dir), mix.export_rules(spark, CONFIG)
    exports = mix.export_lineage(records, mix.export_texts(records, rules), rules)
    return mix.corpus_lineage(index_rows(spark, sf_dir), CONFIG).unionByName(exports)


def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = corpus.numbered_texts(corpus_texts(spark, sf_dir))
    return lines.unionByName(mix.mix_lines(mix.training_mix(export_texts(spark, sf_dir))))


def budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap = CAP_LINES_PER_DOCUMENT * table(spark, sf_dir, "documents").count()
    # one row, worked out once for the queries that read it in several places
    return cut_lineage(sampling.sample_budget(mix.training_totals(lineage(spark, sf_dir)), cap))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts do not need to know where a line stands, so nothing is numbered for them."""
    lines = corpus.unnumbered_texts(corpus_texts(spark, sf_dir))
    lines = lines.unionByName(mix.mix_lines(mix.training_mix(export_texts(spark, sf_dir))).select(*lines.columns))
    lines = sampling.within_sentence_limit(lines, CONFIG.max_sentence_length)
    return vocab_training.word_frequency(lines)


@cache
def _trained(spark: SparkSession, sf_dir: str, config: TrainingConfig) -> vocab_training.Training:
    """Training is a pure function of the read-only tables, so one session trains once for each scale."""
    return vocab_training.train_merges(words(spark, sf_dir), config)


def subword_model(spark: SparkSession, sf_dir: str) -> SubwordModel:
    return SubwordModel.from_training(spark, _trained(spark, sf_dir, CONFIG))


def chosen_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_text.choose_text_column(parquet_text.probe_footers(files.list_parquet(spark, sf_dir)))


def ingest_texts(spark: SparkSession, sf_dir: str, chosen: DataFrame | None = None) -> DataFrame:
    """Normalised texts of every Parquet file that has a text column."""
    chosen = chosen_columns(spark, sf_dir) if chosen is None else chosen
    scan = spread_scan(parquet_text.scan_text(spark, sf_dir, chosen), "row_index")
    return scan.withColumn("text", normalize(F.col("text")))


def ingest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = cut_lineage(chosen_columns(spark, sf_dir))
    return stats.status_records(chosen, stats.file_stats(ingest_texts(spark, sf_dir, chosen)))


def packed(texts: DataFrame) -> DataFrame:
    sizes = sharding.batch_sizes(texts, BATCH_ROWS)
    return sharding.assign_shards(sizes, SHARD_BYTES, segment_shards=SEGMENT_SHARDS)


# Scalar functions


def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized = texts_of(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", normalize(F.col("text")).alias("normalized"))
    return normalized.filter("normalized != ''")


def normalize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts_of(spark, sf_dir, "pages", "page_id", "html").select("page_id", normalize(F.col("html")).alias("normalized"))


def normalize_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", "role", normalize(F.col("text")).alias("normalized"))


def fnv_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", hashing.fnv_checksum(F.col("url")).alias("checksum"))


def unit_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = corpus.numbered_texts(corpus_texts(spark, sf_dir))
    return lines.select(
        "relative_path", "line_no", hashing.unit_interval(sampling.line_key()).alias("unit_hash")
    )


def hex_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = texts_of(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tx.encode_hex(F.col("text")).alias("text_hex"))
    return encoded.withColumn("text", tx.decode_hex(F.col("text_hex")))


def visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts_of(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tx.visible(F.col("text")).alias("visible"))
    pages = table(spark, sf_dir, "pages").select(
        (-F.col("page_id") - 1).alias("doc_id"), tx.visible(F.col("html")).alias("visible")
    )
    return documents.unionByName(pages)


def byte_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        tx.byte_length(F.col("text")).alias("raw_bytes"),
        tx.byte_length(normalize(F.col("text"))).alias("normalized_bytes"),
        tx.ratio(tx.byte_length(normalize(F.col("text"))), tx.byte_length(F.col("text"))).alias("kept_ratio"),
    )


# Lines and index


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = corpus.raw_lines(corpus_texts(spark, sf_dir))
    return lines.select(
        "relative_path", F.col("position.row_index").alias("row_index"), F.col("position.pos").cast("long").alias("pos"), "raw"
    )


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.numbered_texts(corpus_texts(spark, sf_dir)).select("relative_path", "line_no", "kind", "text")


def index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_rows(spark, sf_dir).drop("note")


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An older and a newer state of the corpus files ``(relative_path, row_index, text, n_chars)``.

    A hash of the source says what happened to its file in between: 0 removed, 1 added, 2 and 3 grown by the labelled
    documents, else unchanged.
    """
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_index"), F.lit(True).alias("labelled"))
    texts = texts_of(spark, sf_dir, "documents", "doc_id", "source", "text", "n_chars").select(
        F.concat("source", F.lit(".txt")).alias("relative_path"),
        F.col("doc_id").alias("row_index"),
        normalize(F.col("text")).alias("text"),
        "n_chars",
        (F.conv(F.substring(F.md5(F.encode("source", "UTF-8")), 1, 2), 16, 10).cast("int") % 6).alias("fate"),
    )
    marked = texts.join(labels, "row_index", "left")
    grown = F.col("fate").isin(2, 3) & F.col("labelled").isNotNull()
    states = marked.filter((F.col("fate") != 1) & ~grown), marked.filter("fate <> 0")
    return tuple(state.select("relative_path", "row_index", "text", "n_chars") for state in states)


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def listing(rows: DataFrame) -> DataFrame:
        return rows.groupBy("relative_path").agg(
            F.sum("n_chars").alias("file_size"), F.max("row_index").alias("modified")
        )

    older, newer = _states(spark, sf_dir)
    return listing(older), listing(newer)


def index_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_index.compare_listing(*_listings(spark, sf_dir))


def index_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_index.index_verdict(index_changes(spark, sf_dir))


def index_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of unchanged files from the older index, rows of changed and added files scanned again."""
    changes = cut_lineage(index_changes(spark, sf_dir))
    older, newer = _states(spark, sf_dir)
    # one row for each file
    stale = newer.join(F.broadcast(changes.filter("change in ('changed', 'added')")), "relative_path", "left_semi")
    return corpus_index.merge_index(
        index_of_texts(older), changes, index_of_texts(stale)
    )


def index_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index of the documents as text files, after a further file came and the index was brought up to date from its last version.

    By source, with the number of versions that were written; the second look finds nothing to do.
    """
    folder = _fresh_folder(spark)
    root, stored = f"{folder}/corpus", f"{folder}/index"
    documents = table(spark, sf_dir, "documents").select("source", F.coalesce("text", F.lit("")).alias("value"))
    documents.write.partitionBy("source").text(root, lineSep="\n")
    first = corpus_index.ensure_corpus_index(spark, root, stored)
    added = table(spark, sf_dir, "benchmark").select(F.coalesce("text", F.lit("")).alias("value"))
    added.write.text(f"{root}/source=supplement", lineSep="\n")
    second = corpus_index.ensure_corpus_index(spark, root, stored)
    third = corpus_index.ensure_corpus_index(spark, root, stored)
    kept = first.index.join(third.index, first.index.columns, "left_anti").isEmpty()
    source = F.regexp_extract("relative_path", "^source=([^/]+)/", 1)
    return third.index.groupBy(source.alias("source")).agg(
        F.sum("record_count").alias("lines"),
        F.sum("text_count").alias("texts"),
        F.lit(second.reason).alias("reason"),
        F.lit(kept and third.reused_existing and not second.reused_existing).alias("kept_and_reused"),
        F.lit(Snapshots(spark, stored).current + 1).cast("long").alias("versions"),
    )


# Ingest


def text_column_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_columns(spark, sf_dir).select("relative_path", "text_column", "note")


def parquet_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ordering.file_positions(files.list_parquet(spark, sf_dir))
    return listed.select("relative_path", "file_no", "remaining_files")


def discovery_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.discovery_fingerprint(files.list_parquet(spark, sf_dir))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count of the inventory; its bytes and its checksum of sizes are left to the tests."""
    return files.dataset_inventory(spark, sf_dir).select("file_count")


def _fresh_folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/queries-{uuid.uuid4().hex}"


def text_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as text files, a folder for each source, and read back line by line."""
    folder = _fresh_folder(spark)
    documents = table(spark, sf_dir, "documents").select("source", F.coalesce("text", F.lit("")).alias("value"))
    documents.write.partitionBy("source").text(folder, lineSep="\n")
    lines = text_lines.scan_lines(spark, folder)
    source = F.regexp_extract("relative_path", "^source=([^/]+)/", 1)
    return lines.groupBy(source.alias("source")).agg(
        F.count("*").alias("lines"),
        F.count_if(normalize(F.col("raw")) != "").alias("texts"),
        F.sum(F.octet_length("raw").cast("long")).alias("octets"),
    )


def _write_exports(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The export records as JSON Lines under their paths."""
    records = cut_lineage(export_records(spark, sf_dir))
    for path in mix.EXPORT_PATHS:
        own = records.filter(F.col("relative_path") == path).drop("relative_path", "record_hash")
        own.write.json(f"{folder}/{path}")


def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export records written as JSON Lines under their paths and read back."""
    folder = _fresh_folder(spark)
    _write_exports(spark, sf_dir, folder)
    return exports.read_exports(spark, folder, list(mix.EXPORT_PATHS)).drop("record_hash")


def ingest_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_records(spark, sf_dir).drop("input_bytes", "row_group_count")


def ingest_row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses, row groups included, of the documents as Parquet files: one for each stretch of ids, in row groups of a set number of rows."""
    folder = _fresh_folder(spark)
    stretch = F.floor(F.coalesce("doc_id", F.lit(0)) / F.lit(FILE_IDS)).cast("long")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", stretch.alias("stretch"))
    limited = documents.repartition("stretch").write.option("parquet.block.row.count.limit", GROUP_ROWS)
    limited.partitionBy("stretch").parquet(folder)
    stretch_of = F.regexp_extract("relative_path", "^stretch=(-?[0-9]+)/", 1).cast("long").alias("stretch")
    return ingest_records(spark, folder).select(
        stretch_of, "status", "detected_text_column", "row_group_count", "rows_processed", "text_rows_written", "text_bytes_written"
    )


#: Text tables as they arrive in the queries that run an ingest: first the one group, later the other.
ARRIVALS = (("documents", "benchmark"), ("pages", "conversations"))
DAMAGED = "damaged.parquet"


def _arrive(spark: SparkSession, sf_dir: str, root: str, names: tuple[str, ...]) -> None:
    """Copy tables below ``root``, each as a folder of files."""
    for name in names:
        spread_scan(table(spark, sf_dir, name)).write.parquet(f"{root}/{name}.parquet")


def _damage(spark: SparkSession, root: str) -> None:
    """Put a file there that is named like the others and is no Parquet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{DAMAGED}")
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, False)
    stream.writeBytes("neither footer nor rows")
    stream.close()


def _ingested(spark: SparkSession, out: str) -> DataFrame:
    """Status and counts of an output by source table, from its committed log, with the rows and bytes of its corpus table."""
    source = F.substring_index("relative_path", "/", 1)
    columns = F.array_sort(F.collect_set(F.when(F.col("detected_text_column") != "", F.col("detected_text_column"))))
    counts = [F.sum(name).alias(name) for name in ("rows_processed", "text_rows_written", "text_bytes_written")]
    logged = ingest.file_log(spark, out).groupBy(source.alias("relative_path")).agg(
        F.array_join(F.array_sort(F.collect_set("status")), ",").alias("status"),
        F.array_join(columns, ",").alias("detected_text_column"),
        *counts,
    )
    held = ingest.load_corpus(spark, out).groupBy(source.alias("relative_path")).agg(
        F.count("*").alias("corpus_rows"), F.sum(sharding.text_bytes(F.col("text"))).alias("corpus_bytes")
    )
    return logged.join(held, "relative_path", "left").fillna(0, ["corpus_rows", "corpus_bytes"])


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text tables through the file stream: some files, a stop, then the others and a damaged one.

    The stream starts again from its checkpoint, whose last offset is taken back, so that a micro-batch that was committed comes again.
    """
    folder = _fresh_folder(spark)
    config = IngestConfig(f"{folder}/in", f"{folder}/out", batch_rows=BATCH_ROWS, shard_bytes=SHARD_BYTES)
    checkpoint = f"{folder}/checkpoint"
    _arrive(spark, sf_dir, config.parquet_root, ARRIVALS[0])
    start_ingest_stream(spark, config, checkpoint).awaitTermination()
    forget_last_commit(spark, checkpoint)
    _arrive(spark, sf_dir, config.parquet_root, ARRIVALS[1])
    _damage(spark, config.parquet_root)
    start_ingest_stream(spark, config, checkpoint).awaitTermination()
    return _ingested(spark, config.output_root)


def ingest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text tables and a damaged file through runs that each stop after a third of the batches, until all is done."""
    folder = _fresh_folder(spark)
    root, out = f"{folder}/in", f"{folder}/out"
    for names in ARRIVALS:
        _arrive(spark, sf_dir, root, names)
    _damage(spark, root)
    waiting = parquet_text.choose_text_column(parquet_text.probe_footers(files.list_parquet(spark, root)))
    waiting = waiting.withColumn("start_batch", F.lit(0).cast("long"))
    batches = ingest.within_batches(waiting, BATCH_ROWS, 0).agg(F.sum("end_batch")).first()[0]
    config = IngestConfig(root, out, batch_rows=BATCH_ROWS, shard_bytes=SHARD_BYTES, max_batches=batches // 3 + 1)
    while not ingest.run_ingest(spark, config).completed:
        pass
    return _ingested(spark, out)


def ingest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_totals(ingest_records(spark, sf_dir))


def ingest_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = stats.text_columns_used(ingest_records(spark, sf_dir))
    return used.select(F.array_join("detected_text_columns", ",").alias("detected_text_columns"))


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File statuses of a run that stopped before its skipped files were recorded."""
    done = ingest_records(spark, sf_dir).filter("status = 'completed'")
    statuses = stats.file_statuses(files.list_parquet(spark, sf_dir), done)
    return statuses.drop("input_bytes", "row_group_count")


def status_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running statuses of each corpus file, one for each document, then the last one of each."""
    log = table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit(".txt")).alias("relative_path"),
        F.when(F.octet_length("text") > 2000, "completed").otherwise("skipped").alias("status"),
        F.col("n_chars").alias("input_bytes"),
        F.col("doc_id").alias("seq"),
    )
    return stats.latest_records(log)


def batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.batch_sizes(ingest_texts(spark, sf_dir), BATCH_ROWS)


def bounded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run bounded to half of all batches takes of each file: from its first batch to the end or the bound."""
    chosen = chosen_columns(spark, sf_dir).withColumn("start_batch", F.lit(0).cast("long"))
    total = ingest.within_batches(chosen, BATCH_ROWS, 0).agg(F.sum("end_batch")).first()[0]
    taken = ingest.within_batches(chosen, BATCH_ROWS, max(1, total // 2))
    return taken.filter("note is null").select("relative_path", "file_batches", "end_batch")


def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(ingest_texts(spark, sf_dir)).drop("start_bytes")


def shard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_totals(packed(ingest_texts(spark, sf_dir)))


def shard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with the name of its shard, as the sink writes it."""
    texts = ingest_texts(spark, sf_dir)
    placed = sharding.place_texts(texts, packed(texts), BATCH_ROWS)
    return placed.select("relative_path", "row_index", tx.shard_name(F.col("shard_id")).alias("shard_name"), "text")


# Training mix and sampling


def training_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.training_mix(export_texts(spark, sf_dir))


def held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.held_out_texts(export_texts(spark, sf_dir))


def weighted_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.repeat_weighted(training_mix(spark, sf_dir)).select("relative_path", "source_label", "text")


def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage(spark, sf_dir).drop("note")


def training_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.training_totals(lineage(spark, sf_dir))


def sample_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget(spark, sf_dir)


def bounded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bounded_sample(training_lines(spark, sf_dir), budget(spark, sf_dir))


def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = training_lines(spark, sf_dir)
    return sampling.exact_sample(lines, budget(spark, sf_dir))


def fnv_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bounded_sample(training_lines(spark, sf_dir), budget(spark, sf_dir), "fnv")


def sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = training_lines(spark, sf_dir)
    return sampling.sample_counts(lines, sampling.bounded_sample(lines, budget(spark, sf_dir)))


def overlong_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.overlong_lines(training_lines(spark, sf_dir), CONFIG.max_sentence_length)


# Vocabulary


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir)


def alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab_training.alphabet(words(spark, sf_dir))


def context_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab_training.context_counts(vocab_training.split_symbols(words(spark, sf_dir)))


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab_training.pair_counts(context_counts(spark, sf_dir))


def bpe_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first merges, over all words: a vocabulary with room for a fixed number of merged pieces."""
    return vocab_training.merge_table(spark, _merged(spark, sf_dir))


@cache
def _merged(spark: SparkSession, sf_dir: str) -> vocab_training.Training:
    counted = cut_lineage(words(spark, sf_dir))  # read for the size and for the training
    size = vocab_training.FIRST_FREE_ID + vocab_training.alphabet(counted).count() + MERGE_PIECES
    return vocab_training.train_merges(counted, TrainingConfig(vocab_size=size))


@cache
def merge_model(spark: SparkSession, sf_dir: str) -> SubwordModel:
    """The vocabulary of :func:`bpe_merges`, small enough for SQL to train it as well."""
    return SubwordModel.from_training(spark, _merged(spark, sf_dir))


def vocab_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_model(spark, sf_dir).vocab_rows()


def training_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a whole training run wrote, read back: configuration, manifest, sources, vocabulary file and report.

    The exports are JSON Lines under their paths and the corpus has a folder of text files for each source of the documents; all lines are selected.
    """
    folder = _fresh_folder(spark)
    _write_exports(spark, sf_dir, folder)
    shards = corpus_texts(spark, sf_dir).filter(~tx.is_supplemental(F.col("relative_path")))
    shards.select(F.col("relative_path").alias("source"), F.col("text").alias("value")).write.partitionBy("source").text(f"{folder}/corpus")
    letters = vocab_training.alphabet(words(spark, sf_dir)).count()
    config = TrainingConfig(vocab_size=vocab_training.FIRST_FREE_ID + letters + RUN_PIECES, sample_cap=2**62)
    corpus_root, index_path, options = f"{folder}/corpus", f"{folder}/index", WriteOptions(f"{folder}/out")
    result = train_vocabulary(spark, folder, f"{folder}/dataset", corpus_root, index_path, config)
    write_artifacts(result, config, options, corpus_root, index_path)
    settings = spark.read.json(f"{options.manifests}/config").select("vocab_size", F.size("special_tokens").alias("special_token_names"))
    counts = [
        "learned_vocab_size", "special_token_count", "training_text_count", "scanned_training_text_count", "guaranteed_training_text_count",
        "repeated_training_example_count", "total_training_characters", "held_out_text_count", "held_out_character_count",
    ]
    manifest = spark.read.json(f"{options.manifests}/manifest").select(*counts)
    sources = spark.read.json(f"{options.manifests}/sources").filter("included_in_training")
    kinds = sources.agg(F.count_if(F.col("kind") == tx.PARQUET_CORPUS).alias("has_corpus"), F.sum("text_count").alias("source_texts"))
    model = SubwordModel.load_text(spark, options.manifests)
    pieces = model.vocab.agg(F.count("*").alias("vocabulary_rows"), F.max("id").alias("last_id"))
    report = spark.read.text(f"{options.reports}/training").agg(F.count_if(F.col("value").startswith("# ")).alias("report_titles"))
    row = settings
    for part in (manifest, kinds.select(F.col("has_corpus") > 0, "source_texts").toDF("has_corpus", "source_texts"), pieces, report):
        row = row.join(part)  # each is one row
    return row


def encode_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = subword_model(spark, sf_dir)
    encoded = texts_of(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", model.encode(F.col("text")).alias("ids"))
    return encoded.select("doc_id", model.decode(F.col("ids")).alias("decoded"))


def pages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = subword_model(spark, sf_dir)
    encoded = texts_of(spark, sf_dir, "pages", "page_id", "html").select("page_id", model.encode(F.col("html")).alias("ids"))
    return encoded.select("page_id", model.decode(F.col("ids")).alias("decoded"))


def token_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document summed over its tokens, looked up in the vocabulary: a join, no decode."""
    model = subword_model(spark, sf_dir)
    piece = F.col("piece")
    plain = F.replace(piece, F.lit(tx.SPACE_MARKER), F.lit(" "))
    octets = F.when(piece.rlike("^<0x[0-9A-F]{2}>$"), 1).otherwise(F.octet_length(plain))
    widths = model.vocab.filter("not special").select("id", octets.alias("octets"))
    encoded = texts_of(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", model.encode(F.col("text")).alias("ids"))
    tokens = encoded.select("doc_id", F.explode_outer("ids").alias("id"))
    # the width table has one row for each vocabulary entry
    summed = tokens.join(F.broadcast(widths), "id", "left").groupBy("doc_id")
    # the blank before the first word is no part of the text; an empty text has no token
    return summed.agg(F.coalesce(F.sum("octets") - 1, F.lit(0)).alias("text_bytes"))


def _joined(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), " ")


def describe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = merge_model(spark, sf_dir)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", model.encode(F.col("text")).alias("ids"))
    pieces = F.array_join(model.describe(F.col("ids")), "|").alias("pieces")
    return turns.select("conv_id", "turn", _joined("ids").alias("ids"), pieces)


def describe_tokens_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of :func:`describe_tokens` by the model that its written files give back."""
    folder = _fresh_folder(spark)
    merge_model(spark, sf_dir).save_text(folder)
    model = SubwordModel.load_text(spark, folder)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", model.encode(F.col("text")).alias("ids"))
    pieces = F.array_join(model.describe(F.col("ids")), "|").alias("pieces")
    return turns.select("conv_id", "turn", _joined("ids").alias("ids"), pieces)


def piece_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the whole corpus by piece: each distinct word is encoded once."""
    model = merge_model(spark, sf_dir)
    encoded = words(spark, sf_dir).select("freq", F.explode(model.encode_words(F.col("word"))).alias("id"))
    counts = encoded.groupBy("id").agg(F.sum("freq").alias("count"))
    # both sides have at most one row for each vocabulary entry
    return counts.join(F.broadcast(model.vocab), "id").select("id", "label", "piece", "count")


def inspect_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    inspected = merge_model(spark, sf_dir).inspect(table(spark, sf_dir, "benchmark"), "text").drop("special_tokens")
    return inspected.withColumns({"token_ids": _joined("token_ids"), "token_pieces": F.array_join("token_pieces", "|")})


def held_out_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluate_held_out(merge_model(spark, sf_dir), held_out(spark, sf_dir))


def held_out_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the evaluation that does not depend on the vocabulary, and that nothing is unknown."""
    return held_out_eval(spark, sf_dir).select("held_out_text_count", "held_out_character_count", "unknown_token_count")


QUERIES = {
    function.__name__: function
    for function in (
        normalize_documents,
        normalize_pages,
        normalize_conversations,
        fnv_checksum,
        unit_hash,
        hex_texts,
        visible_text,
        byte_lengths,
        corpus_lines,
        line_numbers,
        index_table,
        index_changes,
        index_validity,
        index_incremental,
        index_store,
        text_column_choice,
        parquet_listing,
        discovery_fingerprint,
        raw_inventory,
        text_file_lines,
        jsonl_records,
        ingest_file_stats,
        ingest_row_groups,
        ingest_stream,
        ingest_resume,
        ingest_totals,
        ingest_text_columns,
        ingest_manifest,
        status_dedup,
        batch_sizes,
        bounded_run,
        shard_assignment,
        shard_totals,
        shard_lines,
        training_mix,
        held_out,
        weighted_repeat,
        source_lineage,
        training_totals,
        sample_budget,
        bounded_sample,
        exact_sample,
        fnv_sample,
        sample_counts,
        overlong_lines,
        word_frequency,
        alphabet,
        context_counts,
        pair_counts,
        bpe_merges,
        vocab_table,
        training_artifacts,
        encode_decode_roundtrip,
        pages_roundtrip,
        token_bytes,
        describe_tokens,
        describe_tokens_loaded,
        piece_frequency,
        inspect_benchmark,
        held_out_eval,
        held_out_sizes,
    )
}
