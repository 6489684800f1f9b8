"""Per-file and per-run statistics, and the corpus index rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.hashing import rolling_checksum, rolling_fold, rolling_unit, row_hash
from lexmill.functions.normalize import normalize
from lexmill.functions.text import byte_length, corpus_kind, text_lines
from lexmill.operators.ordering import BLOCK_ROWS, block_of
from lexmill.operators.sharding import text_bytes

SHARD_NOTE = "A shard of normalised text, written by an ingest run."
SUPPLEMENTAL_NOTE = "Extra corpus text that somebody put beside the shards."
# Statuses of the file tables.
COMPLETED, SKIPPED, PENDING, PROCESSED = "completed", "skipped", "pending", "processed"
#: A bounded run stopped inside the file.
PARTIAL = "partial"


def file_stats(texts: DataFrame) -> DataFrame:
    """Rows, text rows and text bytes of each file; ``texts`` is normalised, empty texts included."""
    return texts.groupBy("relative_path").agg(
        F.count("*").alias("rows_processed"),
        F.count_if(F.col("text") != "").alias("text_rows_written"),
        F.sum(text_bytes(F.col("text"))).alias("text_bytes_written"),
    )


def status_records(chosen: DataFrame, stats: DataFrame) -> DataFrame:
    """One status row for each probed file.

    A file is skipped with its footer note, or when the scan gave other rows than the footer promises.
    """
    joined = chosen.join(stats, "relative_path", "left")
    read = F.coalesce("rows_processed", F.lit(0))
    note = F.coalesce(
        "note",
        F.when(
            read != F.col("footer_rows"),
            F.format_string("Read %d of %d rows.", read, F.col("footer_rows")),
        ),
    )
    done = note.isNull()
    return joined.select(
        "relative_path",
        F.when(done, COMPLETED).otherwise(SKIPPED).alias("status"),
        F.when(done, F.col("text_column")).otherwise("").alias("detected_text_column"),
        "input_bytes",
        F.when(done, F.col("row_group_count")).otherwise(0).cast("long").alias("row_group_count"),
        *[
            F.when(done, F.coalesce(name, F.lit(0))).otherwise(0).cast("long").alias(name)
            for name in ("rows_processed", "text_rows_written", "text_bytes_written")
        ],
        F.coalesce(note, F.lit(PROCESSED)).alias("note"),
    )


def latest_records(log: DataFrame) -> DataFrame:
    """The last record of each path, by ``seq``."""
    names = [name for name in log.columns if name != "seq"]
    return log.groupBy("relative_path").agg(
        *[F.max_by(name, "seq").alias(name) for name in names if name != "relative_path"]
    )


def run_totals(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count_if(F.col("status") == COMPLETED).alias("completed_file_count"),
        F.count_if(F.col("status") == SKIPPED).alias("skipped_file_count"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows_processed"),
        F.coalesce(F.sum("text_rows_written"), F.lit(0)).alias("total_text_rows_written"),
        F.coalesce(F.sum("text_bytes_written"), F.lit(0)).alias("total_text_bytes_written"),
    )


def text_columns_used(records: DataFrame) -> DataFrame:
    """Sorted distinct non-empty text columns, in one row."""
    column = F.col("detected_text_column")
    return records.agg(F.array_sort(F.collect_set(F.when(column != "", column))).alias("detected_text_columns"))


def file_statuses(files: DataFrame, records: DataFrame) -> DataFrame:
    """Every discovered file with its record; a file without one is pending."""
    details = records.drop("input_bytes")
    joined = files.select("relative_path", "input_bytes").join(details, "relative_path", "left")
    return joined.withColumn("status", F.coalesce("status", F.lit(PENDING)))


def _line_hash(raw: Column) -> Column:
    return rolling_unit(row_hash(F.md5(F.encode(raw, "UTF-8"))))


def measured_lines(lines: DataFrame) -> DataFrame:
    """What the index needs of raw lines ``(relative_path, block, position, raw)``, a row for each line, in blocks of bounded size."""
    size = byte_length(normalize(F.col("raw")))
    return lines.select(
        "relative_path",
        F.struct("block", F.floor(F.col("position") / BLOCK_ROWS).alias("part")).alias("block"),
        "position",
        F.lit(1).cast("long").alias("records"),
        (size > 0).cast("long").alias("texts"),
        size.cast("long").alias("octets"),
        _line_hash(F.col("raw")).alias("rolled"),
    )


def measured_texts(texts: DataFrame, block_rows: int) -> DataFrame:
    """The same of the lines of ``(relative_path, row_index, text)``, a row for each text: its lines are folded where it is read."""
    lined = texts.select("relative_path", "row_index", text_lines(F.col("text")).alias("lines"))
    sized = lined.filter(F.size("lines") > 0).withColumn(
        "sizes", F.transform("lines", lambda line: byte_length(normalize(line)).cast("long"))
    )
    return sized.select(
        "relative_path",
        F.struct(block_of(F.col("row_index"), block_rows).alias("block")).alias("block"),
        F.col("row_index").alias("position"),
        F.size("lines").cast("long").alias("records"),
        F.size(F.filter("sizes", lambda size: size > 0)).cast("long").alias("texts"),
        F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size).alias("octets"),
        rolling_fold(F.transform("lines", _line_hash)).alias("rolled"),
    )


def corpus_index(measured: DataFrame) -> DataFrame:
    """Index row of each corpus file from `measured_lines` or `measured_texts`.

    The checksum depends on the order of lines, but its parts join in any grouping: they are folded per block, then over the
    blocks of a file. The texts are read once, no line is numbered, and what is shuffled are lengths and checksums.
    """

    def folded(order: str, keys: tuple[str, ...], rows: DataFrame) -> DataFrame:
        sums = [F.sum(name).alias(name) for name in ("records", "texts", "octets")]
        parts = F.sort_array(F.collect_list(F.struct(F.col(order), F.col("rolled")))).alias("parts")
        grouped = rows.groupBy(*keys).agg(*sums, parts)
        rolled = rolling_fold(F.transform("parts", lambda part: part["rolled"])).alias("rolled")
        return grouped.select(*keys, "records", "texts", "octets", rolled)

    blocks = folded("position", ("relative_path", "block"), measured)
    return folded("block", ("relative_path",), blocks).select(
        "relative_path",
        corpus_kind(F.col("relative_path")).alias("kind"),
        F.col("records").alias("record_count"),
        F.col("texts").alias("text_count"),
        F.col("octets").alias("character_count"),
        rolling_checksum(F.col("rolled")).alias("checksum"),
    )


def with_notes(index: DataFrame) -> DataFrame:
    supplemental = F.col("kind") == "supplemental_corpus_text"
    return index.withColumn("note", F.when(supplemental, SUPPLEMENTAL_NOTE).otherwise(SHARD_NOTE))
