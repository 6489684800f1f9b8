"""The corpus index: reuse it while the listing is unchanged, else rescan only what changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.hashing import ROLLING_PREFIX
from lexmill.functions.text import corpus_kind, parse_corpus_kind
from lexmill.operators.stats import corpus_index, measured_lines, with_notes
from lexmill.session import cut_lineage
from lexmill.sources.files import list_corpus_text
from lexmill.sources.snapshots import Snapshots
from lexmill.sources.text_lines import scan_lines

# Reasons why an index cannot be reused.
NO_INDEX = "No existing corpus index was found."
ROOT_CHANGED = "Corpus root does not match the existing index."
LIST_CHANGED = "Corpus file list changed since the index was written."
FILE_CHANGED = "Corpus file size or timestamp changed since the index was written."
COUNT_CHANGED = "Corpus file count changed since the index was written."
ROWS_INVALID = "Corpus index rows are malformed."

INDEX_COLUMNS = (
    "relative_path",
    "kind",
    "record_count",
    "text_count",
    "character_count",
    "checksum",
    "file_size",
    "modified",
    "note",
)


def compare_listing(index: DataFrame, files: DataFrame) -> DataFrame:
    """``(relative_path, change)`` of every path of the index or the listing.

    Both need ``relative_path, file_size, modified``. A change is ``unchanged``, ``changed``, ``added``
    or ``removed``.
    """
    old = index.select("relative_path", F.struct("file_size", "modified").alias("old"))
    new = files.select("relative_path", F.struct("file_size", "modified").alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old") == F.col("new"), "unchanged")
        .otherwise("changed")
    )
    return old.join(new, "relative_path", "full_outer").select("relative_path", change.alias("change"))


def index_verdict(changes: DataFrame) -> DataFrame:
    """One row: whether the index may be reused, and the reason of the first path that forbids it."""
    reason = (
        F.when(F.col("change") == "removed", LIST_CHANGED)
        .when(F.col("change") == "changed", FILE_CHANGED)
        .when(F.col("change") == "added", COUNT_CHANGED)
    )
    order = F.struct((F.col("change") == "added").alias("late"), F.col("relative_path"))
    return changes.agg(
        F.bool_and(F.col("change") == "unchanged").alias("reusable"),
        F.min_by(reason, F.when(reason.isNotNull(), order)).alias("reason"),
    )


def merge_index(index: DataFrame, changes: DataFrame, rescanned: DataFrame) -> DataFrame:
    """Index rows of unchanged files, and fresh rows of the others."""
    kept = index.join(changes.filter("change = 'unchanged'"), "relative_path", "left_semi")
    return kept.unionByName(rescanned)


@dataclass(frozen=True)
class IndexStatus:
    index: DataFrame
    reused_existing: bool
    file_count: int
    rescanned_count: int
    reason: str


def ensure_corpus_index(spark: SparkSession, corpus_root: str, index_path: str, reuse: bool = True) -> IndexStatus:
    """Load the index if it still describes the corpus files, else refresh and write it as the next version under ``index_path``.

    A changed or new file is rescanned; rows of unchanged files are kept, with the result of a full scan.
    """
    files = cut_lineage(
        list_corpus_text(spark, corpus_root).select(
            "path", "relative_path", F.col("input_bytes").alias("file_size"), "modified"
        )
    )
    file_count = files.count()
    if file_count == 0:
        raise FileNotFoundError(f"no corpus text files under {corpus_root}")
    stored, reason = _load(spark, corpus_root, index_path) if reuse else (None, "")
    if stored is None:
        stale = files
    else:
        changes = cut_lineage(compare_listing(stored, files))
        verdict = index_verdict(changes).first()
        if verdict["reusable"]:
            return IndexStatus(stored.select(*INDEX_COLUMNS), True, file_count, 0, "")
        reason = verdict["reason"]
        stale = files.join(changes.filter("change != 'unchanged'"), "relative_path", "left_semi")
    paths = [row["path"] for row in stale.select("path").collect()]
    fresh = _scan(spark, corpus_root, stale, paths)
    index = fresh if stored is None else merge_index(stored.select(*INDEX_COLUMNS), changes, fresh)
    index = cut_lineage(index)
    Snapshots(spark, index_path).write(index.withColumn("corpus_root", F.lit(corpus_root)).coalesce(1))
    return IndexStatus(index, False, file_count, len(paths), reason)


def _load(spark: SparkSession, corpus_root: str, index_path: str) -> tuple[DataFrame | None, str]:
    stored = Snapshots(spark, index_path).read()
    if stored is None:
        return None, NO_INDEX
    if not {*INDEX_COLUMNS, "corpus_root"} <= set(stored.columns):
        return None, ROWS_INVALID
    stored = cut_lineage(stored)
    check = stored.agg(
        F.coalesce(F.bool_and(F.col("corpus_root") == corpus_root), F.lit(True)).alias("root"),
        F.coalesce(F.bool_and(parse_corpus_kind(F.col("kind")).isNotNull()), F.lit(True)).alias("kinds"),
    ).first()
    if not check["root"]:
        return None, ROOT_CHANGED
    if not check["kinds"]:
        return None, ROWS_INVALID
    return stored, ""


def _scan(spark: SparkSession, corpus_root: str, files: DataFrame, paths: list[str]) -> DataFrame:
    if not paths:
        no_lines = spark.createDataFrame([], "relative_path string, block long, position long, raw string")
        empty = with_notes(corpus_index(measured_lines(no_lines)))
        return empty.withColumn("file_size", F.lit(0)).withColumn("modified", F.current_timestamp()).select(*INDEX_COLUMNS)
    scanned = corpus_index(measured_lines(scan_lines(spark, corpus_root, paths)))
    # a file without a line gives no row of its own
    joined = files.select("relative_path", "file_size", "modified").join(scanned, "relative_path", "left")
    return with_notes(_fill_empty(joined)).select(*INDEX_COLUMNS)


def _fill_empty(index: DataFrame) -> DataFrame:
    filled = index.fillna({"record_count": 0, "text_count": 0, "character_count": 0, "checksum": f"{ROLLING_PREFIX}0"})
    return filled.withColumn("kind", corpus_kind(F.col("relative_path")))
