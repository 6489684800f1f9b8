"""Corpus texts as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.normalize import normalize
from lexmill.functions.text import corpus_kind, normalized_lines, text_lines
from lexmill.operators.ordering import block_of, explode_numbered, running_total

#: Texts of one numbering block.
BLOCK_TEXTS = 4096


def raw_lines(texts: DataFrame) -> DataFrame:
    """``(relative_path, block, position, raw)`` of the lines of ``(relative_path, row_index, text)``."""
    return texts.select(
        "relative_path",
        block_of(F.col("row_index"), BLOCK_TEXTS).alias("block"),
        "row_index",
        F.posexplode(text_lines(F.col("text"))),
    ).select("relative_path", "block", F.struct("row_index", "pos").alias("position"), F.col("col").alias("raw"))


def numbered_texts(texts: DataFrame) -> DataFrame:
    """Training lines ``(relative_path, line_no, kind, weight, text)`` of a table of texts.

    ``line_no`` counts the non-empty normalised lines through a file, so a blank line moves nothing.
    """
    lined = texts.select(
        "relative_path",
        "row_index",
        block_of(F.col("row_index"), BLOCK_TEXTS).alias("block"),
        normalized_lines(F.col("text")).alias("lines"),
    )
    return _as_training_lines(explode_numbered(lined, "lines").withColumnRenamed("line", "text"))


def unnumbered_texts(texts: DataFrame) -> DataFrame:
    """``(weight, text)`` of the same lines, for counts that need no order: one scan and no shuffle."""
    return texts.select(F.lit(1).alias("weight"), F.explode(normalized_lines(F.col("text"))).alias("text"))


def numbered_file_lines(lines: DataFrame) -> DataFrame:
    """As :func:`numbered_texts`, for the lines of text files ``(relative_path, block, position, raw)``."""
    kept = lines.withColumn("text", normalize(F.col("raw"))).filter("text != ''").drop("raw")
    numbered = running_total(kept, F.lit(1), "_earlier", "position")
    return _as_training_lines(numbered.withColumn("line_no", F.col("_earlier") + F.lit(1)))


def _as_training_lines(lines: DataFrame) -> DataFrame:
    """Corpus lines are emitted once, whatever the corpus weight: it moves the sampling budget only."""
    return lines.select(
        "relative_path",
        F.col("line_no").cast("long").alias("line_no"),
        corpus_kind(F.col("relative_path")).alias("kind"),
        F.lit(1).alias("weight"),
        "text",
    )
