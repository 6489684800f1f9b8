"""Text files as lines with stable line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import scanned_path


def scan_lines(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """``(relative_path, block, position, raw)``: one row for each line of the text files under ``root``.

    Lines end at LF only and lose one trailing CR. ``block`` is the split's start in the file and
    ``position`` orders the lines inside it; a file's splits are read by different tasks.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.txt")
    return reader.text(paths if paths is not None else root).select(
        scanned_path(root).alias("relative_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        F.regexp_replace("value", r"\r\z", "").alias("raw"),
    )
