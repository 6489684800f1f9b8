"""Reviewed exports: JSON Lines with four string fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.hashing import row_hash
from lexmill.functions.text import scanned_path

EXPORT_SCHEMA = "split string, normalized_input string, output_text string, example_id string, _corrupt string"


def read_exports(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """``(relative_path, record_hash, split, normalized_input, output_text, example_id)``; missing fields are empty.

    A line that is no JSON object counts as a record with empty fields. An export may be a file or a folder of part files; either way
    ``relative_path`` is the one of ``paths``.
    """
    records = (
        spark.read.schema(EXPORT_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json([f"{root.rstrip('/')}/{path}" for path in paths])
    )
    names = ("split", "normalized_input", "output_text", "example_id")
    fields = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in names]
    scanned = scanned_path(root)
    of_export = [F.when(scanned.startswith(f"{path}/"), F.lit(path)) for path in paths]
    return records.select(
        F.coalesce(*of_export, scanned).alias("relative_path"),
        row_hash(*[F.coalesce(F.col(name), F.lit("")) for name in (*names, "_corrupt")]).alias("record_hash"),
        *fields,
    )
