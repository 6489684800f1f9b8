"""File listings as DataFrames. Only names, sizes and times are read, never content."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.hashing import bag_checksum, row_hash
from lexmill.functions.text import is_supplemental, relative_path

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("relative_path", T.StringType()),
        T.StructField("input_bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)


def list_files(spark: SparkSession, root: str, pattern: str, recursive: bool = True) -> DataFrame:
    """``(path, relative_path, input_bytes, modified)`` of the files below ``root`` that match ``pattern``.

    The pattern is case-sensitive. A missing root is a ``FileNotFoundError``.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    try:
        listing = reader.option("recursiveFileLookup", str(recursive).lower()).load(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(root) from error
        raise
    files = listing.select(
        "path",
        relative_path(F.col("path"), root).alias("relative_path"),
        F.col("length").alias("input_bytes"),
        F.col("modificationTime").alias("modified"),
    )
    return files if recursive else files.filter(~F.col("relative_path").contains("/"))


def list_parquet(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    return list_files(spark, root, "*.parquet", recursive)


def first_files(files: DataFrame, count: int) -> DataFrame:
    """The first ``count`` files in bytewise path order; 0 keeps all of them."""
    return files.orderBy("relative_path").limit(count) if count > 0 else files


def list_corpus_text(spark: SparkSession, root: str) -> DataFrame:
    """Corpus text files with their ``supplemental`` flag; empty when the root does not exist."""
    try:
        files = list_files(spark, root, "*.txt")
    except FileNotFoundError:
        files = spark.createDataFrame([], LISTING_SCHEMA)
    return files.withColumn("supplemental", is_supplemental(F.col("relative_path")))


def discovery_fingerprint(files: DataFrame) -> DataFrame:
    """One row: file count, byte total and fingerprint of a discovered file set.

    The fingerprint is the same for any order of the list, so it is put together from partial sums.
    """
    return files.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("input_bytes"), F.lit(0)).alias("total_bytes"),
        bag_checksum(row_hash(F.col("relative_path"), F.col("input_bytes"))).alias("checksum"),
    )


def dataset_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Audit row over the Parquet files directly under ``root``; all zero when it does not exist."""
    try:
        files = list_parquet(spark, root, recursive=False)
    except FileNotFoundError:
        files = spark.createDataFrame([], LISTING_SCHEMA)
    return discovery_fingerprint(files)


#: What reading a folder that was never written, or holds no file yet, ends in.
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none; every other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return None
        raise
