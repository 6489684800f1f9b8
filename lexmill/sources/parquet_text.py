"""Parquet files of any schema: pick each file's text column from its footer, then scan that column only."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.config import CANDIDATE_TEXT_COLUMNS, FALLBACK_NAME_PARTS
from lexmill.functions.text import scanned_path

# The two column types accepted as text.
TEXT_TYPES = ("string", "large_string")
NO_TEXT_COLUMN = "No supported text column was detected."

FOOTER_COLUMNS = ["relative_path", "path", "input_bytes", "row_group_count", "footer_rows", "fields", "error"]
FOOTER_SCHEMA = (
    "relative_path string, path string, input_bytes long, row_group_count long, footer_rows long, "
    "fields array<struct<ordinal:int,name:string,type:string>>, error string"
)


def probe_footers(files: DataFrame) -> DataFrame:
    """Read each file's footer on the executors: schema, row groups, rows, or the error that prevented it."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for file in batch.itertuples(index=False):
                row = {"relative_path": file.relative_path, "path": file.path, "input_bytes": file.input_bytes}
                try:
                    uri = file.path
                    if uri.startswith("file:"):
                        filesystem, name = fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
                    else:
                        filesystem, name = fs.FileSystem.from_uri(uri)
                    with filesystem.open_input_file(name) as handle:
                        footer = pq.ParquetFile(handle)
                        row["row_group_count"] = footer.metadata.num_row_groups
                        row["footer_rows"] = footer.metadata.num_rows
                        row["fields"] = [
                            {"ordinal": ordinal, "name": field.name, "type": str(field.type)}
                            for ordinal, field in enumerate(footer.schema_arrow)
                        ]
                        row["error"] = None
                except Exception as problem:  # any unreadable file is data here, not a failure of the job
                    row |= {"row_group_count": 0, "footer_rows": 0, "fields": [], "error": str(problem)}
                rows.append(row)
            yield pd.DataFrame(rows, columns=FOOTER_COLUMNS)

    return files.select("relative_path", "path", "input_bytes").mapInPandas(read, FOOTER_SCHEMA)


def choose_text_column(
    footers: DataFrame,
    text_column: str = "",
    candidates: Iterable[str] = CANDIDATE_TEXT_COLUMNS,
) -> DataFrame:
    """Add ``text_column`` and ``note`` to the footer table.

    An explicit column must exist as a string. Otherwise the best-ranked candidate wins, then the
    first string column whose name holds a fallback part. Matching is case-sensitive, and a
    candidate name that a schema holds twice is ambiguous and does not count.
    """
    spark = footers.sparkSession
    names = [text_column] if text_column else list(candidates)
    ranks = spark.createDataFrame(list(enumerate(names)), "rank int, name string")
    fields = footers.select("relative_path", F.explode("fields").alias("field")).select("relative_path", "field.*")
    # one row for each file and name, so that ambiguity shows before the join
    named = fields.groupBy("relative_path", "name").agg(
        F.count("*").alias("copies"), F.min("ordinal").alias("ordinal"), F.first("type").alias("type")
    )
    unique = named.filter("copies = 1")
    # the rank table holds the few configured names
    ranked = unique.join(F.broadcast(ranks), "name").select("relative_path", "rank", "ordinal", "name", "type")
    choices = ranked
    if not text_column:
        contains = F.lit(False)
        for part in FALLBACK_NAME_PARTS:
            contains = contains | F.col("name").contains(part)
        fallback = fields.filter(contains).select(
            "relative_path", F.lit(len(names)).alias("rank"), "ordinal", "name", "type"
        )
        choices = ranked.unionByName(fallback)
    is_text = F.col("type").isin(*TEXT_TYPES)
    order = F.struct("rank", "ordinal")
    best = choices.groupBy("relative_path").agg(
        F.min_by(F.when(is_text, F.col("name")), F.when(is_text, order)).alias("text_column"),
        F.min_by("type", order).alias("first_type"),
    )
    if text_column:
        missing = F.when(
            F.col("first_type").isNull(), F.lit(f"Configured text column was not found: {text_column}")
        ).otherwise(
            F.concat(
                F.lit(f"Configured text column is not a supported string column: {text_column} type="),
                F.col("first_type"),
            )
        )
    else:
        missing = F.lit(NO_TEXT_COLUMN)
    return (
        footers.join(best, "relative_path", "left")
        .withColumn("note", F.coalesce(F.col("error"), F.when(F.col("text_column").isNull(), missing)))
        .drop("first_type", "fields", "error")
    )


def scan_text(spark: SparkSession, root: str, chosen: DataFrame, skip_corrupt: bool = True) -> DataFrame:
    """``(relative_path, row_index, text)`` of every file that has a text column.

    Files are read together per chosen column, with a one-field schema, so the scan reads that
    column and no other. The list of paths is the only thing the driver holds.
    """
    usable = chosen.filter("note is null").select("text_column", "path").collect()
    groups: dict[str, list[str]] = {}
    for file in usable:
        groups.setdefault(file["text_column"], []).append(file["path"])
    scans = []
    for column in sorted(groups):
        schema = T.StructType([T.StructField(column, T.StringType())])
        reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_corrupt).lower())
        scan = reader.parquet(*sorted(groups[column])).select(
            scanned_path(root).alias("relative_path"),
            F.col("_metadata.row_index").alias("row_index"),
            F.col(f"`{column}`").alias("text"),
        )
        scans.append(scan)
    if not scans:
        return spark.createDataFrame([], "relative_path string, row_index long, text string")
    result = scans[0]
    for scan in scans[1:]:
        result = result.unionByName(scan)
    return result
