"""Running numbers over ordered data without sorting a whole file in one task.

A file is cut into blocks. Inside a block a window gives the running sum; the sum over earlier
blocks comes from a table with one row for each block. A file that holds a third of all rows is then
many window partitions, not one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 65536


def block_of(row_index: Column, block_rows: int = BLOCK_ROWS) -> Column:
    return F.floor(row_index / F.lit(block_rows)).cast("long")


def running_total(
    df: DataFrame, value: Column, name: str, order: str, key: str = "relative_path", block: str = "block"
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``key`` before this one.

    ``df`` needs a ``block`` column that grows with ``order`` inside a key.
    """
    valued = df.withColumn("_value", value)
    inside = W.partitionBy(key, block).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    numbered = valued.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    # one row for each block; it is joined on the window's own partitioning, so the text moves once
    earlier = W.partitionBy(key).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    totals = (
        valued.groupBy(key, block)
        .agg(F.sum("_value").alias("_total"))
        .select(key, block, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        numbered.join(totals, [key, block])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
        .drop("_value", "_inside", "_before")
    )


def explode_numbered(df: DataFrame, lines: str, order: str = "row_index", block: str = "block") -> DataFrame:
    """Explode the array column ``lines`` into ``(line_no, line)``, counting from 1 through each file."""
    counted = running_total(df, F.size(lines), "_first", order, block=block)
    return (
        counted.select("*", F.posexplode(lines).alias("_pos", "line"))
        .withColumn("line_no", F.col("_first") + F.col("_pos") + F.lit(1))
        .drop("_first", "_pos", lines)
    )


def file_positions(files: DataFrame) -> DataFrame:
    """``file_no`` of ``file_count`` and the number of files after each, over the file list."""
    everything = W.orderBy("relative_path")
    return files.withColumn("file_no", F.row_number().over(everything)).withColumn(
        "remaining_files", F.count("*").over(W.partitionBy()) - F.col("file_no")
    )
