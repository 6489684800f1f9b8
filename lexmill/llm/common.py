"""What the operators share: how a table becomes texts, and how drops come back to whole rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lexmill.session import broadcast_if_small, ensure_checkpoint_dir

#: The white space of the text contracts: blank, TAB, LF, VT, FF, CR.
WHITESPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a Python worker turns into objects at once; an Arrow batch may hold thousands of long texts.
SLICE_ROWS = 128


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def keyed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` and no other column, so columns of a caller cannot clash; a null text is empty."""
    return df.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder; Spark's cleaner removes it once nothing refers to it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(modulus))


def without_ids(docs: DataFrame, drops: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in ``drops(dropped_id)``; a row without an id stays."""
    drops = broadcast_if_small(drops.dropna(), 16)
    return docs.join(drops, docs[id_col] == drops["dropped_id"], "left_anti")


def map_slices(df: DataFrame, work: Callable[..., list], schema: pa.Schema) -> DataFrame:
    """``work`` over a few rows at a time: it takes a list for each column of ``df`` and returns one for each field of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                columns = work(*(column.to_pylist() for column in batch.slice(start, SLICE_ROWS).columns))
                arrays = [pa.array(column, field.type) for column, field in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, from_arrow_schema(schema))
