"""The corpus pipeline: stages over ``documents``, each one an operator of `lexmill.llm`.

A stage takes the rows its predecessor kept, decides on all of them and returns them with the columns of ``documents``; the last
stage returns the packed pieces. Null texts count as empty, null ids stay unless a text decides otherwise, an empty table
passes through, and columns beyond those of ``documents`` are kept up to the last stage. Rows that repeat an id share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import exact_dedup, packing, quality, simhash, toxicity
from lexmill.llm.common import checkpointed, id_remainder, table, without_ids


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from ``labels`` scores under the threshold."""
    learned = id_remainder("doc_id", 4) != 2
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learned)
    return docs.filter(model.score(F.col("text")) < toxicity.THRESHOLD)


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from ``labels`` score as good."""
    learned = id_remainder("doc_id", 5) != 0
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learned)
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest id."""
    found = exact_dedup.deduplicate_halves(docs)
    return without_ids(docs, found.filter("not kept").select(F.col("doc_id").alias("dropped_id")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose fingerprints of three-word shingles are linked by two bits at most the smallest id."""
    grouped = simhash.group_by_simhash(docs)
    return without_ids(docs, grouped.filter("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; workers still hold what earlier stages loaded."""
    return packing.pack(docs, memos=packing.SMALL_MEMOS)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality_classifier", reject_bad),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_documents),
]

#: The learned stages and the packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; between two of them the rows are written to the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
