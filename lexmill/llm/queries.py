"""The queries of the operators, each over its whole table, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import (
    byte_bpe,
    chat_format,
    conversation_repair,
    exact_dedup,
    fingerprints,
    html_extract,
    lm_score,
    ngram_join,
    oracles,
    packing,
    quality,
    simhash,
    spelling,
    toxicity,
)
from lexmill.llm.common import id_remainder, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder("doc_id", 5) == 0
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    measured = docs.select("doc_id", held_out.alias("held_out"), quality.statistics(F.col("text")).alias("of"))
    scored = measured.select("doc_id", "held_out", model.score(F.col("of")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


#: A conversation of the contract whose texts consist of another template's control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.assemble(turns.unionByName(extra)))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_by_simhash(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate_halves(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.fit_and_score(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_chat_format": op2_chat_format,
    "op3_fingerprints": op3_fingerprints,
    "op4_html_extract": op4_html_extract,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_simhash": op7_simhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_spelling_variants": op13_spelling_variants,
}

#: White space of the exact-dedup contract, as DuckDB's regular expression.
_BLANKS = r"[\x20\x09-\x0D]+"

ORACLES = {
    "op8_exact_dedup": rf"""
        with rows as (
            select doc_id, length(coalesce(text, '')) as n,
                   sha256(regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g')) as text_sha256
            from documents
        ), best as (
            select *, first_value(doc_id) over w as keep_id,
                   count(*) over (partition by text_sha256) as group_size
            from rows window w as (partition by text_sha256 order by n desc, doc_id nulls last)
        )
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from best
    """,
    "op11_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op12_ngram_jaccard_join": oracles.NGRAM_JOIN,
    "op13_spelling_variants": oracles.SPELLING,
}
