"""Held-out evaluation of a vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.normalize import normalize
from lexmill.functions.text import SPACE_MARKER, byte_length, ratio
from lexmill.operators.subword_model import SubwordModel
from lexmill.operators.vocab_training import words_of


def token_sums(model: SubwordModel, texts: DataFrame) -> DataFrame:
    """Parts ``(texts, octets, tokens, fallback, unknown)`` whose sums are those of the encoded texts.

    Each distinct word is encoded once and weighted by its occurrences. What cuts words and is no blank, a newline or a
    marker character of the data, is left to byte pieces: one for each byte. An empty text has no word and no token.
    """
    normalized = texts.select(byte_length(F.col("text")).alias("octets"), normalize(F.col("text")).alias("text"))
    cuts = [
        F.octet_length("text") - F.octet_length(F.replace("text", F.lit(cut), F.lit(""))) for cut in ("\n", SPACE_MARKER)
    ]
    cut_bytes = (cuts[0] + cuts[1]).cast("long")
    whole = normalized.select(
        F.lit(1).cast("long").alias("texts"), "octets", cut_bytes.alias("tokens"), cut_bytes.alias("fallback"),
        F.lit(0).cast("long").alias("unknown"),
    )
    words = normalized.filter("text <> ''").select(F.explode(words_of(F.col("text"))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("freq"))
    encoded = counted.select("freq", model.encode_words(F.col("word")).alias("ids"))
    weighted = encoded.select(
        F.lit(0).cast("long").alias("texts"),
        F.lit(0).cast("long").alias("octets"),
        (F.col("freq") * F.size("ids")).alias("tokens"),
        (F.col("freq") * model.byte_fallback_count(F.col("ids"))).alias("fallback"),
        (F.col("freq") * model.unknown_count(F.col("ids"))).alias("unknown"),
    )
    return whole.unionByName(weighted)


def evaluate_held_out(model: SubwordModel, held_out: DataFrame) -> DataFrame:
    """One row: texts, bytes, tokens, byte-fallback and unknown tokens, and their averages (0 when empty)."""
    sums = token_sums(model, held_out).agg(
        *[
            F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(name)
            for column, name in (
                ("texts", "held_out_text_count"),
                ("octets", "held_out_character_count"),
                ("tokens", "held_out_token_count"),
                ("fallback", "byte_fallback_token_count"),
                ("unknown", "unknown_token_count"),
            )
        ],
    )
    tokens, texts = F.col("held_out_token_count"), F.col("held_out_text_count")
    per_token = ratio(F.col("held_out_character_count"), tokens)
    return (
        sums.withColumn("average_characters_per_token", per_token)
        .withColumn("average_held_out_characters_per_token", per_token)
        .withColumn("average_held_out_tokens_per_example", ratio(tokens, texts))
    )
