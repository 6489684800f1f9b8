"""The training mix: reviewed exports routed by split, weighted by rule, joined to the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import TrainingConfig
from lexmill.functions import text as tx
from lexmill.functions.hashing import bag_checksum, row_hash
from lexmill.functions.normalize import normalize

# The paths of the four reviewed exports and the held-out splits. The notes are ours.
EXPORT_NOTES = {
    "exports/base_training/base_training.jsonl": "Outputs only: plain prose, without the prompt that repeats in the inputs.",
    "exports/contextualization/contextualization.jsonl": "Inputs and outputs: claims with their sources and their doubts.",
    "exports/custom_verbalization/custom_verbalization.jsonl": "Inputs and outputs: structured facts put into words.",
    "exports/small_supervised/small_supervised.jsonl": "Outputs only: declined and unanswerable requests.",
}
HELD_OUT_SPLITS = ("Validation", "Test")
INVENTORY_NOTE = "Listed to be accounted for; training reads the corpus text made from these files, not the files."
EXPORT_PATHS = tuple(EXPORT_NOTES)

RULE_SCHEMA = (
    "relative_path string, kind string, include_input boolean, include_output boolean, "
    "input_weight int, output_weight int, note string"
)


def export_rules(spark: SparkSession, config: TrainingConfig) -> DataFrame:
    """One row for each export: which sides enter training and how often."""
    sides = (
        (tx.BASE_TRAINING, False, True, 0, config.base_training_output_weight),
        (tx.CONTEXTUALIZATION, True, True, config.contextualization_input_weight, config.contextualization_output_weight),
        (
            tx.CUSTOM_VERBALIZATION,
            True,
            True,
            config.custom_verbalization_input_weight,
            config.custom_verbalization_output_weight,
        ),
        (tx.SMALL_SUPERVISED, False, True, 0, config.small_supervised_output_weight),
    )
    rows = [(path, *side, note) for (path, note), side in zip(EXPORT_NOTES.items(), sides, strict=True)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def export_texts(records: DataFrame, rules: DataFrame) -> DataFrame:
    """``(relative_path, kind, source_label, split, held_out, weight, text)`` of all used, non-empty sides."""
    # the rule table has one row for each export
    ruled = records.join(F.broadcast(rules), "relative_path")

    def side(name: str, source: str):
        return F.struct(
            F.col(f"include_{name}").alias("included"),
            F.lit(name).alias("side"),
            normalize(F.col(source)).alias("text"),
            F.col(f"{name}_weight").alias("weight"),
        )

    sides = F.array(side("input", "normalized_input"), side("output", "output_text"))
    return (
        ruled.select("relative_path", "kind", "split", "example_id", F.explode(sides).alias("used"))
        .filter("used.included and used.text != ''")
        .select(
            "relative_path",
            "kind",
            tx.example_label(F.col("example_id"), F.col("used.side")).alias("source_label"),
            "split",
            F.coalesce(F.col("split").isin(*HELD_OUT_SPLITS), F.lit(False)).alias("held_out"),
            F.col("used.weight").alias("weight"),
            F.col("used.text").alias("text"),
        )
    )


def training_mix(texts: DataFrame) -> DataFrame:
    return texts.filter("not held_out").drop("held_out", "split")


def held_out_texts(texts: DataFrame) -> DataFrame:
    """Held-out texts are normalised once more when they are set aside."""
    return (
        texts.filter("held_out")
        .select(
            F.lit(tx.HELD_OUT).alias("kind"), "source_label", "split", normalize(F.col("text")).alias("text")
        )
        .filter("text != ''")
    )


def repeat_weighted(mix: DataFrame) -> DataFrame:
    """Each text ``weight`` times. Counting jobs multiply by the weight instead of repeating."""
    copies = F.expr("array_repeat(text, weight)")
    return mix.withColumn("text", F.explode(copies)).drop("weight")


def export_lineage(records: DataFrame, texts: DataFrame, rules: DataFrame) -> DataFrame:
    """Lineage row of each export. Texts of weight 0 still count; held-out texts do not."""
    counted = records.groupBy("relative_path").agg(
        F.count("*").alias("record_count"), bag_checksum(F.col("record_hash")).alias("checksum")
    )
    included = training_mix(texts).groupBy("relative_path").agg(
        F.count("*").alias("text_count"),
        F.sum(tx.byte_length(F.col("text"))).alias("character_count"),
        F.sum(F.col("weight").cast("long")).alias("repeated_count"),
    )
    # all three tables have one row for each export
    joined = rules.join(counted, "relative_path", "left").join(included, "relative_path", "left")
    zero = {"record_count": 0, "text_count": 0, "character_count": 0, "repeated_count": 0}
    return joined.fillna(zero).select(
        "relative_path",
        "kind",
        F.lit(True).alias("included_in_training"),
        "record_count",
        "text_count",
        "character_count",
        "repeated_count",
        F.coalesce("checksum", F.lit("md5x60:0")).alias("checksum"),
        "note",
    )


def corpus_lineage(index: DataFrame, config: TrainingConfig) -> DataFrame:
    """Lineage rows of the corpus files, from their index."""
    return index.select(
        "relative_path",
        "kind",
        F.lit(True).alias("included_in_training"),
        "record_count",
        "text_count",
        "character_count",
        (F.col("text_count") * F.lit(config.parquet_corpus_weight)).cast("long").alias("repeated_count"),
        "checksum",
        "note",
    )


def inventory_lineage(inventory: DataFrame, root: str) -> DataFrame:
    """Lineage row of the raw dataset: file count and bytes, nothing of it in training."""
    zero = F.lit(0).cast("long")
    return inventory.select(
        F.lit(root).alias("relative_path"),
        F.lit(tx.CORPUS_INVENTORY).alias("kind"),
        F.lit(False).alias("included_in_training"),
        F.col("file_count").alias("record_count"),
        zero.alias("text_count"),
        F.col("total_bytes").alias("character_count"),
        zero.alias("repeated_count"),
        "checksum",
        F.lit(INVENTORY_NOTE).alias("note"),
    )


def training_totals(lineage: DataFrame) -> DataFrame:
    """Totals of the training input before sampling, in one row."""
    used = lineage.filter("included_in_training")
    shard = F.col("kind") == tx.PARQUET_CORPUS
    supplemental = F.col("kind") == tx.SUPPLEMENTAL_CORPUS
    repeated = F.col("repeated_count")

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    return used.agg(
        total(F.col("text_count")).alias("training_text_count"),
        total(repeated).alias("repeated_training_example_count"),
        total(F.when(shard, repeated)).alias("shard_text_count"),
        total(F.when(supplemental, repeated)).alias("supplemental_text_count"),
        total(F.when(~shard, repeated)).alias("guaranteed_text_count"),
        total(F.col("character_count")).alias("total_training_characters"),
    )


def mix_lines(mix: DataFrame) -> DataFrame:
    """Training lines of the project mix: ``(relative_path, line_no, kind, weight, text)``.

    A text may hold newlines; each of its lines is a training line of the same weight.
    """
    lines = mix.select(
        "relative_path", "kind", "weight", "source_label", F.posexplode(tx.normalized_lines(F.col("text")))
    )
    return lines.select(
        "relative_path", F.col("pos").cast("long").alias("line_no"), "kind", "weight", F.col("col").alias("text")
    )


def record_hash_of(*names: str):
    return row_hash(*[F.coalesce(F.col(name), F.lit("")) for name in names])
