"""A training run: corpus index, exports, bounded sample, vocabulary, held-out evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill.config import TrainingConfig
from lexmill.operators import corpus, evaluate, mix, sampling, vocab_training
from lexmill.operators.subword_model import SubwordModel
from lexmill.plans.index import IndexStatus, ensure_corpus_index
from lexmill.plans.progress import RUNNING, ProgressLog
from lexmill.session import cut_lineage
from lexmill.sources.exports import read_exports
from lexmill.sources.files import dataset_inventory
from lexmill.sources.text_lines import scan_lines


@dataclass(frozen=True)
class TrainingInput:
    """Everything a vocabulary is trained on and tested against."""

    lineage: DataFrame
    lines: DataFrame
    held_out: DataFrame
    totals: DataFrame
    budget: DataFrame


@dataclass(frozen=True)
class TrainingResult:
    model: SubwordModel
    manifest: DataFrame
    lineage: DataFrame
    samples: DataFrame
    index: IndexStatus
    run_metrics: dict


def build_input(
    spark: SparkSession,
    source_root: str,
    dataset_root: str,
    corpus_root: str,
    index: DataFrame,
    config: TrainingConfig,
) -> TrainingInput:
    """Corpus lines and weighted export lines, held-out texts, and the lineage of all sources."""
    rules = mix.export_rules(spark, config)
    records = read_exports(spark, source_root, list(mix.EXPORT_PATHS))
    texts = mix.export_texts(records, rules)
    corpus_rows = mix.corpus_lineage(index, config)
    lineage = (
        corpus_rows.unionByName(mix.export_lineage(records, texts, rules))
        .unionByName(mix.inventory_lineage(dataset_inventory(spark, dataset_root), dataset_root))
    )
    # one row for each source
    lineage = cut_lineage(lineage)
    totals = mix.training_totals(lineage)
    file_lines = corpus.numbered_file_lines(scan_lines(spark, corpus_root))
    lines = file_lines.unionByName(mix.mix_lines(mix.training_mix(texts)))
    return TrainingInput(
        lineage,
        lines,
        mix.held_out_texts(texts),
        totals,
        cut_lineage(sampling.sample_budget(totals, config.sample_cap)),
    )


def select_lines(training: TrainingInput, config: TrainingConfig) -> DataFrame:
    if config.sample_mode == "exact":
        return sampling.exact_sample(training.lines, training.budget)
    return sampling.bounded_sample(training.lines, training.budget, config.sample_hash)


def train_vocabulary(
    spark: SparkSession,
    source_root: str,
    dataset_root: str,
    corpus_root: str,
    index_path: str,
    config: TrainingConfig,
    progress_path: str = "",
) -> TrainingResult:
    """Train a vocabulary and describe the run in a one-row manifest.

    Rows about its phases go to ``progress_path`` while it runs, by default beside the index.
    """
    log = ProgressLog(spark, progress_path or f"{index_path}/progress")
    with log.phase("index") as counts:
        index = ensure_corpus_index(spark, corpus_root, index_path, config.reuse_corpus_index)
        counts["files"] = index.file_count
    with log.phase("sources") as counts:
        training = build_input(spark, source_root, dataset_root, corpus_root, index.index, config)
        counts["scanned"] = training.totals.first()["training_text_count"]
    selected = select_lines(training, config)
    scan = Observation("training scan")
    observed = selected.observe(
        scan,
        F.sum(F.col("weight").cast("long")).alias("selected_lines"),
        F.count_if(F.octet_length("text") > config.max_sentence_length).alias("overlong_lines"),
    )
    short = sampling.within_sentence_limit(observed, config.max_sentence_length)
    with log.phase("words") as counts:
        words = cut_lineage(vocab_training.word_frequency(short))
        counts["selected"] = scan.get["selected_lines"] or 0
    with log.phase("merges"):
        trained = vocab_training.train_merges(words, config, lambda done: log.write(f"merges {done}", RUNNING))
    with log.phase("manifest"):
        model = SubwordModel.from_training(spark, trained)
        metrics = scan.get | {"merge_rounds": trained.rounds, "merges": len(trained.merges)}
        manifest = build_manifest(model, training, metrics["selected_lines"] or 0, config)
    return TrainingResult(model, manifest, training.lineage, sample_report(model), index, metrics)


def build_manifest(
    model: SubwordModel, training: TrainingInput, selected_lines: int, config: TrainingConfig
) -> DataFrame:
    """The manifest row; every count in it is measured. The sources are a table of their own, the lineage."""
    evaluation = evaluate.evaluate_held_out(model, training.held_out)
    facts = evaluation.withColumns(
        {
            "model_type": F.lit(model.model_type),
            "normalizer_name": F.lit(model.normalizer_name),
            "requested_vocab_size": F.lit(config.vocab_size),
            "learned_vocab_size": F.lit(model.vocab_size),
            "special_token_count": F.lit(len(model.special_tokens)),
            "training_text_count": F.lit(selected_lines),
            "total_held_out_characters": F.col("held_out_character_count"),
        }
    )
    for name, column in {
        "scanned_training_text_count": "training_text_count",
        "guaranteed_training_text_count": "guaranteed_text_count",
        "repeated_training_example_count": "repeated_training_example_count",
        "total_training_characters": "total_training_characters",
    }.items():
        facts = facts.withColumn(name, training.totals.select(column).scalar())
    rounded = [name for name in facts.columns if name.startswith("average_")]
    for name in rounded:
        facts = facts.withColumn(name, F.round(name, 4))
    special = F.create_map(*[F.lit(x) for item in sorted(model.special_tokens.items()) for x in item])
    return cut_lineage(facts.withColumn("special_tokens", special))


#: The sentences of the sample report, by category.
REPORT_SENTENCES = (
    ("plain prose", "The tide turned at noon, and the boats swung slowly round to face the sea."),
    ("dialogue", "I looked it up twice and found nothing, so I would rather not guess."),
    ("source", "The survey at https://example.org/report/17 (3 May 2019) counts 1,204 households."),
    ("doubt", "Too little was measured to tell, and the answer stays open."),
    ("structured facts", "status=late; delay_minutes=12; reason=\"signal failure\""),
)


def sample_report(model: SubwordModel) -> DataFrame:
    """The report sentences with normalised and decoded text, ids and pieces."""
    sentences = model.spark.createDataFrame(
        [(place, *sentence) for place, sentence in enumerate(REPORT_SENTENCES)],
        "place int, category string, input_text string",
    )
    return model.inspect(sentences, "input_text").drop("vocab_size", "special_tokens").orderBy("place")
