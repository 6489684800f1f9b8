"""Settings of an ingest run, a training run and an artifact set."""

from __future__ import annotations

from dataclasses import dataclass

# Candidate text columns in order of preference, and the name parts tried after them.
CANDIDATE_TEXT_COLUMNS = ("raw_text", "text", "content", "body_text", "normalized_text")
FALLBACK_NAME_PARTS = ("text", "content", "body")

# Ids and pieces of the special tokens.
SPECIAL_TOKENS = (("<unk>", 0), ("<bos>", 1), ("<eos>", 2), ("<pad>", 3))
MODEL_TYPE = "sentencepiece_bpe_v1"


def _at_least(minimum: int, **values: int) -> None:
    for name, value in values.items():
        if value < minimum:
            raise ValueError(f"{name} must be at least {minimum}, got {value}")


@dataclass(frozen=True)
class IngestConfig:
    """``max_files`` and ``max_batches`` of 0 mean no bound on the run."""

    parquet_root: str
    output_root: str
    text_column: str = ""
    candidate_columns: tuple[str, ...] = CANDIDATE_TEXT_COLUMNS
    batch_rows: int = 65536
    shard_bytes: int = 268435456
    recursive: bool = True
    resume: bool = True
    stop_on_file_error: bool = False
    max_files: int = 0
    max_batches: int = 0

    def __post_init__(self) -> None:
        _at_least(1, batch_rows=self.batch_rows, shard_bytes=self.shard_bytes)
        _at_least(0, max_files=self.max_files, max_batches=self.max_batches)


@dataclass(frozen=True)
class TrainingConfig:
    vocab_size: int = 32000
    max_piece_length: int = 24
    max_sentence_length: int = 16384
    sample_cap: int = 5000000
    sample_mode: str = "bernoulli"
    #: Hash of the ``bernoulli`` mode: ``md5``, or ``fnv`` for the byte-wise 64-bit checksum. ``exact`` takes ``md5``.
    sample_hash: str = "md5"
    parquet_corpus_weight: int = 1
    base_training_output_weight: int = 2
    contextualization_input_weight: int = 1
    contextualization_output_weight: int = 2
    custom_verbalization_input_weight: int = 1
    custom_verbalization_output_weight: int = 2
    small_supervised_output_weight: int = 2
    reuse_corpus_index: bool = True
    #: Pairs ranked per merge round. A tuning knob only: pairs beyond it wait for the next round.
    candidates_per_round: int = 200

    def __post_init__(self) -> None:
        if self.vocab_size <= len(SPECIAL_TOKENS):
            raise ValueError("vocab_size must exceed the number of special tokens")
        if self.sample_mode not in ("bernoulli", "exact"):
            raise ValueError(f"unknown sample_mode {self.sample_mode!r}")
        if self.sample_hash not in ("md5", "fnv") or (self.sample_mode, self.sample_hash) == ("exact", "fnv"):
            raise ValueError(f"sample_hash {self.sample_hash!r} does not go with sample_mode {self.sample_mode!r}")
        _at_least(1, max_piece_length=self.max_piece_length, max_sentence_length=self.max_sentence_length)
        _at_least(1, candidates_per_round=self.candidates_per_round)
        _at_least(0, sample_cap=self.sample_cap, parquet_corpus_weight=self.parquet_corpus_weight)


@dataclass(frozen=True)
class WriteOptions:
    output_root: str
    manifests_root: str = ""
    reports_root: str = ""
    write_report: bool = True
    write_samples: bool = True

    @property
    def manifests(self) -> str:
        return self.manifests_root or f"{self.output_root}/manifests"

    @property
    def reports(self) -> str:
        return self.reports_root or f"{self.output_root}/reports"
