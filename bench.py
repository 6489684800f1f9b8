"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores, ``BENCH_REPEAT`` the timed
runs of each query, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lexmill.config import TrainingConfig
from lexmill.operators import vocab_training
from lexmill.plans import table_queries as q
from lexmill.session import local_session


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def train(spark, sf_dir: str) -> vocab_training.Training:
    """400 merges over all words of the training lines."""
    words = q.words(spark, sf_dir).persist()
    letters = vocab_training.alphabet(words).count()
    trained = vocab_training.train_merges(
        words, TrainingConfig(vocab_size=vocab_training.FIRST_FREE_ID + letters + 400)
    )
    words.unpersist()
    return trained


def write_shards(spark, sf_dir: str) -> None:
    placed = q.shard_lines(spark, sf_dir)
    target = tempfile.mkdtemp(prefix="lexmill-bench-")
    placed.write.mode("overwrite").partitionBy("shard_name").parquet(f"{target}/corpus")


HEADLINES = {
    "normalize_documents": lambda spark, sf: drain(q.normalize_documents(spark, sf)),
    "index_table": lambda spark, sf: drain(q.index_table(spark, sf)),
    "bounded_sample": lambda spark, sf: drain(q.bounded_sample(spark, sf)),
    "word_frequency": lambda spark, sf: drain(q.word_frequency(spark, sf)),
    "ingest_file_stats": lambda spark, sf: drain(q.ingest_file_stats(spark, sf)),
    "shard_write": write_shards,
    "held_out": lambda spark, sf: drain(q.held_out(spark, sf)),
    "train_400_merges": train,
    "encode_decode_roundtrip": lambda spark, sf: drain(q.encode_decode_roundtrip(spark, sf)),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = local_session("bench", cores=cores, shuffle_partitions=max(8, int(cores)))
    spark.sparkContext.setLogLevel("ERROR")
    drain(q.normalize_conversations(spark, sf_dir))
    q.subword_model(spark, sf_dir)
    timings = {}
    for name, run in HEADLINES.items():
        taken = []
        for _ in range(repeat):
            started = time.perf_counter()
            run(spark, sf_dir)
            taken.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(taken), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": Path(sf_dir).name}
        )
    )


if __name__ == "__main__":
    main()
