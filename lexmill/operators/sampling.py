"""Bounded, deterministic sampling of corpus lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.hashing import fnv_unit_interval, unit_bits, unit_interval
from lexmill.functions.text import PARQUET_CORPUS, sampling_key
from lexmill.session import cut_lineage

#: Bits of the 52-bit hash resolved by one histogram of the exact mode.
HISTOGRAM_BITS = 13


def sample_budget(totals: DataFrame, cap: int) -> DataFrame:
    """Budget and rate of the shard lines, in one row, from :func:`lexmill.operators.mix.training_totals`."""
    room = F.greatest(F.lit(cap).cast("long") - F.col("guaranteed_text_count"), F.lit(0).cast("long"))
    budget = F.least(F.col("shard_text_count"), room)
    return totals.select(
        "shard_text_count",
        "guaranteed_text_count",
        budget.alias("budget"),
        F.when(F.col("shard_text_count") == 0, 0.0)
        .otherwise(budget.cast("double") / F.col("shard_text_count").cast("double"))
        .alias("rate"),
    )


def line_key() -> Column:
    return sampling_key(F.col("relative_path"), F.col("line_no"), F.col("text"))


def bounded_sample(lines: DataFrame, budget: DataFrame, hash_kind: str = "md5") -> DataFrame:
    """Keep every guaranteed line, and shard lines whose key hashes below the rate.

    ``lines`` is ``(relative_path, line_no, kind, weight, text)``. Each kept line comes once. The cap holds in
    expectation; :func:`exact_sample` meets it exactly. The rate is read as one value, 2 where the budget takes all lines.
    """
    position = fnv_unit_interval(line_key()) if hash_kind == "fnv" else unit_interval(line_key())
    within = F.col("shard_text_count") <= F.col("budget")
    rate = budget.select(F.when(within, 2.0).otherwise(F.col("rate"))).scalar()
    return lines.filter((F.col("kind") != PARQUET_CORPUS) | (position < rate))


def hash_threshold(bits: DataFrame, budget: int) -> tuple[int, int]:
    """``(threshold, ties)``: all hashes below the threshold are kept, and ``ties`` of those equal to it.

    ``bits`` has one 52-bit long column ``bits``. Four rounds narrow the range by histograms of
    8,192 buckets; no row is sorted or moved.
    """
    low, kept = 0, 0
    for shift in range(52 - HISTOGRAM_BITS, -1, -HISTOGRAM_BITS):
        width = 1 << (shift + HISTOGRAM_BITS)
        inside = bits.filter(F.col("bits").between(low, low + width - 1))
        bucket = F.shiftright(F.col("bits") - F.lit(low).cast("long"), shift)
        histogram = inside.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).orderBy("bucket").collect()
        for row in histogram:
            if kept + row["n"] > budget:
                low += row["bucket"] << shift
                break
            kept += row["n"]
        else:
            return 1 << 52, 0
    return low, budget - kept


def exact_sample(lines: DataFrame, budget: DataFrame) -> DataFrame:
    """As :func:`bounded_sample`, but exactly the rate's share of the shard lines: those with the smallest hashes.

    The budget counts lines by weight, so with a weight of w it stands for a w-th of as many lines; with a weight of 0,
    or room for everything, all shard lines stay.
    """
    room = budget.first()
    if room["shard_text_count"] <= room["budget"]:
        return lines
    hashed = lines.withColumn("_bits", F.when(F.col("kind") == PARQUET_CORPUS, unit_bits(line_key())))
    # eight bytes a line, read by all rounds instead of hashing the texts again
    bits = cut_lineage(hashed.filter("_bits is not null").select(F.col("_bits").alias("bits")))
    threshold, ties = hash_threshold(bits, bits.count() * room["budget"] // room["shard_text_count"])
    kept = hashed.filter(F.col("_bits").isNull() | (F.col("_bits") < threshold)).drop("_bits")
    if ties == 0:
        return kept
    # lines that share one 52-bit hash, numbered in key order
    order = W.partitionBy("_bits").orderBy("relative_path", "line_no", "text")
    tied = hashed.filter(F.col("_bits") == threshold).withColumn("_rank", F.row_number().over(order))
    return kept.unionByName(tied.filter(F.col("_rank") <= ties).drop("_bits", "_rank"))


def sample_counts(lines: DataFrame, sample: DataFrame) -> DataFrame:
    """Scanned and selected lines of each kind, repeated lines counted by their weight."""
    weight = F.sum(F.col("weight").cast("long"))
    scanned = lines.groupBy("kind").agg(weight.alias("scanned_lines"))
    selected = sample.groupBy("kind").agg(weight.alias("selected_lines"))
    return scanned.join(selected, "kind", "left").fillna({"selected_lines": 0})


def within_sentence_limit(lines: DataFrame, max_bytes: int) -> DataFrame:
    """Lines longer than the sentence limit take no part in training."""
    return lines.filter(F.octet_length("text") <= max_bytes)


def overlong_lines(lines: DataFrame, max_bytes: int) -> DataFrame:
    return lines.agg(F.count_if(F.octet_length("text") > max_bytes).alias("overlong_lines"))
