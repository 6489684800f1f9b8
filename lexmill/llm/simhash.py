"""SimHash fingerprints of word shingles and the groups of documents whose fingerprints are near.

A-Z is lowered, words are runs of anything but ASCII white space, a shingle is three words joined by blanks (repeats
count; a shorter text is one shingle; a text without words has fingerprint zero). A fingerprint bit is 1 if more than half of
the shingles' XXH64 hashes (seed 42) have it. Two fingerprints link when they differ in at most two bits; documents of
linked fingerprints are in one component, named by its smallest ``doc_id``.

Equal fingerprints collapse first. A pivot table holds each distinct fingerprint's Hamming distances to many reference
fingerprints. Since distances to a pivot differ by no more than the fingerprints do, a pair with a coordinate difference over
two is discarded, and only the rest is verified. Pairs are looked up where two of four 16-bit blocks agree,
which any pair within two bits does somewhere. Blocks with many members are not paired: their fingerprints meet in the
values one bit away from each, as two fingerprints within two bits of each other always do, and link to the least one there.
That way is exact as well, and its work is linear in the number of fingerprints.

Edge cases: a null text is empty; a null ``doc_id`` never names a component unless no other does; repeated rows and equal
texts share their fingerprint and are in one component; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmill.llm.common import checkpointed, keyed_texts, map_slices
from lexmill.llm.components import component_labels
from lexmill.session import broadcast_if_small

SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints link up to this many differing bits; the blocks below are laid out for it.
LINK_BITS = 2
BLOCK_BITS = 16
#: Pairs of blocks with more fingerprints than this meet in their one-bit neighbours instead of pairwise.
CROWD = 48
#: Reference fingerprints of the pivot table, fixed and spread over the space.
PIVOTS = tuple(int(value) for value in np.random.default_rng(7).integers(-(2**63), 2**63, 16))


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        joined = b" ".join(words)
        stops = list(accumulate(len(word) + 1 for word in words))
        starts = [0, *stops[: -SHINGLE_WORDS]]
        digest = xxhash.xxh64_intdigest
        spans = zip(starts, stops[SHINGLE_WORDS - 1 :])
        hashes = np.array([digest(joined[start : stop - 1], SEED) for start, stop in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[start : start + (1 << 16)].view(np.uint8), bitorder="little")
        counts += part.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, print)``: the fingerprint of each whole text as a signed 64-bit integer."""
    texts = keyed_texts(df, id_col, text_col).select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    schema = pa.schema([("doc_id", to_arrow_type(texts.schema["doc_id"].dataType)), ("print", pa.int64())])

    def work(doc_ids: list, raws: list[bytes]) -> list[list]:
        prints = np.array([fingerprint(raw) for raw in raws], np.uint64)
        return [doc_ids, prints.view(np.int64).tolist()]

    return map_slices(texts, work, schema)


def _distances(print_: Column) -> list[Column]:
    """The pivot table's row of a fingerprint: its Hamming distance to each pivot."""
    return [F.bit_count(print_.bitwiseXOR(F.lit(pivot))).cast("byte").alias(f"d{n}") for n, pivot in enumerate(PIVOTS)]


def _buckets(print_: Column) -> Column:
    """One key for each pair of blocks: the pair's number above the two blocks' bits."""
    blocks = [F.shiftrightunsigned(print_, n * BLOCK_BITS).bitwiseAND(F.lit(0xFFFF)) for n in range(64 // BLOCK_BITS)]
    pairs = enumerate(combinations(blocks, 2))
    keys = [
        F.lit(n << 2 * BLOCK_BITS).bitwiseOR(F.shiftleft(first, BLOCK_BITS)).bitwiseOR(second)
        for n, (first, second) in pairs
    ]
    return F.array(*[key.cast("long") for key in keys])


def _pivot_links(keyed: DataFrame) -> DataFrame:
    """Pairs that share a bucket, no pivot tells apart, and verification confirms."""
    names = [f"d{n}" for n in range(len(PIVOTS))]
    left = keyed.select("bucket", F.col("print").alias("a"), *[F.col(name).alias(f"a_{name}") for name in names])
    right = keyed.select("bucket", F.col("print").alias("b"), *[F.col(name).alias(f"b_{name}") for name in names])
    apart = F.greatest(*[F.abs(F.col(f"a_{name}") - F.col(f"b_{name}")) for name in names])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= LINK_BITS
    return left.join(right, "bucket").filter("a < b").filter(apart <= LINK_BITS).filter(near).select("a", "b")


def _neighbour_links(prints: DataFrame) -> DataFrame:
    """Each print with the least one among those that are at most one bit from a common value; a value has at most 65 of them."""
    flipped = [F.col("print").bitwiseXOR(F.lit(1 << n if n < 63 else -(2**63))) for n in range(64)]
    spread = prints.select("print", F.explode(F.array("print", *flipped)).alias("value"))
    hub = F.min("print").over(Window.partitionBy("value")).alias("b")
    return spread.select(F.col("print").alias("a"), hub).filter("a <> b")


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: links that connect all of the distinct ``prints(print)`` within ``LINK_BITS`` of each other."""
    keyed = prints.select("print", F.explode(_buckets(F.col("print"))).alias("bucket"), *_distances(F.col("print")))
    crowds = keyed.groupBy("bucket").count().filter(F.col("count") > CROWD).select("bucket")
    crowds = broadcast_if_small(checkpointed(crowds), 16)
    crowded = keyed.join(crowds, "bucket", "left_semi").select("print").distinct()
    return _pivot_links(keyed.join(crowds, "bucket", "left_anti")).unionByName(_neighbour_links(crowded)).distinct()


def group_by_simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of each row; the fingerprint as 16 hexadecimal digits."""
    rows = checkpointed(fingerprints(df, id_col, text_col))
    classes = checkpointed(rows.groupBy("print").agg(F.min("doc_id").alias("least_id")))
    labels = component_labels(links(classes.select("print"))).withColumnRenamed("node", "print")
    rooted = classes.join(labels, "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = rooted.join(named, "root").select("print", "component_id")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return rows.join(members, "print").select("doc_id", hexed, "component_id")
