"""Exact deduplication of a batch against an immutable snapshot and within itself.

Texts are equal when they are identical without white space. Of equal texts the row with the most code points in
its original text stays, then the smallest ``doc_id``. Edge cases: a null text is empty, empty texts equal one another;
a null ``doc_id`` loses every tie and never names a group unless the whole group has none; repeated rows of one
``doc_id`` share its fate; an empty table gives an empty table; other columns are not read.

A snapshot is digested once. Its distinct digests are cut into shards of bounded size and each shard becomes a binary fuse
filter. The digests of a batch are first grouped among themselves, so a text with a million copies is screened once;
then each shard's filter screens them. What passes is joined with the snapshot's exact buckets. Every digest that more
than one row has is checked on the bytes of the texts, folded to a minimum and a maximum before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lexmill.llm import fuse_filter
from lexmill.llm.common import WHITESPACE, checkpointed, keyed_texts
from lexmill.session import broadcast_if_small

#: Distinct digests of a filter shard; a shard is built and probed by one task.
SHARD_KEYS = 1 << 18


def normalised(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, normal)``, the texts without white space."""
    texts = keyed_texts(df, id_col, text_col)
    return texts.select("doc_id", F.length("text").alias("n_chars"), F.translate("text", WHITESPACE, "").alias("normal"))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, text_sha256)``: the light rows that everything but the byte check works on."""
    return normalised(df, id_col, text_col).select("doc_id", "n_chars", F.sha2("normal", 256).alias("text_sha256"))


def classes(rows: DataFrame) -> DataFrame:
    """``(text_sha256, best, group_size)``, one row for each distinct digest; ``best`` orders as (length, -id)."""
    best = F.max(F.struct(F.col("n_chars"), (-F.col("doc_id")).alias("minus_id")))
    return rows.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))


def _sharded(rows: DataFrame, shards: int) -> DataFrame:
    key = F.xxhash64("text_sha256")
    return rows.withColumn("key", key).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))


def shard_count(n_digests: int) -> int:
    return max(1, -(-n_digests // SHARD_KEYS))


def build_filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """``(shard, filter)``: a fuse filter over the digests of each shard of the snapshot's classes."""

    def build(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        keys = batch.column("key").to_numpy().astype(np.int64).view(np.uint64)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": [fuse_filter.build(keys)]})

    keyed = _sharded(snapshot, shards).select("shard", "key")
    return keyed.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def screen(batch: DataFrame, filters: DataFrame, shards: int, salts: int = 1) -> DataFrame:
    """The batch's classes with ``maybe_old``: whether their shard's filter may hold them.

    A shard of the batch is cut into ``salts`` parts, each of which meets a copy of the shard's filter, whose size is bounded.
    """

    def probe(asked: pa.Table, held: pa.Table) -> pa.Table:
        keys = asked.column("key").to_numpy().astype(np.int64).view(np.uint64)
        found = np.zeros(len(keys), bool)
        if held.num_rows and len(keys):
            found = fuse_filter.contains(held.column("filter")[0].as_py(), keys)
        return asked.drop_columns(["shard", "salt", "key"]).append_column("maybe_old", pa.array(found, pa.bool_()))

    schema = StructType([*batch.schema.fields, StructField("maybe_old", BooleanType())])
    salt = F.pmod(F.xxhash64("text_sha256", "key"), F.lit(salts)).alias("salt")
    asked = _sharded(batch, shards).select("shard", salt, "key", *batch.columns)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt")
    held = filters.select("shard", copies, "filter")
    return asked.groupBy("shard", "salt").cogroup(held.groupBy("shard", "salt")).applyInArrow(probe, schema)


def joint_classes(new: DataFrame, old: DataFrame) -> DataFrame:
    """The classes of batch and snapshot together; a class that the filters clear never meets the snapshot's buckets."""
    n_old = old.count()
    if not n_old:
        return new
    shards = shard_count(n_old)
    new = checkpointed(new)
    # a batch that is much larger than the snapshot is cut into more parts than the snapshot has shards
    salts = -(-shard_count(new.count()) // shards)
    screened = checkpointed(screen(new, build_filters(old, shards), shards, salts))
    fresh = screened.filter("not maybe_old").drop("maybe_old")
    met = screened.filter("maybe_old").drop("maybe_old").unionByName(old).groupBy("text_sha256")
    return fresh.unionByName(met.agg(F.max("best").alias("best"), F.sum("group_size").alias("group_size")))


def check_bytes(texts: DataFrame, suspects: DataFrame) -> None:
    """Fail if a digest of ``suspects(text_sha256)`` stands for two texts of ``texts``, an output of `normalised`.

    Copies fold to their least and greatest text in each task, so a text with a third of all rows crosses the
    network once for each task.
    """
    keyed = texts.select(F.sha2("normal", 256).alias("text_sha256"), "normal")
    met = keyed.join(broadcast_if_small(suspects, 96), "text_sha256", "left_semi")
    bounds = met.groupBy("text_sha256").agg(F.min("normal").alias("least"), F.max("normal").alias("greatest"))
    if not bounds.filter("least <> greatest").isEmpty():
        raise RuntimeError("two texts share a SHA-256 digest")


def _resolved(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Every row of ``rows``, the digests with their side ``newer``, with its class over both sides."""
    old = checkpointed(classes(rows.filter("not newer")))
    joint = checkpointed(joint_classes(classes(rows.filter("newer")), old))
    check_bytes(texts, joint.filter("group_size > 1").select("text_sha256"))
    keep_id = -F.col("best.minus_id")
    return rows.join(joint, "text_sha256").select(
        "newer",
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def deduplicate(
    batch: DataFrame, snapshot: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each row of ``batch``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the best row over batch and snapshot, ``group_size`` counts both.
    """
    snapshot = batch.limit(0) if snapshot is None else snapshot
    rows = digests(batch, id_col, text_col).withColumn("newer", F.lit(True)).unionByName(
        digests(snapshot, id_col, text_col).withColumn("newer", F.lit(False))
    )
    texts = normalised(batch, id_col, text_col).unionByName(normalised(snapshot, id_col, text_col))
    return _resolved(checkpointed(rows), texts).filter("newer").drop("newer")


def deduplicate_halves(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One table as an older half (by a hash of the id), the snapshot, and a newer half that comes in as a batch.

    Returns the columns of `deduplicate` for every row of both halves; ids without a hash are old.
    """
    rows = digests(docs, id_col, text_col)
    rows = rows.withColumn("newer", F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1))
    return _resolved(checkpointed(rows), normalised(docs, id_col, text_col)).drop("newer")
