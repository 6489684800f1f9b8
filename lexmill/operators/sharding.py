"""Batches of rows and their packing into size-bounded shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.text import byte_length, shard_name
from lexmill.operators.ordering import block_of, running_total
from lexmill.session import broadcast_if_small, cut_lineage

#: A packing segment holds at most these bytes, counted in shards, and these batches. Tests make them small to cross segments often.
SEGMENT_SHARDS = 1024
SEGMENT_BATCHES = 65536
#: Segments, or blocks of segments, that one task joins to a block.
FAN = 64


def text_bytes(text: Column) -> Column:
    """Bytes a text takes in a shard: itself and its newline; an empty text takes none."""
    return F.when(text != "", byte_length(text) + F.lit(1)).otherwise(F.lit(0))


def batch_sizes(texts: DataFrame, batch_rows: int) -> DataFrame:
    """One row for each batch of ``batch_rows`` input rows: rows, text rows and text bytes.

    ``texts`` holds normalised ``(relative_path, row_index, text)``, empty texts included.
    """
    return texts.groupBy("relative_path", block_of(F.col("row_index"), batch_rows).alias("batch_no")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("text") != "").alias("text_rows"),
        F.sum(text_bytes(F.col("text"))).alias("text_bytes"),
    )


def batch_offsets(batches: DataFrame) -> DataFrame:
    """Add ``start_bytes``, the text bytes of all batches before this one in (path, batch) order, and ``place``.

    Places grow in that order and are no less than the number of batches before.
    """
    located = running_total(
        batches.withColumn("block", block_of(F.col("batch_no"), 4096)), F.col("text_bytes"), "_in_file", "batch_no"
    )
    # the window without a key runs over the file list: one row for each file
    files = batches.groupBy("relative_path").agg(
        F.sum("text_bytes").alias("_file_bytes"), (F.max("batch_no") + 1).alias("_file_places")
    )
    earlier = W.orderBy("relative_path").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select(
        "relative_path",
        F.coalesce(F.sum("_file_bytes").over(earlier), F.lit(0)).alias("_file_start"),
        F.coalesce(F.sum("_file_places").over(earlier), F.lit(0)).alias("_first_place"),
    )
    return (
        located.join(starts, "relative_path")
        .withColumn("start_bytes", F.col("_file_start") + F.col("_in_file"))
        .withColumn("place", F.col("_first_place") + F.col("batch_no"))
        .drop("_in_file", "_file_start", "_first_place", "block")
    )


def _next_opening(starts: np.ndarray, ends: np.ndarray, shard_bytes: int) -> np.ndarray:
    """For a shard opened at each batch, the index of the batch that opens the next one."""
    overflowing = np.searchsorted(ends, starts + shard_bytes, side="right")
    return np.maximum(overflowing, np.arange(len(starts)) + 1)


class Passage:
    """How packing runs through a stretch of batches, as a function of the shard that is open before it.

    That shard is known by its first byte, ``open_start``. The first batch whose end lies more than a shard behind it opens the next
    one. So there is a row for each batch that may be the first to open a shard here, in order: where the batch begins and
    ends, how many shards are opened from there to the end of the stretch, and the first byte of the last of them. Only batches that
    begin within a shard of the stretch's start may be it. If no row fits, the open shard runs through.
    """

    COLUMNS = ("entry_start", "entry_end", "opened", "open_start")
    SCHEMA = ", ".join(f"{name} long" for name in COLUMNS)

    def __init__(self, rows: pd.DataFrame, shard_bytes: int):
        ordered = rows.sort_values("entry_end")
        self.starts, self.ends, self.opened, self.exits = (ordered[name].to_numpy() for name in self.COLUMNS)
        self.shard_bytes = shard_bytes

    @classmethod
    def through(cls, batches: pd.DataFrame, shard_bytes: int) -> pd.DataFrame:
        """The rows of a stretch of batches in order, worked out from its end."""
        starts = batches["start_bytes"].to_numpy()
        ends = starts + batches["text_bytes"].to_numpy()
        following = _next_opening(starts, ends, shard_bytes).tolist()
        count = len(following)
        opened, last = [1] * count, list(range(count))
        for index in range(count - 1, -1, -1):
            if following[index] < count:
                opened[index] = 1 + opened[following[index]]
                last[index] = last[following[index]]
        rows = dict(zip(cls.COLUMNS, (starts, ends, np.array(opened, np.int64), starts[last])))
        return pd.DataFrame(rows)[starts < starts[0] + shard_bytes]

    def _rows_for(self, open_starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, open_starts + self.shard_bytes, side="right")

    def enter(self, open_start: int | None, open_shard: int) -> tuple[int | None, int]:
        """The open shard behind the stretch: its first byte and its id; before the first batch of all there is none."""
        at = 0 if open_start is None else int(self._rows_for(np.array([open_start]))[0])
        if at == len(self.ends):
            return open_start, open_shard
        return int(self.exits[at]), open_shard + int(self.opened[at])

    def then(self, after: Passage) -> Passage:
        """This stretch and the one behind it as one."""
        at = after._rows_for(self.exits)
        on = at < len(after.ends)
        at = np.where(on, at, 0)
        joined = Passage.__new__(Passage)
        joined.shard_bytes = self.shard_bytes
        # a shard that is open before this stretch may run through it and end in the next one
        late = after.starts < self.starts[0] + self.shard_bytes
        joined.starts = np.concatenate([self.starts, after.starts[late]])
        joined.ends = np.concatenate([self.ends, after.ends[late]])
        joined.opened = np.concatenate([self.opened + np.where(on, after.opened[at], 0), after.opened[late]])
        joined.exits = np.concatenate([np.where(on, after.exits[at], self.exits), after.exits[late]])
        return joined

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(self.COLUMNS, (self.starts, self.ends, self.opened, self.exits))))


_STATE = "block long, open_start long, open_shard long"


def _join_blocks(passages: DataFrame, shard_bytes: int, fan: int) -> DataFrame:
    """``(block, ...)`` of the blocks one level up: ``fan`` neighbours are one."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        passage = None
        for _, rows in group.groupby("block", sort=True):
            one = Passage(rows, shard_bytes)
            passage = one if passage is None else passage.then(one)
        return passage.rows().assign(block=int(group["block"].iloc[0]) // fan)

    upper = F.floor(F.col("block") / F.lit(fan))
    return passages.groupBy(upper.alias("upper")).applyInPandas(join, f"{Passage.SCHEMA}, block long")


def _enter_blocks(passages: DataFrame, entered: DataFrame, shard_bytes: int, fan: int) -> DataFrame:
    """The state before each block, from the states before the blocks one level up."""

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        open_start, open_shard = group["open_before"].iloc[0], int(group["shard_before"].iloc[0])
        open_start = None if pd.isna(open_start) else int(open_start)
        states = []
        for block, rows in group.groupby("block", sort=True):
            states.append((block, open_start, open_shard))
            open_start, open_shard = Passage(rows, shard_bytes).enter(open_start, open_shard)
        return pd.DataFrame(states, columns=["block", "open_start", "open_shard"]).astype({"open_start": "Int64"})

    # one row for each block one level up
    above = F.broadcast(entered.toDF("upper", "open_before", "shard_before"))
    below = passages.withColumn("upper", F.floor(F.col("block") / F.lit(fan))).join(above, "upper")
    return below.groupBy("upper").applyInPandas(follow, _STATE)


def enter_segments(passages: DataFrame, blocks: int, shard_bytes: int, first: tuple[int | None, int], fan: int = FAN) -> DataFrame:
    """The open shard before each of ``blocks`` stretches, by a parallel prefix over their passages.

    Neighbours are joined to blocks, these to larger ones, until one task can follow the rest; then the states go back down, level by
    level. The driver holds the first state and the number of levels.
    """
    levels = [passages]
    while blocks > fan:
        levels.append(cut_lineage(_join_blocks(levels[-1], shard_bytes, fan)))
        blocks = -(-blocks // fan)
    entered = passages.sparkSession.createDataFrame([(0, *first)], _STATE)
    for level in reversed(levels):
        entered = cut_lineage(_enter_blocks(level, entered, shard_bytes, fan))
    return entered


def assign_shards(
    batches: DataFrame,
    shard_bytes: int,
    first_shard: int = 0,
    open_bytes: int = 0,
    segment_shards: int = SEGMENT_SHARDS,
    segment_batches: int = SEGMENT_BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """Add ``shard_id`` to the non-empty batches, packing greedily in (path, batch) order.

    A batch that would push a non-empty shard over ``shard_bytes`` opens the next shard; a batch is never
    split. ``first_shard`` and ``open_bytes`` continue a shard that an earlier run left open.

    Greedy packing is sequential, but where a shard ends depends only on where it starts. So the batches are cut into segments of
    bounded bytes and batches, each segment works out in its own task how shards run through it (`Passage`), `enter_segments`
    finds the shard that is open before each, and then every segment numbers its own batches.
    """
    offsets = batch_offsets(batches.filter("text_bytes > 0"))
    shifted = offsets.withColumn("start_bytes", F.col("start_bytes") + F.lit(open_bytes))
    by_bytes = F.floor(F.col("start_bytes") / F.lit(shard_bytes * segment_shards))
    by_batches = F.floor(F.col("place") / F.lit(segment_batches))
    placed = cut_lineage(shifted.withColumn("stretch", F.struct(by_bytes, by_batches)).drop("place"))
    # one row for each segment
    segments = cut_lineage(
        placed.select("stretch").distinct().withColumn("segment", (F.row_number().over(W.orderBy("stretch")) - 1).cast("long"))
    )
    placed = placed.join(F.broadcast(segments), "stretch").drop("stretch")

    def pass_through(group: pd.DataFrame) -> pd.DataFrame:
        rows = Passage.through(group.sort_values("start_bytes"), shard_bytes)
        return rows.assign(block=group["segment"].iloc[0])

    passages = cut_lineage(placed.groupBy("segment").applyInPandas(pass_through, f"{Passage.SCHEMA}, block long"))
    first = (0, first_shard) if open_bytes else (None, first_shard - 1)
    entered = enter_segments(passages, segments.count(), shard_bytes, first, fan).withColumnRenamed("block", "segment")

    def number(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start_bytes").reset_index(drop=True)
        starts = group["start_bytes"].to_numpy()
        ends = starts + group["text_bytes"].to_numpy()
        open_start = group["open_start"].iloc[0]
        following = _next_opening(starts, ends, shard_bytes)
        at = 0 if pd.isna(open_start) else int(np.searchsorted(ends, open_start + shard_bytes, side="right"))
        openings = []
        while at < len(starts):
            openings.append(at)
            at = int(following[at])
        group["shard_id"] = group["open_shard"] + np.searchsorted(openings, np.arange(len(starts)), side="right")
        return group[["relative_path", "batch_no", "rows", "text_rows", "text_bytes", "start_bytes", "shard_id"]]

    # one row for each segment
    numbered = placed.join(F.broadcast(entered), "segment").groupBy("segment")
    return numbered.applyInPandas(
        number,
        "relative_path string, batch_no long, rows long, text_rows long, text_bytes long, "
        "start_bytes long, shard_id long",
    )


def shard_totals(assigned: DataFrame) -> DataFrame:
    """Per shard: its file name, batches, texts and bytes."""
    return assigned.groupBy("shard_id").agg(
        shard_name(F.first("shard_id")).alias("shard_name"),
        F.count("*").alias("batches"),
        F.sum("text_rows").alias("text_rows"),
        F.sum("text_bytes").alias("text_bytes"),
    )


def place_texts(texts: DataFrame, assigned: DataFrame, batch_rows: int) -> DataFrame:
    """The non-empty texts with the shard of their batch.

    The batch table is broadcast while it is small, so the texts do not move; beyond that the join
    shuffles both sides on (path, batch), keys of at most ``batch_rows`` texts each.
    """
    shards = cut_lineage(assigned.select("relative_path", "batch_no", "shard_id"))
    kept = texts.filter("text != ''").withColumn("batch_no", block_of(F.col("row_index"), batch_rows))
    return kept.join(broadcast_if_small(shards, bytes_per_row=256), ["relative_path", "batch_no"])
