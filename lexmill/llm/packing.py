"""Best-fit packing of tokenised documents into sequences, under several capacities at once.

A document is its ids and a closing id 0. One that is longer than a sequence may be is cut into pieces of full length; its
last piece may be shorter. A sequence has capacities in tokens, in documents and in attention cost (the sum of squared
lengths); each piece needs a vector of all three. Pieces go from long to short, and each one into the open sequence that the weighted rule
likes best among those with room in every dimension: the largest dot product of need and residual, or the smallest residual norm.

A piece's need depends on its length alone, so the plan is made on the histogram of lengths: equal sequences are one class with a count,
and the driver holds as many numbers as there are lengths, whatever the number of documents. Pieces find their place by their
rank within their length, numbered per task and shifted by the counts of the tasks before, so no length is ranked in one task.

Edge cases: a null text is empty and packs as the closing id alone; repeated rows are packed each on its own, and a null id
like any other; the longest text is cut, never dropped; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from lexmill.llm.common import SLICE_ROWS, checkpointed, keyed_texts

VOCABULARY_PATH = public_tokenizers.path("word_bpe_49k.json")
CLOSING_ID = 0
#: Entries of a generation of a worker's two memos, of runs without white space and of words: about 180 MB, or 80 MB.
LARGE_MEMOS = (150_000, 300_000)
SMALL_MEMOS = (100_000, 100_000)
#: The longest run or word that enters a memo.
MEMO_CHARS = 40

#: Python splits at these too, the vocabulary's normaliser does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: The vocabulary's pattern for lower-case Latin-1, where its normaliser does no more than to lower the case; white space is in no match.
_LETTERS, _NUMBERS, _BLANKS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")
#: The vocabulary's name of each byte: a printable one is the character of its number, the others follow from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_NAMES = {byte: 256 + place for place, byte in enumerate(sorted({*range(256)} - _PRINTABLE))}
_SPACES = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_WHITE = re.compile(f"[{''.join(map(chr, _SPACES))}]+")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. With the defaults tokens bind first; the other two bind when they are set lower."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.1)
    rule: str = "norm"

    @property
    def longest(self) -> int:
        """The longest piece that fits into an empty sequence."""
        return min(self.tokens, math.isqrt(self.attention))

    def scores(self, length: int, left: np.ndarray) -> np.ndarray:
        """How much the rule likes each residual (rows of tokens, documents, attention); larger is better."""
        limits = np.array([self.tokens, self.documents, self.attention], np.float64)
        weights, need = np.array(self.weights), np.array([length, 1, length * length]) / limits
        if self.rule == "dot":
            return (left / limits) @ (weights * need)
        return -(((left / limits - need) ** 2) @ weights)


class Memo(dict):
    """A dict that computes what it lacks, one at a time; when it is full it becomes the older of two generations."""

    def __init__(self, compute: Callable[[str], bytes], entries: int, longest: int = MEMO_CHARS) -> None:
        super().__init__()
        self._compute, self._entries, self._longest = compute, entries, longest
        self._older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self._older.get(piece)
        if found is None:
            found = self._compute(piece)
        if len(piece) <= self._longest:
            if len(self) >= self._entries:
                self._older = dict(self)
                self.clear()
            self[piece] = found
        return found


class WordVocabulary:
    """Ids of texts by the public word vocabulary. It drops white space, so texts are encoded word by word, with a memo.

    Texts of Latin-1 characters alone are cut where the vocabulary's own pattern cuts, and its merges are asked for the words; other
    texts are cut at white space, and what of them is not Latin-1 goes through the whole vocabulary, normaliser included.
    """

    def __init__(self, path: str, memos: tuple[int, int] = LARGE_MEMOS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._merges = self._whole.model
        self._memo = Memo(self._encode_chunk, memos[0])
        self._words = Memo(self._encode_word, memos[1])

    def _encode_latin(self, text: str) -> bytes | None:
        """None for a text with other characters or one that may hold a special token."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if "<|" in text:
            return None
        return b"".join(map(self._words.__getitem__, _LATIN_WORDS.findall(text.lower())))

    def _encode_chunk(self, chunk: str) -> bytes:
        found = self._encode_latin(chunk)
        if found is None:
            ids = self._whole.encode(chunk, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _encode_word(self, word: str) -> bytes:
        named = word.encode().decode("latin-1").translate(_BYTE_NAMES)
        ids = [token.id for token in self._merges.tokenize(named)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = self._encode_latin(text)
        if found is None:
            words = _WHITE.split(text) if _SEPARATORS.search(text) else text.split()
            found = b"".join(map(self._memo.__getitem__, words))
        return found


@cache
def vocabulary(path: str, memos: tuple[int, int] = LARGE_MEMOS) -> WordVocabulary:
    return WordVocabulary(path, memos)


def pieces(
    df: DataFrame,
    capacity: Capacity = Capacity(),
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = VOCABULARY_PATH,
    memos: tuple[int, int] = LARGE_MEMOS,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, part, place)``; ``place`` counts equal lengths within the task ``part``."""
    texts = keyed_texts(df, id_col, text_col)
    schema = pa.schema(
        [
            ("doc_id", to_arrow_type(texts.schema["doc_id"].dataType)),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("part", pa.int32()),
            ("place", pa.int64()),
        ]
    )
    step = capacity.longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = vocabulary(path, memos), TaskContext.get().partitionId()
        seen = np.zeros(step + 1, np.int64)
        closing = CLOSING_ID.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                found = []
                for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                    ids = coder.encode(text) + closing
                    for number, start in enumerate(range(0, len(ids) // 4, step)):
                        own = ids[4 * start : 4 * (start + step)]
                        length = len(own) // 4
                        found.append((doc_id, number, start, length, zlib.crc32(own), part, int(seen[length])))
                        seen[length] += 1
                columns = zip(*found) if found else [()] * len(schema)
                arrays = [pa.array(column, field.type) for column, field in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return texts.mapInArrow(cut, from_arrow_schema(schema))


def plan(histogram: dict[int, int], capacity: Capacity = Capacity()) -> np.ndarray:
    """Rows of (length, first rank, count, first sequence, offset): pieces of a length go to consecutive sequences by rank.

    ``histogram`` counts the pieces of each length.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    # A class is a residual vector with the ranges of sequences that have it.
    classes: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    sequences = 0

    def fill(left: tuple[int, int, int], first: int, count: int, each: int, length: int, rank: int) -> int:
        """Put ``each`` pieces into each of ``count`` sequences from ``first`` on; returns the next rank."""
        offset = capacity.tokens - left[0]
        for slot in range(each):
            rows.append((length, rank, count, first, offset + slot * length))
            rank += count
        now = (left[0] - each * length, left[1] - each, left[2] - each * length * length)
        if now[0] > 0 and now[1] > 0 and now[2] > 0:
            classes.setdefault(now, []).append((first, count))
        return rank

    for length in sorted(histogram, reverse=True):
        waiting, rank, square = histogram[length], 0, length * length
        kinds = list(classes)
        left = np.array(kinds, np.int64).reshape(-1, 3)
        fits = np.flatnonzero((left[:, 0] >= length) & (left[:, 1] >= 1) & (left[:, 2] >= square))
        order = fits[np.argsort(-capacity.scores(length, left[fits]), kind="stable")]
        for kind in (kinds[place] for place in order):
            if not waiting:
                break
            most = min(kind[0] // length, kind[1], kind[2] // square)
            ranges = classes.pop(kind)
            while ranges and waiting:
                first, count = ranges.pop()
                full = min(count, waiting // most)
                if full:
                    rank = fill(kind, first, full, most, length, rank)
                    waiting -= full * most
                if full < count and waiting and waiting < most:
                    rank = fill(kind, first + full, 1, waiting, length, rank)
                    waiting, full = 0, full + 1
                if full < count:
                    ranges.append((first + full, count - full))
            if ranges:
                classes.setdefault(kind, []).extend(ranges)
        if waiting:
            empty = (capacity.tokens, capacity.documents, capacity.attention)
            most = min(empty[0] // length, empty[1], empty[2] // square)
            for count, each in ((waiting // most, most), (1, waiting % most)):
                if count and each:
                    rank = fill(empty, sequences, count, each, length, rank)
                    sequences += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cut: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """Give every row of `pieces` its ``sequence_id`` and ``offset``."""
    cut = checkpointed(cut)
    counts = checkpointed(cut.groupBy("part", "length").count())
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    planned = plan(histogram, capacity)
    lengths, ranks, firsts, offsets = planned[:, 0], planned[:, 1], planned[:, 3], planned[:, 4]

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted, found = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        row = np.zeros(len(wanted), np.int64)
        for kind in np.unique(wanted):
            start, stop = np.searchsorted(lengths, [kind, kind + 1])
            of = wanted == kind
            row[of] = start + np.searchsorted(ranks[start:stop], found[of], "right") - 1
        return pd.DataFrame({"sequence_id": firsts[row] + found - ranks[row], "offset": offsets[row]})

    ranked = cut.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.withColumn("at", placed("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"
    )


def pack(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    path: str = VOCABULARY_PATH,
    memos: tuple[int, int] = LARGE_MEMOS,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece of every document."""
    return place(pieces(docs, capacity, path=path, memos=memos), capacity)
