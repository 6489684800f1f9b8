"""Encode, decode and describe text columns with a trained vocabulary."""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import MODEL_TYPE, SPECIAL_TOKENS
from lexmill.functions.normalize import NORMALIZER_NAME, normalize
from lexmill.functions.text import SPACE_MARKER, decode_hex, visible
from lexmill.operators.vocab_training import (
    BYTE_PIECES,
    merge_rows,
    merge_table,
    special_ids,
    vocab_rows,
    vocab_table,
)

# Fixed value: how a decoder shows the unknown token.
UNKNOWN_SURFACE = " ⁇ "

#: Distinct words one Python worker remembers before it starts over.
WORD_CACHE_SIZE = 200_000
#: Characters of the longest word that is remembered, so that a full memory takes some 100 MB; text without blanks makes words of any length.
WORD_CACHE_LENGTH = 64
#: Texts of an Arrow batch that are Python strings at a time.
SLICE_ROWS = 128


def segment_word(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge a word's characters by ascending merge rank, leftmost first, in n log n steps."""
    symbols: list[str | None] = list(word)
    size = len(symbols)
    following, previous = list(range(1, size + 1)), list(range(-1, size - 1))
    waiting: list[tuple[int, int, str, str]] = []

    def offer(at: int) -> None:
        if at >= 0 and following[at] < size:
            pair = (symbols[at], symbols[following[at]])
            if pair in ranks:
                heapq.heappush(waiting, (ranks[pair], at, *pair))

    for at in range(size):
        offer(at)
    while waiting:
        _, at, left, right = heapq.heappop(waiting)
        after = following[at]
        if symbols[at] != left or after >= size or symbols[after] != right:
            continue
        symbols[at], symbols[after] = left + right, None
        following[at] = following[after]
        if following[at] < size:
            previous[following[at]] = at
        offer(previous[at])
        offer(at)
    return [symbol for symbol in symbols if symbol is not None]


class WordIds(dict):
    """The ids of words as bytes of 32-bit integers: found when first asked for, and remembered if short."""

    def __init__(self, encode_word: Callable[[str], list[int]]):
        super().__init__()
        self._encode_word = encode_word

    def __missing__(self, word: str) -> bytes:
        found = array("i", self._encode_word(word)).tobytes()
        if len(word) <= WORD_CACHE_LENGTH:
            if len(self) >= WORD_CACHE_SIZE:
                self.clear()
            self[word] = found
        return found


def _write_rows(rows: DataFrame, path: str) -> None:
    """Rows as tab-separated lines under a header, in one file: a vocabulary's worth at most."""
    written = rows.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True)
    written.option("quote", "").option("emptyValue", "").csv(path)


def _read_rows(spark: SparkSession, path: str, names: tuple[str, ...], numbers: tuple[str, ...]) -> DataFrame:
    """Lines of a written file by field name. A line of another number of fields and a number that is none are errors."""
    fields = F.split("value", "\t", -1)

    def wrong(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{what} in {path}: "), F.col("value")))

    lines = spark.read.text(path).filter(F.col("value") != "\t".join(names))
    whole = F.when(F.size(fields) == len(names), fields).otherwise(wrong("wrong number of fields").cast("array<string>"))
    columns = []
    for place, name in enumerate(names):
        field = F.element_at(whole, place + 1)
        if name in numbers:
            field = F.when(field.rlike(r"^[0-9]{1,18}\z"), field.cast("long")).otherwise(wrong("bad number").cast("long"))
        columns.append(field.alias(name))
    return lines.select(*columns)


class SubwordModel:
    """A vocabulary and its merges. Both are bounded by the vocabulary size, so they travel as constants."""

    model_type = MODEL_TYPE
    normalizer_name = NORMALIZER_NAME

    def __init__(self, spark: SparkSession, vocab: DataFrame, merges: DataFrame):
        self.spark = spark
        self.vocab = vocab
        self.merges = merges
        rows = vocab.orderBy("id").collect()
        if [row["id"] for row in rows] != list(range(len(rows))):
            raise ValueError("vocabulary ids must run from 0 without gaps")
        self.pieces = [row["piece"] for row in rows]
        self.special_tokens = {row["label"]: row["id"] for row in rows if row["special"]}
        self._visible = [
            row["label"] if row["special"] else row["shown"]
            for row in vocab.withColumn("shown", visible(F.col("piece"))).orderBy("id").collect()
        ]
        self._ranks: dict[tuple[str, str], int] = {}
        for row in merges.orderBy("rank").collect():
            self._ranks.setdefault((row["left"], row["right"]), row["rank"])

    @classmethod
    def from_training(cls, spark: SparkSession, training) -> SubwordModel:
        return cls(spark, vocab_table(spark, training), merge_table(spark, training))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SubwordModel:
        return cls(spark, spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"))

    def save(self, path: str) -> None:
        self.vocab.coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
        self.merges.coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")

    def save_text(self, path: str) -> None:
        """Write the vocabulary and the merges as tab-separated files, pieces in hex, below ``path``."""
        _write_rows(self.vocab_rows(), f"{path}/vocab")
        _write_rows(merge_rows(self.merges), f"{path}/merges")

    @classmethod
    def load_text(cls, spark: SparkSession, path: str) -> SubwordModel:
        """The model from the files of :meth:`save_text`; its ids are those of the model that was written.

        The vocabulary names each piece once, but a piece may have several pairs that merge into it, each with a rank of its
        own, so the ranks come from the merges. Errors: a line with too few or too many fields, a bad number, an odd or bad hex
        payload, a kind that is neither special nor piece, gaps or repeats in ids or ranks, a merge whose piece the vocabulary lacks.
        """
        names = ("id", "kind", "label", "piece_hex", "visible_piece")
        rows = _read_rows(spark, f"{path}/vocab", names, ("id",))
        kind = F.col("kind")
        problem = F.raise_error(F.concat(F.lit("unknown kind of vocabulary entry: "), kind)).cast("boolean")
        special = F.when(kind.isin("special", "piece"), kind == "special").otherwise(problem)
        vocab = rows.select(
            F.col("id").cast("int").alias("id"), special.alias("special"), "label", decode_hex(F.col("piece_hex")).alias("piece")
        )
        names = ("rank", "left_hex", "right_hex", "count")
        parts = _read_rows(spark, f"{path}/merges", names, ("rank", "count"))
        parts = parts.select(
            F.col("rank").cast("int").alias("rank"),
            decode_hex(F.col("left_hex")).alias("left"),
            decode_hex(F.col("right_hex")).alias("right"),
            "count",
        )
        merges = parts.select("rank", "left", "right", F.concat("left", "right").alias("piece"), "count")
        model = cls(spark, vocab, merges)
        ranks = [row["rank"] for row in merges.select("rank").orderBy("rank").collect()]
        if ranks != list(range(len(ranks))):
            raise ValueError("merge ranks must run from 0 without gaps")
        lacking = {left + right for left, right in model._ranks} - set(model.pieces)
        if lacking:
            raise ValueError(f"merges into pieces that the vocabulary lacks: {sorted(lacking)[:3]}")
        return model

    @property
    def vocab_size(self) -> int:
        return len(self.pieces)

    def tokens(self) -> DataFrame:
        return self.vocab.orderBy("id")

    def special_map(self) -> DataFrame:
        return special_ids(self.vocab)

    def vocab_rows(self) -> DataFrame:
        return vocab_rows(self.vocab)

    def encode(self, text: Column) -> Column:
        """Normalise a text column and encode it to ``array<int>``."""
        return self._encoder()(normalize(text))

    def encode_words(self, words: Column) -> Column:
        """Encode marked training words, for statistics over distinct words."""
        return self._encoder(marked=True)(words)

    def _encoder(self, marked: bool = False):
        ids = {piece: token_id for token_id, piece in enumerate(self.pieces) if piece}
        for value, piece in enumerate(BYTE_PIECES):
            # a byte piece is reached through its byte, never through its spelling
            ids.pop(piece, None)
        first_byte = len(SPECIAL_TOKENS)
        shared = self.spark.sparkContext.broadcast((ids, self._ranks))

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known, ranks = shared.value
            # a word with its marker, or a newline, or a marker character of the data itself
            cutter = re.compile(f"[ ]?[^ \n{SPACE_MARKER}]+|[ \n{SPACE_MARKER}]")

            def encode_word(word: str) -> list[int]:
                if word == SPACE_MARKER:
                    return [first_byte + byte for byte in word.encode()]
                found = []
                for symbol in segment_word(word.replace(" ", SPACE_MARKER), ranks):
                    token = known.get(symbol)
                    if token is None:
                        found.extend(first_byte + byte for byte in symbol.encode())
                    else:
                        found.append(token)
                return found

            ids_of = WordIds(encode_word).__getitem__
            for batch in batches:
                encoded = []
                for start in range(0, len(batch), SLICE_ROWS):
                    for text in batch.slice(start, SLICE_ROWS).to_pylist():
                        if not text:
                            encoded.append(b"")
                            continue
                        source = text.replace(SPACE_MARKER, " ", 1) if marked else " " + text
                        encoded.append(b"".join(map(ids_of, cutter.findall(source))))
                bounds = np.cumsum([0, *(len(ids) // 4 for ids in encoded)])
                ids = pa.Array.from_buffers(pa.int32(), int(bounds[-1]), [None, pa.py_buffer(b"".join(encoded))])
                yield pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids)

        return encode

    def _constants(self, values: list[str]) -> Column:
        """A constant array of strings; the separator occurs in none of them."""
        return F.split(F.lit("\x1f".join(values)), "\x1f")

    def decode(self, ids: Column) -> Column:
        """Token ids back to text: markers become blanks, byte pieces their bytes; an id outside the vocabulary is an error."""
        surfaces = []
        for token_id, piece in enumerate(self.pieces):
            if token_id == self.special_tokens.get("<unk>"):
                octets = UNKNOWN_SURFACE.encode()
            elif piece in BYTE_PIECES and token_id < len(SPECIAL_TOKENS) + len(BYTE_PIECES):
                octets = bytes([token_id - len(SPECIAL_TOKENS)])
            else:
                octets = piece.replace(SPACE_MARKER, " ").encode()
            surfaces.append(octets)
        shared = self.spark.sparkContext.broadcast(surfaces)

        @F.arrow_udf("binary")
        def octets_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            table = pa.array(shared.value, pa.binary())
            for batch in batches:
                # the bytes of all tokens lie one after the other, so those of a text need bounds only
                bounds = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(batch), 0).to_numpy()))
                taken = table.take(batch.flatten())
                ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1)[bounds] if len(taken) else bounds.astype(np.int32)
                whole = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), taken.buffers()[2]])
                yield pc.if_else(batch.is_valid(), whole, pa.scalar(None, pa.binary()))

        return F.regexp_replace(F.make_valid_utf8(octets_of(ids.cast("array<int>")).cast("string")), "^ ", "")

    def describe(self, ids: Column) -> Column:
        """Label of each special token, visible form of each other piece; an unknown id is an error."""
        table = self._constants(self._visible)
        size = F.lit(self.vocab_size)

        def one(token: Column) -> Column:
            problem = F.raise_error(F.concat(F.lit("unknown token id "), token.cast("string"))).cast("string")
            known = (token >= F.lit(0)) & (token < size)
            return F.when(known, F.element_at(table, F.when(known, token + F.lit(1)).otherwise(F.lit(1)))).otherwise(problem)

        return F.transform(ids, one)

    def byte_fallback_count(self, ids: Column) -> Column:
        """Number of byte pieces among the ids."""
        first = len(SPECIAL_TOKENS)
        is_byte = lambda token: (token >= F.lit(first)) & (token < F.lit(first + len(BYTE_PIECES)))
        return F.size(F.filter(ids, is_byte))

    def unknown_count(self, ids: Column) -> Column:
        unknown = self.special_tokens["<unk>"]
        return F.size(F.filter(ids, lambda token: token == F.lit(unknown)))

    def inspect(self, df: DataFrame, text_column: str) -> DataFrame:
        """Add normalised text, token ids, pieces, decoded text and the vocabulary's facts."""
        encoded = df.withColumn("normalized_text", normalize(F.col(text_column))).withColumn(
            "token_ids", self.encode(F.col(text_column))
        )
        return (
            encoded.withColumn("decoded_text", self.decode(F.col("token_ids")))
            .withColumn("token_pieces", self.describe(F.col("token_ids")))
            .withColumn("vocab_size", F.lit(self.vocab_size))
            .withColumn("special_tokens", F.create_map(*[F.lit(x) for kv in sorted(self.special_tokens.items()) for x in kv]))
        )

    def piece_counts(self, encoded: DataFrame, ids: str = "token_ids") -> DataFrame:
        """``(id, label, piece, count)`` over a table of id arrays, looked up in the vocabulary."""
        counts = encoded.select(F.explode(ids).alias("id")).groupBy("id").agg(F.count("*").alias("count"))
        # both sides have at most one row for each vocabulary entry
        return counts.join(F.broadcast(self.vocab), "id").select("id", "label", "piece", "count")
