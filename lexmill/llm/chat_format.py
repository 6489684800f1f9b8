"""Chat conversations as token ids with a loss mask, and back.

Segments are encoded separately: the text of each turn by a byte-level BPE, the structure by reserved ids above the vocabulary, which no
text can produce. The loss mask is the prefix sum of +1 where an assistant text begins and -1 where it ends. In the rendered
string the reserved ids appear as control strings; the same strings inside a text are escaped, reversibly.

Edge cases: null texts and roles are empty; turns order by (turn, role, text), null turns first; repeated rows are turns of their
own; a null ``conv_id`` is a conversation like any other; unknown roles keep their name and carry no loss; an empty table gives
an empty table; other columns are not read. A conversation is streamed turn by turn, so its length is not bounded by memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lexmill.llm.byte_bpe import codec

RANKS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The role whose texts are learned.
LEARNED_ROLE = "assistant"
#: Control strings of the rendered template, in the order of their reserved ids above the vocabulary.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
TEMPLATE = (TURN, BODY, END)
#: Control strings of other widespread templates; inside a text they are escaped as well.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
#: Opens every escape; U+241B, the picture of the escape character.
ESCAPE = "␛"

ASSEMBLED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("start", pa.int64()),
        ("ids", pa.binary()),
        ("mask_change", pa.binary()),
        ("formatted", pa.string()),
    ]
)
READ_BACK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_tokens", pa.int64()),
        ("loss_tokens", pa.int64()),
    ]
)

_CONTROL = re.compile("|".join(map(re.escape, sorted((ESCAPE, *TEMPLATE, *FOREIGN), key=len, reverse=True))))
_ESCAPED = re.compile(f"{ESCAPE}([{ESCAPE}-])")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)


def escape(text: str) -> str:
    """``text`` without any control string: each gets ``ESCAPE -`` after its first character, an ESCAPE is doubled."""

    def mark(match: re.Match) -> str:
        found = match[0]
        return ESCAPE * 2 if found == ESCAPE else f"{found[0]}{ESCAPE}-{found[1:]}"

    return _CONTROL.sub(mark, text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda match: match[1].replace("-", ""), text)


def reserved_ids(path: str = RANKS_PATH) -> dict[str, int]:
    """The id of each control string: the first ids above the vocabulary."""
    first = len(codec(path).pieces)
    return {control: first + place for place, control in enumerate(TEMPLATE)}


def assemble(df: DataFrame, path: str = RANKS_PATH) -> DataFrame:
    """A row for each turn, in order within a conversation: ``conv_id, start, ids, mask_change, formatted``.

    ``start`` is the turn's first token in its conversation. ``mask_change`` holds, for each token, what the running sum of the loss mask
    gains there. ``formatted`` is the rendered turn. Rows of a conversation stay together in one partition, in order.
    """

    def spliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, marks = codec(path), reserved_ids(path)
        current, start = object(), 0
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))):
                if conv_id != current:
                    current, start = conv_id, 0
                role, text = escape(role), escape(text)
                head = np.frombuffer(coder.encode(role), "<u4")
                body = np.frombuffer(coder.encode(text), "<u4")
                ids = np.concatenate([[marks[TURN]], head, [marks[BODY]], body, [marks[END]]]).astype("<u4")
                change = np.zeros(len(ids), np.int8)
                if role == LEARNED_ROLE:
                    change[len(head) + 2] += 1
                    change[len(ids) - 1] -= 1
                rows.append((conv_id, start, ids.tobytes(), change.tobytes(), f"{TURN}{role}{BODY}{text}{END}"))
                start += len(ids)
            yield _batch(rows, ASSEMBLED)

    turns = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(spliced, from_arrow_schema(ASSEMBLED))


def read_back(assembled: DataFrame, path: str = RANKS_PATH) -> DataFrame:
    """A row for each conversation of `assemble`'s output, from its ids and mask alone.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, loss_tokens``.
    """
    class Reading:
        def __init__(self, conv_id) -> None:
            self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.formatted_chars = self.n_tokens = self.loss_tokens = 0

        def row(self) -> tuple:
            digests = (self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest())
            return (self.conv_id, self.n_turns, *digests, self.formatted_chars, self.n_tokens, self.loss_tokens)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, marks = codec(path), reserved_ids(path)

        def text_of(ids: np.ndarray) -> str:
            return unescape(coder.decode(ids.tobytes()).decode())

        reading = None
        for batch in batches:
            done = []
            for conv_id, _, raw, change, formatted in zip(*(column.to_pylist() for column in batch.columns)):
                if reading is None or reading.conv_id != conv_id:
                    if reading is not None:
                        done.append(reading.row())
                    reading = Reading(conv_id)
                ids = np.frombuffer(raw, "<u4")
                learned = np.cumsum(np.frombuffer(change, np.int8)) > 0
                body, end = np.flatnonzero(ids == marks[BODY])[0], np.flatnonzero(ids == marks[END])[-1]
                role, text = text_of(ids[1:body]), text_of(ids[body + 1 : end])
                reading.turns.update(f"{role}\n{text}\n".encode())
                loss = text_of(ids[learned])
                reading.loss.update(loss.encode())
                reading.loss_chars += len(loss)
                reading.loss_tokens += int(learned.sum())
                reading.n_turns += 1
                reading.n_tokens += len(ids)
                reading.formatted_chars += len(formatted)
            yield _batch(done, READ_BACK)
        if reading is not None:
            yield _batch([reading.row()], READ_BACK)

    return assembled.mapInArrow(read, from_arrow_schema(READ_BACK))
