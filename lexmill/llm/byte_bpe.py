"""Byte-level BPE by the ranks of a public vocabulary, without special tokens.

A pre-token that is itself in the vocabulary is resolved by a minimal perfect hash over the vocabulary's byte strings; any other
one is merged from single bytes, lowest rank and then leftmost first: the short ones of some rows at once, a merge of each in a numpy round,
a long one by a heap over a linked list. Both tiers are behind a memo of bounded size, because words repeat. Edge cases: a null text is empty and has no ids; the longest text is encoded
whole; repeated rows are encoded each on its own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmill.llm.common import keyed_texts, map_slices

#: The default vocabulary.
RANKS_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Entries of a generation of each memo; the longest piece that enters one.
MEMO_ENTRIES = 150_000
MEMO_CHARS = 40
#: The longest pre-token, in bytes, that is merged together with others; how many are at most.
TOGETHER_BYTES, TOGETHER = 48, 20_000

#: White space other than single blanks between words: there a blank does not simply open the next pre-token.
_IRREGULAR = re.compile(r" \s|[^\S ] |^\s|\s$|[\x1c-\x1f]")


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: buckets choose a seed that places all their keys in free slots.

    ``find`` gives a key's slot, or -1 for a string that is no key.
    """

    def __init__(self, keys: list[bytes], bucket_load: int = 2) -> None:
        self.size = len(keys)
        self.buckets = max(1, -(-self.size // bucket_load))
        self.seeds = np.zeros(self.buckets, np.int64)
        members: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in keys:
            members[xxhash.xxh3_64_intdigest(key) % self.buckets].append(key)
        slots: list[bytes | None] = [None] * self.size
        free = iter(range(self.size))
        for bucket in sorted(range(self.buckets), key=lambda number: -len(members[number])):
            if len(members[bucket]) == 1:
                slot = next(place for place in free if slots[place] is None)
                self.seeds[bucket] = -1 - slot
                slots[slot] = members[bucket][0]
                continue
            seed = 1
            while members[bucket]:
                wanted = {xxhash.xxh3_64_intdigest(key, seed) % self.size: key for key in members[bucket]}
                if len(wanted) == len(members[bucket]) and all(slots[place] is None for place in wanted):
                    for place, key in wanted.items():
                        slots[place] = key
                    break
                seed += 1
            self.seeds[bucket] = seed
        self.keys = slots
        self._seeds = self.seeds.tolist()

    def find(self, key: bytes) -> int:
        seed = self._seeds[xxhash.xxh3_64_intdigest(key) % self.buckets]
        slot = -1 - seed if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.size
        return slot if self.keys[slot] == key else -1


class Memo(dict):
    """A dict that has what it lacks computed, many at a time; when it is full it becomes the older of two generations."""

    def __init__(self, compute: Callable[[list[str]], list[bytes]], entries: int, longest: int = MEMO_CHARS) -> None:
        super().__init__()
        self._compute, self._entries, self._longest = compute, entries, longest
        self._older: dict[str, bytes] = {}

    def find(self, pieces: set[str]) -> dict[str, bytes]:
        """The value of each piece."""
        found = dict(zip(pieces, map(self.get, pieces)))
        unknown = [piece for piece, value in found.items() if value is None]
        older = map(self._older.get, unknown)
        new = {piece: value for piece, value in zip(unknown, older) if value is not None}
        unknown = [piece for piece in unknown if piece not in new]
        new.update(zip(unknown, self._compute(unknown)))
        found.update(new)
        for piece, value in new.items():
            if len(piece) <= self._longest:
                if len(self) >= self._entries:
                    self._older = dict(self)
                    self.clear()
                self[piece] = value
        return found


class PairRanks:
    """The rank of the merge of two tokens, by their ranks, for arrays of pairs."""

    #: Stands for pairs that do not merge.
    NONE = 1 << 32

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._width = max(ranks.values(), default=0) + 1
        splits = [
            (ranks[piece[:at]] * self._width + ranks[piece[at:]], rank)
            for piece, rank in ranks.items()
            for at in range(1, len(piece))
            if piece[:at] in ranks and piece[at:] in ranks
        ]
        pairs, merged = np.array(splits, np.int64).reshape(-1, 2).T
        order = np.argsort(pairs)
        self._pairs, self._merged = np.append(pairs[order], -1), np.append(merged[order], self.NONE)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left * self._width + right
        places = np.searchsorted(self._pairs[:-1], pairs)
        return np.where(self._pairs[places] == pairs, self._merged[places], self.NONE)


def _chunks_of(text: str) -> list[str]:
    if not text or _IRREGULAR.search(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *[" " + word for word in rest]]


class ByteCodec:
    """Encoder and decoder of one rank file. Ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
        self.hash = PerfectHash(list(ranks))
        self.id_of_slot = [struct.pack("<I", ranks[key]) for key in self.hash.keys]
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self._ranks = ranks
        self._pattern = regex.compile(pattern)
        self._words = Memo(self._encode_words, MEMO_ENTRIES)
        self._chunks = Memo(self._encode_chunks, MEMO_ENTRIES)
        singles = [ranks.get(bytes([byte])) for byte in range(256)]
        self._together = None not in singles
        if self._together:
            self._pairs, self._byte_ranks = PairRanks(ranks), np.array(singles, np.int64)
            self._byte_pairs = self._pairs.of(np.repeat(self._byte_ranks, 256), np.tile(self._byte_ranks, 256))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        raws = [word.encode() for word in words]
        found: list[bytes] = [b""] * len(raws)
        short = []
        for number, (raw, slot) in enumerate(zip(raws, map(self.hash.find, raws))):
            if slot >= 0:
                found[number] = self.id_of_slot[slot]
            elif self._together and len(raw) <= TOGETHER_BYTES:
                short.append(number)
            else:
                found[number] = np.array(self.merge(raw), "<u4").tobytes()
        for start in range(0, len(short), TOGETHER):
            part = short[start : start + TOGETHER]
            for number, ids in zip(part, self.merge_together([raws[number] for number in part])):
                found[number] = ids
        return found

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        split = list(map(self._pattern.findall, chunks))
        found = self._words.find(set(chain.from_iterable(split)))
        return [found[words[0]] if len(words) == 1 else b"".join([found[word] for word in words]) for words in split]

    def merge_together(self, raws: list[bytes]) -> list[bytes]:
        """The ids of short byte strings: each round merges in every one of them its pair of lowest rank, the leftmost of equals."""
        by_size: dict[int, list[int]] = {}
        for number, raw in enumerate(raws):
            by_size.setdefault(len(raw), []).append(number)
        found: list[bytes] = [b""] * len(raws)
        for size, numbers in by_size.items():
            whole = np.frombuffer(b"".join([raws[number] for number in numbers]), np.uint8).astype(np.int64).reshape(-1, size)
            numbers, ids = np.array(numbers), self._byte_ranks[whole]
            # the column at the end stands for no further merge
            ranks = np.full(whole.shape, PairRanks.NONE)
            ranks[:, :-1] = self._byte_pairs[whole[:, :-1] * 256 + whole[:, 1:]]
            while len(numbers):
                places = ranks.argmin(1)
                lowest = ranks[np.arange(len(ids)), places]
                done = lowest == PairRanks.NONE
                if done.any():
                    for number, part in zip(numbers[done].tolist(), ids[done].astype("<u4")):
                        found[number] = part.tobytes()
                    left = ~done
                    numbers, ids, ranks, places, lowest = numbers[left], ids[left], ranks[left], places[left], lowest[left]
                    if not len(numbers):
                        break
                rows, last = np.arange(len(ids)), ids.shape[1] - 1
                # the right token of the pair goes, all after it move up by one
                ids[rows, places] = lowest
                stay = np.ones(ids.shape, bool)
                stay[rows, places + 1] = False
                ids, ranks = ids[stay].reshape(-1, last), ranks[stay].reshape(-1, last)
                ranks[rows, places] = PairRanks.NONE
                right = np.flatnonzero(places < last - 1)
                ranks[right, places[right]] = self._pairs.of(ids[right, places[right]], ids[right, places[right] + 1])
                left = np.flatnonzero(places > 0)
                ranks[left, places[left] - 1] = self._pairs.of(ids[left, places[left] - 1], ids[left, places[left]])
        return found

    def merge(self, raw: bytes) -> list[int]:
        """Merge single bytes by a heap of (rank, position) over a doubly linked list."""
        ranks, size = self._ranks, len(raw)
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        alive = [True] * size
        heap = []
        for start in range(size - 1):
            rank = ranks.get(raw[start : start + 2])
            if rank is not None:
                heap.append((rank, start, start + 2))
        heapify(heap)
        while heap:
            rank, start, stop = heappop(heap)
            if not alive[start]:
                continue
            right = end[start]
            if right >= size or end[right] != stop:
                continue  # one of the two was merged meanwhile
            alive[right] = False
            end[start] = stop
            if stop < size:
                before[stop] = start
                wider = ranks.get(raw[start : end[stop]])
                if wider is not None:
                    heappush(heap, (wider, start, end[stop]))
            left = before[start]
            if left >= 0:
                wider = ranks.get(raw[left:stop])
                if wider is not None:
                    heappush(heap, (wider, left, stop))
        ids, start = [], 0
        while start < size:
            ids.append(ranks[raw[start : end[start]]])
            start = end[start]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as bytes."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes.

        No pre-token reaches over a blank between two words, so regular texts are encoded word by word.
        """
        split = list(map(_chunks_of, texts))
        found = self._chunks.find(set(chain.from_iterable(split)))
        return [b"".join(map(found.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def codec(path: str) -> ByteCodec:
    """One codec for each Python worker and rank file."""
    return ByteCodec(path)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS_PATH) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: the ids of each text as little-endian unsigned 32-bit integers."""
    texts = keyed_texts(df, id_col, text_col)
    id_type = to_arrow_type(texts.schema["doc_id"].dataType)
    schema = pa.schema([("doc_id", id_type), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def work(doc_ids: list, texts: list[str]) -> list[list]:
        ids = codec(path).encode_all(texts)
        return [doc_ids, [len(part) // 4 for part in ids], ids]

    return map_slices(texts, work, schema)


def decode(df: DataFrame, ids_col: str = "ids", path: str = RANKS_PATH) -> DataFrame:
    """``df`` with the ``decoded`` bytes of its ids; null ids stay null."""

    @F.pandas_udf("binary")
    def bytes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield ids.map(codec(path).decode, na_action="ignore")

    return df.withColumn("decoded", bytes_of(ids_col))


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS_PATH) -> DataFrame:
    """`encode` and `decode` in one pass: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    texts = keyed_texts(df, id_col, text_col)
    id_type = to_arrow_type(texts.schema["doc_id"].dataType)
    schema = pa.schema(
        [("doc_id", id_type), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def work(doc_ids: list, texts: list[str]) -> list[list]:
        coder, counts, digests, decoded = codec(path), [], [], []
        for ids in coder.encode_all(texts):
            counts.append(len(ids) // 4)
            digests.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return [doc_ids, counts, digests, decoded]

    return map_slices(texts, work, schema)
