"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs at line ends, a paragraph into clauses after punctuation, and a clause of more than 192 characters
into runs of 24 words. Each piece, with its number among equal pieces, becomes a 64-bit digest. A sketch adds every digest to
three of its cells: a count and two exclusive-or sums. Two sketches subtract cell by cell; peeling the cells that hold a
single digest recovers those on one side only. If cells are left over, both texts are sketched again four times larger.
The likeness of two texts is the Jaccard index that the recovered difference implies; it is exact.

The fingerprint string holds the number of pieces and the smallest sketch, so equal texts have equal fingerprints.
Edge cases: a null text is empty; an empty text has no pieces and is like another empty text (1) and no other (0); rows
with equal ids order by text; a null id sorts first; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import keyed_texts
from lexmill.llm.peeling import below, mix64

#: Cells of the sketch in a fingerprint, and how much larger each retry is.
BASE_CELLS = 24
GROWTH = 4
#: Longest piece, in words.
RUN_WORDS = 24
#: Rows between two neighbouring bounds of the document order, and the most bounds the driver holds.
BUCKET_ROWS = 2_000
MOST_BUCKETS = 20_000

_CLAUSES = re.compile(r"[^\n.!?;:,]*[\n.!?;:,]+|[^\n.!?;:,]+$")
_CHECK_SEED = 977


def pieces(text: str) -> list[str]:
    """The paragraphs of ``text``, cut at clauses, without outer white space."""
    found = []
    for clause in _CLAUSES.findall(text):
        clause = clause.strip()
        if len(clause) > 8 * RUN_WORDS:
            words = clause.split()
            found.extend(" ".join(words[at : at + RUN_WORDS]) for at in range(0, len(words), RUN_WORDS))
        elif clause:
            found.append(clause)
    return found


def piece_digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of the pieces; the k-th copy of a piece has a digest of its own."""
    counts = Counter(pieces(text))
    copies = [f"{piece}\x00{copy}" for piece, n in counts.items() if n > 1 for copy in range(1, n)]
    return np.fromiter(map(xxhash.xxh64_intdigest, [*counts, *copies]), np.uint64, len(counts) + len(copies))


def _cells(digests: np.ndarray, n_cells: np.ndarray | int, seed: int) -> np.ndarray:
    """Three cells of each digest, one in each third of its sketch, so never the same twice."""
    third = np.asarray(n_cells) // 3
    return np.stack([below(mix64(digests, seed * 3 + part + 1), third) + part * third for part in range(3)])


class Sketch:
    """Many sketches of one size side by side; ``owner`` says which sketch each digest belongs to."""

    def __init__(self, owners: int, n_cells: int) -> None:
        self.n_cells = n_cells
        self.count = np.zeros(owners * n_cells, np.int32)
        self.keys = np.zeros(owners * n_cells, np.uint64)
        self.checks = np.zeros(owners * n_cells, np.uint64)

    def add(self, digests: np.ndarray, owner: np.ndarray, sign: np.ndarray | int = 1) -> None:
        checks = mix64(digests, _CHECK_SEED)
        for cells in _cells(digests, self.n_cells, self.n_cells) + owner * self.n_cells:
            np.add.at(self.count, cells, sign)
            np.bitwise_xor.at(self.keys, cells, digests)
            np.bitwise_xor.at(self.checks, cells, checks)

    def __sub__(self, other: Sketch) -> Sketch:
        difference = Sketch(0, self.n_cells)
        difference.count = self.count - other.count
        difference.keys, difference.checks = self.keys ^ other.keys, self.checks ^ other.checks
        return difference

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digests, owner, sign) recovered, and for each sketch whether it came out empty."""
        found, owners, signs = [], [], []
        while True:
            pure = np.flatnonzero(np.abs(self.count) == 1)
            pure = pure[self.checks[pure] == mix64(self.keys[pure], _CHECK_SEED)]
            if not len(pure):
                break
            owner = pure // self.n_cells
            _, once = np.unique(np.stack([owner.astype(np.uint64), self.keys[pure]]), axis=1, return_index=True)
            digests, owner, sign = self.keys[pure][once], owner[once], self.count[pure][once]
            found.append(digests), owners.append(owner), signs.append(sign)
            self.add(digests, owner, -sign)
        clear = ((self.count == 0) & (self.keys == 0)).reshape(-1, self.n_cells).all(1)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return join(found, np.uint64), join(owners, np.int64), join(signs, np.int32), clear


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), lengths)


def differences(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """For each pair the number of digests on one side only, by subtracting and peeling sketches."""
    sizes = np.zeros(len(left), np.int64)
    waiting, n_cells = np.arange(len(left)), BASE_CELLS
    while len(waiting):
        sides = []
        for sets in (left, right):
            sketch = Sketch(len(waiting), n_cells)
            sketch.add(*_flat([sets[pair] for pair in waiting]))
            sides.append(sketch)
        _, owner, _, clear = (sides[0] - sides[1]).peel()
        recovered = np.bincount(owner, minlength=len(waiting))
        sizes[waiting[clear]] = recovered[clear]
        waiting, n_cells = waiting[~clear], n_cells * GROWTH
    return sizes


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The Jaccard index of each pair of digest sets; two empty sets are alike."""
    total = np.fromiter((len(a) + len(b) for a, b in zip(left, right)), np.float64, len(left))
    different = differences(left, right)
    union = (total + different) / 2
    return np.where(union == 0, 1.0, (total - different) / 2 / np.maximum(union, 1))


def fingerprint_strings(sets: list[np.ndarray]) -> list[str]:
    """``pieces:cells`` for each digest set, the cells in base64."""
    sketch = Sketch(len(sets), BASE_CELLS)
    sketch.add(*_flat(sets))
    parts = [part.reshape(-1, BASE_CELLS) for part in (sketch.count, sketch.keys, sketch.checks.astype("<u2"))]
    return [
        f"{len(digests)}:{base64.b64encode(b''.join(part[row].tobytes() for part in parts)).decode()}"
        for row, digests in enumerate(sets)
    ]


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many (or all) first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next_text(texts: DataFrame) -> DataFrame:
    """``(doc_id, text, next_text)``: the text after each in ascending ``(doc_id, text)`` order; the last takes the first.

    The order is cut at ids that exist, so a bucket ends just before a row that is also sent to it as its sentinel: one
    shuffle of the texts, and no window over the whole table. The bounds are ids only, and their number is fixed.
    """
    ids = texts.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("place"))
    n_rows, least = ids.agg(F.count("*"), F.min("place")).first()
    buckets = min(MOST_BUCKETS, max(1, n_rows // BUCKET_ROWS))
    bounds = np.zeros(0, np.int64)
    if n_rows:
        shares = [bucket / buckets for bucket in range(1, buckets)]
        found = ids.agg(F.percentile_approx("place", shares or [0.5], max(10_000, 20 * buckets))).first()[0]
        bounds = np.unique(np.array([*found, least] if shares else [least], np.int64))

    @F.pandas_udf("array<int>")
    def buckets_of(places: pd.Series) -> pd.Series:
        """The bucket of an id; a bound also goes to the bucket it ends, the least id to the last bucket."""
        values = places.to_numpy(np.int64)
        own = np.searchsorted(bounds, values, "right") - 1
        opens = bounds[own] == values
        return pd.Series([[b, (b - 1) % len(bounds)] if o else [b] for b, o in zip(own.tolist(), opens.tolist())])

    placed = texts.withColumn("place", F.coalesce("doc_id", F.lit(-(2**63))))
    dealt = placed.select("*", F.posexplode(buckets_of("place")).alias("sentinel", "bucket"))
    order = Window.partitionBy("bucket").orderBy("sentinel", "place", "text")
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .filter("sentinel = 0")
        .select("doc_id", "text", "next_text")
    )


def compare_texts(text: Column, following: Column) -> Column:
    """A struct of the fingerprint, the edited text's digest and fingerprint, and both likenesses."""

    @F.pandas_udf(
        "edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_pieces long"
    )
    def compared(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, followings in batches:
            own, known = [], ("", piece_digests(""))
            after, edited, digests = [], [], []
            for text, following in zip(texts, followings):
                own.append(known[1] if known[0] == text else piece_digests(text))
                known = (following, piece_digests(following))
                after.append(known[1])
                changed = edited_text(text, following)
                digests.append(hashlib.sha256(changed.encode()).hexdigest())
                edited.append(piece_digests(changed))
            yield pd.DataFrame(
                {
                    "edited_sha256": digests,
                    "fingerprint": fingerprint_strings(own),
                    "edited_fingerprint": fingerprint_strings(edited),
                    "near_edited": likeness(own, edited),
                    "near_next": likeness(own, after),
                    "n_pieces": [len(found) for found in own],
                }
            )

    return compared(text, following)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of its edited text, and their likenesses."""
    rows = with_next_text(keyed_texts(df, id_col, text_col))
    found = compare_texts(F.col("text"), F.col("next_text")).alias("of")
    compared = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), found)
    return compared.select("doc_id", "n_chars", "of.*")
