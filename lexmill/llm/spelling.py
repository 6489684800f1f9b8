"""Spelling variants: words one edit from a far more frequent word, found by asymmetric chunks.

A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]``, only A-Z lowered, of at least 7 code points and at least 2 occurrences. Two
words are near if exactly one code point is inserted, deleted or replaced. A word's form is its near word with the most
occurrences (ties: the least in code-point order), if that has ten times the word's own; its root is where the forms lead.

The shorter word of a pair (of two equally long ones: either) gives two disjoint chunks, its halves; the other gives its grams of these
lengths at their places. One edit leaves a half as it is: the first at its place, the second shifted by the difference of the lengths,
which is one at most. So the join on (length, half, gram) meets every near pair; each met pair is verified by its edit distance, and a
pair that both halves meet counts by the first. A half that crowds, as a usual beginning does, is not paired: what is left of the word is
within one edit as well, so it is halved again and the join is on the half and one of its two quarters. Its work then
grows with the words that agree in three quarters of their letters.

Counts cover every whole text. Edge cases: a null text has no words; a null ``doc_id`` counts as an empty string before the colon;
repeated rows count again; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lexmill.llm.common import SLICE_ROWS, checkpointed, keyed_texts
from lexmill.session import broadcast_if_small

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form has this many times the word's occurrences.
FACTOR = 10
#: One in this many runs loses a code point.
DAMAGED = 31
#: Keys with more words than this on either side are joined by halves and quarters.
CROWD = 64
#: Distinct runs that a task counts before it hands them on.
HELD = 1 << 17

#: The runs in lowered UTF-8: U+00C0 to U+00FF are C3 80 to C3 BF there.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _without(run: bytes, place: int) -> bytes:
    text = run.decode()
    place %= len(text)
    return (text[:place] + text[place + 1 :]).encode()


def words_of(doc_id: str, text: bytes) -> Counter[bytes]:
    """The runs of a UTF-8 text, damaged by the crc32 of ``<doc_id>:<run>``, with their occurrences."""
    start = zlib.crc32(f"{doc_id}:".encode())
    found: Counter[bytes] = Counter()
    for run, n in Counter(_RUN.findall(text.lower())).items():
        drawn = zlib.crc32(run, start)
        found[_without(run, drawn) if drawn % DAMAGED == 0 else run] += n
    return found


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all runs that are long and frequent enough."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def batch_of(counts: Counter[bytes]) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    # a byte can make half a code point, so this drops nothing that is long enough
                    counts.update({w: n for w, n in words_of(doc_id, text).items() if len(w) >= LEAST_LENGTH})
                    if len(counts) > HELD:
                        yield batch_of(counts)
                        counts = Counter()
        if counts:
            yield batch_of(counts)

    texts = keyed_texts(df, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.encode("text", "UTF-8")
    )
    counted = texts.mapInArrow(run, from_arrow_schema(schema)).filter(F.char_length("word") >= LEAST_LENGTH)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _part(word: Column, start: Column, length: Column) -> Column:
    """Code points of the word from ``start``, counted from 0; none if ``start`` is behind its end."""
    return F.substring(word, start + 1, length)


def _halves(word: Column, short: Column) -> list[tuple[Column, Column]]:
    """For each half of a word of ``short`` letters: the gram of ``word`` that stands where it must, and what is left of ``word``."""
    length = F.char_length(word)
    first = F.floor(short / 2).cast("int")
    second = first + length - short
    return [
        (_part(word, F.lit(0), first), _part(word, first, length)),
        (_part(word, second, length), _part(word, F.lit(0), second)),
    ]


def _coarse(word: Column, short: Column) -> list[Column]:
    """``(short, half, gram)`` of each half."""
    return [
        F.struct(short.alias("short"), F.lit(half).alias("half"), gram.alias("gram"))
        for half, (gram, _) in enumerate(_halves(word, short))
    ]


def _fine(word: Column, short: Column) -> list[Column]:
    """``(short, half, gram, quarter, piece)``: each half with each quarter of what the short word has left."""
    keys = []
    first = F.floor(short / 2).cast("int")
    for half, (gram, rest) in enumerate(_halves(word, short)):
        left = short - first if half == 0 else first
        for quarter, (piece, _) in enumerate(_halves(rest, left)):
            names = {"short": short, "half": F.lit(half), "gram": gram, "quarter": F.lit(quarter), "piece": piece}
            keys.append(F.struct(*[value.alias(name) for name, value in names.items()]))
    return keys


_COARSE, _FINE = ["short", "half", "gram"], ["short", "half", "gram", "quarter", "piece"]


def _chunks(words: DataFrame, keys) -> DataFrame:
    """The chunks of each word as the shorter one of a pair."""
    length = F.char_length("word")
    return words.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.inline(F.array(*keys(F.col("word"), length))))


def _grams(words: DataFrame, keys) -> DataFrame:
    """The grams of each word as the longer one of a pair, or as the greater of two equally long ones."""
    length = F.char_length("word")
    shorts = [length, length - 1]
    all_keys = F.array(*[key for short in shorts for key in keys(F.col("word"), short)])
    return words.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.inline(all_keys))


def _verified(met: DataFrame) -> DataFrame:
    """Of pairs that share a chunk those with one edit; a pair that both halves meet is taken with the first."""
    first = F.floor(F.col("short") / 2).cast("int")
    by_first = _part(F.col("a"), F.lit(0), first) == _part(F.col("b"), F.lit(0), first)
    once = (F.col("half") == 0) | ~by_first
    ordered = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    near = F.levenshtein("a", "b", 1) == 1
    return met.filter(ordered).filter(once).filter(near).select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: each pair of near words of ``words(word, n)`` once."""
    chunks, grams = _chunks(words, _coarse), _grams(words, _coarse)
    sizes = chunks.groupBy(*_COARSE).count().unionByName(grams.groupBy(*_COARSE).count())
    crowds = sizes.filter(F.col("count") > CROWD).select(*_COARSE).distinct()
    crowds = broadcast_if_small(checkpointed(crowds), 48)
    few = chunks.join(crowds, _COARSE, "left_anti").join(grams, _COARSE)
    fine = [side.join(crowds, _COARSE, "left_semi") for side in (_chunks(words, _fine), _grams(words, _fine))]
    fine = _verified(fine[0].join(fine[1], _FINE)).distinct()
    return _verified(few).unionByName(fine)


def _forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(word, form, n, n_near, form_n)`` of every word."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    grouped = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(grouped, "word", "left")
    taken = -F.col("best.minus_n") >= FACTOR * F.col("n")
    return joined.select(
        "word",
        F.when(taken, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, -F.col("best.minus_n")).alias("form_n"),
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form. A form is ten times as frequent as its word, so paths are short and never loop."""
    current = checkpointed(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = broadcast_if_small(current.select(F.col("word").alias("of"), F.col("root").alias("further")), 64)
        jumped = checkpointed(current.join(onward, F.col("root") == F.col("of"), "left").drop("of"))
        moved = not jumped.filter("further is not null").isEmpty()
        current = jumped.select("word", F.coalesce("further", "root").alias("root"))
        if not moved:
            return current


def group_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the texts."""
    words = checkpointed(word_counts(df, id_col, text_col))
    forms = checkpointed(_forms(words, near_pairs(words)))
    joined = forms.join(_roots(forms), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
