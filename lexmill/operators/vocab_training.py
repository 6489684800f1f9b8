"""Byte-fallback BPE training as DataFrame jobs.

Words are counted once over the corpus; the merge loop then touches only the table of distinct
words. A phase cuts these at pairs too rare for its merges and counts the distinct runs that are left. Each of its rounds picks as many merges
as can be proven to be the next ones of one-at-a-time greedy merging, applies them to the runs that hold them, and updates the counts by the
difference these make.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill.config import SPECIAL_TOKENS, TrainingConfig
from lexmill.operators.merge_plan import RoundPlan
from lexmill.functions.text import SPACE_MARKER, encode_hex, visible
from lexmill.session import BROADCAST_LIMIT_BYTES, StepTables, broadcast_if_small

MERGE_SCHEMA = "rank int, left string, right string, piece string, count long"
VOCAB_SCHEMA = "id int, special boolean, label string, piece string"
BYTE_PIECES = tuple(f"<0x{value:02X}>" for value in range(256))
FIRST_FREE_ID = len(SPECIAL_TOKENS) + len(BYTE_PIECES)
#: Once a round changes at most this share of the open words, later ones find theirs by an index of pairs.
SPARSE_SHARE = 0.2
#: Rounds that are replayed on the words found before all words and their index are written anew.
REPLAYED_ROUNDS = 8
#: Merges that the first phase aims at, those of a later one in proportion to those before it, and how many pairs more than that a phase keeps. They
#: steer the cost alone: a phase that ends too early is followed by another, pairs too many make more runs.
PHASE_MERGES, PHASE_GROWTH, SPARE_PAIRS = 256, 3, 32
#: Memory of one word number in a broadcast: eight bytes, a few times that when hashed.
NUMBER_BYTES = 64


def words_of(text: Column) -> Column:
    """Words of a training line: a blank before a word becomes its marker, as does the start of the line.

    Words cross neither blank nor newline. A marker character in the data is no blank, so it cuts
    words and is left to the byte pieces.
    """
    cut = F.replace(text, F.lit(SPACE_MARKER), F.lit("\n"))
    marked = F.concat(F.lit(SPACE_MARKER), F.replace(cut, F.lit(" "), F.lit(" " + SPACE_MARKER)))
    return F.filter(F.split(marked, "[ \n]"), lambda word: word != "")


def word_frequency(lines: DataFrame) -> DataFrame:
    """``(word, freq)`` over weighted training lines ``(text, weight)``."""
    words = lines.select(F.explode(words_of(F.col("text"))).alias("word"), "weight")
    return words.groupBy("word").agg(F.sum(F.col("weight").cast("long")).alias("freq")).filter("freq > 0")


def alphabet(words: DataFrame) -> DataFrame:
    """``(ch, freq)``: every character of the training words; the coverage is complete."""
    characters = words.select(F.explode(F.split("word", "")).alias("ch"), "freq")
    return characters.groupBy("ch").agg(F.sum("freq").alias("freq"))


def split_symbols(words: DataFrame) -> DataFrame:
    """Words as blank-separated symbols, at first their characters: ``(symbols, freq)``."""
    return words.select(F.array_join(F.split("word", ""), " ").alias("symbols"), "freq")


def _contexts(padded: Column) -> Column:
    """Every symbol of a word with its two neighbours, from its symbols between two empty strings."""
    size = F.size(padded)
    pairs = F.zip_with(
        F.slice(padded, F.lit(1), size - 2),
        F.slice(padded, F.lit(2), size - 2),
        lambda left, mid: F.struct(left.alias("left"), mid.alias("mid")),
    )
    return F.zip_with(
        pairs,
        F.slice(padded, F.lit(3), size - 2),
        lambda pair, right: F.struct(pair["left"].alias("left"), pair["mid"].alias("mid"), right.alias("right")),
    )


def _exploded(words: DataFrame, symbols: Column, freq: Column) -> DataFrame:
    outside = F.array(F.lit(""))
    # split once, in a projection of its own below the explode
    padded = words.select(F.concat(outside, F.split(symbols, " "), outside).alias("padded"), freq.alias("count"))
    return padded.select(F.explode(_contexts(F.col("padded"))).alias("at"), "count").select("at.*", "count")


def context_counts(symbols: DataFrame) -> DataFrame:
    """``(left, mid, right, count)`` of symbols in context, weighted by word frequency."""
    contexts = _exploded(symbols, F.col("symbols"), F.col("freq"))
    return contexts.groupBy("left", "mid", "right").agg(F.sum("count").alias("count"))


def pair_counts(contexts: DataFrame) -> DataFrame:
    """``(left, right, count)`` of adjacent symbols, from their contexts."""
    pairs = contexts.filter("left != ''").groupBy("left", F.col("mid").alias("other"))
    return pairs.agg(F.sum("count").alias("count")).withColumnRenamed("other", "right")


def best_pairs(pairs: DataFrame, max_piece_length: int, limit: int) -> DataFrame:
    """The leading pairs in merge order: higher count, shorter piece, bytewise smaller piece, smaller left."""
    return (
        pairs.withColumn("piece", F.concat("left", "right"))
        .filter(F.char_length("piece") <= max_piece_length)
        .orderBy(F.desc("count"), F.char_length("piece"), "piece", "left")
        .limit(limit)
    )


def contexts_of(contexts: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """The contexts that hold one of a few pairs on either side."""
    wanted = ", ".join(_sql_string(f"{left} {right}") for left, right in pairs)
    return contexts.filter(f"concat_ws(' ', left, mid) in ({wanted}) or concat_ws(' ', mid, right) in ({wanted})")


def _sql_string(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def merge_passes(merges: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """Cut the merges of a round into runs whose occurrences cannot overlap, so that each run is one pass."""
    passes: list[list[tuple[str, str]]] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    for left, right in merges:
        if not passes or left in rights or right in lefts:
            passes.append([])
            lefts, rights = set(), set()
        passes[-1].append((left, right))
        lefts.add(left)
        rights.add(right)
    return passes


def apply_merges(symbols: Column, merges: list[tuple[str, str]]) -> Column:
    """Join the merged pairs of blank-separated symbols: one regular expression for each pass."""
    for pairs in merge_passes(merges):
        choices = "|".join(f"({_quoted(left)}) ({_quoted(right)})" for left, right in pairs)
        groups = "".join(f"${index}" for index in range(1, 2 * len(pairs) + 1))
        symbols = F.regexp_replace(symbols, f"(?<![^ ])(?:{choices})(?![^ ])", groups)
    return symbols


def _quoted(symbol: str) -> str:
    """A symbol as a literal in a Java regular expression."""
    return re.sub(r"([!-/:-@\[-`{-~])", r"\\\1", symbol)


def merge_words(symbols: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """Words before and after a round: ``(symbols, merged, freq)``."""
    return symbols.withColumn("merged", apply_merges(F.col("symbols"), merges))


def context_changes(words: DataFrame) -> DataFrame:
    """What a round changes in the context counts: each word loses its contexts before and gains those after it."""
    lost = F.struct(F.col("symbols").alias("symbols"), (-F.col("freq")).alias("freq"))
    gained = F.struct(F.col("merged").alias("symbols"), F.col("freq").alias("freq"))
    versions = words.select(F.explode(F.array(lost, gained)).alias("version")).select("version.*")
    return _exploded(versions, F.col("symbols"), F.col("freq"))


def summed_contexts(*parts: DataFrame) -> DataFrame:
    """Context counts as the sum of counts and changes; contexts that no word has any more are left out."""
    moved = functools.reduce(DataFrame.unionByName, parts)
    return moved.groupBy("left", "mid", "right").agg(F.sum("count").alias("count")).filter("count > 0")


def open_words(words: DataFrame) -> DataFrame:
    """The merged words that can merge further: those of more than one symbol."""
    return words.select(F.col("merged").alias("symbols"), "freq").filter(F.col("symbols").contains(" "))


def pair_index(words: DataFrame) -> DataFrame:
    """Inverted index ``(pair, id)`` of words ``(id, symbols)``: a pair is two adjacent symbols with a blank between them.

    It stays in the partitions of the words, sorted by pair in each, so a pair that most words hold is in no single task, and
    a scan for a few pairs skips most pages.
    """
    symbols = words.select("id", F.split("symbols", " ").alias("at"))
    held = F.zip_with(
        F.slice("at", F.lit(1), F.size("at") - 1),
        F.slice("at", F.lit(2), F.size("at") - 1),
        lambda left, right: F.concat_ws(" ", left, right),
    )
    return symbols.select(F.explode(F.array_distinct(held)).alias("pair"), "id").sortWithinPartitions("pair")


class _Pairs:
    """The symbols of a batch of blank-separated words, and its pairs: ``kinds`` as numbers, ``kind_of`` each place where one symbol follows another."""

    def __init__(self, words: pa.Array):
        lists = pc.split_pattern(words, " ")
        self.bounds = lists.offsets.to_numpy().astype(np.int64)
        self.symbols = lists.flatten().dictionary_encode()
        ids = self.symbols.indices.to_numpy().astype(np.int64)
        self.width = len(self.symbols.dictionary)
        follows = np.ones(len(ids), bool)
        follows[self.bounds[:-1]] = False  # a word has a symbol at least
        self.places = np.flatnonzero(follows)
        self.kinds, self.kind_of = np.unique(ids[self.places - 1] * self.width + ids[self.places], return_inverse=True)

    def parts(self) -> tuple[pa.Array, pa.Array]:
        names = self.symbols.dictionary
        return names.take(pa.array(self.kinds // max(self.width, 1))), names.take(pa.array(self.kinds % max(self.width, 1)))


def adjacent_counts(symbols: DataFrame) -> DataFrame:
    """``(left, right, count)`` of adjacent symbols, weighted by word frequency; added up in the tasks first."""
    schema = pa.schema([("left", pa.string()), ("right", pa.string()), ("count", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pairs = _Pairs(batch.column("symbols"))
            freq = np.repeat(batch.column("freq").to_numpy(), np.diff(pairs.bounds))[pairs.places]
            counts = np.zeros(len(pairs.kinds), np.int64)
            np.add.at(counts, pairs.kind_of, freq)
            yield pa.RecordBatch.from_arrays([*pairs.parts(), pa.array(counts)], schema=schema)

    parts = symbols.select("symbols", "freq").mapInArrow(count, "left string, right string, count long")
    return parts.groupBy("left", "right").agg(F.sum("count").alias("count"))


def frequent_runs(symbols: DataFrame, frequent: set[tuple[str, str]]) -> DataFrame:
    """``(symbols, freq)`` of the runs of two symbols and more in which every pair is one of a few; equal runs are one row."""
    schema = pa.schema([("symbols", pa.string()), ("freq", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pairs = _Pairs(batch.column("symbols"))
            kept = np.array([pair in frequent for pair in zip(*(part.to_pylist() for part in pairs.parts()))], bool)
            begins = np.ones(len(pairs.symbols), bool)
            begins[pairs.places[kept[pairs.kind_of]]] = False
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], len(begins))
            freq = np.repeat(batch.column("freq").to_numpy(), np.diff(pairs.bounds))[starts]
            texts = pairs.symbols.dictionary.take(pairs.symbols.indices)
            runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(begins)), pa.int32()), texts), " ")
            found = pa.table([runs, freq], names=["symbols", "freq"]).filter(pa.array(ends - starts > 1))
            summed = found.group_by("symbols").aggregate([("freq", "sum")]).rename_columns(["symbols", "freq"])
            yield from summed.cast(schema).to_batches()

    runs = symbols.select("symbols", "freq").mapInArrow(cut, "symbols string, freq long")
    return runs.groupBy("symbols").agg(F.sum("freq").alias("freq"))


def phase_pairs(symbols: DataFrame, max_piece_length: int, limit: int) -> tuple[set[tuple[str, str]], int]:
    """The most frequent pairs, at most ``limit``, and the count that all of them and no other reach; a count of 1 means all pairs.

    A merge joins its parts between two symbols of today, at all its places, so it is at most as frequent as that pair is now. So merges that reach the
    count join only these pairs, wherever these occur, and the rest of a word does not matter to them.
    """
    eligible = adjacent_counts(symbols).filter(F.char_length("left") + F.char_length("right") <= max_piece_length)
    ranked = eligible.orderBy(F.desc("count")).limit(limit + 1).collect()
    least = ranked[limit]["count"] + 1 if len(ranked) > limit else 1
    frequent = {(row["left"], row["right"]) for row in ranked if row["count"] >= least}
    # of equal counts throughout, none can be left out
    return frequent, least if frequent else 1


class WordTables:
    """The open words of a training run, or the runs of them that a phase needs, and the counts of their symbols in context, from round to round.

    As long as a round changes many words, it rewrites all of them. Once a round changes at most `SPARSE_SHARE` of them, the words are
    numbered and an inverted index from pairs to numbers is written. From then on a round looks up the words that hold a merged pair,
    replays on them the rounds since the index was written, and writes the changes of the counts alone. After `replayed`
    rounds words, index and counts are written anew.

    A merged pair may hold symbols that are younger than the index. The last old symbol of its left part and the first one of its right
    part were neighbours when the index was written, so that pair is the one to look up. It may find words that hold the
    merged pair no more; these lose and gain the same contexts.
    """

    def __init__(self, symbols: DataFrame, sparse_share: float, replayed: int):
        self._sparse_share, self._replayed = sparse_share, replayed
        self._steps = StepTables(symbols.sparkSession)
        self._words = self._steps.write(symbols)
        self._contexts = self._steps.write(context_counts(self._words))
        self._index: DataFrame | None = None
        self._numbered = 0
        self._changes: list[DataFrame] = []
        self._pending: list[list[tuple[str, str]]] = []
        self._first: dict[str, set[str]] = {}
        self._last: dict[str, set[str]] = {}
        #: Rounds that rewrote all words, rounds that looked their words up, and index builds.
        self.dense = self.sparse = self.builds = 0

    def leading(self, max_piece_length: int, limit: int) -> list:
        pairs = pair_counts(self._counts())
        return best_pairs(pairs.filter("count > 0"), max_piece_length, limit).collect()

    def nearby(self, pairs: list[tuple[str, str]]) -> list:
        """The contexts of a few pairs; these are bounded by the pairs and the symbols beside them."""
        return summed_contexts(contexts_of(self._counts(), pairs)).collect()

    def apply(self, merges: list[tuple[str, str]]) -> None:
        if self._index is None:
            self._rewrite(merges)
        else:
            self._look_up(merges)

    def clear(self) -> None:
        self._steps.clear()

    def _counts(self) -> DataFrame:
        """Counts and changes, not yet summed."""
        return self._steps.together(self._contexts, *self._changes)

    def _rewrite(self, merges: list[tuple[str, str]]) -> None:
        self.dense += 1
        seen = Observation()
        differs = F.col("merged") != F.col("symbols")
        words = merge_words(self._words, merges)
        merged = self._steps.write(words.observe(seen, F.count("*").alias("words"), F.count_if(differs).alias("changed")))
        self._contexts = self._steps.write(summed_contexts(self._contexts, context_changes(merged.filter(differs))))
        self._words = open_words(merged)
        if seen.get["changed"] <= self._sparse_share * seen.get["words"]:
            self._write_index()
        else:
            self._steps.keep(merged, self._contexts)

    def _write_index(self) -> None:
        self.builds += 1
        seen = Observation()
        numbered = self._words.withColumn("id", F.monotonically_increasing_id())
        self._words = self._steps.write(numbered.observe(seen, F.count("*").alias("words")))
        self._numbered = seen.get["words"]
        self._index = self._steps.write(pair_index(self._words))
        self._changes, self._pending, self._first, self._last = [], [], {}, {}
        self._steps.keep(self._words, self._index, self._contexts)

    def _look_up(self, merges: list[tuple[str, str]]) -> None:
        self.sparse += 1
        wanted = {
            f"{last} {first}"
            for left, right in merges
            for last in self._last.get(left, {left})
            for first in self._first.get(right, {right})
        }
        found = self._index.filter(" or ".join(f"pair = {_sql_string(pair)}" for pair in sorted(wanted)))
        numbers = found.select("id").distinct()
        if self._numbered * NUMBER_BYTES <= BROADCAST_LIMIT_BYTES:
            numbers = F.broadcast(numbers)
        else:
            # written first, as it is counted before it is joined
            numbers = broadcast_if_small(self._steps.write(numbers), NUMBER_BYTES)
        held = self._words.join(numbers, "id", "left_semi")
        before = held.select(self._replay().alias("symbols"), "freq")
        changes = context_changes(merge_words(before, merges))
        changes = changes.groupBy("left", "mid", "right").agg(F.sum("count").alias("count")).filter("count <> 0")
        self._changes.append(self._steps.write(changes))
        self._steps.keep(self._words, self._index, self._contexts, *self._changes)
        self._pending.append(merges)
        for left, right in merges:
            # a piece that was there before the merge goes on standing for itself as well
            for ends, part in ((self._first, left), (self._last, right)):
                ends.setdefault(left + right, {left + right}).update(ends.get(part, {part}))
        if len(self._pending) >= self._replayed:
            self._contexts = self._steps.write(summed_contexts(self._counts()))
            self._words = open_words(self._words.select(self._replay().alias("merged"), "freq"))
            self._write_index()

    def _replay(self) -> Column:
        return functools.reduce(apply_merges, self._pending, F.col("symbols"))


@dataclass
class Training:
    """Result of a training run: the merge list in order, the alphabet in order, the rounds taken, those of them that
    found their words by the index of pairs, and how often that index was written."""

    merges: list[tuple]
    characters: list[str]
    rounds: int
    indexed_rounds: int = 0
    index_builds: int = 0


def train_merges(
    words: DataFrame,
    config: TrainingConfig,
    report: Callable[[int], None] = lambda done: None,
    sparse_share: float = SPARSE_SHARE,
    replayed: int = REPLAYED_ROUNDS,
) -> Training:
    """Learn merges from ``(word, freq)`` until the vocabulary is full or no pair is left; ``report`` hears of the merges after each round.

    Merges come in phases. A phase counts the pairs of all words, keeps the most frequent ones and has its rounds on the runs that these make up,
    as long as the next merge is as frequent as they are; then its merges are applied to the words. Runs are few, as they repeat far more than
    words do, so words are read twice and written once in a phase instead of in each round. Where all pairs are kept, the runs are the words.

    The driver sees the leading pairs of a round and their contexts and the pairs of a phase, a few times the merges at most, never words. Tables are
    written beside the checkpoints and replaced ones are deleted, so plans stay short, a lost executor costs one round at most, and the disk in
    use does not grow with the rounds. ``sparse_share`` and ``replayed`` steer the cost alone (see :class:`WordTables`).
    """
    spark = words.sparkSession
    steps = StepTables(spark)
    # a small table of words is much work to expand, so it keeps all its partitions
    spread = words.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    symbols = steps.write(split_symbols(spread))
    capacity = config.vocab_size - FIRST_FREE_ID
    # the alphabet must fit the vocabulary, so no more than that is fetched
    letters = alphabet(symbols.select(F.replace("symbols", F.lit(" "), F.lit("")).alias("word"), "freq"))
    found = letters.orderBy(F.desc("freq"), "ch").limit(max(capacity, 0) + 1).collect()
    characters = [row["ch"] for row in found]
    if SPACE_MARKER not in characters:
        characters.append(SPACE_MARKER)
    if len(characters) > capacity:
        steps.clear()
        raise ValueError(
            f"vocab_size {config.vocab_size} has no room for the alphabet and {FIRST_FREE_ID} fixed pieces"
        )
    known = set(characters)
    merges: list[tuple] = []
    rounds = indexed_rounds = index_builds = 0
    exhausted = False
    while len(known) < capacity and not exhausted:
        aim = min(capacity - len(known), max(PHASE_MERGES, PHASE_GROWTH * len(merges)))
        frequent, least = phase_pairs(symbols, config.max_piece_length, aim + SPARE_PAIRS)
        tables = WordTables(symbols if least == 1 else frequent_runs(symbols, frequent), sparse_share, replayed)
        applied: list[list[tuple[str, str]]] = []
        while len(known) < capacity:
            leading = tables.leading(config.max_piece_length, config.candidates_per_round)
            # a pair that the runs lack has a lower count than this
            if not leading or leading[0]["count"] < least:
                exhausted = least == 1
                break
            pairs = [(row["left"], row["right"], row["count"]) for row in leading]
            nearby = tables.nearby([pair[:2] for pair in pairs])
            plan = RoundPlan(pairs, nearby, known, config.max_piece_length)
            accepted = list(itertools.takewhile(lambda merge: merge[2] >= least, plan.take(capacity - len(known))))
            for left, right, count in accepted:
                merges.append((len(merges), left, right, left + right, count))
                known.add(left + right)
            if len(known) >= capacity:
                break
            rounds += 1
            report(len(merges))
            applied.append([pair[:2] for pair in accepted])
            tables.apply(applied[-1])
        tables.clear()
        indexed_rounds, index_builds = indexed_rounds + tables.sparse, index_builds + tables.builds
        if len(known) < capacity and not exhausted:
            merged = functools.reduce(apply_merges, applied, F.col("symbols"))
            symbols = steps.write(open_words(symbols.select(merged.alias("merged"), "freq")))
            steps.keep(symbols)
    steps.clear()
    return Training(merges, characters, rounds, indexed_rounds, index_builds)


def merge_table(spark: SparkSession, training: Training) -> DataFrame:
    return spark.createDataFrame(training.merges, MERGE_SCHEMA)


def vocab_table(spark: SparkSession, training: Training) -> DataFrame:
    """``(id, special, label, piece)``: specials, 256 byte pieces, merged pieces by rank, then characters."""
    merged = list(dict.fromkeys(piece for _, _, _, piece, _ in training.merges))
    learned = merged + [ch for ch in training.characters if ch not in set(merged)]
    rows = [(token_id, True, piece, "") for piece, token_id in SPECIAL_TOKENS]
    pieces = [*BYTE_PIECES, *learned]
    rows += [
        (token_id, False, f"piece_{token_id}", piece) for token_id, piece in enumerate(pieces, start=len(SPECIAL_TOKENS))
    ]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def special_ids(vocab: DataFrame) -> DataFrame:
    """One row with the map of special tokens to ids."""
    entries = F.array_sort(F.collect_list(F.when(F.col("special"), F.struct("label", "id"))))
    return vocab.agg(F.map_from_entries(entries).alias("special_tokens"))


def vocab_sizes(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count("*").alias("vocab_size"), F.count_if("special").alias("special_count"))


def vocab_rows(vocab: DataFrame) -> DataFrame:
    """The vocabulary as it is written: ``id, kind, label, piece_hex, visible_piece``, by id."""
    special = F.col("special")
    return vocab.select(
        "id",
        F.when(special, "special").otherwise("piece").alias("kind"),
        "label",
        F.when(special, "").otherwise(encode_hex(F.col("piece"))).alias("piece_hex"),
        F.when(special, F.col("label")).otherwise(visible(F.col("piece"))).alias("visible_piece"),
    ).orderBy("id")


def merge_rows(merges: DataFrame) -> DataFrame:
    """The merges as they are written: ``rank, left_hex, right_hex, count``, by rank."""
    return merges.select(
        "rank", encode_hex(F.col("left")).alias("left_hex"), encode_hex(F.col("right")).alias("right_hex"), "count"
    ).orderBy("rank")
