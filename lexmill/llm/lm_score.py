"""Masked pseudo-likelihood of texts under a bidirectional window network, trained in numpy on all of the corpus.

A text is its lower-case words between white space. The vocabulary is the most frequent words of the corpus; every other word is
one of a fixed number of hash buckets, and has its share of the bucket by its count in the corpus. The network predicts a masked token from the two tokens on each side: the
embeddings of the four places are summed and squashed, then a softmax over groups of tokens and one over the tokens of the group
give the token's probability. A text's score is the sum of the log-probabilities of its tokens, each predicted from both sides.
The texts are read twice: once to count their words, once to write what the rounds and the scoring read, the token ids, two bytes each.

The exact counts of the most frequent words, a bounded number, go to the tasks; what a text has of all other words is written beside its ids and meets
the counts in a join.

Each round masks a part of the positions of every text, by a hash of text and position; the rounds together cover every position once. Tasks train on their own rows from a common model,
and their changes are averaged row by row, weighted by how often a task met the row, in a grouped sum. What comes back to the driver is
one model of fixed size, whatever the number of rows; the counts of all words stay a table, which grows with the corpus. A word that the
corpus does not have, or has once, counts one; a bucket keeps one count for the words that the corpus does not have.

Edge cases: a null or blank text has no tokens, a ``log_prob`` of 0 and a null mean; the longest text is scored whole, in
blocks; repeated rows are scored each on its own and count as often as they occur; an empty table gives an empty table; other
columns are not read. Random draws are seeded by round and task, so a repeated task gives the same change.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from lexmill.llm.common import SLICE_ROWS, checkpointed, keyed_texts
from lexmill.llm.peeling import mix64

#: Tokens: frequent words, then hash buckets; the softmax has GROUPS groups of GROUP_SIZE tokens.
WORDS, BUCKETS, GROUP_SIZE = 3072, 1024, 64
TOKENS = WORDS + BUCKETS
GROUPS = TOKENS // GROUP_SIZE
#: Stands for the places before the first and after the last token.
PAD = TOKENS
#: Places of the window relative to the token, and the width of the hidden layer.
PLACES = (-2, -1, 1, 2)
HIDDEN = 24
#: Rounds over the corpus, each one for its part of the positions, and the training step.
ROUNDS = 2
STEP, BATCH = 0.08, 4096
#: Positions that are scored at once; distinct words that a task counts before it sends them on.
BLOCK, COUNTED_WORDS = 1 << 13, 400_000
#: Words whose counts every task holds, at most; bytes of text that are cut into words at once.
KNOWN_WORDS, CUT_BYTES = 1 << 17, 1 << 24
#: White space of `str.split` that Arrow does not cut at.
_ODD_SPACES = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Logits up to this size need no shift before the exponential: 64 such terms add up within a 32-bit float.
SAFE_LOGIT = 80
#: Model rows: an embedding for each place and token, an output for each token and group, and the hidden bias.
_OUT = len(PLACES) * (TOKENS + 1)
_GROUP = _OUT + TOKENS
_BIAS = _GROUP + GROUPS
ROWS = _BIAS + 1


def _bucket(word: str) -> int:
    return WORDS + zlib.crc32(word.encode()) % BUCKETS


class Ids(dict):
    """Token ids of words; a word outside the vocabulary has its bucket's."""

    def __missing__(self, word: str) -> int:
        return _bucket(word)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _cut(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """(the words of all texts as `words_of` has them, how many each text has)."""
    lowered = pa.array([text.lower() for text in texts], pa.string())
    odd = pc.match_substring_regex(lowered, _ODD_SPACES)
    if pc.any(odd).as_py():
        plain = [" ".join(text.split()) if is_odd else text for text, is_odd in zip(lowered.to_pylist(), odd.to_pylist())]
        lowered = pa.array(plain, pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(lowered))
    words, counts = split.flatten(), pc.list_value_length(split).to_numpy()
    some = pc.not_equal(words, "")
    if not pc.all(some).as_py():  # a blank text is cut into one empty word
        owner = np.repeat(np.arange(len(texts)), counts)[some.to_numpy(zero_copy_only=False)]
        words, counts = words.filter(some), np.bincount(owner, minlength=len(texts))
    return words, counts


def _parts(batch: pa.RecordBatch, column: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, and of CUT_BYTES bytes in ``column`` but for the last row of each."""
    stops = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = stops[start - 1] if start else 0
        stop = min(start + rows, int(np.searchsorted(stops, before + CUT_BYTES)) + 1, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts, counted within tasks first."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def added(counts: list[pa.RecordBatch]) -> pa.RecordBatch:
        """One row for each word of ``counts``."""
        whole = pa.Table.from_batches(counts, schema)
        if len(counts) > 1:
            whole = whole.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"])
        columns = [column.combine_chunks() for column in whole.columns]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            for part in _parts(batch, 0, batch.num_rows):
                found = pc.value_counts(_cut(part.column(0).to_pylist())[0])
                waiting.append(pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], schema=schema))
                if sum(one.num_rows for one in waiting) >= COUNTED_WORDS:
                    yield added(waiting)
                    waiting = []
        yield added(waiting)

    return texts.select("text").mapInArrow(count, from_arrow_schema(schema)).groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class WindowModel:
    """``table`` holds all weights, a row of HIDDEN weights and a bias for each of ROWS.

    ``bucket_counts`` are the tokens of each bucket. ``known`` has the counts of its most frequent words, in no order; ``rare(word, n)`` has at least
    the other ones that the corpus has more than once, on the executors.
    """

    words: list[str]
    table: np.ndarray
    bucket_counts: np.ndarray
    rare: DataFrame
    known: dict[str, int] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        """What a round needs."""
        return {name: value for name, value in self.__dict__.items() if name not in ("rare", "known")}

    def ids(self) -> Ids:
        return Ids({word: number for number, word in enumerate(self.words)})

    @property
    def outputs(self) -> np.ndarray:
        return self.table[_OUT:_GROUP].reshape(GROUPS, GROUP_SIZE, HIDDEN + 1)


def _windows(sequences: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(padded ids of all texts, positions of the tokens, text of each token)."""
    owner = np.repeat(np.arange(len(sequences)), list(map(len, sequences)))
    gap = len(PLACES)
    flat = np.full(len(owner) + gap * (len(sequences) + 1), PAD, np.int32)
    positions = np.arange(len(owner)) + gap * (owner + 1)
    flat[positions] = np.concatenate([np.empty(0, np.int32), *(np.asarray(one, np.int32) for one in sequences)])
    return flat, positions, owner


def _rows_of(flat: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The embedding rows of the window of each position."""
    return np.stack([flat[positions + place] + number * (TOKENS + 1) for number, place in enumerate(PLACES)])


def _largest_logit(table: np.ndarray) -> float:
    """A bound on all logits of ``table``: the hidden layer is between -1 and 1."""
    return float((np.abs(table[_OUT:_BIAS]) @ np.ones(HIDDEN + 1, np.float32)).max())


def _odds(logits: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials of the logits, up to a factor for each row; their sums)."""
    if not largest < SAFE_LOGIT:
        logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], np.float32)


def _softmax(logits: np.ndarray, largest: float) -> np.ndarray:
    odds, sums = _odds(logits, largest)
    odds *= (1 / sums)[:, None]
    return odds


def _hidden(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The hidden layer, and a column of ones for the biases of the outputs."""
    total = table.take(rows[0], 0)
    for place in rows[1:]:
        total += table.take(place, 0)
    total += table[_BIAS]
    np.tanh(total, out=total)
    total[:, HIDDEN] = 1
    return total


def _by_group(groups: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """(an order by group, the groups that occur with their part of the order)."""
    counts = np.bincount(groups, minlength=GROUPS)
    stops = np.cumsum(counts)
    parts = [(int(group), slice(int(stops[group] - counts[group]), int(stops[group]))) for group in np.flatnonzero(counts)]
    return np.argsort(groups.astype(np.uint16), kind="stable"), parts


def _within_groups(inputs: np.ndarray, outputs: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """The products of ``inputs``, which stand group by group, with the outputs of the tokens of their group."""
    logits = np.empty((len(inputs), GROUP_SIZE), np.float32)
    for group, part in parts:
        np.matmul(inputs[part], outputs[group].T, out=logits[part])
    return logits


def _sums(rows: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sums of runs of ``counts`` rows in ``order``. Most runs are short; `numpy.add.reduceat` takes a call for each run and column."""
    starts = np.cumsum(counts) - counts
    by_length = np.argsort(np.minimum(counts, 9).astype(np.uint8), kind="stable")
    firsts, stops = starts[by_length], np.cumsum(np.bincount(np.minimum(counts, 9), minlength=10))
    sums = np.empty((len(counts), rows.shape[1]), rows.dtype)
    for length in range(1, 9):
        part = slice(stops[length - 1], stops[length])
        if part.start < part.stop:
            first, found = firsts[part], sums[part]
            rows.take(order[first], 0, out=found, mode="clip")
            if length > 1:
                rest = rows.take(order[first + 1], 0)
                for number in range(2, length):
                    rest += rows.take(order[first + number], 0)
                found += rest
    if stops[8] < stops[9]:
        lengths = counts[by_length[stops[8] :]]
        places = np.repeat(firsts[stops[8] :] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        sums[stops[8] :] = np.add.reduceat(rows.take(order[places], 0), np.cumsum(lengths) - lengths)
    found = np.empty_like(sums)
    found[by_length] = sums
    return found


def log_probabilities(model: WindowModel, flat: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The log-probability of the token at each position, given both sides."""
    found = np.zeros(len(positions))
    group_rows, largest = model.table[_GROUP:_BIAS], _largest_logit(model.table)
    for start in range(0, len(positions), BLOCK):
        at = positions[start : start + BLOCK]
        targets = flat[at]
        padded = _hidden(model.table, _rows_of(flat, at))
        groups, members = np.divmod(targets, GROUP_SIZE)
        odds, sums = _odds(padded @ group_rows.T, largest)
        logs = np.log(odds[np.arange(len(at)), groups] / sums + 1e-30, dtype=np.float64)
        order, parts = _by_group(groups)
        odds, sums = _odds(_within_groups(padded.take(order, 0), model.outputs, parts), largest)
        logs[order] += np.log(odds[np.arange(len(at)), members[order]] / sums + 1e-30, dtype=np.float64)
        found[start : start + BLOCK] = logs
    return found


class Trainer:
    """Adaptive gradient steps on one task's masked positions, from a common start."""

    def __init__(self, start: WindowModel) -> None:
        self.start = start.table
        self.model = WindowModel(start.words, start.table.copy(), start.bucket_counts, None)
        self.squares = np.full(ROWS, 1e-6, np.float32)
        self.met = np.zeros(ROWS, np.float32)
        # of the outputs, the groups and the bias, which stand together
        self._gradients = np.zeros((ROWS - _OUT, HIDDEN + 1), np.float32)

    def _steps(self, squares: np.ndarray, gradients: np.ndarray) -> None:
        """Makes ``gradients`` of distinct rows steps, as long as the row's gradients so far allow; these are added to ``squares``."""
        squares += np.einsum("ij,ij->i", gradients, gradients) / np.float32(HIDDEN + 1)
        gradients *= (STEP / np.sqrt(squares))[:, None]

    def step(self, flat: np.ndarray, positions: np.ndarray) -> None:
        table, targets, rows = self.model.table, flat[positions], _rows_of(flat, positions)
        padded = _hidden(table, rows)
        groups, members = np.divmod(targets, GROUP_SIZE)
        group_rows, largest = table[_GROUP:_BIAS], _largest_logit(table)
        gradients, each = self._gradients, np.arange(len(targets))
        error = _softmax(padded @ group_rows.T, largest)
        error[each, groups] -= 1
        back = error @ group_rows
        np.matmul(error.T, padded, out=gradients[TOKENS:-1])
        order, parts = _by_group(groups)
        inputs, outputs = padded.take(order, 0), self.model.outputs
        miss = _softmax(_within_groups(inputs, outputs, parts), largest)
        miss[each, members[order]] -= 1
        inner, of_outputs = np.empty_like(padded), gradients[:TOKENS].reshape(GROUPS, GROUP_SIZE, HIDDEN + 1)
        if len(parts) < GROUPS:
            of_outputs[:] = 0
        for group, part in parts:
            np.matmul(miss[part], outputs[group], out=inner[part])
            np.matmul(miss[part].T, inputs[part], out=of_outputs[group])
        place_of = np.empty_like(order)
        place_of[order] = each
        back += inner.take(place_of, 0)
        np.multiply(padded, padded, out=padded)
        np.subtract(1, padded, out=padded)
        back *= padded  # no change for the column of ones
        back.sum(0, out=gradients[-1])
        self._steps(self.squares[_OUT:], gradients)
        table[_OUT:] -= gradients
        self.met[_OUT:_GROUP] += np.bincount(targets, minlength=TOKENS)
        self.met[_GROUP:_BIAS] += np.bincount(groups, minlength=GROUPS)
        self.met[_BIAS] += 1
        places = rows.ravel()
        order = np.argsort(places.astype(np.uint16), kind="stable")
        counts = np.bincount(places, minlength=_OUT)
        self.met[:_OUT] += counts
        distinct = np.flatnonzero(counts)
        changes = _sums(back, order % len(targets), counts[distinct])
        squares = self.squares.take(distinct)
        self._steps(squares, changes)
        self.squares[distinct] = squares
        table[distinct] = table.take(distinct, 0) - changes

    def changes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, weight, weighted change) of the rows that were met."""
        rows = np.flatnonzero(self.met)
        return rows, self.met[rows], (self.model.table[rows] - self.start[rows]) * self.met[rows, None]


_CHANGE = [f"c{number}" for number in range(HIDDEN + 1)]


def in_round(text: str, n_tokens: int, number: int, rounds: int) -> np.ndarray:
    """Whether round ``number`` masks each position of the text; every position is in one of the rounds."""
    return _masked([zlib.crc32(text.encode())], [n_tokens], number, rounds)


def _masked(text_hashes: list[int], lengths: list[int], number: int, rounds: int) -> np.ndarray:
    """The masks of texts, one after the other."""
    places = np.arange(sum(lengths), dtype=np.uint64) - np.repeat(np.cumsum([0, *lengths[:-1]], dtype=np.uint64), lengths)
    seeds = np.array(text_hashes, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(places ^ np.repeat(seeds, lengths), 0) % np.uint64(rounds) == np.uint64(number)


def _encoded(texts: DataFrame, model: WindowModel) -> DataFrame:
    """``(row, doc_id, hash, ids, share, rest)`` of each ``(row, doc_id, text)``; the rounds and the scoring read it.

    ``ids`` are the token ids, two bytes each. ``share`` is the logarithm of the shares of the words outside the vocabulary in their buckets, but that
    each word that no task knows counts one; ``rest`` has these, one for each time, joined by blanks.
    """
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", to_arrow_type(texts.schema["doc_id"].dataType)),
            ("hash", pa.int64()),
            ("ids", pa.binary()),
            ("share", pa.float64()),
            ("rest", pa.string()),
        ]
    )
    vocabulary = set(model.words)
    others = [word for word in model.known if word not in vocabulary]
    listed = [*model.words, *others]
    codes = np.array([*range(len(model.words)), *map(_bucket, others)], np.uint16)
    buckets = -np.log1p(model.bucket_counts)
    shares = np.zeros(len(listed))
    shares[len(model.words) :] = buckets[codes[len(model.words) :].astype(int) - WORDS] + np.log([model.known[word] for word in others])

    def work(part: pa.RecordBatch, known: pa.StringArray) -> pa.RecordBatch:
        texts = part.column(2).to_pylist()
        words, counts = _cut(texts)
        places = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
        unknown = np.flatnonzero(places < 0)
        rest = words.take(pa.array(unknown)).to_pylist()
        ids = np.append(codes, 0).take(places)
        ids[unknown] = list(map(_bucket, rest))
        logs = np.append(shares, 0).take(places)
        logs[unknown] = buckets[ids[unknown].astype(int) - WORDS]
        stops = np.cumsum(counts)
        cuts, others = [0, *stops.tolist()], np.searchsorted(unknown, [0, *stops]).tolist()
        raw = ids.astype("<u2").tobytes()
        columns = [
            part.column(0),
            part.column(1).cast(schema.field("doc_id").type),
            [zlib.crc32(text.encode()) for text in texts],
            [raw[2 * start : 2 * stop] for start, stop in zip(cuts, cuts[1:])],
            np.bincount(np.repeat(np.arange(len(texts)), counts), logs, minlength=len(texts)),
            [" ".join(rest[start:stop]) for start, stop in zip(others, others[1:])],
        ]
        arrays = [column if isinstance(column, pa.Array) else pa.array(column, of.type) for column, of in zip(columns, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(listed, pa.string())
        for batch in batches:
            for part in _parts(batch, 2, batch.num_rows):
                yield work(part, known)

    return texts.select("row", "doc_id", "text").mapInArrow(run, from_arrow_schema(schema))


def token_ids(texts: DataFrame, model: WindowModel) -> DataFrame:
    """``(hash, ids)`` of each text, its token ids as bytes, two for each; all rounds read them."""
    return _encoded(_numbered(texts.select("text"), "text", "text"), model).select("hash", "ids")


def _round(tokens: DataFrame, model: WindowModel, number: int, rounds: int) -> WindowModel:
    """One round over all texts, given as `token_ids`; returns the averaged model."""
    schema = pa.schema([("row", pa.int32()), ("weight", pa.float32()), *[(name, pa.float32()) for name in _CHANGE]])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(model)
        draw = np.random.default_rng([number, TaskContext.get().partitionId()])
        waiting: list[np.ndarray] = []
        hashes: list[int] = []
        size = 0

        def learn() -> None:
            _learn(trainer, waiting, [_masked(hashes, list(map(len, waiting)), number, rounds)], draw)

        for batch in batches:
            for text_hash, raw in zip(batch.column(0), batch.column(1)):
                waiting.append(np.frombuffer(raw.as_py(), np.uint16))
                hashes.append(text_hash.as_py())
                size += len(waiting[-1])
                if size >= BATCH * rounds:
                    learn()
                    waiting, hashes, size = [], [], 0
        if waiting:
            learn()
        rows, weights, changes = trainer.changes()
        columns = [rows.astype(np.int32), weights, *np.ascontiguousarray(changes.T)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    changed = tokens.select("hash", "ids").mapInArrow(train, from_arrow_schema(schema))
    summed = changed.groupBy("row").agg(F.sum("weight").alias("weight"), *[F.sum(c).alias(c) for c in _CHANGE]).toPandas()
    table = model.table.copy()
    rows = summed["row"].to_numpy(np.int64)
    table[rows] += (summed[_CHANGE].to_numpy(np.float64) / summed[["weight"]].to_numpy(np.float64)).astype(np.float32)
    return WindowModel(model.words, table, model.bucket_counts, model.rare, model.known)


def _learn(trainer: Trainer, sequences: list, parts: list[np.ndarray], draw: np.random.Generator) -> None:
    flat, positions, _ = _windows(sequences)
    masked = positions[np.concatenate(parts)]
    draw.shuffle(masked)
    for start in range(0, len(masked), BATCH):
        trainer.step(flat, masked[start : start + BATCH])


def _numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed_texts(df, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")


def _untrained(texts: DataFrame) -> WindowModel:
    """A model whose vocabulary and output biases are those of the counts of the words."""
    counts = checkpointed(word_counts(texts))
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    frequent = [row["word"] for row in top]
    share = np.ones(TOKENS)
    share[: len(top)] += [row["n"] for row in top]
    bucket = F.pmod(F.crc32(F.encode("word", "UTF-8")), F.lit(BUCKETS)).cast("int").alias("bucket")
    listed = F.broadcast(counts.sparkSession.createDataFrame([(word,) for word in frequent], "word string"))
    for row in counts.join(listed, "word", "left_anti").groupBy(bucket).agg(F.sum("n").alias("n")).collect():
        share[WORDS + row["bucket"]] += row["n"]
    # the tasks know all words from a size of count on, as far as they are not too many
    size, least, many = F.floor(F.log2("n") * 8).cast("int"), None, 0
    for row in sorted(counts.groupBy(size.alias("size")).count().collect(), reverse=True):
        many += row["count"]
        if many > KNOWN_WORDS:
            break
        least = row["size"]
    most = counts.limit(0) if least is None else counts.filter(size >= least)
    known = dict(zip(*most.select("word", "n").toArrow().to_pydict().values()))
    rare = counts.filter("n > 1") if least is None else counts.filter((F.col("n") > 1) & (size < least))
    table = np.zeros((ROWS, HIDDEN + 1), np.float32)
    table[:, :HIDDEN] = np.random.default_rng(11).normal(0, 0.1, (ROWS, HIDDEN))
    by_group = share.reshape(GROUPS, GROUP_SIZE)
    table[_GROUP:_BIAS, HIDDEN] = np.log(by_group.sum(1) / share.sum())
    table[_OUT:_GROUP, HIDDEN] = np.log(by_group / by_group.sum(1, keepdims=True)).ravel()
    return WindowModel(frequent, table, share[WORDS:] - 1, rare, known)


def _trained(model: WindowModel, tokens: DataFrame, rounds: int) -> WindowModel:
    for number in range(rounds):
        model = _round(tokens, model, number, rounds)
    return model


def fit(df: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> WindowModel:
    """The model of all texts: counts give the vocabulary and the first output biases, rounds train the network."""
    texts = keyed_texts(df, text_col, text_col).select("text")
    model = _untrained(texts)
    return _trained(model, checkpointed(token_ids(texts, model)), rounds) if rounds and model.words else model


def score(df: DataFrame, model: WindowModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, log_prob, mean_log_prob)`` of each whole text."""
    return _scored(checkpointed(_encoded(_numbered(df, id_col, text_col), model)), model)


def _scored(tokens: DataFrame, model: WindowModel) -> DataFrame:
    """`score` of texts given as `_encoded`."""
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", to_arrow_type(tokens.schema["doc_id"].dataType)),
            ("n_tokens", pa.int64()),
            ("log_prob", pa.float64()),
        ]
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        sequences = [np.frombuffer(raw, np.uint16) for raw in part.column(2).to_pylist()]
        flat, positions, owner = _windows(sequences)
        logs = np.bincount(owner, log_probabilities(model, flat, positions), minlength=len(sequences)) + part.column(3).to_numpy()
        columns = [part.column(0), part.column(1).cast(schema.field("doc_id").type), pa.array(list(map(len, sequences)), pa.int64()), pa.array(logs)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield work(batch.slice(start, SLICE_ROWS))

    own = tokens.select("row", "doc_id", "ids", "share").mapInArrow(run, from_arrow_schema(schema))
    rest = tokens.filter("rest <> ''").select("row", F.explode(F.split("rest", " ")).alias("word"))
    logs = rest.join(model.rare, "word").groupBy("row").agg(F.sum(F.log("n")).alias("log_prob"))
    firsts = [F.max(name).alias(name) for name in ("doc_id", "n_tokens")]
    met = own.unionByName(logs, allowMissingColumns=True)
    summed = met.groupBy("row").agg(*firsts, F.sum("log_prob").alias("log_prob"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob")
    return summed.select("doc_id", "n_tokens", "log_prob", mean)


def fit_and_score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`fit` and `score` of the same texts, which are encoded once."""
    texts = _numbered(df, id_col, text_col)
    model = _untrained(texts)
    tokens = checkpointed(_encoded(texts, model))
    return _scored(tokens, _trained(model, tokens, ROUNDS) if model.words else model)
