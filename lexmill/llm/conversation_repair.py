"""Cheapest repair of a conversation's structure, by a suffix-shared automaton over the signatures of all conversations.

A row is a turn. Its first fault counts: blank (nothing but white space), duplicate (role and text stood earlier in the
conversation), truncated (the last character that is no white space is not one of ``.!?``). Edits: Keep 0, Rerole to user or
assistant 1, Delete 2 (the only choice for blank and duplicate rows), Insert an empty user or assistant turn 5; a truncated row that
is not deleted adds 5. The initials of the roles that are left must match ``(s?(ua)+)?``. Of the cheapest edits the one whose
initials ``D I K R``, in order, are least in ASCII is taken; since two choices at one place always differ in their letter,
costs and letters at that place decide, and no suffixes are compared.

A row becomes one letter (role and fault), a conversation a string of letters, its signature. Strings are cut from the rows in ranges of
(conversation, turn), so a conversation with a third of all rows is read by many tasks. Signatures are then dealt by their reversed
order: equal suffixes are neighbours, and a task holds the automaton's nodes of the current suffix only. A node is made once
for all conversations that share the suffix; for each state of the grammar it has the cost to go and the first edits of the best audit,
whose rest is the next node's. Nodes whose costs differ by a constant share their table entry.
Texts are shuffled once, by conversation, to be edited; there they are streamed. A conversation's signature and audit have a
letter for each row, which is as long as the answer itself; no task holds the texts of one.

Edge cases: a null role or text is one blank (no role, a blank row); a null ``conv_id`` is a conversation of its own; rows without a turn
come first; rows of one turn are ordered by role, then by the MD5 of the text; a role that is empty or begins with
another letter than s, u, a can only be reroled or deleted; repeated rows are duplicates; an empty table gives an empty table;
a conversation without rows after damage has zeros and an empty audit; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lexmill.llm.common import WHITESPACE, checkpointed

ENDINGS = ".!?"
#: Rows that the damage draws for each kind: one in this many.
KINDS = 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# A letter of a signature is the role's number times four plus the fault's number, from "A" on.
ROLE_INITIALS = "sua"
OTHER_ROLE = 3
SOUND, BLANK, DUPLICATE, CUT = range(4)
LETTERS = "".join(chr(ord("A") + n) for n in range(16))
#: Rows that must go are alike to the grammar.
GONE = "X"
_MUST_GO = "".join(letter for n, letter in enumerate(LETTERS) if n % 4 in (BLANK, DUPLICATE))
_LEGAL_PAIRS = {"su", "ua", "au"}

# The grammar's states, by the initial read last; START and ASSISTANT may end.
START, SYSTEM, USER, ASSISTANT = range(4)
_READS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state after a user or assistant turn, whichever fits.
_FITTING = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE_OF = {USER: "user", ASSISTANT: "assistant"}


class SuffixAutomaton:
    """Nodes of the current suffix, from the end of the signature; `audit` moves it to another signature.

    ``_table`` maps (class of the next node, letter) to the class of the node, what it adds to all costs and, for each state, the
    edits up to its row and the state after them. A class is the costs to go from each state, less their least.
    """

    def __init__(self) -> None:
        end = (0, 2 * INSERT, INSERT, 0)
        self._classes, self._numbers = [end], {end: 0}
        self._table: dict[tuple[int, str], tuple[int, int, list[tuple[str, int]]]] = {}
        self._suffix = ""
        self._nodes: list[tuple[int, int, list[tuple[str, int]]]] = []

    def _node(self, after: int, letter: str) -> tuple[int, int, list[tuple[str, int]]]:
        found = self._table.get((after, letter))
        if found is None:
            found = self._table[after, letter] = self._made(self._classes[after], letter)
        return found

    def _made(self, to_go: tuple[int, ...], letter: str) -> tuple[int, int, list[tuple[str, int]]]:
        best: list[tuple[int, str, int]] = []
        for state in range(4):
            options = [(DELETE + to_go[state], "D", state)]
            if letter != GONE:
                role, fault = divmod(LETTERS.index(letter), 4)
                extra = TRUNCATED if fault == CUT else 0
                kept = _READS.get((state, ROLE_INITIALS[role])) if role != OTHER_ROLE else None
                if kept is not None:
                    options.append((extra + to_go[kept], "K", kept))
                fitting = _FITTING[state]
                options.append((REROLE + extra + to_go[fitting], "R", fitting))
            best.append(min(options))
        for _ in range(2):  # two insertions lead round the states; more never pay
            inserted = [(INSERT + best[_FITTING[s]][0], "I" + best[_FITTING[s]][1], best[_FITTING[s]][2]) for s in range(4)]
            best = [min(pair) for pair in zip(best, inserted)]
        least = min(cost for cost, _, _ in best)
        costs = tuple(cost - least for cost, _, _ in best)
        number = self._numbers.setdefault(costs, len(self._classes))
        if number == len(self._classes):
            self._classes.append(costs)
        return number, least, [(letters, state) for _, letters, state in best]

    def audit(self, signature: str) -> tuple[int, str]:
        """The cost and the audit of a signature of edit letters; cheap if its end equals that of the last one asked."""
        backwards = signature[::-1]
        shared = 0
        for mine, theirs in zip(backwards, self._suffix):
            if mine != theirs:
                break
            shared += 1
        del self._nodes[shared:]
        for letter in backwards[shared:]:
            after, cost = self._nodes[-1][:2] if self._nodes else (0, 0)
            number, least, moves = self._node(after, letter)
            self._nodes.append((number, cost + least, moves))
        self._suffix = backwards
        letters, state = [], START
        for _, _, moves in reversed(self._nodes):
            edits, state = moves[state]
            letters.append(edits)
        letters.append({SYSTEM: "II", USER: "I"}.get(state, ""))
        number, cost = self._nodes[-1][:2] if self._nodes else (0, 0)
        return cost + self._classes[number][START], "".join(letters)


def damage(df: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows dropped (no copies), emptied, cut, repeated or given another role.

    Which of them happens is drawn by crc32 of ``conv_id:turn`` modulo 20; most rows stay as they are. A null is one blank.
    """

    def blank_if_null(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(blank_if_null("conv_id"), F.lit(":"), blank_if_null("turn"))
    draw = F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(KINDS))
    text = blank_if_null("text")
    return df.select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(blank_if_null("role")).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ENDINGS, "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )


def _rows(df: DataFrame) -> DataFrame:
    """The rows of `df` with nulls filled, a number of copies and the digest that orders the rows of a turn."""
    copies = F.col("copies").cast("int") if "copies" in df.columns else F.lit(1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return df.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("digest"),
        text.alias("text"),
        copies.alias("copies"),
    )


def _letter(first: Column) -> Column:
    """The letter of a row; ``first``: whether its role and text have not stood earlier."""
    role = F.position(F.left("role", F.lit(1)), F.lit(ROLE_INITIALS)) - 1
    role = F.when((F.col("role") == "") | (role < 0), OTHER_ROLE).otherwise(role)
    fault = F.when(F.col("last") == "", BLANK).when(~first, DUPLICATE)
    fault = fault.when(~F.col("last").isin(*ENDINGS), CUT).otherwise(SOUND)
    return F.substring(F.lit(LETTERS), 4 * role + fault + 1, F.lit(1))


def _segments(rows: DataFrame) -> DataFrame:
    """``(conv_id, segment, letters, first_turn, last_turn, turns)`` for each range of rows and conversation in it.

    A conversation with dropped rows only has a segment without letters.
    """
    trimmed = F.rtrim("text", F.lit(WHITESPACE))
    last = F.when(trimmed == "", "").otherwise(F.right(trimmed, F.lit(1)))
    light = checkpointed(rows.select("conv_id", "turn", "role", "digest", "copies", last.alias("last")))
    seen = light.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("seen"))
    seen = seen.toDF("in_conv", "of_role", "of_digest", "seen")
    same = F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("role") == F.col("of_role"))
    met = light.join(seen, same & (F.col("digest") == F.col("of_digest")), "left")
    marked = met.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        "copies",
        _letter(F.col("turn").eqNullSafe(F.col("seen.turn"))).alias("letter"),
        _letter(F.lit(False)).alias("repeated"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)

    fields = [("letters", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())]
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current: list | None = None
        row_before: tuple | None = None
        for batch in batches:
            done = []
            for conv_id, turn, role, digest, copies, letter, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current[0] != conv_id:
                    if current is not None:
                        done.append((current[0], part, "".join(current[1]), *current[2:]))
                    current, row_before = [conv_id, [], None, None, 0], None
                if not copies:
                    continue
                if (turn, role, digest) == row_before:
                    letter = repeated
                row_before = (turn, role, digest)
                current[1].append(letter + repeated * (copies - 1))
                if turn is not None and turn != current[3]:
                    current[2] = turn if current[2] is None else current[2]
                    current[3] = turn
                    current[4] += 1
            yield _batch(done, schema)
        if current is not None:
            yield _batch([(current[0], part, "".join(current[1]), *current[2:])], schema)

    typed = dealt.withColumn("conv_id", F.col("conv_id").cast("long"))
    return typed.mapInArrow(run, from_arrow_schema(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def signatures(rows: DataFrame) -> DataFrame:
    """``(conv_id, signature, gaps)``, one row for each conversation of the rows."""
    parts = F.sort_array(F.collect_list(F.struct("segment", "letters", "first_turn", "last_turn", "turns")))
    joined = _segments(rows).groupBy("conv_id").agg(parts.alias("parts"))
    timed = F.filter("parts", lambda part: part["turns"] > 0)
    count = F.size(timed)
    met = F.zip_with(
        F.slice(timed, F.lit(1), F.greatest(count - 1, F.lit(0))),
        F.slice(timed, F.lit(2), F.greatest(count - 1, F.lit(0))),
        lambda left, right: (left["last_turn"] == right["first_turn"]).cast("long"),
    )

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda sum_, value: sum_ + value)

    distinct = total(F.transform(timed, lambda part: part["turns"])) - total(met)
    span = F.element_at(timed, -1)["last_turn"] - F.element_at(timed, 1)["first_turn"] + 1
    letters = F.array_join(F.transform("parts", lambda part: part["letters"]), "")
    return joined.select(
        "conv_id", letters.alias("signature"), F.when(count > 0, span - distinct).otherwise(F.lit(0).cast("long")).alias("gaps")
    )


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _counts(signature: str) -> tuple[int, int, int, int]:
    faults = [sum(signature.count(LETTERS[4 * role + fault]) for role in range(4)) for fault in (BLANK, DUPLICATE, CUT)]
    initials = [(ROLE_INITIALS + "?")[LETTERS.index(letter) // 4] for letter in signature]
    return *faults, sum(left + right not in _LEGAL_PAIRS for left, right in zip(initials, initials[1:]))


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``, one row for each conversation of the rows."""
    edited = F.translate("signature", _MUST_GO, GONE * len(_MUST_GO))
    signed = checkpointed(signatures(rows).withColumn("backwards", F.reverse(edited)))
    order = ["backwards", "signature", "conv_id"]
    dealt = signed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "gaps", "signature", "backwards")
    schema = pa.schema(
        [("conv_id", pa.int64()), ("gaps", pa.int64()), *[(name, pa.int64()) for name in _COUNTS], ("audit", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known, answer = SuffixAutomaton(), None, ()
        for batch in batches:
            done = []
            for conv_id, gaps, signature, backwards in zip(*(column.to_pylist() for column in batch.columns)):
                if signature != known:
                    known, answer = signature, (*_counts(signature), *automaton.audit(backwards[::-1]))
                done.append((conv_id, gaps, *answer))
            yield _batch(done, schema)

    return dealt.mapInArrow(run, from_arrow_schema(schema))


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the turns after the edits of `audits`, in order within one partition."""
    rows = _rows(rows).filter("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies")
    heads = audited.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"),
        F.lit(1).alias("copies"),
    )
    order = ["conv_id", "kind", "turn", "role", "digest"]
    together = rows.withColumn("conv_id", F.col("conv_id").cast("long")).unionByName(heads)
    dealt = together.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, at, state, place, current = "", 0, START, 0, None
        for batch in batches:
            done: list[tuple] = []

            def put(role: str, text: str) -> None:
                nonlocal place
                done.append((current, place, role, text))
                place += 1

            def insert() -> None:
                nonlocal at, state
                while edits[at : at + 1] == "I":
                    state = _FITTING[state]
                    put(_ROLE_OF[state], "")
                    at += 1

            for conv_id, kind, role, text, copies in zip(*(column.to_pylist() for column in batch.columns)):
                if not kind:
                    current, edits, at, state, place = conv_id, text, 0, START, 0
                    insert()
                    continue
                for _ in range(copies):
                    edit = edits[at]
                    at += 1
                    if edit != "D":
                        state = _READS[state, role[0]] if edit == "K" else _FITTING[state]
                        put(role if edit == "K" else _ROLE_OF[state], text)
                    insert()
            yield _batch(done, REPAIRED)

    return dealt.mapInArrow(run, from_arrow_schema(REPAIRED))


def _digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of `repaired_turns`, which keeps a conversation together and in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done = []
            for conv_id, place, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if place == 0:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _batch(done, schema)
        if digest is not None:
            yield _batch([(current, digest.hexdigest())], schema)

    return turns.mapInArrow(run, from_arrow_schema(schema))


def repair(df: DataFrame) -> DataFrame:
    """`audits` with ``repaired_sha256``, the digest of the repaired turns as ``role:text`` lines, for each conversation.

    ``df`` has ``conv_id, turn, role, text``, and may say with ``copies`` how often a row stands there in a row; rows with 0 copies only
    name their conversation.
    """
    found = checkpointed(audits(_rows(df)))
    digests = _digests(repaired_turns(df, found)).withColumnRenamed("conv_id", "of")
    joined = found.join(digests, found["conv_id"].eqNullSafe(digests["of"]), "left").drop("of")
    empty = hashlib.sha256().hexdigest()
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))
