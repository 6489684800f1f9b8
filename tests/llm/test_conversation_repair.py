from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from lexmill.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows: list[tuple]) -> list[tuple]:
    done = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        done += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return done


def plain_faults(rows: list[tuple]) -> list[str]:
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        faults.append("")
        if not body:
            faults[-1] = "blank"
        elif (role, text) in seen:
            faults[-1] = "duplicate"
        elif body[-1] not in ".!?":
            faults[-1] = "truncated"
        seen.add((role, text))
    return faults


def cheapest(rows: list[tuple], faults: list[str]) -> tuple[int, str, list[str]]:
    """By trying edits place by place, cheapest first; the initials so far are held whole and matched by the expression itself."""
    def prefix(initials: str) -> bool:
        return any(re.fullmatch("(s?(ua)+)?", initials + rest) for rest in ("", "a", "ua", "u" "a"))

    best: dict = {(0, ""): (0, "", [])}
    # only the last initial matters to what may follow, so of equal places the best is kept for each (place, last initial)
    frontier = [(0, "", [], 0, "")]
    final = None
    while frontier:
        frontier.sort(key=lambda one: (one[0], one[1]))
        cost, audit, lines, place, initials = frontier.pop(0)
        if final is not None and cost > final[0]:
            break
        if place == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            final = min(final, (cost, audit, lines)) if final else (cost, audit, lines)
        steps = [(5, "I", f"{role}:", 0, role[0]) for role in ("user", "assistant")]
        if place < len(rows):
            role, text = rows[place][2:]
            steps.append((2, "D", None, 1, ""))
            if faults[place] not in ("blank", "duplicate"):
                extra = 5 if faults[place] == "truncated" else 0
                if role:
                    steps.append((extra, "K", f"{role}:{text}", 1, role[0]))
                steps += [(1 + extra, "R", f"{new}:{text}", 1, new[0]) for new in ("user", "assistant")]
        for more, letter, line, moved, initial in steps:
            if len(initials) > 3:
                initials = initials[-1]  # behind a pair the last initial says it all
            if not prefix(initials + initial) and not prefix("ua" * bool(initials) + initial) and initial:
                continue
            after = initials + initial
            if not prefix(after):
                continue
            short = "ua" if re.fullmatch("s?(ua)+", after) else "u" if re.fullmatch("s?(ua)*u", after) else after
            key, value = (place + moved, short), (cost + more, audit + letter)
            if key not in best or value <= best[key][:2]:
                made = lines if line is None else [*lines, line]
                best[key] = (*value, made)
                frontier.append((*value, made, place + moved, short))
    return final


def expected(rows: list[tuple]) -> list[tuple]:
    found = []
    damaged = plain_damage(rows)
    for conv_id in {row[0] for row in rows}:
        mine = [row for row in damaged if row[0] == conv_id]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        faults = plain_faults(mine)
        turns = [row[1] for row in mine if row[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest(mine, faults)
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found.append((conv_id, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=repr)


def made(draw: random.Random, conversations: int) -> list[tuple]:
    rows = []
    texts = ["Yes.", "No!", "cut off", "", " \n", "Well?\n ", "ü ende", "Yes. ", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    for conv_id in range(conversations):
        for turn in range(draw.randrange(9)):
            place = draw.choice([turn, turn, turn * 2, None, 3])
            text = draw.choice(texts) if draw.random() < 0.6 else f"Turn {draw.random()}."
            rows.append((conv_id, place, draw.choice(roles), text))
    return rows


def test_equals_brute_force(spark):
    rows = made(random.Random(4), 150) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (-5, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = repair.repair(repair.damage(frame))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_automaton_equals_brute_force_on_short_signatures():
    automaton = repair.SuffixAutomaton()
    roles, faults = ["system", "user", "assistant", "tool"], ["", "blank", "truncated"]
    letters = {(r, f): repair.GONE if f == "blank" else repair.LETTERS[4 * r + {"": 0, "truncated": 3}[f]] for r in range(4) for f in faults}
    rows = list(itertools.product(range(4), faults))
    for length in (0, 1, 2, 3):
        for picked in itertools.product(rows, repeat=length):
            signature = "".join(letters[one] for one in picked)
            plain = cheapest([(0, 0, roles[r], "x") for r, _ in picked], [f for _, f in picked])
            assert automaton.audit(signature) == plain[:2], signature


def test_order_of_questions_and_long_conversations():
    draw = random.Random(2)
    asked = ["".join(draw.choice(repair.LETTERS + repair.GONE) for _ in range(draw.randrange(12))) for _ in range(200)]
    shared = repair.SuffixAutomaton()
    assert [shared.audit(one) for one in asked] == [repair.SuffixAutomaton().audit(one) for one in asked]
    keep = repair.LETTERS[4] + repair.LETTERS[8]
    assert shared.audit(keep * 100_000) == (0, "K" * 200_000)


def test_one_conversation_over_many_ranges(spark, monkeypatch):
    """A conversation that holds nearly all rows is cut into ranges, turns repeat across them."""
    draw = random.Random(9)
    rows = [(7, n // 3, draw.choice(["user", "assistant"]), draw.choice([f"{n}.", "same."])) for n in range(900)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Ho.")]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA)))
        assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_own_interface_repaired_turns_and_clashing_columns(spark):
    rows = [(1, 0, "assistant", "Hello.", "x"), (1, 1, "assistant", "There.", "y"), (1, 2, "user", "", "z")]
    schema = "conv_id int, turn int, role string, text string, audit string"
    frame = spark.createDataFrame(rows, schema)
    (row,) = repair.repair(frame).collect()
    assert (row.cost, row.audit, row.blank) == (3, "RKD", 1)
    prepared = repair._rows(frame)
    turns = repair.repaired_turns(frame, repair.audits(prepared)).orderBy("place").collect()
    assert [tuple(t) for t in turns] == [(1, 0, "user", "Hello."), (1, 1, "assistant", "There.")]


def test_dropped_rows_and_empty_table(spark):
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    got = repair.repair(repair.damage(spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA))).collect()
    assert [tuple(row) for row in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert repair.repair(repair.damage(spark.createDataFrame([], SCHEMA))).collect() == []
    long = "word " * 400_000
    (row,) = repair.repair(spark.createDataFrame([(1, 0, "user", long)], SCHEMA)).collect()
    assert (row.truncated, row.cost, row.audit) == (1, 2, "D")
