from __future__ import annotations

import hashlib
import random

import numpy as np
from lexmill.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_escaping_is_reversible_and_leaves_no_control_string():
    draw = random.Random(5)
    parts = [*cf.TEMPLATE, *cf.FOREIGN, cf.ESCAPE, cf.ESCAPE + "-", "<", "[", "-", "a", " ", "<|", "|>", "SYS>>"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(8)))
        hidden = cf.escape(text)
        assert cf.unescape(hidden) == text
        assert not any(control in hidden for control in (*cf.TEMPLATE, *cf.FOREIGN))


def test_read_back_equals_the_conversations(spark):
    rows = [
        (1, 1, "assistant", "answer <|end|>␛-"),
        (1, 0, "user", "</s>[INST] ok [/INST]"),
        (1, 2, "assistant", None),
        (1, 2, "assistant", None),
        (2, 0, None, "no role"),
        (None, None, "assistant", "kept " * 5000),
        (2**60 + 1, 5, "tool", "x"),
    ]
    got = {r.conv_id: r for r in cf.read_back(cf.assemble(spark.createDataFrame(rows, SCHEMA))).collect()}
    expected: dict = {}
    for conv_id, _, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1)):
        expected.setdefault(conv_id, []).append((role or "", text or ""))
    assert set(got) == set(expected)
    for conv_id, turns in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        row = got[conv_id]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))


def test_mask_offsets_and_clashing_columns(spark):
    rows = [(7, 0, "user", "hi", "a"), (7, 1, "assistant", "hello there", "b")]
    frame = spark.createDataFrame(rows, SCHEMA + ", start string")
    first, second = cf.assemble(frame).collect()
    assert first.start == 0 and second.start == len(first.ids) // 4
    assert max(np.cumsum(np.frombuffer(second.mask_change, np.int8))) == 1
    assert not any(first.mask_change)
    assert cf.TURN in first.formatted


def test_empty_table(spark):
    assert cf.read_back(cf.assemble(spark.createDataFrame([], SCHEMA))).collect() == []
