from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from lavra.llm import chat

TURNS = "conv_id bigint, turn int, role string, text string"
NASTY = st.text(alphabet="<|\\im_startend>\n a", max_size=30)


@given(NASTY, NASTY)
def test_turns_read_back_as_written(role, text):
    template = chat.Template()
    formatted = "".join(piece for piece, _ in chat.segments_of(template, role, text))
    assert list(chat._parser(template)(formatted * 2)) == [(role, text)] * 2


@given(NASTY)
def test_escaped_text_opens_no_control_string(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text


def test_only_trained_text_bears_loss():
    parts = chat.segments_of(chat.Template(), "assistant", "yes")
    assert [piece for piece, loss in parts if loss] == ["yes"]
    assert not any(loss for _, loss in chat.segments_of(chat.Template(), "user", "yes"))


def test_machine_reports_turns_out_of_order(table, rows):
    turns = table(
        TURNS,
        (1, 0, "user", "a"),
        (1, 1, "assistant", "b"),
        (2, 0, "assistant", "a"),
        (3, 0, "user", "a"),
        (4, 0, "user", "a"),
        (4, 1, "robot", "b"),
        (4, 2, "assistant", "c"),
    )
    found = chat.read_back(chat.format_chat(turns))
    assert rows(found, "conv_id", "valid", "first_bad_turn") == [
        (1, True, None),
        (2, False, 0),
        (3, False, None),
        (4, False, 1),
    ]


def test_digests_nulls_ties_and_extra_columns(table, rows):
    turns = table(
        TURNS + ", turn_no int, loss int",
        (1, None, "user", None, 9, 9),
        (1, 1, "assistant", "<|im_end|>é", 9, 9),
        (1, 1, "assistant", "<|im_end|>é", 9, 9),
        (None, 0, None, "x", 9, 9),
    )
    found = {row["conv_id"]: row for row in chat.read_back(chat.format_chat(turns)).collect()}
    said = "user\n\n" + "assistant\n<|im_end|>é\n" * 2
    assert found[1]["n_turns"] == 3
    assert found[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert found[1]["loss_sha256"] == hashlib.sha256(("<|im_end|>é" * 2).encode()).hexdigest()
    assert found[1]["loss_chars"] == 22
    assert found[None]["turns_sha256"] == hashlib.sha256(b"\nx\n").hexdigest()


def test_no_turns(table):
    assert chat.read_back(chat.format_chat(table(TURNS))).count() == 0


def test_long_conversation_streams(spark):
    turns = spark.range(5000).selectExpr(
        "1L AS conv_id",
        "CAST(id AS int) AS turn",
        "IF(id % 2 = 0, 'user', 'assistant') AS role",
        "repeat('word ', 50) AS text",
    )
    (row,) = chat.read_back(chat.format_chat(turns)).collect()
    assert (row["n_turns"], row["valid"], row["loss_chars"]) == (5000, True, 2500 * 250)
