"""Chat formatting: a finite-state machine checks the order of roles, and a declarative template
turns every turn into text segments that say whether a model is trained on them.

A conversation is a sequence, so its turns stream through one task in order. Spark sorts them,
spilling to disk, and neither step holds more than one turn, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches

START = "start"


@dataclass(frozen=True)
class Template:
    """What a turn looks like and which roles may follow which.

    `turn` lists the parts of a turn: `{role}`, `{text}` or a fixed string. Fixed strings that
    hold `opening` are control strings; `header_end` ends the role. Text of `trained` roles
    bears loss, nothing else does. `order` maps a state to the roles it accepts and the states
    they lead to; a conversation must end in one of `final`.
    """

    turn: tuple[str, ...] = ("<|im_start|>", "{role}", "\n", "{text}", "<|im_end|>\n")
    trained: frozenset[str] = frozenset({"assistant"})
    order: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            START: {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    final: frozenset[str] = frozenset({"assistant"})


_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_BACKSLASH = re.compile(r"\\(\\|n)")
_SEGMENT = "conv_id bigint, turn_no bigint, part_no int, text string, loss boolean, ok boolean"
_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint, valid boolean, first_bad_turn bigint"
)
_BATCH_CHARS = 1 << 20


def escape(text: str) -> str:
    """`text` without the opening of a control string: a backslash goes between < and |,
    and one more where there are some."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Like `escape`, and without a line break."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _BACKSLASH.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def step(template: Template, state: str, role: str) -> tuple[str, bool]:
    """State after `role` and whether it was accepted. A role out of order leads to the state
    that it would lead to elsewhere, so that one error is not counted again and again."""
    follow = template.order.get(state, {}).get(role)
    if follow is not None:
        return follow, True
    known = (moves[role] for moves in template.order.values() if role in moves)
    return next(known, state), False


def segments_of(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    """Text and loss flag of the segments of one turn; neighbours of one flag are joined."""
    parts: list[tuple[str, bool]] = []
    for part in template.turn:
        if part == "{text}":
            piece, loss = escape(text), role in template.trained
        else:
            piece, loss = (escape_role(role) if part == "{role}" else part), False
        if parts and parts[-1][1] == loss:
            parts[-1] = (parts[-1][0] + piece, loss)
        else:
            parts.append((piece, loss))
    return parts


def _batched(rows: Iterator[tuple], schema: str, width: int) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about `_BATCH_CHARS` characters; `width` is the text's place."""
    names = [column.split()[0] for column in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[column.split()[1]] for column in schema.split(", ")]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[width])
        if size >= _BATCH_CHARS:
            yield _record_batch(held, names, types)
            held, size = [], 0
    if held:
        yield _record_batch(held, names, types)


def _record_batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def format_chat(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments (`conv_id`, `turn_no`, `part_no`, `text`, `loss`, `ok`) of all `turns`
    (`conv_id`, `turn`, `role`, `text`).

    The text of a conversation is its segments' texts in the order of `turn_no` and `part_no`.
    Turns come in the order of `turn`, null first; equal ones by role and text, so repeated
    rows are repeated turns. Null roles and texts are empty. `ok` is false for a turn whose
    role the machine does not accept there; such turns are formatted all the same. Rows
    whose `conv_id` is null are one conversation. Other columns are not looked at.
    """
    template = template or Template()

    def format_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, own in groupby(rows, lambda row: row[0]):
            state = START
            for turn_no, (_, role, text) in enumerate(own):
                role, text = role or "", text or ""
                state, ok = step(template, state, role)
                for part_no, (piece, loss) in enumerate(segments_of(template, role, text)):
                    yield conv_id, turn_no, part_no, piece, loss, ok

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(format_rows(_rows(batches, "conv_id", "role", "text")), _SEGMENT, 3)

    bound_batches(turns.sparkSession)
    ordered = (
        turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.mapInArrow(run, _SEGMENT)


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation of `segments`, what its formatted text says when it is parsed again.

    Returns `conv_id`, `n_turns`, `turns_sha256` (of role, line break, text, line break per
    turn), `loss_chars` and `loss_sha256` (of all unescaped text that bears loss),
    `formatted_chars`, `valid` (the machine accepts all turns and the end) and
    `first_bad_turn`.
    """
    template = template or Template()
    parse = _parser(template)

    def digest_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, own in groupby(rows, lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = formatted = 0
            state, bad = START, None
            for turn_no, parts in groupby(own, lambda row: row[1]):
                whole = []
                for _, _, piece, bears_loss in parts:
                    whole.append(piece)
                    if bears_loss:
                        plain = unescape(piece)
                        loss_chars += len(plain)
                        loss.update(plain.encode())
                formatted += sum(map(len, whole))
                for role, text in parse("".join(whole)):
                    n_turns += 1
                    turns.update(f"{role}\n{text}\n".encode())
                    state, ok = step(template, state, role)
                    bad = turn_no if bad is None and not ok else bad
            valid = bad is None and state in template.final
            digests = turns.hexdigest(), loss_chars, loss.hexdigest()
            yield conv_id, n_turns, *digests, formatted, valid, bad

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, "conv_id", "turn_no", "text", "loss")
        yield from _batched(digest_rows(rows), _DIGEST, 2)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no", "part_no")
    return ordered.mapInArrow(run, _DIGEST)


def _parser(template: Template):
    """Finds (role, text) of all turns in formatted text by its control strings alone."""
    pattern = "".join(
        {"{role}": r"(?P<role>[^\n]*?)", "{text}": r"(?P<text>.*?)"}.get(part, re.escape(part))
        for part in template.turn
    )
    turn = re.compile(pattern, re.DOTALL)

    def parse(text: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(text):
            found = turn.match(text, at)
            if not found:
                raise ValueError(f"no turn at character {at}")
            yield unescape_role(found["role"]), unescape(found["text"])
            at = found.end()

    return parse
