"""The transformation against plain slicing, and chunks against the whole text."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lavra.llm import fill_middle as fim

WEIGHTS = fim._byte_weights()


def plain(id, text):
    """The form by slices of the whole text."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(c in text for c in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    draw = random.Random(1)
    mixed = "ab <P\n>SMé中😀"
    wide = "".join(draw.choices("é中😀x", k=9000))
    ascii_ = "".join(draw.choices("abc d\n", k=9000))
    special = ["", None, "a", "<P>", "x<S>y", "<M", "<", "a<", "é", "😀" * 50, "<" * 200, "\0" * 5000]
    # A control string at every place around the ends of chunks, also of the longest ones.
    ends = fim.chunk_ends(np.frombuffer(ascii_.encode(), np.uint8), WEIGHTS)
    split = [ascii_[: e + d] + "<M>" + ascii_[e + d :] for e in ends[:4] for d in (-3, -2, -1, 0, 1)]
    uniform = ["a" * (4096 + d) + "<S>" + "a" * 50 for d in (-3, -2, -1, 0)]
    drawn = ["".join(draw.choices(mixed, k=draw.randint(1, 400))) for _ in range(300)]
    return [*special, *split, *uniform, *drawn, wide, ascii_, wide + ascii_, ascii_]


def test_equals_slices_and_restores(docs):
    rows = list(enumerate(texts())) + [(None, "no id at all"), (7, "again"), (7, "again")]
    made = fim.transform(docs(*rows)).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    found = made.select("doc_id", *fim._NEW, "back").collect()
    expected = [(id, *plain(id, text), text or "") for id, text in rows]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_very_long_text(docs):
    draw = random.Random(2)
    text = "".join(draw.choices("abcdé中 ", k=3_000_000))
    rows = [(id, text) for id in (1, 2, 3)]
    made = fim.transform(docs(*rows))
    same = fim.restore(F.col("output"), F.col("form")) == F.col("text")
    for row in made.select(*fim._NEW, "doc_id", same.alias("same")).collect():
        assert tuple(row)[:5] == plain(row["doc_id"], text) and row["same"]


def test_empty_table_and_clashing_names(spark, docs):
    assert fim.transform(docs()).collect() == []
    rows = spark.createDataFrame([(1, "some text", "mine", 5, "x")], "doc_id int, text string, FORM string, n int, _made string")
    made = fim.transform(rows)
    assert made.columns == ["doc_id", "text", "_made", *fim._NEW]
    (row,) = made.collect()
    assert tuple(row)[3:] == plain(1, "some text") and row["_made"] == "x"


def test_struct_is_computed_once(docs):
    made = fim.transform(docs((1, "text")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("forms(") == 1


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
def test_cuts_do_not_depend_on_blocks(monkeypatch, block):
    text = np.frombuffer(random.Random(3).randbytes(20000), np.uint8)
    whole = fim._hash_cuts(text, WEIGHTS).tolist()
    monkeypatch.setattr(fim, "_BLOCK", block)
    assert fim._hash_cuts(text, WEIGHTS).tolist() == whole
    # The rolling sum, byte by byte.
    rolling, found = 0, []
    for i, byte in enumerate(text.tolist()):
        rolling = ((rolling << 1) + int(WEIGHTS[byte])) & 0xFFFFFFFF
        if rolling >> (32 - fim.MEAN_BITS) == 0:
            found.append(i + 1)
    assert found == whole


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=9000))
def test_chunks_cover_the_text(content):
    ends = fim.chunk_ends(np.frombuffer(content, np.uint8), WEIGHTS)
    sizes = np.diff([0, *ends])
    assert (ends[-1] if ends else 0) == len(content)
    assert all(fim.SHORTEST <= size <= fim.LONGEST for size in sizes[:-1])
    assert all(0 < size <= fim.LONGEST for size in sizes[-1:])


def test_shared_passages_share_chunks():
    """Behind different openings, a long passage is worked out once."""
    draw = random.Random(4)
    passage = "".join(draw.choices("abcdefgh ", k=40_000))
    memory = fim.Memory()
    for opening in ("", "x", "another opening " * 30):
        fim.Measured((opening + passage).encode(), WEIGHTS, memory)
    once = len(fim.chunk_ends(np.frombuffer(passage.encode(), np.uint8), WEIGHTS))
    assert once <= memory.worked_out <= once + 12


def test_memory_is_bounded_and_compares_content():
    memory = fim.Memory(4000)
    draw = random.Random(5)
    chunks = [draw.randbytes(draw.randint(64, 300)) for _ in range(200)]
    for content in chunks + chunks[::-1]:
        assert memory.summary(content) == fim.summarize(content)
        held = sum(map(len, memory.new)) + sum(map(len, memory.old))
        assert held <= 4000
