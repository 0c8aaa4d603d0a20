"""Counts against the library's ids of whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from lavra.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = tc.read_model(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
LENGTHS = tc.Lengths({}, MODEL)

SPECIAL = [
    "", None, " ", "   ", "\n", "a", " a", "a ", "  a  b  ", "a\nb", "a\n\n b", "\n a", "a\tb", "▁", "▁a",
    "a▁b", "a▁ ▁b", " ▁", "<s>x</s><unk>", "<0x0A>", "\0", "a\0b", "é", "中文字", "é" * 300,
    "😀👩‍👩‍👧 x", "12345 67,890.12", " x　y", "﻿a", "\r\n", "a" * 5000, " " * 5000, "ab" * 3000,
]


def split_count(text):
    import re

    parts = re.compile(MODEL.pattern).findall
    cut = re.compile(MODEL.boundary)
    return sum(LENGTHS[p] for block in tc.blocks(tc.escaped(text), cut) for p in parts(block))


def counts(df, limit=tc.LIMIT):
    return sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect())


def plain(rows, limit=tc.LIMIT):
    return sorted(
        (i, len((t or "").encode()), n, n > limit)
        for i, t in rows
        for n in [len(LIBRARY.encode(t or ""))]
    )


def random_texts(seed, n):
    draw = random.Random(seed)
    pieces = [LIBRARY.id_to_piece(i).replace(tc.BLANK, " ") for i in draw.sample(range(300, 32000), 400)]
    return ["".join(draw.choices(pieces + [" ", "\n", "x", "▁"], k=draw.randint(1, 80))) for _ in range(n)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tabthe12.,'é中<>/s"), st.characters(exclude_categories=["Cs"])), max_size=120))
def test_parts_add_up(text):
    assert split_count(text) == len(LIBRARY.encode(text))


def test_parts_add_up_on_pieces():
    for text in random_texts(1, 1500) + SPECIAL[2:]:
        assert split_count(text) == len(LIBRARY.encode(text))


@pytest.mark.parametrize("block", [1, 7, 50])
def test_blocks_do_not_change_counts(monkeypatch, block):
    monkeypatch.setattr(tc, "_BLOCK", block)
    for text in random_texts(2, 200) + SPECIAL[2:]:
        assert split_count(text) == len(LIBRARY.encode(text))


@pytest.mark.parametrize("entries", [1, 50, tc.TABLE_ENTRIES])
def test_equals_library(docs, entries):
    rows = list(enumerate(SPECIAL + random_texts(3, 200))) + [(1, "again"), (1, "again")]
    found = counts(tc.count_tokens(docs(*rows), MODEL, table_entries=entries))
    assert found == plain(rows)


def test_limit_and_long_texts(docs):
    rows = [(1, "word " * 4095 + "w"), (2, "word " * 4096), (3, "".join(random_texts(4, 3000))), (4, "中a" * 50_000)]
    assert counts(tc.count_tokens(docs(*rows), MODEL)) == plain(rows)


def test_empty_table_and_clashing_names(spark, docs):
    assert tc.count_tokens(docs(), MODEL).collect() == []
    rows = spark.createDataFrame([(None, "one two", "mine", 5)], "doc_id bigint, text string, N_TOKENS string, packed int")
    (row,) = tc.count_tokens(rows, MODEL).collect()
    assert row["n_tokens"] == len(LIBRARY.encode("one two")) and row["packed"] == 5 and row["doc_id"] is None


def test_worker_memory_is_bounded():
    lengths = tc.Lengths({"▁the": 1}, MODEL, most=10)
    for i in range(100):
        assert lengths[f"▁w{i}"] == len(LIBRARY.encode(f"w{i}"))
        assert len(lengths) <= 11 and lengths["▁the"] == 1
    before = lengths.encoded
    assert lengths["▁w99"] and lengths.encoded == before


def test_summary_keeps_frequent_entries():
    """Whatever the order and the merges, an entry with more than a share of 1/most stays."""
    draw = random.Random(5)
    stream = ["hot"] * 3000 + ["warm"] * 1500 + [f"w{draw.randrange(4000)}" for _ in range(8000)]
    draw.shuffle(stream)
    whole = tc.Summary(50)
    for at in range(0, len(stream), 500):
        one = tc.Summary(50)
        for part in range(at, at + 500, 100):
            one.add(stream[part : part + 100])
        whole.merge(one.packed())
        assert len(whole.counts) <= 100
    assert [k for k, _ in whole.counts.most_common(2)] == ["hot", "warm"]


def test_other_models_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte fallback"):
        tc.Model(proto.SerializeToString())


def test_no_shuffle_of_parts(docs):
    """The counting plan has no exchange: the table was made before, and rows stay where they are."""
    plan = tc.count_tokens(docs((1, "a b")), MODEL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
