from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lavra.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding(
    "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
TEXTS = [
    None,
    "",
    " ",
    "plain words, 123 and they'll",
    "tabs\tand\n\nlines  \r\n  end   ",
    "Ünïcödé ñ 漢字 🙂🙂   x  y",
    "<|endoftext|> is text",
    "a" * 3000 + " " + "ab" * 700,
    "\x00\x1c\x1f\x85 odd",
    "def f(x):\n    return x**2  # done",
]


def test_merges_like_the_library():
    draw = random.Random(3)
    for _ in range(400):
        word = "".join(draw.choices("abcdeéü漢 'sthing", k=draw.randint(1, 40)))
        expected = LIBRARY._encode_single_piece(word)
        assert bpe.merge(word.encode(), RANKS) == expected
        assert bpe._merge_long(word.encode(), RANKS) == expected


def test_many_words_at_once_equal_merge(monkeypatch):
    draw = random.Random(5)
    words = [
        "".join(draw.choices("abcdeéü漢 'sthing", k=draw.randint(0, 14))).encode() for _ in range(3000)
    ]
    words += [b"a" * n for n in range(33)] + [bytes([b]) for b in range(256)] + [words[0]] * 3
    words += [draw.randbytes(draw.randint(1, 32)) for _ in range(300)]
    pairs = bpe.Pairs.of(RANKS)
    expected = [bpe._packed(bpe.merge(word, RANKS)) if word else b"" for word in words]
    for block in (1, 7, bpe._MERGED_AT_ONCE):
        monkeypatch.setattr(bpe, "_MERGED_AT_ONCE", block)
        some = slice(None, 400) if block == 1 else slice(None)
        assert bpe.merge_many(words[some], pairs) == expected[some]
    assert bpe.merge_many([], pairs) == []


def test_fold_equals_merge(spark):
    draw = random.Random(4)
    words = ["x", "é", "ing", " the"]
    words += [" " + "".join(draw.choices("abcdeésthing", k=draw.randint(2, 12))) for _ in range(60)]
    frame = spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")
    for row in bpe.fold_merges(frame, RANKS).collect():
        assert row["ids"] == bpe.merge(row["word"].encode(), RANKS)


@pytest.mark.parametrize("table_words, bound", [(1, 3 << 16), (1000, 3 << 16), (5, 3)])
def test_whole_texts_like_the_library_and_back(docs, monkeypatch, table_words, bound):
    """Whatever the table holds, and however little a worker remembers."""
    monkeypatch.setattr(bpe, "MEMORY_WORDS", bound)
    monkeypatch.setattr(bpe, "_GROUP_CHARS", 1 << 19 if bound > 3 else 10)
    frame = docs(*enumerate(TEXTS), (3, TEXTS[3])).selectExpr("*", "1 AS word", "2 AS parts")
    coded = bpe.encode(frame, RANKS, public_tokenizers.PATTERN, table_words=table_words)
    found = coded.withColumn("bytes", bpe.decode(F.col("ids"), frame, RANKS)).collect()
    assert len(found) == len(TEXTS) + 1
    reports = {r["doc_id"]: r for r in bpe.digests(coded, RANKS).collect()}
    at_once = bpe.encode_digests(frame, RANKS, public_tokenizers.PATTERN, table_words=table_words)
    assert sorted(at_once.collect()) == sorted(bpe.digests(coded, RANKS).collect())
    for row in found:
        text = TEXTS[row["doc_id"]] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert row["ids"] == ids
        assert bytes(row["bytes"]) == text.encode()
        report = reports[row["doc_id"]]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert report["n_tokens"] == len(ids)
        assert report["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert report["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_report_of_nothing(docs):
    from lavra.llm import queries

    assert queries.bpe_report(docs()).count() == 0
    (row,) = queries.bpe_report(docs((1, None))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (1, 0, empty, empty)


def test_plan_text_is_bounded(spark, docs):
    """Spark keeps the text of plans, and the rank map is a literal of some megabytes."""
    bpe.encode(docs((1, "a word")), RANKS, public_tokenizers.PATTERN)
    frame = spark.createDataFrame([(" word",)], "word string")
    plan = bpe.fold_merges(frame, RANKS)._jdf.queryExecution()
    assert len(plan.toString()) < 200_000


def _same(rows):
    return sorted(tuple(row) for row in rows)


@pytest.mark.parametrize("most", [1, 2, 5, 6, 40, 1000])
def test_most_frequent_words(spark, most):
    """The first by count and then by word, whatever powers of two the counts lie between."""
    draw = random.Random(most)
    counts = {f"w{i}": draw.choice([1, 1, 2, 3, 3, 4, 7, 8, 9, 300]) for i in range(60)}
    counted = spark.createDataFrame(list(counts.items()), "word string, count bigint")
    expected = sorted(counts, key=lambda word: (-counts[word], word))[:most]
    found = [row["word"] for row in bpe.most_frequent(counted, most).collect()]
    assert found == expected
    assert bpe.most_frequent(counted.limit(0), most).collect() == []


def test_each_word_of_the_table_is_folded_once(docs, monkeypatch):
    """The fold runs on a written table, so that a limit above it folds no words to drop them,
    and no plan with exchanges holds the rank map."""
    plans, fold = [], bpe.fold_merges

    def seen(words, ranks):
        plans.append(words._jdf.queryExecution().optimizedPlan().toString())
        return fold(words, ranks)

    monkeypatch.setattr(bpe, "fold_merges", seen)
    frame = docs(*((i, f"a{i % 7} b{i} and words") for i in range(50)))
    coded = bpe.encode_digests(frame, RANKS, public_tokenizers.PATTERN, table_words=9)
    expected = bpe.digests(bpe.encode(frame, RANKS, public_tokenizers.PATTERN), RANKS)
    assert _same(coded.collect()) == _same(expected.collect())
    assert len(plans) == 2
    assert not any(word in plan for plan in plans for word in ("Limit", "Sort", "Aggregate"))


def test_what_tasks_get_is_flat(spark, docs, monkeypatch):
    """The driver holds the table as Arrow and numpy buffers: no object per word or piece."""
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or send(self, value)
    )
    bpe.encode_digests(docs((1, "some words")), RANKS, public_tokenizers.PATTERN)
    (tables,) = sent
    assert set(vars(tables)) == {"folded", "pieces", "pairs"}
    assert tables.folded.num_rows == 2
    assert tables.known == {b"some": bpe._packed(bpe.merge(b"some", RANKS)),
                            b" words": bpe._packed(bpe.merge(b" words", RANKS))}
    assert tables.ranks == RANKS


def test_no_table_at_all(docs):
    frame = docs((1, "some words"), (2, None))
    none = bpe.encode_digests(frame, RANKS, public_tokenizers.PATTERN, table_words=0)
    some = bpe.encode_digests(frame, RANKS, public_tokenizers.PATTERN, table_words=10)
    assert _same(none.collect()) == _same(some.collect())
