"""Token counts of a sentence-piece vocabulary, by looking up the lengths of pre-tokens.

A pre-token is a part of the text that no merge can leave. Its token count therefore does not
depend on its neighbours, and a text's count is a sum. Lengths of the most frequent pre-tokens go
to every task as one compact table; each worker encodes the others itself and remembers them.
No pre-token is ever shuffled: the table comes from bounded summaries, one row per task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from lavra.llm.common import bound_batches, utf8_bytes

LIMIT = 4096
# The mark that the vocabulary has for a blank.
BLANK = "▁"

# Bounds of the table that every task gets: pre-tokens, and characters of one.
TABLE_ENTRIES = 1 << 16
TABLE_CHARS = 24
# Pre-tokens that a task's summary keeps, and that a worker remembers beside the table.
SUMMARY_ENTRIES = 1 << 13
CACHE_ENTRIES = 1 << 18
# Summaries are merged in two levels, so that a merge reads one in so many.
FIRST_MERGES, SECOND_MERGES = 256, 16

# Longer pre-tokens are cut where no merge can pass, and not remembered.
_LONG = 64
# Characters of a text that are split at once.
_BLOCK = 1 << 18


class Model:
    """What can be said of a vocabulary without encoding: where no merge can pass."""

    def __init__(self, serialized: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(serialized)
        norm, train, kinds = proto.normalizer_spec, proto.trainer_spec, type(proto.SentencePiece())
        plain = [piece.piece for piece in proto.pieces if piece.type == kinds.NORMAL]
        known = {kinds.NORMAL, kinds.BYTE, kinds.UNKNOWN, kinds.CONTROL}
        if not (
            train.model_type == train.BPE
            and train.byte_fallback
            and not train.treat_whitespace_as_suffix
            and norm.name == "identity"
            and norm.add_dummy_prefix
            and norm.escape_whitespaces
            and not norm.remove_extra_whitespaces
            and {piece.type for piece in proto.pieces} <= known
        ):
            raise ValueError(
                "only BPE vocabularies with byte fallback, an unchanged text and a blank put "
                "before it can be counted by pre-tokens"
            )
        # Two characters can end up in one piece only if some piece has them side by side.
        self.pairs = frozenset(a + b for piece in plain for a, b in zip(piece, piece[1:]))
        if any(b == BLANK != a for a, b in self.pairs):
            raise ValueError("a piece has a blank behind another character")
        # No merge passes from another character to a blank, and none a line break if no piece
        # has one.
        lone = not any("\n" in pair for pair in self.pairs)
        # Without the blank in front, which `escaped` adds, parts can be encoded by themselves.
        norm.add_dummy_prefix = False
        self.serialized = proto.SerializeToString()
        self.pattern = (
            f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n+" if lone else f"{BLANK}+[^{BLANK}]*"
        )
        self.boundary = f"[^{BLANK}](?={BLANK})" + ("|\n" if lone else "")


def read_model(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def escaped(text: str) -> str:
    """The text as the library sees it; an empty one stays empty."""
    return BLANK + text.replace(" ", BLANK) if text else ""


def blocks(text: str, boundary: re.Pattern) -> Iterator[str]:
    """An escaped text in parts of some bounded length, cut only at a boundary: a count is the
    sum of the counts of the parts."""
    start = 0
    while len(text) - start > _BLOCK:
        found = boundary.search(text, start + _BLOCK)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


class Lengths(dict):
    """Token counts by pre-token: the table, and what this worker has encoded since."""

    def __init__(self, table: dict[str, int], model: Model, most: int = CACHE_ENTRIES):
        super().__init__(table)
        self.table, self.most, self.pairs = table, len(table) + most, model.pairs
        library = sentencepiece.SentencePieceProcessor(model_proto=model.serialized)
        self.encode = library.encode
        self.encoded = 0

    def __missing__(self, part: str) -> int:
        if len(part) > _LONG:
            parts = self.cut(part)
            if len(parts) > 1:
                return sum(map(self.__getitem__, parts))
        self.encoded += 1
        length = len(self.encode(part))
        if len(part) <= _LONG:
            if len(self) >= self.most:
                self.clear()
                self.update(self.table)
            self[part] = length
        return length

    def cut(self, part: str) -> list[str]:
        """The parts of a long pre-token between which no piece can reach."""
        pairs = self.pairs
        ends = [i for i, pair in enumerate(map(str.__add__, part, part[1:]), 1) if pair not in pairs]
        return [part[a:b] for a, b in zip([0, *ends], [*ends, len(part)], strict=True)]


class Summary:
    """The most frequent entries of a stream, in bounded memory: when there are twice as many as
    may stay, the count that half of them reach is taken off all, and those without any go."""

    def __init__(self, most: int):
        self.most, self.counts = most, Counter()

    def add(self, parts: Iterable[str]) -> None:
        self.counts.update(parts)
        self._shrink(2 * self.most)

    def merge(self, packed: bytes) -> None:
        lines, _, counts = zlib.decompress(packed).partition(b"\0")
        numbers = np.frombuffer(counts, np.int64).tolist()
        for part, count in zip(lines.decode().split("\n"), numbers, strict=False):
            self.counts[part] += count
        self._shrink(2 * self.most)

    def _shrink(self, above: int) -> None:
        if len(self.counts) > above:
            off = sorted(self.counts.values(), reverse=True)[self.most]
            self.counts = Counter({k: n - off for k, n in self.counts.items() if n > off})

    def packed(self) -> bytes:
        """Entries, a line each, and their counts."""
        self._shrink(self.most)
        counts = np.array(list(self.counts.values()), np.int64).tobytes()
        return zlib.compress("\n".join(self.counts).encode() + b"\0" + counts, 1)


def _countable(part: str) -> bool:
    return len(part) <= TABLE_CHARS and "\n" not in part and "\0" not in part


def frequent_parts(text: Column, docs: DataFrame, model: Model, most: int) -> list[str]:
    """Up to `most` of the pre-tokens that all texts have most often.

    Every task reads its texts and hands on one packed summary of at most SUMMARY_ENTRIES;
    summaries are merged by tasks, then by fewer tasks, and the driver merges the last 16.
    Which pre-tokens are found changes the speed and no count.
    """
    pattern, boundary = model.pattern, model.boundary

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cut = re.compile(pattern).findall, re.compile(boundary)
        summary = Summary(SUMMARY_ENTRIES)
        for batch in batches:
            for one in batch.column("text"):
                for block in blocks(escaped(one.as_py()), cut):
                    summary.add(filter(_countable, split(block)))
        if summary.counts:
            yield pa.RecordBatch.from_arrays([pa.array([summary.packed()])], names=["packed"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(most)
        for batch in batches:
            for one in batch.column("packed"):
                summary.merge(one.as_py())
        if summary.counts:
            yield pa.RecordBatch.from_arrays([pa.array([summary.packed()])], names=["packed"])

    summaries = docs.select(text.alias("text")).mapInArrow(summarize, "packed binary")
    for merges in (FIRST_MERGES, SECOND_MERGES):
        place = F.xxhash64("packed")
        summaries = summaries.repartition(merges, place).mapInArrow(merge, "packed binary")
    whole = Summary(most)
    for row in summaries.collect():
        whole.merge(row["packed"])
    ordered = sorted(whole.counts.items(), key=lambda entry: (-entry[1], entry[0]))
    return [part for part, _ in ordered[:most]]


def _compact(table: dict[str, int]) -> bytes:
    lengths = np.array(list(table.values()), np.uint8).tobytes()
    return zlib.compress("\n".join(table).encode() + b"\0" + lengths)


def _spread(packed: bytes) -> dict[str, int]:
    lines, _, lengths = zlib.decompress(packed).partition(b"\0")
    return dict(zip(lines.decode().split("\n"), lengths, strict=False)) if lengths else {}


def count_tokens(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    limit: int = LIMIT,
    table_entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """`docs` with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens).

    `n_tokens` is the number of ids that the library gives for the whole text, without ids for
    begin and end; strings of special tokens are ordinary text. Null text counts as empty and
    has no tokens. Rows keep their number and columns; a column named like a new one, in either
    case, is replaced.
    """
    bound_batches(docs.sparkSession)
    whole = F.coalesce(docs[text], F.lit(""))
    parts = frequent_parts(whole, docs, model, table_entries)
    encoder = Lengths({}, model)
    table = {part: encoder[part] for part in parts}
    sent = docs.sparkSession.sparkContext.broadcast((_compact(table), model))

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packed, own = sent.value
        split, cut = re.compile(own.pattern).findall, re.compile(own.boundary)
        of = Lengths(_spread(packed), own).__getitem__

        def count(text: str) -> int:
            return sum(sum(map(of, split(block))) for block in blocks(escaped(text), cut))

        for batch in batches:
            yield pa.array([count(one.as_py()) for one in batch], pa.int64())

    measured = {"n_bytes": utf8_bytes(docs[text]), "n_tokens": counted(whole)}
    return docs.withColumns(measured).withColumn("over_limit", F.col("n_tokens") > limit)
