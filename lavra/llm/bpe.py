"""Byte-level BPE encoding and decoding.

Counting the words of the corpus is a Spark aggregation. Higher-order functions fold the ranked
merges over the bytes of the most frequent distinct words, with the rank map as a literal. That
bounded word table goes to every task, where texts become ids by looking up each distinct word
of a group of them; words outside the table are merged on the spot by the same rule, so the
table's size changes speed, not results.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches, bound_plan_texts
from lavra.runtime import staging

# Bound of the word table that every task gets, and of the bytes of a word in it.
TABLE_WORDS = 1 << 16
TABLE_WORD_BYTES = 32
# Words that a Python worker remembers at most, the table among them.
MEMORY_WORDS = 3 << 16
# Words that one task folds.
_FOLDED_AT_ONCE = 1 << 13
# The literal rank map is an array of small maps: a key's bucket is its checksum's remainder.
_BUCKETS = 1 << 14
# Bytes of a word up to which scanning is faster than keeping a queue.
_SHORT = 64
# Characters of texts whose distinct words are looked up, and merged if unknown, together; and
# words in one block of such merging.
_GROUP_CHARS = 1 << 21
_MERGED_AT_ONCE = 1 << 13
# In place of a rank: larger than any.
_NONE = (1 << 31) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: Base64 bytes and rank per line."""
    with open(path, "rb") as lines:
        rows = (line.split() for line in lines if line.strip())
        return {base64.b64decode(piece): int(rank) for piece, rank in rows}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank joins first, the leftmost of equals."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return _merge_short(word, ranks) if len(word) <= _SHORT else _merge_long(word, ranks)


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges with a scan for the lowest rank each time."""
    rank_of, none = ranks.get, len(ranks) + (1 << 32)
    bounds = list(range(len(word) + 1))
    pairs = [rank_of(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (lowest := min(pairs)) != none:
        i = pairs.index(lowest)
        del bounds[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank_of(word[bounds[i] : bounds[i + 2]], none)
        if i:
            pairs[i - 1] = rank_of(word[bounds[i - 1] : bounds[i + 1]], none)
    return [ranks[word[a:b]] for a, b in pairwise(bounds)]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges with a queue of pairs, so that the time hardly grows faster than the word."""
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = list(range(1, n + 1))
    queue = [
        (rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None
    ]
    heapq.heapify(queue)
    while queue:
        _, left, until = heapq.heappop(queue)
        right = after[left]
        # A pair counts only as long as both of its parts are still what they were.
        if end[left] < 0 or right >= n or end[right] != until:
            continue
        end[left], after[left], end[right] = until, after[right], -1
        if after[left] < n:
            before[after[left]] = left
        for a, b in ((before[left], left), (left, after[left])):
            if a >= 0 and b < n:
                rank = ranks.get(word[a : end[b]])
                if rank is not None:
                    heapq.heappush(queue, (rank, a, end[b]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = after[at]
    return ids


@dataclass(frozen=True)
class Pairs:
    """Ranks of joined pairs, for merging many words at once: `keys` (sorted) are the first
    part's rank times the vocabulary's size plus the second's, `ranks` those of both joined.
    `bytes` are the ranks of single bytes, `starts` those of each byte followed by each."""

    keys: np.ndarray
    ranks: np.ndarray
    bytes: np.ndarray
    starts: np.ndarray
    size: int

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Pairs:
        size = max(ranks.values(), default=0) + 1
        found = (
            (first * size + second, rank)
            for piece, rank in ranks.items()
            for at in range(1, len(piece))
            if (first := ranks.get(piece[:at])) is not None
            and (second := ranks.get(piece[at:])) is not None
        )
        table = np.fromiter(found, [("key", np.int64), ("rank", np.int32)])
        table.sort(order="key")
        single = [ranks.get(bytes([byte]), -1) for byte in range(256)]
        starts = [ranks.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)]
        return cls(
            table["key"].copy(),
            table["rank"].copy(),
            np.array(single, np.int32),
            np.array(starts, np.int32),
            size,
        )

    def rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Rank of every pair; _NONE for those that do not join, or have no second part."""
        if not len(self.keys):
            return np.full(first.shape, _NONE, np.int32)
        key = first.astype(np.int64) * self.size + second
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (second >= 0), self.ranks[at], _NONE)


def merge_many(words: Sequence[bytes], pairs: Pairs) -> list[bytes]:
    """Packed ids of many words, by the same rule as `merge`: in each step every word joins its
    adjacent pair of lowest rank, the leftmost of equals, until none of its pairs has a rank."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    packed: list[bytes] = [b""] * len(words)
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(words), _MERGED_AT_ONCE):
        chosen = order[at : at + _MERGED_AT_ONCE]
        for word, ids in zip(chosen.tolist(), _merge_block(words, chosen, lengths, pairs), strict=True):
            packed[word] = ids
    return packed


def _merge_block(
    words: Sequence[bytes], chosen: np.ndarray, lengths: np.ndarray, pairs: Pairs
) -> list[bytes]:
    width = int(lengths[chosen].max(initial=0)) + 1
    columns = np.arange(width)
    inside = columns[None, :] < lengths[chosen][:, None]
    # A row per word, ended by -1; every step shortens the rows that still have a pair.
    content = np.frombuffer(b"".join(words[i] for i in chosen), np.uint8)
    ids = np.full((len(chosen), width), -1, np.int32)
    ids[inside] = pairs.bytes[content]
    ranks = np.full((len(chosen), width), _NONE, np.int32)
    paired = inside.copy()
    paired[:, :-1] &= inside[:, 1:]
    at = np.flatnonzero(paired[inside])
    ranks[paired] = pairs.starts[content[at].astype(np.int32) << 8 | content[at + 1]]
    rows = np.arange(len(chosen))
    left, left_ranks = ids, ranks
    while len(rows):
        place = left_ranks.argmin(axis=1)
        lowest = left_ranks[np.arange(len(rows)), place]
        more = lowest != _NONE
        if not more.all():
            ids[rows[~more], : left.shape[1]] = left[~more]
            ids[rows[~more], left.shape[1] :] = -1
            rows, place, lowest = rows[more], place[more], lowest[more]
            left, left_ranks = left[more], left_ranks[more]
            if not len(rows):
                break
        # What stands behind the pair's first part moves up by one.
        source = columns[None, : left.shape[1] - 1] + (
            columns[None, : left.shape[1] - 1] > place[:, None]
        )
        left = np.take_along_axis(left, source, axis=1)
        left_ranks = np.take_along_axis(left_ranks, source, axis=1)
        every = np.arange(len(rows))
        left[every, place] = lowest
        after = np.minimum(place + 1, left.shape[1] - 1)
        behind = np.where(after > place, left[every, after], -1)
        left_ranks[every, place] = pairs.rank(lowest, behind)
        second = np.flatnonzero(place > 0)
        before = place[second] - 1
        left_ranks[second, before] = pairs.rank(left[second, before], lowest[second])
    sizes = (ids >= 0).sum(axis=1)
    flat, ends = ids[ids >= 0].astype("=i4").tobytes(), np.cumsum(sizes) * 4
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _java_pattern(pattern: str) -> str:
    """The same classes in Spark's expressions: Unicode white space as well."""
    return f"(?U){pattern}"


def count_words(text: Column, docs: DataFrame, pattern: str) -> DataFrame:
    """Distinct words (`word`) and the number of documents (`count`) that each stands in."""
    matches = F.regexp_extract_all(text, F.lit(_java_pattern(pattern)), F.lit(0))
    return (
        docs.select(F.explode(F.array_distinct(matches)).alias("word"))
        .groupBy("word")
        .count()
        .where(F.octet_length("word") <= TABLE_WORD_BYTES)
    )


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The `most` words of the largest counts; ties go by word.

    `counted` should be written, as it is read twice: first for the number of words by power of
    two of their count, so that only words that may be among the first are put in order.
    """
    power = F.length(F.bin("count"))
    sizes = counted.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("words")).collect()
    words = {row["power"]: row["words"] for row in sizes}
    least, found = 0, 0
    for least in sorted(words, reverse=True):
        found += words[least]
        if found >= most:
            break
    return (
        counted.where(power >= least).orderBy(F.desc("count"), "word").limit(most).select("word")
    )


def _rank_map(ranks: dict[bytes, int]) -> Column:
    """Literal array of maps from hexadecimal pieces to ranks, by checksum of the piece."""
    buckets: list[dict[str, int]] = [{} for _ in range(_BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        buckets[zlib.crc32(key.encode()) % _BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """`body(value)`, with `value` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`word` and `ids` of distinct words: a fold that joins one pair per step until no pair
    has a rank. Parts are hexadecimal texts of bytes, so joining bytes is joining texts."""
    table = _rank_map(ranks)

    def rank(piece: Column) -> Column:
        bucket = F.get(table, (F.crc32(piece) % _BUCKETS).cast("int"))
        return F.try_element_at(bucket, piece)

    def pair_ranks(parts: Column) -> Column:
        n = F.size(parts) - 1
        return F.zip_with(
            F.slice(parts, 1, n), F.slice(parts, 2, n), lambda a, b: rank(F.concat(a, b))
        )

    def step(parts: Column, _: Column) -> Column:
        return F.when(F.size(parts) < 2, parts).otherwise(_let(pair_ranks(parts), join_best(parts)))

    def join_best(parts: Column):
        def joined(found: Column) -> Column:
            at = F.array_position(found, F.array_min(found)).cast("int")
            both = F.concat(F.get(parts, at - 1), F.get(parts, at))
            head, tail = F.slice(parts, 1, at - 1), F.slice(parts, at + 2, F.size(parts))
            return F.when(F.array_min(found).isNull(), parts).otherwise(
                F.concat(head, F.array(both), tail)
            )

        return joined

    pieces = F.regexp_extract_all(F.hex(F.encode("word", "UTF-8")), F.lit(".."), F.lit(0))
    steps = F.sequence(F.lit(1), F.greatest(F.size("parts") - 1, F.lit(1)))
    folded = F.aggregate(steps, F.col("parts"), step)
    return words.select("word", pieces.alias("parts")).select(
        "word", F.transform(folded, rank).alias("ids")
    )


def _folded(words: DataFrame, ranks: dict[bytes, int], most: int) -> pa.Table:
    """The folded table of at most `most` words. They are written before they are folded: each
    is folded once, in tasks of equal size, and the plan that holds the rank map is a short one."""
    tasks = max(1, -(-most // _FOLDED_AT_ONCE))
    with staging(words.repartition(tasks), "bpe_words") as written:
        return fold_merges(written, ranks).toArrow()


@dataclass
class _Tables:
    """What every task gets: the folded table, the pieces by rank and the ranks of pairs. The
    dictionaries are made where they are used, once in a Python worker."""

    folded: pa.Table
    pieces: pa.LargeBinaryArray
    pairs: Pairs

    @cached_property
    def known(self) -> dict[bytes, bytes]:
        """Packed ids of the words of the folded table."""
        words = self.folded["word"].cast(pa.large_binary()).to_pylist()
        ids = chain.from_iterable(map(_rows, self.folded["ids"].chunks))
        return {word: one.tobytes() for word, one in zip(words, ids, strict=True)}

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        pieces = enumerate(self.pieces.to_pylist())
        return {piece: rank for rank, piece in pieces if piece is not None}


def _tables(
    docs: DataFrame, text: Column, ranks: dict[bytes, int], pattern: str, table_words: int
) -> Broadcast:
    """The folded table, the pieces and their pairs, for every task."""
    spark = docs.sparkSession
    bound_batches(spark)
    bound_plan_texts(spark)
    with staging(count_words(text, docs, pattern), "bpe_counts") as counted:
        folded = _folded(most_frequent(counted, table_words), ranks, table_words)
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    tables = _Tables(folded, pa.array(pieces, pa.large_binary()), Pairs.of(ranks))
    return spark.sparkContext.broadcast(tables)


def _taken(values: pa.LargeBinaryArray, places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the chosen values, one after the other, and where each starts and ends."""
    if not len(places):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, content = values.take(places).buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(places) + 1]
    return np.frombuffer(content, np.uint8)[: ends[-1]], ends


# Ids of some texts, one after the other, and where each text's ids start and end.
_Coded = tuple[np.ndarray, np.ndarray]


def _coder(tables: _Tables, pattern: str) -> Callable[[pa.Array], Iterator[_Coded]]:
    """A task's function from texts to their ids, for some texts at a time.

    Texts are taken together up to some length. Arrow finds their distinct words; those that are
    not known yet are merged at once, and each occurrence takes its word's ids. Words are
    remembered until there are too many; then the table alone stays.
    """
    split = regex.compile(pattern).findall
    known = dict(tables.known)

    def learn(words: list[bytes]) -> list[bytes]:
        """Merge the words that are not known; returns those too long to be remembered."""
        new = [word for word in words if word not in known]
        long = [word for word in new if len(word) > TABLE_WORD_BYTES]
        short = [word for word in new if len(word) <= TABLE_WORD_BYTES]
        known.update(zip(short, merge_many(short, tables.pairs), strict=True))
        known.update((word, _packed(merge(word, tables.ranks))) for word in long)
        return long

    def code_group(group: list[list[str]]) -> _Coded:
        every = pa.array(chain.from_iterable(group), pa.large_string()).dictionary_encode()
        words = every.dictionary.cast(pa.large_binary()).to_pylist()
        long = learn(words)
        packed = pa.array(map(known.__getitem__, words), pa.large_binary())
        ids, ends = _taken(packed, every.indices)
        for word in long:
            del known[word]
        if len(known) > MEMORY_WORDS:
            known.clear()
            known.update(tables.known)
        return ids.view(np.int32), ends[np.cumsum([0, *map(len, group)])] // 4

    def code(texts: pa.Array) -> Iterator[_Coded]:
        group: list[list[str]] = []
        size = 0
        for one in texts:
            text = one.as_py()
            group.append(split(text))
            size += len(text)
            if size >= _GROUP_CHARS:
                yield code_group(group)
                group, size = [], 0
        if group:
            yield code_group(group)

    return code


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    name: str = "ids",
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """`docs` with `name`, the ids (array<int>) of the whole `text`; null and empty have none.

    `pattern` splits the text; each match is merged by itself, and there are no special
    tokens. `table_words` bounds the distinct words that are folded beforehand and sent out.
    """
    whole = F.coalesce(docs[text], F.lit(""))
    tables = _tables(docs, whole, ranks, pattern, table_words)

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        code = _coder(tables.value, pattern)
        for batch in batches:
            coded = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                for ids, ends in code(batch)
            ]
            yield pa.concat_arrays(coded) if coded else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(name, ids_of(whole))


def encode_digests(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """What `digests` gives for the ids of `encode`, in one pass: ids are decoded where they
    were made, and only their digests leave the task."""
    whole = F.coalesce(docs[text], F.lit(""))
    tables = _tables(docs, whole, ranks, pattern, table_words)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, pieces = _coder(tables.value, pattern), tables.value.pieces
        for batch in batches:
            done = 0
            for ids, ends in code(batch.column("text")):
                content, places = _taken(pieces, pa.array(ids))
                spans = pairwise(ends.tolist())
                both = ((ids[a:b], content[places[a] : places[b]]) for a, b in spans)
                yield _digest_rows(batch.column("doc_id").slice(done, len(ends) - 1), both)
                done += len(ends) - 1

    return docs.select("doc_id", whole.alias("text")).mapInArrow(report, _digest_schema(docs))


def _packed(ids: Sequence[int]) -> bytes:
    return array("i", ids).tobytes()


def _rows(lists: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list array as views of its values; null rows are empty."""
    values = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    return (values[a:b] for a, b in pairwise(offsets))


def decode(ids: Column, docs: DataFrame, ranks: dict[bytes, int]) -> Column:
    """Bytes of an array of ids: the pieces, concatenated. Null has none; ids outside the
    vocabulary raise."""
    bound_batches(docs.sparkSession)
    pieces = docs.sparkSession.sparkContext.broadcast({rank: p for p, rank in ranks.items()})

    @F.arrow_udf("binary")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        piece = pieces.value.__getitem__
        for batch in batches:
            yield pa.array([b"".join(map(piece, row.tolist())) for row in _rows(batch)], pa.binary())

    return joined(F.coalesce(ids, F.array().cast("array<int>")))


def _digest_schema(docs: DataFrame) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _digest_rows(
    doc_ids: pa.Array, rows: Iterator[tuple[np.ndarray, bytes | np.ndarray]]
) -> pa.RecordBatch:
    """Counts and digests of documents' ids and of the bytes that they decode to."""
    counts, packed, decoded = [], [], []
    for ids, content in rows:
        counts.append(len(ids))
        packed.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
        decoded.append(hashlib.sha256(content).hexdigest())
    columns = [pa.array(counts, pa.int64()), pa.array(packed, pa.string())]
    return pa.RecordBatch.from_arrays(
        [doc_ids, *columns, pa.array(decoded, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def digests(coded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """`doc_id`, `n_tokens`, and SHA-256 (lowercase hexadecimal) of the ids as little-endian
    unsigned 32-bit integers and of the bytes they decode to. Null ids count as none."""
    bound_batches(coded.sparkSession)
    pieces = coded.sparkSession.sparkContext.broadcast({rank: p for p, rank in ranks.items()})

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces.value.__getitem__
        for batch in batches:
            rows = _rows(batch.column("ids"))
            both = ((row, b"".join(map(piece, row.tolist()))) for row in rows)
            yield _digest_rows(batch.column("doc_id"), both)

    picked = coded.select("doc_id", F.col(ids).alias("ids"))
    return picked.mapInArrow(report, _digest_schema(coded))
