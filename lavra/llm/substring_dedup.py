"""Removal of word passages that occur earlier in the corpus, by super-k-mer partitioning.

A window is a number of consecutive words; its minimiser is the smallest hash among the shorter
word runs in it. Consecutive windows with one minimiser travel as one packed string to the
minimiser's bucket, so equal windows always meet. There they are sorted by hash, compared word
by word, and all but the earliest are marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches, free_name, utf8_bytes
from lavra.runtime import bounded, materialize

WINDOW_WORDS = 20
MINIMISER_WORDS = 3

# Text that a task looks at together, packed text per bucket on average, and the text of
# distinct windows that one bucket may hold before it is split by window. Working memory is
# about 30 times these.
_GROUP_BYTES = 4 << 20
_BUCKET_BYTES = 3 << 20
_STATE_BYTES = 6 << 20
_SPLIT = 64
_PIECE_WORDS = 1 << 18

_EARLIEST = -(1 << 63)
_ROW = "bucket bigint, body binary, place bigint, mark bigint, start int, windows int"
_PACK_LEVEL = 6

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class Segments:
    """Word sequences in one buffer, each from a document's word `start` on.

    `text` joins the words of a sequence by spaces and the sequences by line breaks; `place`
    and `mark` name the documents.
    """

    def __init__(self, texts: list[bytes], place, mark, start):
        self.text = b"\n".join(texts)
        self.place = np.asarray(place, np.int64)
        self.mark = np.asarray(mark, np.int64)
        self.start = np.asarray(start, np.int32)

    def pack(self) -> bytes:
        parts = [
            np.int64(len(self.place)).tobytes(),
            np.diff(self.place, prepend=np.int64(0)).tobytes(),
            self.mark.tobytes(),
            self.start.tobytes(),
            self.text,
        ]
        body = b"".join(parts)
        packed = _codec().compress(body, asbytes=True)
        return len(body).to_bytes(8, "little") + packed

    @staticmethod
    def unpack(body: bytes) -> Segments:
        size = int.from_bytes(body[:8], "little")
        raw = _codec().decompress(body[8:], decompressed_size=size, asbytes=True)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        done = Segments([], [], [], [])
        done.place = np.cumsum(np.frombuffer(raw, np.int64, n, 8))
        done.mark = np.frombuffer(raw, np.int64, n, 8 + 8 * n)
        done.start = np.frombuffer(raw, np.int32, n, 8 + 16 * n)
        done.text = raw[8 + 20 * n :]
        return done

    @staticmethod
    def join(parts: list[Segments]) -> Segments:
        done = Segments([part.text for part in parts], [], [], [])
        for name in ("place", "mark", "start"):
            setattr(done, name, np.concatenate([getattr(part, name) for part in parts]))
        return done


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=_PACK_LEVEL)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _range_hashes(values: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """64-bit hash of values[first:after] for every range, from prefix sums modulo 2^64."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_FACTOR, len(values)), out=sums[1:])
    return _mixed((sums[after] - sums[first]) * _powers(_INVERSE, len(values) + 1)[first])


def _word_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, one byte of all words that are long enough at a time."""
    order = np.argsort(begin - end, kind="stable")
    begin, length = begin[order], (end - begin)[order]
    hashes = length.astype(np.uint64)
    going = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
    for step, n in enumerate(going.tolist()):
        hashes[:n] *= np.uint64(_FACTOR)
        hashes[:n] += codes[begin[:n] + step]
    placed = np.empty_like(hashes)
    placed[order] = _mixed(hashes)
    return placed


class Windows:
    """All windows of some segments, in the order of segment and start."""

    def __init__(self, segments: Segments, words: int, minimiser: int):
        self.segments, self.words, text = segments, words, segments.text
        codes = np.frombuffer(text, np.uint8)
        gaps = np.flatnonzero((codes == 32) | (codes == 10))
        self.begin = np.concatenate([[0], gaps + 1])
        self.end = np.concatenate([gaps, [len(codes)]])
        segment = np.concatenate([[0], np.cumsum(codes[gaps] == 10)])
        self.first_word = np.searchsorted(segment, np.arange(len(segments.place)))
        n = len(segment)
        starts = np.arange(max(0, n - words + 1))
        self.at = starts[segment[starts] == segment[starts + words - 1]] if n >= words else starts
        self.segment = segment[self.at]
        self.start = segments.start[self.segment] + (self.at - self.first_word[self.segment])
        self.place = segments.place[self.segment]
        hashes = _word_hashes(codes, self.begin, self.end)
        self.hash = _range_hashes(hashes, self.at, self.at + words)
        self.minimiser = minimiser
        self._word_hashes = hashes

    def bytes_of(self, i: int, j: int) -> bytes:
        """Text from window i to window j of the same segment."""
        return self.segments.text[self.begin[self.at[i]] : self.end[self.at[j] + self.words - 1]]

    def minimisers(self) -> np.ndarray:
        """Smallest hash of the word runs of each window."""
        n = len(self._word_hashes)
        least = _range_hashes(
            self._word_hashes,
            np.arange(n - self.minimiser + 1),
            np.arange(self.minimiser, n + 1),
        )
        # Minima over twice as many runs each time, then two that overlap.
        runs, covered = self.words - self.minimiser + 1, 1
        while 2 * covered <= runs:
            least = np.minimum(least[:-covered], least[covered:])
            covered *= 2
        if covered < runs:
            least = np.minimum(least[: covered - runs], least[runs - covered :])
        return least[self.at]

    def repeated(self) -> np.ndarray:
        """Whether the same words also stand in a window of smaller (place, start)."""
        marked = np.zeros(len(self.at), bool)
        order = np.argsort(self.hash, kind="stable")
        same = self.hash[order[1:]] == self.hash[order[:-1]]
        member = np.zeros(len(order), bool)
        member[1:] |= same
        member[:-1] |= same
        found = order[member]
        if not len(found):
            return marked
        found = found[np.lexsort((self.start[found], self.place[found], self.hash[found]))]
        head = np.concatenate([[True], self.hash[found[1:]] != self.hash[found[:-1]]])
        mate = np.empty(len(self.at), np.int64)
        mate[found] = found[np.flatnonzero(head)[np.cumsum(head) - 1]]
        later = found[
            (self.place[found] != self.place[mate[found]])
            | (self.start[found] != self.start[mate[found]])
        ]
        later.sort()
        if not len(later):
            return marked
        # Neighbouring windows with neighbouring mates are compared as one text.
        mates = mate[later]
        cut = np.flatnonzero(
            (np.diff(later) != 1)
            | (np.diff(mates) != 1)
            | (np.diff(self.segment[later]) != 0)
            | (np.diff(self.segment[mates]) != 0)
        )
        collided = set()
        for a, b in zip(
            np.concatenate([[0], cut + 1]).tolist(),
            np.concatenate([cut, [len(later) - 1]]).tolist(),
            strict=True,
        ):
            if self.bytes_of(later[a], later[b]) == self.bytes_of(mates[a], mates[b]):
                marked[later[a : b + 1]] = True
            else:
                collided.update(self.hash[later[a : b + 1]].tolist())
        if collided:
            self._compare_texts(found[np.isin(self.hash[found], list(collided))], marked)
        return marked

    def _compare_texts(self, found: np.ndarray, marked: np.ndarray) -> None:
        """The exact answer for windows whose hash stands for several texts."""
        earliest: dict[bytes, tuple[int, int]] = {}
        for i in found:
            key = (int(self.place[i]), int(self.start[i]))
            text = self.bytes_of(i, i)
            earliest[text] = min(key, earliest.get(text, key))
        for i in found:
            key = (int(self.place[i]), int(self.start[i]))
            marked[i] = key > earliest[self.bytes_of(i, i)]

    def runs(self, chosen: np.ndarray, *apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of every run of chosen neighbours; `apart` values end runs."""
        i = np.flatnonzero(chosen)
        if not len(i):
            return i, i
        cut = (np.diff(self.at[i]) != 1) | (np.diff(self.segment[i]) != 0)
        for values in apart:
            cut |= values[i[1:]] != values[i[:-1]]
        cut = np.flatnonzero(cut)
        return i[np.concatenate([[0], cut + 1])], i[np.concatenate([cut, [len(i) - 1]])]

    def cut_out(self, first: np.ndarray, last: np.ndarray) -> Segments:
        """The runs as segments of their own."""
        begin = self.begin[self.at[first]].tolist()
        end = self.end[self.at[last] + self.words - 1].tolist()
        text = self.segments.text
        texts = [text[a:b] for a, b in zip(begin, end, strict=True)]
        of = self.segment[first]
        return Segments(texts, self.place[first], self.segments.mark[of], self.start[first])


def _rows(found: list[tuple[int, bytes]] = (), marks: Segments | None = None, counts=()):
    """Output rows: packed texts for a bucket, or marked runs of windows."""
    n, m = len(found), len(counts)
    if not n + m:
        return []
    places = [None] * n + (marks.place.tolist() if m else [])
    ids = [None] * n + (marks.mark.tolist() if m else [])
    starts = [None] * n + (marks.start.tolist() if m else [])
    return [
        pa.RecordBatch.from_arrays(
            [
                # Marked runs travel with the packed texts, dealt by document.
                pa.array([b for b, _ in found] + [-1 - abs(p) for p in places[n:]], pa.int64()),
                pa.array([body for _, body in found] + [None] * m, pa.binary()),
                pa.array(places, pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(starts, pa.int32()),
                pa.array([None] * n + list(counts), pa.int32()),
            ],
            names=["bucket", "body", "place", "mark", "start", "windows"],
        )
    ]


def _marked_rows(windows: Windows, marked: np.ndarray):
    first, last = windows.runs(marked)
    found = Segments([], windows.place[first], [], windows.start[first])
    found.mark = windows.segments.mark[windows.segment[first]]
    return _rows(marks=found, counts=(last - first + 1).tolist())


def _dealt(windows: Windows, first: np.ndarray, last: np.ndarray, bucket: np.ndarray):
    """The runs, packed by bucket."""
    order = np.argsort(bucket, kind="stable")
    first, last, bucket = first[order], last[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    found = [
        (int(bucket[a]), windows.cut_out(first[a:b], last[a:b]).pack())
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)], strict=True)
        if a < b
    ]
    return _rows(found)


def _map_side(words: int, minimiser: int, buckets: int):
    """Documents (place, mark, text) to packed super-k-mers and repeats found on the way."""

    def look_at(texts: list[bytes], place: list[int], mark: list[int], start: list[int]):
        order = np.lexsort((start, place))
        windows = Windows(
            Segments(
                [texts[i] for i in order],
                [place[i] for i in order],
                [mark[i] for i in order],
                [start[i] for i in order],
            ),
            words,
            minimiser,
        )
        repeated = windows.repeated()
        yield from _marked_rows(windows, repeated)
        minimisers = windows.minimisers()
        first, last = windows.runs(~repeated, minimisers)
        bucket = (minimisers[first] % np.uint64(buckets)).astype(np.int64)
        yield from _dealt(windows, first, last, bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple[list, list, list, list] = ([], [], [], [])
        size = 0
        for batch in batches:
            columns = (batch.column(name) for name in ("place", "mark", "text"))
            for place, mark, text in zip(*columns, strict=True):
                if not text.is_valid:
                    continue
                found = text.as_py().encode().split()
                for lo in range(0, len(found) - words + 1, _PIECE_WORDS):
                    piece = b" ".join(found[lo : lo + _PIECE_WORDS + words - 1])
                    for values, value in zip(
                        group, (piece, place.as_py(), mark.as_py(), lo), strict=True
                    ):
                        values.append(value)
                    size += len(piece)
                    if size >= _GROUP_BYTES:
                        yield from look_at(*group)
                        group, size = ([], [], [], []), 0
        if size:
            yield from look_at(*group)

    return run


def _bucket_side(words: int, minimiser: int, modulus: int):
    """Sorted buckets to marked repeats. Windows seen so far are kept once; a bucket with too
    many distinct ones hands them on, window by window, to smaller buckets (`modulus` of
    them in all; 0 hands nothing on)."""

    def sift(parts: list[Segments]) -> tuple[Windows, np.ndarray]:
        windows = Windows(Segments.join(parts), words, minimiser)
        return windows, windows.repeated()

    def handed_on(windows: Windows, left: np.ndarray):
        each = np.flatnonzero(left)
        bucket = (windows.hash[each] % np.uint64(modulus)).astype(np.int64)
        return _dealt(windows, each, each, bucket)

    def of_bucket(bodies: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
        parts, size, kept, full = [], 0, 0, False
        for body in bodies:
            parts.append(Segments.unpack(body))
            size += len(parts[-1].text)
            if size - kept >= max(_GROUP_BYTES, kept):
                windows, repeated = sift(parts)
                yield from _marked_rows(windows, repeated)
                state = windows.cut_out(*windows.runs(~repeated))
                size = kept = len(state.text)
                full = full or (modulus and size > _STATE_BYTES and (~repeated).sum() > 1)
                if full:
                    yield from handed_on(windows, ~repeated)
                    parts, size, kept = [], 0, 0
                else:
                    parts = [state]
        if parts:
            windows, repeated = sift(parts)
            yield from _marked_rows(windows, repeated)
            if full:
                yield from handed_on(windows, ~repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted: marked runs have negative buckets and pass through.
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            marks = batch.filter(pc.is_null(batch.column("body")))
            if marks.num_rows:
                yield marks
            if marks.num_rows < batch.num_rows:
                rest.append(batch)
                break
        packed = (
            (bucket.as_py(), body.as_py())
            for batch in chain(rest, batches)
            for bucket, body in zip(batch.column("bucket"), batch.column("body"), strict=True)
            if body.is_valid
        )
        for _, rows in groupby(packed, itemgetter(0)):
            yield from of_bucket(body for _, body in rows)

    return run


def repeated_windows(
    docs: DataFrame, words: int = WINDOW_WORDS, minimiser: int = MINIMISER_WORDS
) -> DataFrame:
    """Runs (`place`, `mark`, `start`, `windows`) of windows that also start earlier, from
    `docs` (`place`, `mark`, `text`)."""
    if not 1 <= minimiser <= words:
        raise ValueError("a minimiser has 1 to `words` words")
    bound_batches(docs.sparkSession)
    size = docs.agg(F.sum(utf8_bytes(F.col("text")))).first()[0] or 0
    buckets = max(1, 3 * size // _BUCKET_BYTES)
    dealt = docs.mapInArrow(_map_side(words, minimiser, buckets), _ROW)
    modulus, marks = buckets, []
    while True:
        modulus = modulus * _SPLIT if modulus < 1 << 40 else 0
        sorted_rows = dealt.repartition("bucket").sortWithinPartitions("bucket")
        step = sorted_rows.mapInArrow(_bucket_side(words, minimiser, modulus), _ROW)
        step = materialize(step, "windows")
        marks.append(step.where("body is null"))
        dealt = step.where("body is not null")
        if dealt.isEmpty():
            break
    return reduce(DataFrame.unionByName, marks).select("place", "mark", "start", "windows")


def _keep(words: int):
    def kept(text: str | None, runs) -> tuple[str | None, int, int]:
        if text is None:
            return None, 0, 0
        found = text.encode().split()
        left = np.ones(len(found), bool)
        for run in runs or ():
            left[run["start"] : run["start"] + run["windows"] + words - 1] = False
        rest = b" ".join([found[i] for i in np.flatnonzero(left)])
        return rest.decode(), len(found), len(found) - int(left.sum())

    return kept


def remove_repeats(
    docs: DataFrame, words: int = WINDOW_WORDS, minimiser: int = MINIMISER_WORDS
) -> DataFrame:
    """`docs` with `text` without the words of repeated windows, joined by one space, and
    with `n_words` and `n_removed`; columns of these names are replaced.

    A window repeats if its words also start at a smaller (`doc_id`, start) in the input; a
    null id counts as the smallest. Rows that share an id do not come before one another at the
    same start, so repeated rows are treated alike. Texts shorter than a window lose nothing,
    and null texts stay null with 0 words.
    """
    place, mark, runs, of = (free_name(docs, name) for name in ("place", "mark", "runs", "of"))
    # Only ids that repeat need the text to tell their rows apart.
    shared = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(of))
    shared = bounded(materialize(shared.withColumn(mark, F.lit(True)), "shared_ids"))
    text_mark = F.when(F.col(mark), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))
    named = (
        docs.join(shared, F.col("doc_id").eqNullSafe(F.col(of)), "left")
        .drop(of)
        .withColumns(
            {
                place: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_EARLIEST)),
                mark: text_mark,
            }
        )
    )
    marks = repeated_windows(
        named.select(F.col(place).alias("place"), F.col(mark).alias("mark"), "text"),
        words,
        minimiser,
    )
    per_doc = marks.groupBy(F.col("place").alias(place), F.col("mark").alias(mark)).agg(
        F.collect_list(F.struct("start", "windows")).alias(runs)
    )
    return _cut(named.join(per_doc, [place, mark], "left"), words, runs).drop(place, mark, runs)


def _cut(joined: DataFrame, words: int, runs: str) -> DataFrame:
    kept = _keep(words)
    done = free_name(joined, "done")

    @F.arrow_udf("struct<text:string,n_words:bigint,n_removed:bigint>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            rows = [kept(t.as_py(), r.as_py()) for t, r in zip(texts, found, strict=True)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            types = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.StructArray.from_arrays(arrays, ["text", "n_words", "n_removed"])

    result: Column = F.col(done)
    return (
        joined.withColumn(done, cut(F.col("text"), F.col(runs)))
        .withColumns({name: result[name] for name in ("text", "n_words", "n_removed")})
        .drop(done)
    )
